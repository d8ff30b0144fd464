"""All registered queries."""

from . import grids, keys, loads, shapes
from .registry import ORACLES, QUERIES
