from .ledger import LoadError, LoadScope
from .store import Warehouse

__all__ = ["LoadError", "LoadScope", "Warehouse"]
