"""Dimensions as parameters of one generic load."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..warehouse.schema import CONFIG_COLUMNS, GEOM_COLUMNS, STOP_EXTRA, TABLES, TRAJ_EXTRA
from ..warehouse.store import Warehouse
from . import expanders
from .lookup import lookup
from .merge import FIRST_LOAD, merge_keys, merge_smart, merge_surrogate

logger = logging.getLogger(__name__)

Processor = Callable[[DataFrame, dict[str, str]], DataFrame]
Names = dict[str, str]


@dataclass(frozen=True)
class Dimension:
    """A dimension table with its keys and the way it takes in new rows.

    ``strategy(warehouse, batch_id, rows, dimension)`` may be any callable, and
    so may each processor ``(batch, names) -> batch``.
    """

    table: str
    keys: list[str]
    attributes: list[str]
    surrogate: str | None = None
    processors: tuple[Processor, ...] = ()
    strategy: Callable = merge_surrogate

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.attributes]

    @property
    def is_text(self) -> bool:
        """One text behind a sequence, taken in as it stands."""
        return (
            self.strategy is merge_surrogate and len(self.keys) == 1 and not self.attributes
            and not self.processors and TABLES[self.table].schema[self.keys[0]].dataType == StringType()
        )

    @property
    def is_derived(self) -> bool:
        """A single smart key from which processors make everything else."""
        return self.strategy is merge_smart and len(self.keys) == 1 and bool(self.processors)

    def names(self, overrides: Names) -> Names:
        """Dimension column -> batch column; what is not overridden keeps its name."""
        return {**{c: c for c in self.columns}, **overrides}

    def process(self, batch: DataFrame, names: Names) -> DataFrame:
        for processor in self.processors:
            batch = processor(batch, names)
        return batch

    def candidates(self, batch: DataFrame, roles: Sequence[Names]) -> DataFrame:
        """Rows the batch offers, over all roles the dimension plays in it, each with
        the first load (``FIRST_LOAD``) that brings it; 0 where loads are not told."""
        parts = []
        for overrides in roles:
            names = self.names(overrides)
            rows = self.process(batch, names)
            load = F.col("load_id") if "load_id" in rows.columns else F.lit(0)
            parts.append(
                rows.select(*[F.col(names[c]).alias(c) for c in self.columns], load.cast("bigint").alias(FIRST_LOAD))
            )
        every = reduce(DataFrame.unionByName, parts)
        return every.groupBy(*self.columns).agg(F.min(FIRST_LOAD).alias(FIRST_LOAD))


def _smart(
    table: str, attributes: Sequence[str], processors: tuple[Processor, ...] = ()
) -> Dimension:
    key = TABLES[table].primary
    return Dimension(table, [key], list(attributes), None, processors, merge_smart)


def _merged(table: str, keys: Sequence[str], attributes: Sequence[str] = ()) -> Dimension:
    return Dimension(table, list(keys), list(attributes), TABLES[table].primary)


DATE = _smart(
    "date_dim",
    ["year_no", "month_no", "day_no", "week_no", "weekday_no", "quarter_no", "iso_date",
     "month_name"],
    (expanders.expand_date_ids,),
)
TIME = _smart(
    "time_dim", ["hour_no", "minute_no", "second_no", "fifteen_min_no", "five_min_no"],
    (expanders.expand_time_ids,),
)
COUNTRY = _smart(
    "country_dim",
    ["alpha3", "country_name", "country_code", "region", "sub_region", "intermediate_region",
     "region_code", "sub_region_code", "intermediate_region_code"],
)
TRANSPONDER_TYPE = _merged("transponder_type_dim", ["transponder_type"])
VESSEL_TYPE = _merged("vessel_type_dim", ["vessel_type"])
VESSEL_NAME = _merged("vessel_name_dim", ["vessel_name"])
POS_TYPE = _merged("pos_type_dim", ["pos_type"])
CARGO_TYPE = _merged("cargo_type_dim", ["cargo_type"])
CALL_SIGN = _merged("call_sign_dim", ["call_sign"])
DESTINATION = _merged("destination_dim", ["org_msg"])
NAV_STATUS = _merged("nav_status_dim", ["nav_status"])
TRAJ_TYPE = _merged("traj_type_dim", ["traj_type"])
STATE_CHANGE = _merged("traj_state_change_dim", ["state_change"])
VESSEL = _merged(
    "vessel_dim", ["mmsi", "imo"],
    ["mid", "radio_service_type", "is_valid_mmsi", "is_valid_imo", "in_eu_mrv_db"],
)
VESSEL_CONFIG = _merged("vessel_config_dim", CONFIG_COLUMNS)
TRAJ_GEOM = Dimension(
    "traj_geom_dim", ["ais_traj_id"], [*GEOM_COLUMNS, *TRAJ_EXTRA], "geom_id",
    (expanders.expand_traj_geometry,),
)
STOP_GEOM = Dimension(
    "stop_geom_dim", ["ais_stop_id"], [*GEOM_COLUMNS, *STOP_EXTRA], "geom_id",
    (expanders.expand_stop_geometry,),
)


def load_dimension(
    wh: Warehouse, batch_id: int, batch: DataFrame, dim: Dimension,
    roles: Sequence[Names] = ({},),
) -> None:
    """Take the batch's new members into the dimension, all roles at once."""
    start = time.perf_counter()
    rows = dim.candidates(batch, roles)
    if dim.strategy not in (merge_smart, merge_surrogate):
        rows = rows.drop(FIRST_LOAD)  # a strategy of the user's own gets the dimension's columns
    dim.strategy(wh, batch_id, rows, dim)
    logger.info("%s took in new members in %.2fs", dim.table, time.perf_counter() - start)


def load_keys(
    wh: Warehouse, batch_id: int, batch: DataFrame, roles: Sequence[tuple[Dimension, Sequence[Names]]]
) -> None:
    """Take the batch's new members into dimensions of a single key, in one pass.

    The dimensions are texts behind a sequence, or derived from their key.
    """
    start = time.perf_counter()
    values = [
        F.struct(F.lit(d.table).alias("dimension"), F.col(d.names(names)[d.keys[0]]).cast("string").alias("value"))
        for d, some in roles for names in some
    ]
    offered = batch.select(F.explode(F.array(*values)).alias("v")).select("v.*")
    merge_keys(wh, batch_id, offered, [d for d, _ in roles])
    logger.info("%d dimensions took in new members in %.2fs", len(roles), time.perf_counter() - start)


def attach_surrogate(
    wh: Warehouse, batch_id: int | None, batch: DataFrame, dim: Dimension, role: Names, *,
    row_id: str, counted: DataFrame | None = None, how: str = "left",
    members: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """Add the dimension's surrogate to the batch, under the role's name for it.

    ``counted`` holds the same keys and tells which are hot. ``members`` are the
    dimension's rows and its bytes on disk, if they are at hand.
    """
    names = dim.names(role)
    rows, size = members or (wh.table(dim.table, batch_id), wh.bytes(dim.table, batch_id))
    return lookup(
        batch, rows, {names[k]: k for k in dim.keys}, dim.surrogate,
        role.get(dim.surrogate, dim.surrogate), dim_bytes=size,
        row_id=row_id, counted=counted, how=how,
    )
