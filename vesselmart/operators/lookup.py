"""Null-safe look-ups that stand a hot key.

A small dimension is broadcast after its size is checked. Beyond that size, the
most frequent keys are answered from a broadcast of just those keys, whether the
dimension has them or not, and their rows are salted over the shuffle of the
remaining join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEYS = 256  # most frequent keys that are answered from a broadcast
SALTS = 1024
EXPANSION = 4  # memory a broadcast row takes against its compressed size on disk


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which the session lets a side be broadcast."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(float(text[:-1]) * units[text[-1]]) if text[-1:] in units else int(text)


def fits_broadcast(spark: SparkSession, disk_bytes: int) -> bool:
    return disk_bytes * EXPANSION <= broadcast_limit(spark)


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality over (left, right) column names in which null equals null."""
    return reduce(
        lambda a, b: a & b, (left[lc].eqNullSafe(right[rc]) for lc, rc in pairs)
    )


def new_members(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate rows whose key is not yet in the dimension."""
    known = existing.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return candidates.join(
        known, null_safe(candidates, known, [(k, f"__{k}") for k in keys]), "left_anti"
    )


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The ``HOT_KEYS`` most frequent keys of ``df``, null parts included."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    order = [F.desc("__n"), *[F.col(k).asc_nulls_first() for k in keys]]
    return counts.orderBy(*order).limit(HOT_KEYS).drop("__n")


def lookup(
    df: DataFrame, dim: DataFrame, keys: dict[str, str], value: str, out: str, *,
    dim_bytes: int, row_id: str, counted: DataFrame | None = None, how: str = "left",
) -> DataFrame:
    """Add the dimension's ``value`` as ``out``; ``keys`` maps df columns to dim columns.

    ``dim_bytes`` is the dimension's size on disk and ``row_id`` a column that is
    (nearly) unique in ``df``. Hot keys are found in ``counted`` (default: ``df``);
    in a chain of look-ups, give the rows from before the chain, so that the plan
    does not contain the chain again for every look-up.
    """
    spark = df.sparkSession
    renamed = {f"__key{n}": c for n, c in enumerate(keys.values())}
    small = dim.select(*[F.col(c).alias(k) for k, c in renamed.items()], F.col(value).alias("__value"))
    pairs = list(zip(keys, renamed))
    if fits_broadcast(spark, dim_bytes):
        small = small.withColumnRenamed("__value", out)
        df = df.drop(out)
        return df.join(F.broadcast(small), null_safe(df, small, pairs), how).drop(*renamed)

    hot = hot_keys(df if counted is None else counted, list(keys)).select(
        *[F.col(a).alias(f"__hot_{k}") for a, k in pairs]
    )
    hot_pairs = [(f"__hot_{k}", k) for k in renamed]
    # at most HOT_KEYS rows by construction, whatever the dimension's size
    known = small.join(F.broadcast(hot), null_safe(small, hot, [(k, h) for h, k in hot_pairs])).select(
        *renamed, F.col("__value").alias("__hot_value")
    )
    answers = hot.join(F.broadcast(known), null_safe(hot, known, hot_pairs), "left").select(
        *[h for h, _ in hot_pairs], "__hot_value", F.lit(True).alias("__is_hot")
    )
    marked = df.join(
        F.broadcast(answers), null_safe(df, answers, [(a, f"__hot_{k}") for a, k in pairs]), "left"
    ).drop(*[h for h, _ in hot_pairs])
    # hot rows are answered, also by "none": they carry a salt no dimension row
    # has, so they spread over the shuffle and stay unmatched
    spread = F.pmod(F.xxhash64(row_id), F.lit(SALTS)) + 1
    marked = marked.withColumn("__salt", F.when(F.col("__is_hot"), spread).otherwise(0))
    # always 0, but not a constant: the optimiser would turn the equality with a
    # constant into a filter and partition by the key alone
    small = small.withColumn("__cold", F.pmod(F.xxhash64(*renamed), F.lit(1).cast("bigint")))
    found = marked.join(
        small.hint("merge"),
        null_safe(marked, small, pairs) & (marked["__salt"] == small["__cold"]), "left",
    ).withColumn(out, F.coalesce("__hot_value", "__value"))
    if how == "inner":
        found = found.filter(F.col(out).isNotNull())
    return found.drop(*renamed, "__value", "__hot_value", "__is_hot", "__salt", "__cold")
