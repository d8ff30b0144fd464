"""Checks of a table against its declared constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..warehouse.schema import TABLES, Table
from ..warehouse.store import Warehouse

REPORT = "table_name string, rule string, violations bigint"


def _row_rules(table: Table) -> dict[str, str]:
    rules = {f"not null: {c}": f"{c} IS NULL" for c in table.required}
    rules |= {f"length: {c} <= {n}": f"length({c}) > {n}" for c, n in table.lengths.items()}
    rules |= {f"check: {name}": f"NOT ({condition})" for name, condition in table.checks.items()}
    if table.max_id:
        rules[f"sequence: {table.primary} <= {table.max_id}"] = f"{table.primary} > {table.max_id}"
    return rules


def audit(df: DataFrame, name: str) -> DataFrame:
    """(table_name, rule, violations) for every constraint of the table.

    Row rules are counted in one pass. A uniqueness rule counts keys that occur
    more than once; a key with a null part is unique by definition, but for the
    primary key.
    """
    table = TABLES[name]
    rules = _row_rules(table)
    spark = df.sparkSession
    counts = df.agg(
        F.map_from_arrays(
            F.array(*[F.lit(r) for r in rules]),
            F.array(*[F.count_if(F.expr(c)) for c in rules.values()]),
        ).alias("found")
    ).select(F.explode("found").alias("rule", "violations"))
    parts = [counts] if rules else [spark.createDataFrame([], "rule string, violations bigint")]
    keys = [(table.primary,)] if table.primary else []
    for key in [*keys, *table.unique]:
        whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key))
        repeated = df.filter(whole).groupBy(*key).count().filter("count > 1")
        rule = f"unique: {', '.join(key)}"
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(rule).alias("rule"), "violations"
            )
        )
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(name).alias("table_name"), "rule", F.col("violations").cast("bigint")
    )


def repeated_keys(wh: Warehouse, batch_id: int) -> list[tuple[str, str, int]]:
    """(table, key, number) of unique keys that a batch breaks, within itself or with
    what is visible.

    Only tables the batch grew are looked at, in one scan each, and of them 128 bits
    a key, all in one aggregation. Ids of a sequence go on from the log and need no
    look.
    """
    grown = {e["table_name"] for e in wh.written(batch_id) if e["no_rows"]}
    parts = []
    for name in sorted(grown):
        table = TABLES[name]
        own = [(table.primary,)] if table.primary and not table.max_id else []
        keys = [
            F.when(
                reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key)),
                F.struct(
                    F.lit(name).alias("table_name"), F.lit(", ".join(key)).alias("key"),
                    F.xxhash64(*key).alias("a"), F.xxhash64(F.lit(1), *key).alias("b"),
                ),
            )
            for key in [*own, *table.unique]
        ]
        if keys:
            rows = wh.table(name, batch_id).select(F.explode(F.array_compact(F.array(*keys))).alias("k"))
            parts.append(rows.select("k.*"))
    if not parts:
        return []
    counted = reduce(DataFrame.unionAll, parts).groupBy("table_name", "key", "a", "b").count()
    broken = counted.filter("count > 1").groupBy("table_name", "key").agg(F.count(F.lit(1)).alias("n"))
    return [(r["table_name"], r["key"], r["n"]) for r in broken.collect()]  # a row a rule
