"""Quality rules with robust multivariate outliers, built-in functions only.

Base rules fail a document of fewer than 50 words or with more than half of its
words in repeated three-word windows. The rest are judged by a vector of six
transformed statistics (``FEATURES``). Per language and source, the minimum
covariance determinant gives a centre and a covariance that outliers cannot
move: from medians and quartiles on, concentration steps take the half of the
documents nearest to the centre and estimate anew from them; a last estimate
takes all within the 97.5 % quantile. A document is rejected whose squared
Mahalanobis distance from its group exceeds ``cut``.

Groups of fewer than ``MIN_GROUP`` documents are judged by an estimate over all
documents of their language, those of its larger groups included. Languages that
have fewer in all are pooled; a pool still smaller rejects nothing.

Statistics are whole multiples of 1/4096 and are summed exactly, and quantiles
come from counts by bin, so results do not depend on how rows are partitioned.
No group meets in one task: every step is an aggregation with partial sums, and
what is joined back is one row a group. Tables of the groups are broadcast while
they are below ``FEW_GROUPS`` rows, counted each time, else joined by a shuffle
(whose hot keys adaptive execution splits).

Defined results: a null text has no words and fails the base; null languages
and sources are groups of their own; equal documents get equal verdicts; other
columns of ``documents`` are not read by ``judge`` (``keep`` carries them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised, without_ids, word_array

FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeated", "capitals")
#: Least standard deviation of each statistic, so that one that is constant
#: among ordinary documents does not make every other value an outlier.
FLOOR = (0.25, 0.25, 0.1, 0.05, 0.05, 0.05)
SCALE = 4096
MIN_GROUP = 60
FEW_GROUPS = 50_000
STEPS = 4
#: Squared distance beyond which a document is rejected: far above the 1 - 1e-9
#: quantile of chi-square with six degrees of freedom (56), since ordinary
#: statistics have longer tails than the normal distribution.
CUT = 120.0
P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def base(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed) with lines and capitals counted besides.

    Write the result before filtering by it: a filter would be moved down and
    repeat the counting for every use."""
    text = F.coalesce("text", F.lit(""))
    solid = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = documents.select(
        "doc_id", "lang", "source", word_array(F.col("text")).alias("words"), solid.alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )
    n = F.size("words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
            lambda i: F.xxhash64(
                F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        "doc_id", "lang", "source", n.cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"), "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # windows found twice, in the order of their hash; most documents have none
    placed = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(
            F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    df = df.withColumn("placed", placed).drop("windows")

    def twin(x: Column, k: Column) -> Column:
        same = [F.coalesce(F.get("placed", k + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
        return same[0] | same[1]

    starts = F.sort_array(F.transform(F.filter("placed", twin), lambda x: x["i"]))
    df = df.withColumn("starts", starts).drop("placed")
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda s, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - s, F.lit(3))),
        ),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    df = df.withColumn("n_repeat_words", covered).drop("starts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def statistics(df: DataFrame) -> list[Column]:
    """The transformed statistics, as whole multiples of 1 / SCALE."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = [
        F.log1p("n_words"), F.col("word_chars") / words, F.log1p(10 * F.col("n_symbols") / words),
        F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), F.col("n_repeat_words") / words,
        F.col("n_capitals") / F.greatest("word_chars", F.lit(1)),
    ]
    # far beyond the range of ordinary documents distances need not grow
    return [
        F.round(F.least(v, F.lit(64.0)) * SCALE).cast("long").alias(name)
        for v, name in zip(values, FEATURES)
    ]


def _chi_square(x: float, half: int) -> float:
    """Distribution function with 2 * half degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def _quantile(p: float, half: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, half) < p else (low, middle)
    return low


def _few(groups: DataFrame) -> bool:
    return groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS


def _join_groups(df: DataFrame, groups: DataFrame, on: list[str], few: bool) -> DataFrame:
    """Join one row a group; broadcast only if the groups were counted to be few."""
    return df.join(F.broadcast(groups) if few else groups, on)


def _with_group(df: DataFrame) -> DataFrame:
    """Adds ``pool``, whose estimate a row counts in, and ``judged``, whether by it.

    That is language and source, or for small groups the language or all small
    languages. Where a language is needed, the rows of its large groups come a
    second time for its estimate, not to be judged by it.
    """
    sized = df.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n"))
    of_lang = sized.groupBy("lang_key").agg(
        F.sum("n").alias("all_n"), F.min("n").alias("least_n")
    )
    sized = sized.join(of_lang, "lang_key")
    own, lang = F.to_json(F.struct("lang_key", "source_key")), F.to_json(F.struct("lang_key"))
    large = F.col("n") >= MIN_GROUP

    def entry(pool: Column, judged: bool) -> Column:
        return F.struct(pool.alias("pool"), F.lit(judged).alias("judged"))

    entries = (
        F.when(large & (F.col("least_n") < MIN_GROUP), F.array(entry(own, True), entry(lang, False)))
        .when(large, F.array(entry(own, True)))
        .when(F.col("all_n") >= MIN_GROUP, F.array(entry(lang, True)))
        .otherwise(F.array(entry(F.lit("all"), True)))
    )
    groups = materialised(sized.select("lang_key", "source_key", F.inline(entries)), "pools")
    return _join_groups(df, groups, ["lang_key", "source_key"], _few(groups))


def _params(sums: DataFrame, factor: float) -> DataFrame:
    """Centre and Cholesky factor of each pool from its exact sums."""
    mean = {i: F.col(f"s{i}").cast("double") / F.col("n") for i in range(P)}
    df = sums.select("pool", "n", *[f"s{i}" for i in range(P)], *[f"s{i}_{j}" for i, j in PAIRS])
    df = df.select("pool", *[f"s{i}_{j}" for i, j in PAIRS], "n", *[mean[i].alias(f"m{i}") for i in range(P)])
    for i, j in PAIRS:
        cov = (F.col(f"s{i}_{j}").cast("double") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * factor
        if i == j:
            cov = F.greatest(cov, F.lit(0.0)) + F.lit(float((FLOOR[i] * SCALE) ** 2))
        df = df.withColumn(f"c{i}_{j}", cov)
    for i in range(P):
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            value = (
                F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / F.col(f"l{j}_{j}")
            )
            df = df.withColumn(f"l{i}_{j}", value)
    return df.select("pool", *[f"m{i}" for i in range(P)], *[f"l{i}_{j}" for i, j in PAIRS])


def _distance(df: DataFrame, params: DataFrame, few: bool) -> DataFrame:
    """``df`` with the squared Mahalanobis distance ``d2`` from its pool."""
    kept = df.columns
    df = _join_groups(df, params, ["pool"], few)
    total = F.lit(0.0)
    for i in range(P):
        y = F.col(FEATURES[i]) - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}_{k}") * F.col(f"y{k}")
        df = df.withColumn(f"y{i}", y / F.col(f"l{i}_{i}"))
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return df.select(*kept, total.alias("d2"))


def _sums(df: DataFrame) -> DataFrame:
    exact = "decimal(38,0)"
    return df.groupBy("pool").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(FEATURES[i])).alias(f"s{i}") for i in range(P)],
        *[
            F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(20,0)")).cast(exact).alias(f"s{i}_{j}")
            for i, j in PAIRS
        ],
    )


def _quantile_bins(df: DataFrame, keys: list[str], shares: tuple[float, ...]) -> DataFrame:
    """Per key, the lowest ``bin`` at or below which each share of the rows lies."""
    counted = df.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*keys)
    upto = F.sum("n").over(whole.orderBy("bin"))
    counted = counted.select(*keys, "bin", upto.alias("upto"), F.sum("n").over(whole).alias("total"))
    return counted.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("upto") >= F.col("total") * share, F.col("bin"))).alias(f"q{k}")
            for k, share in enumerate(shares)
        ]
    )


def _start(df: DataFrame) -> DataFrame:
    """Medians, and standard deviations from quartiles, without correlations."""
    long = df.select(
        "pool", F.posexplode(F.array(*[F.floor(F.col(f) / 16) for f in FEATURES])).alias("f", "bin")
    )
    q = _quantile_bins(long, ["pool", "f"], (0.25, 0.5, 0.75))
    at = [F.when(F.col("f") == i, F.col("q1") * 16.0 + 8) for i in range(P)]
    spread = [F.when(F.col("f") == i, (F.col("q2") - F.col("q0")) * 16 / 1.349) for i in range(P)]
    wide = q.groupBy("pool").agg(
        *[F.max(at[i]).alias(f"m{i}") for i in range(P)], *[F.max(spread[i]).alias(f"w{i}") for i in range(P)]
    )
    return wide.select(
        "pool", *[f"m{i}" for i in range(P)],
        *[
            (
                F.sqrt(F.col(f"w{i}") * F.col(f"w{i}") + F.lit(float((FLOOR[i] * SCALE) ** 2)))
                if i == j else F.lit(0.0)
            ).alias(f"l{i}_{j}")
            for i, j in PAIRS
        ],
    )


def _bin(d2: Column) -> Column:
    """Distances in bins of about two per cent, the smallest together."""
    return F.floor(F.log2(F.greatest(d2, F.lit(1e-3))) * 32)


def robust_params(df: DataFrame, few: bool) -> DataFrame:
    """Centre and Cholesky factor of each pool by minimum covariance determinant."""
    params = materialised(_start(df), "mcd")
    half = P // 2
    middle = _quantile(0.5, half)
    for _ in range(STEPS):
        near = _distance(df, params, few).withColumn("bin", _bin(F.col("d2")))
        limits = materialised(_quantile_bins(near, ["pool"], (0.5,)), "mcd")
        inside = _join_groups(near, limits, ["pool"], few).filter(F.col("bin") <= F.col("q0"))
        # the covariance of the nearer half of a normal sample, scaled to the whole
        params = materialised(_params(_sums(inside), 0.5 / _chi_square(middle, half + 1)), "mcd")
    edge = _quantile(0.975, half)
    inside = _distance(df, params, few).filter(F.col("d2") <= edge)
    return materialised(_params(_sums(inside), 0.975 / _chi_square(edge, half + 1)), "mcd")


def judge(documents: DataFrame, cut: float = CUT) -> DataFrame:
    """(doc_id, n_words, base counts, base_failed, kept, distance) of every document."""
    counts = base(documents)
    # one value for null, another for every string
    key = {c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("lang", "source")}
    rows = counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", key["lang"].alias("lang_key"), key["source"].alias("source_key"), *statistics(counts),
    )
    rows = materialised(rows, "statistics")
    failed = rows.filter("base_failed").withColumn("distance", F.lit(None).cast("double"))
    sound = rows.filter("NOT base_failed")
    pooled = materialised(_with_group(sound), "pooled")
    sizes = materialised(pooled.groupBy("pool").agg(F.count(F.lit(1)).alias("size")), "pools")
    few = _few(sizes)
    params = robust_params(pooled, few)
    # pools too small for an estimate get no row here, and so no distance
    params = params.join(sizes.filter(F.col("size") >= MIN_GROUP).select("pool"), "pool")
    pooled = pooled.filter("judged")
    judged = _distance(pooled, params, few)
    rest = _join_groups(pooled, sizes.filter(F.col("size") < MIN_GROUP).drop("size"), ["pool"], few)
    rest = rest.withColumn("d2", F.lit(None).cast("double"))
    columns = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    ]
    every = failed.select(*columns, "distance").unionByName(
        judged.select(*columns, F.col("d2").alias("distance"))
    ).unionByName(rest.select(*columns, F.col("d2").alias("distance")))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)
    return every.select(*columns, kept.alias("kept"), F.round("distance", 3).alias("distance"))


def keep(documents: DataFrame, cut: float = CUT) -> DataFrame:
    """``documents`` without those rejected, all columns kept; rows that share an
    id go together if one of them is rejected."""
    return without_ids(documents, judge(documents, cut).filter("NOT kept"))
