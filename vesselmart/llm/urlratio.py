"""URL filter by the ratio of two character language models.

Explicit rules (host and path prefix, allow or block) decide first. URLs that a
rule decides are also the training material: one variable-order Markov model
for accepted URLs, one for rejected ones. For every other URL the two
log-likelihoods are compared,

    ratio = (log P(url | accepted) - log P(url | rejected)) / (length + 1),

and the URL is blocked when the ratio is below a threshold calibrated on a fifth
of the ruled URLs that the models have not seen.

What rules look at would give the answer away, so it is taken off every URL
alike, in training, calibration and judging (``compared``): the top label of the
host, the labels before it where a rule names them at that place, and as many
leading directories of the path as the deepest rule names.

Smoothing is interpolation by the number of different followers of a context
(Witten-Bell), from order ``ORDER`` down to single bytes and then to equal
chances of 256 bytes and the end. Contexts are exact: a context and the byte
after it are packed into one whole number, and the counts are tables of Spark
that grow with the URLs.

1. Strings are made distinct; each gives its different grams (a byte and the
   four before it) with how often they occur.
2. Grams are counted over all strings; every shorter context gets its counts
   from them. A context holds 257 followers at most.
3. Each different gram looks up its five contexts once and folds them into the
   difference of the two logarithms. Contexts of order 0 and 1 (259 rows at
   most) are broadcast; a longer one is asked for by different grams only.
4. Strings add up the differences of their grams, as whole multiples of
   1 / ``SCALE``, so that the sum does not depend on its order. The ``HOT`` most
   frequent grams are answered from a broadcast, so that no key of the join has
   more than one in ``HOT`` of all rows. Pages look up their string likewise.

Defined results: null URLs and URLs without ``://`` have empty host and path; an
empty string has ratio 0 and is allowed. Without both accepted and rejected
training URLs nothing is blocked by ratio. Of rules of one length the first in
text order wins. Repeated URLs count as often as they occur, repeated page ids
are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, materialised

ORDER = 4
#: Bits of a symbol: 0 marks the start, 1 to 256 are bytes, END the end.
BITS, END = 9, 257
#: Bytes of strings whose grams a task makes at a time.
SLICE = 1 << 18
#: Grams, and strings, that are answered from a broadcast.
HOT, HOT_STRINGS = 4096, 256
#: Whole numbers in one unit of a logarithm.
SCALE = 1 << 32
#: One ruled string in so many calibrates the threshold instead of being counted.
HELD = 5
#: Calibration bins per nat, and the largest ratio told apart.
FINE, LARGEST = 256, 8


def host(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, upper, upper.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host_: Column, path_: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. A rule is "host/path-prefix"."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        name, _, rest = rule.partition("/")
        fits = (host_ == name) | host_.endswith("." + name)
        out = F.when(fits & path_.startswith("/" + rest), F.lit(rule)).otherwise(out)
    return out


def compared(host_: Column, path_: Column, rules: dict[str, str]) -> Column:
    """What is left of a URL without the parts that rules look at."""
    hosts = [rule.split("/", 1)[0].split(".")[::-1] for rule in rules]
    named = ""
    for place in range(max(map(len, hosts), default=1) - 1, 0, -1):
        labels = "|".join(rf"\Q{h}\E" for h in sorted({h[place] for h in hosts if len(h) > place}))
        named = rf"(?:{named}(?:{labels})\.)?"
    deepest = max((len([d for d in rule.split("/")[1:] if d]) for rule in rules), default=0)
    return F.concat(
        F.regexp_replace(host_, rf"(?:^|\.){named}[^.]*\z", ""),
        F.regexp_replace(path_, rf"\A(?:/[^/]*+(?=/)){{0,{deepest}}}", ""),
    )


def _grams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of a string and how often each occurs."""
    body = np.frombuffer(text, np.uint8).astype(np.int64) + 1
    symbols = np.concatenate([np.zeros(ORDER, np.int64), body, np.full(1, END)])
    n = len(symbols) - ORDER
    gram = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        gram = gram << BITS | symbols[k:k + n]
    return np.unique(gram, return_counts=True)


def occurrences(strings: DataFrame) -> DataFrame:
    """(sid, gram, n, up, down) of every string and gram; up and down are how often
    accepted and rejected URLs of training hold it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "string", SLICE):
                found = [_grams(t.encode()) for t in part.column("string").to_pylist()]
                sizes = [len(g) for g, _ in found]
                n = np.concatenate([c for _, c in found])
                per_row = [part.column(c).to_numpy(zero_copy_only=False) for c in ("sid", "accepted", "rejected")]
                sid, up, down = (np.repeat(c, sizes) for c in per_row)
                grams = np.concatenate([g for g, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (sid, grams, n, n * up, n * down)],
                    ["sid", "gram", "n", "up", "down"],
                )

    seen = [F.when(F.col("held"), F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("accepted", "rejected")]
    return strings.select("sid", "string", *seen).mapInArrow(work, "sid long, gram long, n long, up long, down long")


def _by_order(grams: DataFrame, *kept: str) -> DataFrame:
    """Each gram once an order, with its context of that order and its last symbol."""
    orders = F.explode(F.array(*[F.lit(k) for k in range(ORDER + 1)])).alias("ord")
    context = F.expr(
        f"shiftright(gram & (shiftleft(1L, {BITS} * (ord + 1)) - 1), {BITS}) | shiftleft(CAST(ord AS BIGINT), 40)"
    )
    symbol = F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    return grams.select("gram", *kept, orders).select(
        "gram", *kept, "ord", context.alias("context"), symbol.alias("symbol")
    )


def contexts(grams: DataFrame) -> DataFrame:
    """Every context of training: per model the occurrences and the number of
    different followers, and the counts of each follower."""
    cells = _by_order(grams.filter("up + down > 0"), "up", "down").groupBy("ord", "context", "symbol").agg(
        F.sum("up").alias("up"), F.sum("down").alias("down")
    )
    return cells.groupBy("ord", "context").agg(
        *[F.sum(c).alias(f"{c}_total") for c in ("up", "down")],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in ("up", "down")],
        F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("up", "down")))).alias("seen"),
    )


def _chance(levels: Column, side: str) -> Column:
    """Interpolated chance, from the shortest context to the longest."""

    def mixed(chance: Column, level: Column) -> Column:
        total, kinds = level[f"{side}_total"], level[f"{side}_kinds"]
        return F.when(total > 0, (level[side] + kinds * chance) / (total + kinds)).otherwise(chance)

    return F.aggregate(levels, F.lit(1.0 / END), mixed)


def fit(found: DataFrame) -> DataFrame:
    """(gram, uses, delta) of every gram of ``occurrences``: the difference of its
    logarithms under the two models, as a whole multiple of 1 / ``SCALE``."""
    grams = found.groupBy("gram").agg(
        F.count(F.lit(1)).alias("uses"), F.sum("up").alias("up"), F.sum("down").alias("down")
    )
    grams = materialised(grams, "grams")
    known = materialised(contexts(grams), "contexts")
    asked = _by_order(grams, "uses")
    low = asked.filter("ord <= 1").join(F.broadcast(known.filter("ord <= 1").drop("ord")), "context", "left")
    high = asked.filter("ord > 1").join(known.filter("ord > 1").drop("ord"), "context", "left")
    numbers = [f"{side}_{kind}" for side in ("up", "down") for kind in ("total", "kinds")]
    cell = F.try_element_at("seen", "symbol")
    level = F.struct(
        "ord", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers],
        *[F.coalesce(cell[c], F.lit(0)).alias(c) for c in ("up", "down")],
    )
    folded = low.unionByName(high).select("gram", "uses", level.alias("level")).groupBy("gram", "uses").agg(
        F.sort_array(F.collect_list("level")).alias("levels")
    )
    difference = F.ln(_chance(F.col("levels"), "up")) - F.ln(_chance(F.col("levels"), "down"))
    return folded.select("gram", "uses", F.round(difference * SCALE).cast("long").alias("delta"))


def score(strings: DataFrame) -> DataFrame:
    """``strings(sid, string, accepted, rejected, held)`` with the length-normalised
    log-likelihood difference ``ratio``."""
    found = materialised(occurrences(strings), "occurrences")
    model = materialised(fit(found), "model")
    hot = F.broadcast(model.orderBy(F.desc("uses"), "gram").limit(HOT).select("gram", "delta"))
    near = found.join(hot, "gram")
    far = found.join(hot, "gram", "left_anti").join(model, "gram")
    each = [d.select("sid", (F.col("n") * F.col("delta")).alias("part")) for d in (near, far)]
    sums = each[0].unionByName(each[1]).groupBy("sid").agg(F.sum("part").alias("sum"))
    length = F.octet_length("string") + 1
    return strings.join(sums, "sid").withColumn("ratio", F.col("sum") / SCALE / length).drop("sum")


def calibrated(bins) -> float:
    """Threshold with the largest sum of kept accepted and blocked rejected shares;
    0 without both kinds. Of equal ones the one nearest to 0."""
    up, down = int(bins["up"].sum()), int(bins["down"].sum())
    if not up or not down:
        return 0.0
    best = (-1.0, 0.0, 0.0)
    for edge in sorted({0, *bins["bin"].tolist()}):
        kept = bins["up"][bins["bin"] >= edge].sum() / up
        blocked = bins["down"][bins["bin"] < edge].sum() / down
        best = max(best, (round(float(kept + blocked), 12), -abs(edge) / FINE, edge / FINE))
    return best[2]


def threshold(scored: DataFrame) -> float | None:
    """From the held strings of ``score``; null without both kinds in training. What
    reaches the driver is one row a bin."""
    seen = scored.filter("NOT held").agg(F.sum("accepted").alias("up"), F.sum("rejected").alias("down")).first()
    if not seen["up"] or not seen["down"]:
        return None
    edge = F.lit(LARGEST * FINE)
    bin_ = F.least(F.greatest(F.floor(F.col("ratio") * FINE), -edge), edge)
    return calibrated(
        scored.filter("held AND accepted + rejected > 0").groupBy(bin_.alias("bin"))
        .agg(F.sum("accepted").alias("up"), F.sum("rejected").alias("down")).toPandas()
    )


def judge(pages: DataFrame, rules: dict[str, str], url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, ratio) of every page. Rules map
    "host/path-prefix" to "allow" or "block"."""
    parts = pages.select(F.col(key).alias("page_key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    parts = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    parts = parts.withColumn("string", compared(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r for r, v in rules.items() if v == "allow"])
    strings = parts.filter("string <> ''").groupBy("string").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(allowed).alias("accepted"),
        F.count_if(F.col("rule").isNotNull() & ~allowed).alias("rejected"),
    )
    strings = materialised(strings.select(
        "*", F.monotonically_increasing_id().alias("sid"), F.sha2("string", 256).alias("digest"),
        (F.pmod(F.xxhash64("string"), F.lit(HELD)) == 0).alias("held"),
    ), "strings")
    scored = materialised(score(strings).drop("string"), "scored")
    limit = threshold(scored)

    # a page finds its ratio by the digest of its string, that of a frequent one without a shuffle
    ratios = scored.select("digest", "ratio")
    hot = scored.orderBy(F.desc("pages"), "digest").limit(HOT_STRINGS).select("digest", F.col("ratio").alias("near"))
    asked = parts.withColumn("digest", F.sha2("string", 256)).join(F.broadcast(hot), "digest", "left")
    asked = asked.withColumn("near", F.when(F.col("string") == "", F.lit(0.0)).otherwise(F.col("near")))
    done = asked.filter(F.col("near").isNotNull()).withColumn("ratio", F.col("near"))
    rest = asked.filter(F.col("near").isNull()).join(ratios, "digest")
    every = done.unionByName(rest)

    good = F.lit(True) if limit is None else (F.col("string") == "") | (F.col("ratio") >= F.lit(limit))
    by_method = F.when(good, F.lit("allow")).otherwise(F.lit("block"))
    by_rule = F.when(allowed, F.lit("allow")).otherwise(F.lit("block"))
    return every.select(
        F.col("page_key").alias(key), "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_method).alias("verdict"), "ratio",
    )
