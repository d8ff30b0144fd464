"""Quality scores by Bradley-Terry pairwise ranking.

Pairs of one good and one bad document are preferences. Under the Bradley-Terry
model the good one wins with chance sigmoid(w . (x_good - x_bad)), so the weights
are found by logistic loss on feature differences, with a small ridge. A
document's strength is w . x; a quantile of the strengths of all documents, the
one that divides the labels best, is the threshold, and scores are logistic in
the distance from it, ``ACCEPT`` at the threshold.

Features are rates of a whole text (``RATES``), each with hinges at its
quartiles so that too little and too much can both count. They are computed by
built-in functions; labels, language, source and id are not among them.

Weights are fitted on the driver from at most ``LABELLED`` labelled documents, the
first by a hash of their id, and ``PAIRS`` pairs. Standard deviations, quartiles and
quantiles of strengths come from all documents and the threshold from all labels
that are not held out, by exact sums and counts by bin.

Defined results: null and empty texts have all rates 0 and get a score like any
other; without both labels every score is 0.5; of several labels of a document
the lowest counts; labels without a document are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised, word_array

#: Most labelled documents the weights are fitted on.
LABELLED = 20_000
#: Preference pairs drawn from them.
PAIRS = 60_000
ACCEPT = 0.7
#: Rates are summed and counted as whole multiples of 1 / FINE, larger ones as LARGEST.
FINE, LARGEST = 4096, 1 << 14
#: Values counted together at first when quartiles are looked for.
STRETCH = 1 << 13
QUARTERS = (0.25, 0.5, 0.75)
#: Bins of strengths in one unit; strengths beyond MOST either way count as that.
BINS, MOST = 1024, 64
RIDGE = 1e-2
RATES = (
    "log_words", "distinct", "word_length", "symbols", "exclaims", "capitals", "digits",
    "stops", "line_rate", "dup_lines",
)


def rates(documents: DataFrame) -> DataFrame:
    """(doc_id, rates) of every row of ``documents(doc_id, text)``."""
    text = F.coalesce("text", F.lit(""))
    df = documents.select(
        "doc_id", word_array(F.col("text")).alias("words"), F.split(text, "\n").alias("lines"),
        *[
            F.regexp_count(text, F.lit(pattern)).alias(name)
            for name, pattern in (
                ("c_symbols", r"[#*$%&|<>]"), ("c_exclaims", "!"), ("c_capitals", "[A-Z]"),
                ("c_digits", "[0-9]"), ("c_stops", r"[.,;:?]"),
            )
        ],
    )
    words = F.greatest(F.size("words"), F.lit(1))
    letters = F.length(F.concat_ws("", "words"))
    lines = F.size("lines")
    values = [
        F.log1p(F.size("words")), F.size(F.array_distinct("words")) / words, letters / words,
        F.log1p(10 * F.col("c_symbols") / words), F.log1p(10 * F.col("c_exclaims") / words),
        F.col("c_capitals") / F.greatest(letters, F.lit(1)),
        F.col("c_digits") / F.greatest(letters, F.lit(1)),
        F.col("c_stops") / words, lines / words,
        (lines - F.size(F.array_distinct("lines"))) / F.greatest(lines, F.lit(1)),
    ]
    return df.select("doc_id", *[v.cast("double").alias(n) for v, n in zip(values, RATES)])


@dataclass
class Ranking:
    """Knots of each rate, weights of the rate and its hinges, and the threshold."""

    scale: np.ndarray
    knots: np.ndarray
    weights: np.ndarray
    threshold: float
    fitted: bool = True

    def strength(self, x: np.ndarray) -> np.ndarray:
        return expanded(x / self.scale, self.knots) @ self.weights.ravel()

    def column(self) -> Column:
        """Strength of a row of rates as an expression."""
        total = F.lit(0.0)
        for k, name in enumerate(RATES):
            x = F.col(name) / F.lit(float(self.scale[k]))
            total = total + x * F.lit(float(self.weights[k, 0]))
            for j, knot in enumerate(self.knots[k]):
                hinge = F.greatest(x - F.lit(float(knot)), F.lit(0.0))
                total = total + hinge * F.lit(float(self.weights[k, j + 1]))
        return total


def expanded(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Each rate followed by its hinges."""
    hinges = np.maximum(x[:, :, None] - knots[None], 0)
    return np.concatenate([x[:, :, None], hinges], axis=2).reshape(len(x), -1)


def spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Standard deviation of each rate and its quartiles in these, over all rows."""
    whole = rows.select(
        *[F.round(F.least(F.col(r), F.lit(float(LARGEST))) * FINE).cast("long").alias(r) for r in RATES]
    )
    sums = whole.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("decimal(20,0)")).alias(f"s_{r}") for r in RATES],
        *[F.sum((F.col(r) * F.col(r)).cast("decimal(20,0)")).alias(f"q_{r}") for r in RATES],
    ).first()
    n = sums["n"]
    if not n:
        return np.ones(len(RATES)), np.zeros((len(RATES), 3))
    # whole numbers up to the division, so that nothing cancels
    squares = [(n * int(sums[f"q_{r}"]) - int(sums[f"s_{r}"]) ** 2) / n**2 for r in RATES]
    scale = np.maximum(np.sqrt(squares) / FINE, 1e-6)
    return scale, quartiles(whole, n) / FINE / scale[:, None]


def quartiles(whole: DataFrame, n: int) -> np.ndarray:
    """Per rate the lowest value at or below which each quarter of the ``n`` rows of
    whole numbers lies.

    Values are counted in stretches of ``STRETCH`` first, then one by one in the at
    most three stretches a rate that hold its quartiles, so that no task and not
    the driver gets more than ``LARGEST * FINE / STRETCH`` or ``STRETCH`` counts of each.
    """
    long = whole.select(F.posexplode(F.array(*RATES)).alias("f", "bin"))
    stretch = F.floor(F.col("bin") / STRETCH)
    wide = long.groupBy("f", stretch.alias("bin")).count().toPandas().sort_values("bin")
    found = {}
    for f, some in wide.groupby("f"):
        upto = some["count"].cumsum().to_numpy()
        for k, share in enumerate(QUARTERS):
            at = int(np.searchsorted(upto, n * share))
            found[f, k] = (int(some["bin"].iloc[at]), int(upto[at] - some["count"].iloc[at]))
    holds = F.lit(False)
    for f, place in sorted({(f, place) for (f, _), (place, _) in found.items()}):
        holds = holds | ((F.col("f") == f) & (stretch == place))
    near = long.filter(holds).groupBy("f", "bin").count().toPandas().sort_values("bin")
    out = np.zeros((len(RATES), len(QUARTERS)))
    for (f, k), (place, below) in found.items():
        some = near[(near["f"] == f) & (near["bin"] // STRETCH == place)]
        upto = below + some["count"].cumsum().to_numpy()
        out[f, k] = some["bin"].iloc[int(np.searchsorted(upto, n * QUARTERS[k]))]
    return out


def fit(x: np.ndarray, good: np.ndarray, scale: np.ndarray | None = None, knots: np.ndarray | None = None) -> Ranking:
    """Weights from rows of rates and their labels; scale and knots of these rows unless given."""
    if scale is None:
        scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(len(RATES))
    z = x / scale
    if knots is None:
        knots = np.quantile(z, QUARTERS, axis=0).T if len(x) else np.zeros((len(RATES), 3))
    flat = Ranking(scale, knots, np.zeros((len(RATES), 4)), 0.0, False)
    up, down = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(up) or not len(down):
        return flat
    rows = expanded(z, knots)
    draw = np.random.default_rng(7)
    win, lose = draw.choice(up, PAIRS), draw.choice(down, PAIRS)
    difference = rows[win] - rows[lose]
    w = np.zeros(rows.shape[1])
    for _ in range(30):  # Newton steps; the loss is convex
        chance = 1 / (1 + np.exp(-np.clip(difference @ w, -30, 30)))
        slope = difference.T @ (chance - 1) / PAIRS + RIDGE * w
        curve = (difference * (chance * (1 - chance))[:, None]).T @ difference / PAIRS
        step = np.linalg.solve(curve + RIDGE * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Ranking(scale, knots, w.reshape(len(RATES), 4), 0.0)


def dividing(rows: DataFrame, known: DataFrame, model: Ranking) -> float:
    """Of 199 quantiles of the strengths of all rows the one that divides the known labels best."""
    edge = F.lit(float(MOST))
    bin_ = F.floor(F.least(F.greatest(model.column(), -edge), edge) * BINS)
    both = rows.select("doc_id", bin_.alias("bin")).join(known, "doc_id", "left")
    bins = both.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("up"),
        F.count_if(F.col("label") == 0).alias("down"),
    ).toPandas().sort_values("bin")
    n, up, down = (bins[c].to_numpy(np.int64) for c in ("n", "up", "down"))
    upto = np.cumsum(n)
    at = np.unique(np.searchsorted(upto, np.linspace(0.005, 0.995, 199) * upto[-1]))
    balance = (up.sum() - np.cumsum(up)[at] + up[at]) / up.sum() + (np.cumsum(down)[at] - down[at]) / down.sum()
    # of equally good quantiles the middle one
    best = np.flatnonzero(np.isclose(balance, max(balance)))
    return float(bins["bin"].to_numpy()[at[best[len(best) // 2]]]) / BINS


def first_labelled(labelled: DataFrame) -> DataFrame:
    """The ``LABELLED`` rows whose id has the lowest hash.

    Of more rows, those above a bound on the hash that leaves a quarter more than
    asked for go first, so that tasks hand few more rows to the driver than it
    keeps, however many partitions there are.
    """
    key = F.xxhash64("doc_id")
    n = labelled.count()
    if n > LABELLED:
        bound = -(1 << 63) + ((1 << 64) * LABELLED * 5 // (4 * n))
        few = labelled.filter(key <= F.lit(min(bound, (1 << 63) - 1)))
        # repeated ids share a hash: where they leave too few, the bound goes
        labelled = few if few.count() >= LABELLED else labelled
    return labelled.orderBy(key, "doc_id").limit(LABELLED)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def score(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; held-out labels are not used."""
    rows = materialised(rates(documents), "rates")
    known = labels.filter(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("label"))
    known = known.filter(~held_out(F.col("doc_id")))
    scale, knots = spread(rows)
    sample = first_labelled(rows.join(known, "doc_id")).toPandas()
    model = fit(sample[list(RATES)].to_numpy(np.float64), sample["label"].to_numpy(), scale, knots)
    if model.fitted:
        model.threshold = dividing(rows, known, model)
    offset = float(np.log(ACCEPT / (1 - ACCEPT)))
    value = F.lit(0.5)
    if model.fitted:
        value = 1 / (1 + F.exp(-(model.column() - F.lit(model.threshold)) - F.lit(offset)))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score")).select(
        "*", F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted")
    )
