"""Quality rules and pairwise ranking."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from vesselmart.llm import pairrank, quality
from vesselmart.llm.common import materialised

from .helpers import DOCUMENT, documents, prose, repeat_words

ODD = [
    None, "", " \n\t", "a", "a b c a b c", "x\nx\n \n\nx", "#*$%&|<> a|b", "a\x0bb\x0cc\x85d", "w " * 30_000,
    "same words here", "same words here", "é\U0001f600 a", "A b\r\nA b\r\n",
]


def _counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), repeat_words(words),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_base_counts(spark):
    draw = random.Random(8)
    texts = ODD + ["".join(draw.choices("ab  \n#.", k=draw.randint(0, 300))) for _ in range(150)]
    df = documents(spark, texts, n_words="clash", pool="clash")
    rows = {r["doc_id"]: r for r in quality.base(df).collect()}
    for k, text in enumerate(texts):
        want = _counts(text)
        assert tuple(rows[k][c] for c in COLUMNS) == want
        assert rows[k]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def _mcd(x):
    """The same estimate in numpy, on the whole multiples that are summed."""
    floor = np.diag((np.array(quality.FLOOR) * quality.SCALE) ** 2)

    def lowest(v, share):
        v = np.sort(v)
        return v[max(0, int(np.ceil(share * len(v))) - 1)]

    bins = np.floor(x / 16)
    centre = np.array([lowest(b, 0.5) * 16.0 + 8 for b in bins.T])
    spread = np.array([(lowest(b, 0.75) - lowest(b, 0.25)) * 16 / 1.349 for b in bins.T])
    cov = np.diag(spread**2) + floor

    def distance():
        y = np.linalg.solve(np.linalg.cholesky(cov), (x - centre).T)
        return (y**2).sum(axis=0)

    def estimate(inside, factor):
        part = x[inside]
        return part.mean(axis=0), np.cov(part.T, bias=True) * factor + floor

    half = quality.P // 2
    middle = quality._quantile(0.5, half)
    for _ in range(quality.STEPS):
        bins = np.floor(np.log2(np.maximum(distance(), 1e-3)) * 32)
        centre, cov = estimate(bins <= lowest(bins, 0.5), 0.5 / quality._chi_square(middle, half + 1))
    edge = quality._quantile(0.975, half)
    centre, cov = estimate(distance() <= edge, 0.975 / quality._chi_square(edge, half + 1))
    return distance()


def test_distances_follow_the_estimate(spark):
    draw = random.Random(9)
    texts = []
    for k in range(300):
        words = [draw.choice(["on", "the", "winter", "harbour", "Sea", "of", "ships"]) + str(draw.randrange(90)) for _ in range(draw.randint(60, 400))]
        text = " ".join(words)
        texts.append(text if k % 10 else text.upper().replace(" ", "!! ") + " ###" * 40)
    df = documents(spark, texts)
    rows = {r["doc_id"]: r for r in quality.judge(df).collect()}
    sound = materialised(quality.base(df), "base").filter("NOT base_failed")
    table = sound.select("doc_id", *quality.statistics(sound)).toPandas().sort_values("doc_id")
    want = _mcd(table[list(quality.FEATURES)].to_numpy(float))
    got = np.array([rows[k]["distance"] for k in table["doc_id"]])
    assert np.allclose(got, want, rtol=1e-5, atol=2e-3)
    kept = {k for k in rows if rows[k]["kept"]}
    assert kept == {k for k in range(300) if k % 10}


def test_edges_of_the_rules(spark):
    good = [prose(k, 120, 5000) for k in range(70)]
    rows = [(k, t, None, "s", 1) for k, t in enumerate(good)] + [(100, prose(1, 120, 5000), "xx", None, 1)]
    rows += [(200 + k, t, "en", None, None) for k, t in enumerate(ODD)] + [(300, good[0], None, "s", 1)] * 2
    df = spark.createDataFrame(rows, DOCUMENT).withColumn("d2", F.lit("clash"))
    out = quality.judge(df)
    verdicts = out.collect()
    assert len(verdicts) == len(rows)
    by_id = {r["doc_id"]: r for r in verdicts}
    assert by_id[0]["distance"] == by_id[300]["distance"]
    assert by_id[100]["kept"] and by_id[100]["distance"] is None  # too few to judge
    assert not any(by_id[200 + k]["kept"] for k in range(len(ODD)))
    stay = quality.keep(df)
    assert stay.columns == df.columns
    assert {r["doc_id"] for r in stay.collect()} == {r["doc_id"] for r in verdicts if r["kept"]}


def test_result_does_not_depend_on_partitions(spark):
    df = documents(spark, [prose(k, 100 + k, 3000) for k in range(130)])
    a, b = (
        {r["doc_id"]: tuple(r) for r in quality.judge(df.repartition(n)).collect()} for n in (1, 7)
    )
    assert a == b


def _labelled(spark, n=400):
    draw = random.Random(10)
    texts, labels = [], []
    for k in range(n):
        good = draw.random() < 0.7
        text = prose(k, draw.randint(30, 200), 5000)
        texts.append(text if good else draw.choice([text.upper() + "!!!", "spam " * 80, text.replace(" ", " | ")]))
        labels.append((k, int(good), 0))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_ranking_generalises(spark):
    docs, labels, known = _labelled(spark)
    rows = {r["doc_id"]: r for r in pairrank.score(docs, labels).collect()}
    held = [(rows[k], q) for k, q, _ in known if rows[k]["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == q for r, q in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows.values())
    # held-out labels do not change a score
    turned = labels.withColumn(
        "quality", F.when(pairrank.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert {r["doc_id"]: r["score"] for r in pairrank.score(docs, turned).collect()} == {
        k: r["score"] for k, r in rows.items()
    }


def test_ranking_edges(spark):
    docs, labels, _ = _labelled(spark, 60)
    odd = documents(spark, [(1000 + k, t) for k, t in enumerate(ODD)])
    more = labels.unionByName(labels).unionByName(
        spark.createDataFrame([(9999, 1, 0), (1000, None, 0), (None, 1, 0)], labels.schema)
    )
    rows = pairrank.score(docs.unionByName(odd).withColumn("score", F.lit("clash")), more).collect()
    assert len(rows) == 60 + len(ODD)
    same = [r["score"] for r in rows if r["doc_id"] in (1009, 1010)]
    assert same[0] == same[1] and all(r["score"] is not None for r in rows)
    flat = pairrank.score(docs, labels.filter("quality = 1")).collect()
    assert {(r["score"], r["predicted"]) for r in flat} == {(0.5, 0)}


def test_pair_loss_is_at_its_least():
    draw = np.random.default_rng(11)
    x = draw.normal(size=(300, len(pairrank.RATES)))
    good = (x[:, 0] + 0.3 * draw.normal(size=300) > 0).astype(int)
    model = pairrank.fit(x, good)
    s = model.strength(x)
    assert (s[good == 1][:, None] > s[good == 0][None]).mean() > 0.95
    rows = pairrank.expanded(x / model.scale, model.knots)
    rng = np.random.default_rng(7)
    d = rows[rng.choice(np.flatnonzero(good == 1), pairrank.PAIRS)] - rows[rng.choice(np.flatnonzero(good == 0), pairrank.PAIRS)]
    loss = lambda w: np.log1p(np.exp(-d @ w)).mean() + pairrank.RIDGE / 2 * (w**2).sum()
    w = model.weights.ravel()
    assert all(loss(w) <= loss(w + 0.01 * draw.normal(size=len(w))) for _ in range(20))


def test_small_group_is_judged_by_its_language(spark):
    texts = [prose(400 + k, 120, 5000) for k in range(205)]
    texts[203] = texts[203].upper().replace(" ", "!! ") + " ###" * 40
    rows = [(k, t, "de", "large" if k < 200 else "small", 1) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert len(got) == len(rows) and all(r["distance"] is not None for r in got.values())
    assert [k for k in range(200, 205) if not got[k]["kept"]] == [203]
    # the large group is judged by its own estimate
    alone = quality.judge(spark.createDataFrame(rows[:200], DOCUMENT)).collect()
    assert {k: got[k]["distance"] for k in range(200)} == {r["doc_id"]: r["distance"] for r in alone}


def test_ranking_statistics_cover_all_rows(spark, monkeypatch):
    docs, labels, known = _labelled(spark)
    rates = materialised(pairrank.rates(docs), "rates")
    x = rates.toPandas()[list(pairrank.RATES)].to_numpy(float)
    scale, knots = pairrank.spread(rates)
    assert np.allclose(scale, np.maximum(x.std(axis=0), 1e-6), atol=2e-4)
    assert np.allclose(knots * scale[:, None], np.quantile(x, (0.25, 0.5, 0.75), axis=0, method="inverted_cdf").T, atol=2e-4)
    seen = []
    fit = pairrank.fit
    monkeypatch.setattr(pairrank, "LABELLED", 40)
    monkeypatch.setattr(pairrank, "fit", lambda *a: seen.append((a, fit(*a))) or seen[-1][1])
    rows = {r["doc_id"]: r for r in pairrank.score(docs, labels).collect()}
    (args, model), = seen
    assert len(args[0]) == 40 and np.array_equal(model.scale, scale) and np.array_equal(model.knots, knots)
    # no other division of all labels that are not held out is better
    open_ = [(rows[k]["score"], q) for k, q, _ in known if not rows[k]["held_out"]]
    up, down = ([s for s, q in open_ if q == v] for v in (1, 0))
    balance = lambda t: np.mean([s >= t for s in up]) + np.mean([s < t for s in down])
    assert balance(pairrank.ACCEPT) >= max(balance(np.quantile([r["score"] for r in rows.values()], q)) for q in np.linspace(0.01, 0.99, 50)) - 0.02


def test_sample_and_quartiles_of_the_ranking(spark, monkeypatch):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    monkeypatch.setattr(pairrank, "LABELLED", 100)
    first = [r[0] for r in ids.orderBy(F.xxhash64("doc_id")).limit(100).collect()]
    assert [r[0] for r in pairrank.first_labelled(ids).collect()] == first
    one = spark.createDataFrame([(7,)] * 300, "doc_id long")
    assert pairrank.first_labelled(one).count() == 100
    assert pairrank.first_labelled(ids.limit(40)).count() == 40
    monkeypatch.setattr(pairrank, "STRETCH", 64)
    draw = np.random.default_rng(3)
    values = np.stack([draw.integers(0, 10 ** (k % 6), 2000) for k in range(len(pairrank.RATES))], axis=1)
    whole = spark.createDataFrame(values.tolist(), ", ".join(f"{r} long" for r in pairrank.RATES))
    want = np.sort(values, axis=0)[[499, 999, 1499]].T
    assert (pairrank.quartiles(whole, 2000) == want).all()


def test_ranking_of_empty_tables(spark):
    docs = documents(spark, [None, "some words here"])
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    assert pairrank.score(docs.limit(0), labels).count() == 0
    assert [r["score"] for r in pairrank.score(docs, labels.limit(0)).collect()] == [0.5, 0.5]
