"""The cleaning pipeline as a whole, and the registered queries."""

import corpus_pipeline
from pyspark.sql import functions as F

from vesselmart.llm import pii
from vesselmart.llm.queries import QUERIES

from .helpers import component_ids, documents, prose


def test_every_stage_takes_effect(spark, sf_dir, tmp_path):
    item = prose(77, 40, 10_000)
    near = prose(1, 200, 10_000)
    texts = [prose(k, 150 + k, 10_000) for k in range(70)]
    texts += [texts[3], near, near.replace("w", "w", 1) + " more", "too short", None, "w1 w2 " * 100, texts[5] + " a@b.co 1.2.3.4"]
    texts += [prose(500, 80, 10_000) + " " + item + " " + prose(501, 80, 10_000), prose(502, 90, 10_000) + " mail x@y.org"]
    df = documents(spark, texts, extra="kept").withColumn("keys", F.lit("clash"))
    sf = str(tmp_path)
    df.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert sorted(docs.columns) == sorted(df.columns)
        docs = docs.cache()
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    junk = {k for k, t in enumerate(texts) if t in ("too short", None, "w1 w2 " * 100)}
    assert set(seen[0]) == set(range(len(texts))) - junk
    pairs = sorted(seen[0].items())
    assert set(seen[1]) == set(component_ids(pairs))
    assert set(seen[1]) - set(seen[2]) == {k for k, t in enumerate(texts) if t and item in t}
    assert set(seen[3]) == set(seen[2])
    for number, text in seen[3].items():
        assert not any(pii.find_plain(text).values())
        assert text == texts[number] or "<" in text
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(out) == set(seen[3]) and all(r["decodes"] and r["n_tokens"] == len(r["ids"]) for r in out.values())


def test_empty_table(spark, sf_dir):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
