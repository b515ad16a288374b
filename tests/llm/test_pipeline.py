"""The corpus pipeline on a small corpus: every stage against its operator's brute force, and on nulls and empties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontam, secrets, toxicity
from tests.llm.test_corpus import DOCS, brute_components, toxic_corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(3)
    texts, labels = toxic_corpus(5, 260)
    texts = [t or "" for t in texts[:260]]
    item = " ".join(f"item{i}" for i in range(20))
    for i in range(1, 260, 13):
        texts[i] = texts[i - 1]
    texts[10] = f"w1 {item} w2"
    texts[11] = "w1 w2 w3 w4 w5 password=abcdefghijklmnopq w6 w7"
    for i in (10, 11):
        labels[i] = 0
    rows = [(i, t, "en", f"s{rng.integers(0, 3)}", len(t)) for i, t in enumerate(texts)]
    rows += [(None, "a row without an id and some words", "en", None, 3), (900, None, None, "s1", None), (901, "", "en", "s1", 0), (902, "w1 only " * 4000, "en", "s2", 1), (902, "w1 only " * 4000, "en", "s2", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("component_id", F.lit("x"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        out = stage(spark, docs, folder)
        assert out.columns == columns, name
        after = out.collect()
        ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in after)
        if name == "toxicity":
            model = toxicity.train(spark, folder, docs)
            assert ids == sorted((r["doc_id"] is None, r["doc_id"]) for r in before if model.score(r["text"])[0] < 0.5)
            assert 0.75 * len(before) < len(after) < 0.85 * len(before)
        elif name == "near_duplicates":
            want = brute_components([r["text"] for r in before], [r["doc_id"] for r in before])
            assert ids == sorted({(False, k) for k, _, c in want if k is not None and k == c} | {(True, None)})
        elif name == "decontamination":
            assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {10}
        else:
            assert {r["doc_id"]: r["text"] for r in after} == {r["doc_id"]: r["text"] and secrets.redact(r["text"], secrets.spans(r["text"])) for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None) and any("[assign]" in (r["text"] or "") for r in after)
        docs = spark.createDataFrame(after, out.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.columns == [*columns, "rank", "block", "slot", "in_mix"] and last.count() == docs.count()


def test_run_is_the_stages_in_order(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert 10 not in ids and 900 in ids and 902 in ids and out.where("doc_id = 902").count() == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]


def test_empty_tables(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
    assert decontam.hits(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")).count() == 0
