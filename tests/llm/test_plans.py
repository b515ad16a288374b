"""What the plans read and run: pruned scans, no Python on the native paths, no join where none is needed."""

import re

import pytest

from tessera.llm import common, decontam, mixing, pii, secrets, toxicity

ROWS = [(i, f"text {i} a.b{i}@mail.example.com", "en", f"s{i % 3}", 5) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "documents.parquet")
    spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text: str) -> set[str]:
    return {c for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in re.findall(r"(\w+):", s)}


def test_native_operators_run_no_python(docs):
    for df in (pii.replace(docs), mixing.mix(docs)):
        assert not re.search("Python|Pandas|Arrow", plan(df))
    assert read_columns(plan(mixing.mix(docs.select("doc_id", "source")))) == {"doc_id", "source"}
    assert "Join" not in plan(pii.replace(docs.select("doc_id", "text")))


def test_scans_are_narrow_and_pruned(spark, docs):
    bench = spark.createDataFrame([(0, "one two three four five six")], "item_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    for df in (secrets.scan(docs), decontam.hits(docs, bench), toxicity.score(docs, model)):
        text = plan(df)
        assert "Exchange" not in text and read_columns(text) == {"doc_id", "text"}


def test_scratch_folder_is_the_one_the_session_names(spark, docs):
    df = common.materialise(docs.limit(3))
    root = spark.conf.get("spark.checkpoint.dir")
    assert common.scratch_root(spark) == root and root in df.inputFiles()[0] and df.count() == 3
    common.discard(df)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(df._tessera_path).count()
