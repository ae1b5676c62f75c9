import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from parcelwise.llm.decontaminate import normalised  # noqa: E402

from .test_neardup import brute  # noqa: E402
from .test_substrings import brute_runs  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before the first stage and after each, as a test of the contract between them."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(900_001, "1234 5678 !!", "en", "x", 12), (900_002, None, None, None, None), (900_003, "", "en", "x", 0), (None, "no id but the words of and the", "en", "x", 30), (900_004, "qzx wvk " * 30, None, "x", 0)]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    extra += [(900_005, "The and of that. " + benchmark.upper().replace(" ", "  ") + " And the.", "en", "x", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_language_stage(stages):
    before, after = rows(stages[0]), rows(stages[1])
    gone = set(before) - set(after)
    assert {900_001, 900_002, 900_003} <= gone and None in after
    assert all(not any(c.isalpha() for c in before[i] or "") or i == 900_004 for i in gone)


def test_near_duplicate_stage(stages):
    before, after = rows(stages[1]), rows(stages[2])
    named = [(i, t) for i, t in before.items() if i is not None]
    groups = brute(named, 5)
    assert set(after) == {i for i, (_, least) in groups.items() if i == least} | {None}


def test_substring_stage(stages):
    """Words inside a run of 25 that stands earlier go, by an independent search for all runs; nothing else does."""
    before, after = rows(stages[2]), rows(stages[3])
    gone = brute_runs([(i, t) for i, t in before.items() if i is not None], 25)
    assert set(before) == set(after) and any(gone.values())
    for i, text in before.items():
        words = [m for m in re.finditer(r"[^ \t\n\v\f\r]+", text or "") if m.span() not in gone.get(i, ())]
        assert re.findall(r"[^ \t\n\v\f\r]+", after[i] or "") == [m.group() for m in words]
    assert stages[3].where(F.col("n_chars") != F.char_length("text")).count() == 0


def test_decontamination_stage(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    items = [normalised(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {i for i, t in before.items() if any(x in normalised(t) for x in items)}
    assert 900_005 in exact and exact <= set(before) - set(after)
    assert len(set(before) - set(after)) <= len(exact) + 2


def test_packing_stage_and_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    pieces = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"] for r in pieces} == set(rows(stages[4])) and all(r["n"] == r["m"] for r in pieces)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_empty_documents(spark, stages):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, stages[0].limit(0), SF).collect() == []
