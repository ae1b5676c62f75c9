import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelwise.llm import fingerprints as fp
from parcelwise.llm.queries import fingerprint_digests

SCHEMA = "doc_id long, text string, here string, next string, bucket int, sketch string, guest int"


def shingles(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {hashlib.md5(" ".join(w[i : i + words]).encode()).hexdigest()[:16] for i in range(max(1, len(w) - words + 1))} if w else set()


def least(*sets, k=fp.K):
    return sorted(set().union(*sets))[:k]


def share(a, b):
    union = least(a, b)
    return len(set(least(a)) & set(least(b)) & set(union)) / len(union) if union else 1.0


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def given(spark):
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (0, 1, 4, 5, 6, 40, 300, 900)] + [None, "", " \n\t ", "One  two\nTHREE four five", "one two three four five"]
    texts += [texts[6]] * 5 + [texts[7] + " tail", "é🙂ü " * 40, prose(rng, 30_000, 9_000)]
    rng.shuffle(texts)
    ids = rng.sample(range(-50, 10_000), len(texts) - 2) + [2**62, -(2**62)]
    rows = list(zip(ids, texts, strict=True))
    return rows, spark.createDataFrame([(i, t, "x", "y", 7, "z", None) for i, t in rows], SCHEMA)


def expected(rows):
    order = sorted(rows, reverse=True)
    want = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = shingles(text), shingles(edited), shingles(after)
        want[i] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(least(a)), "".join(least(b)), share(a, b), share(a, c)
        )
    return want


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_brute_force(spark, partitions):
    rows, df = given(spark)
    got = {r[0]: tuple(r[1:]) for r in fingerprint_digests(df.repartition(partitions)).collect()}
    assert got == expected(rows)


def test_one_row_is_its_own_next(spark):
    df = spark.createDataFrame([(3, "a b c d e f g h")], "doc_id long, text string")
    row = fingerprint_digests(df).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b c d a b c d"[:8] + b"a b c d").hexdigest()


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "a b c d e f")] * 3 + [(5, "x y z u v")] * 2 + [(2, "k l m n o")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fp.fingerprints(df).collect()
    assert len(got) == 6
    assert sorted(r["edited"] for r in got if r["doc_id"] is None) == ["a b c "] * 3
    assert sorted(r["edited"] for r in got if r["doc_id"] == 5) == ["x y zk l ", "x y zx y "]
    assert [r["edited"] for r in got if r["doc_id"] == 2] == ["k l mx y "]
    only = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["edited"] for r in fp.fingerprints(only).collect()) == ["", "a "]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprint_digests(empty).collect() == []
    assert fp.merge_groups(fp.fingerprints(empty), ["doc_id"], "sketch").collect() == []


def test_fingerprint_reads_back(spark):
    _, df = given(spark)
    back = fp.fingerprints(df).select("sketch", fp.read_fingerprint(fp.fingerprint(F.col("sketch"))).alias("back")).collect()
    assert all(r["sketch"] == r["back"] for r in back)


def test_parts_merge_and_estimates_hold(spark):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(60_000)]
    texts = [(g, " ".join(rng.sample(words, 120))) for g in ("a", "b", None) for _ in range(150)]
    texts += [("a", texts[0][1])] * 700 + [("b", t) for g, t in texts[:75]]
    df = spark.createDataFrame(texts, "g string, text string").select("g", fp.sketch(F.col("text")).alias("s"))
    merged = fp.merge_groups(df, ["g"], "s")
    got = {r["g"]: r["sketch"] for r in merged.collect()}
    sets = {g: set().union(*(shingles(t) for h, t in texts if h == g)) for g in ("a", "b", None)}
    assert got == {g: least(s) for g, s in sets.items()}
    both = merged.where("g = 'a'").select(F.col("sketch").alias("a")).join(merged.where("g = 'b'").select(F.col("sketch").alias("b")))
    row = both.select(
        fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b")), fp.distinct_shingles(F.col("a"))
    ).first()
    a, b = sets["a"], sets["b"]
    assert abs(row[0] - len(a & b) / len(a | b)) < 0.15
    assert abs(row[1] - len(a & b) / len(a)) < 0.25
    assert abs(row[2] / len(a) - 1) < 0.3


def test_no_python_in_the_plan_and_one_shuffle_of_texts(spark):
    _, df = given(spark)
    plan = fingerprint_digests(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") == 1 and "Join" not in plan
