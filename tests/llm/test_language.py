import numpy as np
from pyspark.sql import functions as F

from parcelwise.llm.language import DISCOUNT, Model, fit, predict


def unit(*values):
    return np.log(np.array(values))


def test_words_first_then_shorter_grams():
    units = {0: {"the": unit(0.5, 0.1)}, 4: {"ther": unit(0.2, 0.1)}, 3: {"ing": unit(0.3, 0.1)}, 2: {}, 1: {"x": unit(0.1, 0.4)}}
    model = Model(("a", "b"), units)
    assert np.allclose(model.score("the")[0], units[0]["the"])
    got, weight = model.score("theringx?")
    assert np.allclose(got, DISCOUNT * units[4]["ther"] + DISCOUNT**2 * units[3]["ing"] + DISCOUNT**4 * units[1]["x"])
    assert np.isclose(weight, DISCOUNT + DISCOUNT**2 + DISCOUNT**4)
    assert model.score("??")[1] == 0


ROWS = [
    ("en", "the cat and the dog are in the house of the king"),
    ("en", "this is the way that we are going with the others"),
    ("de", "der hund und die katze sind in dem haus des königs"),
    ("de", "das ist der weg den wir mit den anderen gehen"),
]


def test_fit_and_predict(spark):
    rows = [(i, lang, text, i * 0.1) for i, (lang, text) in enumerate(ROWS * 5)]
    rows += [(100, None, "unlabelled the the", 0.0), (101, "fr", None, 0.0), (102, "fr", "held out le la", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, score double")
    model = fit(docs, docs["doc_id"] != 102)
    assert model.languages == ("de", "en")
    asked = [(1, "The House!", "de"), (2, "DER Hund, die Hündin", None), (3, None, "en"), (4, "12 ½ ² !?", "en"), (5, "", None), (None, "the", None), (1, "The House!", "en"), (7, "漢字", None), (8, "kingdom waytions", None), (9, "the " * 120_000, None)]
    got = predict(spark.createDataFrame(asked, "doc_id long, text string, lang_pred string"), model).collect()
    by = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got)
    assert by == [(0, "en"), (1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (7, "de"), (8, "en"), (9, "en")]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_ties_empty_tables_and_bounds(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    model = fit(empty, F.lit(True))
    assert predict(empty, model).collect() == []
    one = spark.createDataFrame([(1, "x", "word")], "doc_id long, lang string, text string")
    assert predict(one, model).first()["lang_pred"] == "und"
    same = spark.createDataFrame([(1, "b", "word"), (2, "a", "word")], "doc_id long, lang string, text string")
    row = predict(same, fit(same, F.lit(True))).first()
    assert (row["lang_pred"], row["score"]) == ("a", 0.5)
    many = spark.createDataFrame([(i, "a", f"word{chr(97 + i % 26)}" * 3) for i in range(100)], "doc_id long, lang string, text string")
    assert len(fit(many, F.lit(True), most_words=5).units[0]) == 5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from parcelwise.llm.queries import op8_language_id

    got = op8_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_pipeline_stage_rejects_unlearned_scripts_and_noise_but_no_short_clean_text(spark):
    import random

    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    whole = docs.where("lang IS NOT NULL AND length(text) > 300").orderBy("doc_id").limit(60).collect()
    short = [(10**7 + k, " ".join(r["text"].split()[:4]), None, "x", 0) for k, r in enumerate(whole) if sum(map(str.isalpha, " ".join(r["text"].split()[:4]))) > 8]
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choices("bcdfghjklmnpqrstvwxzaeiou", k=rng.randint(4, 9))) for _ in range(n)) for n in (5, 40, 400)]
    other = ["το σπίτι είναι μεγάλο και ο δρόμος μακρύς", "这是一个没有学过的语言的句子", "это предложение " * 50, *noise]
    foreign = [(2 * 10**7 + k, x, None, "x", 0) for k, x in enumerate(other)]
    given = docs.unionByName(spark.createDataFrame(short + foreign, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, given, "").select("doc_id").collect()}
    assert not kept & {r[0] for r in foreign}
    assert len(short) > 30 and {r[0] for r in short} <= kept
    gone = [r for r in docs.collect() if r["doc_id"] not in kept]
    print("gone of", docs.count(), ":", len(gone), [r["text"][:60] for r in gone[:5]])
    assert len(gone) < 0.01 * docs.count()
