import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from parcelwise.llm import quality
from parcelwise.llm.quality import RULES, Measures, Rule, judge, order_rules
from parcelwise.llm.words import WordHashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    own = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    n = Counter(own)
    covered = {k + d for k, w in enumerate(own) if n[w] > 1 for d in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t\x0b\x1c\x85　#|<")), max_size=80))
def test_measures(text):
    m = Measures(text.encode(), WordHashes())
    assert {k: getattr(m, k) for k in plain(text)} == plain(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_windows(words):
    text = " ".join(words)
    assert Measures(text.encode(), WordHashes()).n_repeat_words == plain(text)["n_repeat_words"]


def test_order_by_rejections_per_cost():
    a, b, c = (Rule(x, lambda m: False) for x in "abc")
    assert [r.name for r in order_rules([a, b, c], {"a": (1.0, 0.1), "b": (0.1, 0.05), "c": (1.0, 0.0)})] == ["b", "a", "c"]


def test_verdict_does_not_depend_on_the_order(spark):
    good = " ".join(f"word{chr(97 + i)}" for i in range(26))
    rows = [(1, good), (2, None), (3, ""), (4, "few words"), (5, "same words again and again and so on " * 9), (6, good.replace("d", "#")), (None, good), (1, good), (7, good + "\nx" * 60), (8, "9" * 300 + " " + good)]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, kept boolean")
    kept = []
    for rules in (RULES, RULES[::-1]):
        got = judge(docs, rules=rules, report=("n_words", "n_repeat_words")).collect()
        assert len(got) == len(rows)
        assert sorted((r["doc_id"] or 0, r["n_words"], r["n_repeat_words"]) for r in got) == sorted(
            (i or 0, plain(t)["n_words"], plain(t)["n_repeat_words"]) for i, t in rows
        )
        kept.append(sorted(r["doc_id"] or 0 for r in got if r["kept"]))
    assert kept == [[0, 1, 1]] * 2


def test_no_rule_runs_after_a_rejection(spark):
    class Broken:
        def __call__(self, m):
            if m.n_words == 0:
                raise ValueError("the rule before has rejected this row")
            return False

    ordered = order_rules([Rule("broken", Broken()), Rule("empty", lambda m: m.n_words == 0)], {"empty": (1e-6, 0.5)})
    m = Measures(b"", WordHashes())
    assert any(rule.rejects(m) for rule in ordered)


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sample_is_drawn_from_all_partitions(spark):
    """The first file holds one source that a rule always rejects; a sample of first rows would take the rule for the best."""
    docs = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", "CASE WHEN id < 1000 THEN 'x' WHEN id % 4 = 1 THEN 'y' END AS text", "1 AS rule")
    first, other = Rule("first", lambda m: m.text == b"x"), Rule("other", lambda m: m.text != b"x")
    found = quality.measure_rules(docs, [first, other], "text", 800)
    assert 0.15 < found["first"][1] < 0.35
    assert abs(found["first"][1] + found["other"][1] - 1) < 1e-9
    assert all(cost > 0 for cost, _ in found.values())
    whole = quality.measure_rules(docs, [first], "text", 10**6)
    assert whole["first"][1] == 0.25


def test_very_long_text(spark):
    text = "again and again the same line\n" * 60_000 + "and " + " ".join(f"w{k}" for k in range(300_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = judge(docs, report=("n_words", "word_chars", "n_dup_lines", "n_repeat_words")).first()
    words = text.split()
    assert (row["n_words"], row["word_chars"]) == (len(words), sum(map(len, words)))
    assert row["n_dup_lines"] == 59_999 and row["n_repeat_words"] == 360_000 and not row["kept"]
