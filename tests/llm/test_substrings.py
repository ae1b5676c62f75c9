import random
import re

import pytest

from parcelwise.llm.substrings import parts, remove_spans, repeated_spans, units


def brute(rows, unit, min_words):
    """Characters to remove per document, looking at all documents in order of id."""
    seen, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        own = parts(text, unit)
        gone = set()
        for first in range(len(own)):
            for last in range(first, len(own)):
                if sum(p[3] for p in own[first : last + 1]) >= min_words:
                    key = tuple(p[2] for p in own[first : last + 1])
                    if key in seen:
                        gone |= set(range(own[first][0], own[last][1]))
                    seen.setdefault(key, i)
                    break
        if gone:
            out[i] = gone
    return out


def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 9))).capitalize() + rng.choice([".", "!", ".", "?"])
    passages = [[sentence() for _ in range(8)] for _ in range(4)]
    rows = []
    for n in range(80):
        own = [sentence() for _ in range(rng.randint(0, 12))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randint(0, len(own))
            own[at:at] = [rng.choice(["", "mid of line "]) + rng.choice([" ", "  ", "\n"]).join(rng.choice(passages))]
        rows.append((n, "".join(s + rng.choice([" ", "\n", "\n\n"]) for s in own)))
    rows += [(100, None), (101, ""), (102, rows[3][1]), (103, "Short."), (104, "Short.")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("unit", "min_words"), [("sentence", 10), ("line", 5), ("paragraph", 12)])
def test_spans_match_brute_force(spark, unit, min_words):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, first_doc_id string, start int").repartition(3)
    spans = repeated_spans(docs, unit=unit, min_words=min_words)
    got = {}
    for r in spans.collect():
        assert r["first_doc_id"] <= r["doc_id"]
        own = got.setdefault(r["doc_id"], set())
        assert not own & set(range(r["start"] - 1, r["end"] + 1))
        own |= set(range(r["start"], r["end"]))
    want = brute(rows, unit, min_words)
    texts = dict(rows)
    bare = lambda found: {i: {k for k in own if not texts[i][k].isspace()} for i, own in found.items()}
    assert bare(got) == bare(want)
    cleaned = {r["doc_id"]: r for r in remove_spans(docs, spans).collect()}
    assert set(cleaned) == set(texts)
    for i, r in cleaned.items():
        if texts[i] is None:
            assert r["text"] is None and r["kept_spans"] is None
        else:
            assert r["text"] == "".join(c for k, c in enumerate(texts[i]) if k not in got.get(i, ()))
            assert r["text"] == "".join(texts[i][s:e] for s, e in r["kept_spans"]) and r["first_doc_id"] == "x"


def test_units():
    own = parts("One two. Three!\nFour five six seven. Eight.", "sentence")
    assert [p[2] for p in own] == [b"one two.", b"three!", b"four five six seven.", b"eight."]
    assert [(a, b) for a, b, _ in units(own, 3)] == [(0, 1), (1, 2), (2, 2)]
    assert units(own, 100) == [] and parts(" \n ", "line") == []


def test_one_text_null_ids_repeated_rows_and_empty(spark):
    long = "This is a sentence of eight words, truly. "
    docs = spark.createDataFrame([(1, long + "Else. " + long), (None, long), (2, "x\n" + long), (2, "x\n" + long)], "doc_id long, text string")
    spans = repeated_spans(docs, min_words=8)
    assert sorted(tuple(r) for r in spans.collect()) == [(1, 48, 89, 1), (2, 2, 43, 1)]
    assert sorted(str(r["text"]) for r in remove_spans(docs, spans).collect()) == sorted([long + "Else.  ", long, "x\n ", "x\n "])
    empty = docs.limit(0)
    assert repeated_spans(empty).collect() == [] and remove_spans(empty, repeated_spans(empty)).collect() == []


def brute_runs(rows, min_words):
    """Words (by place) and first documents of every run of words that stands earlier, by id and place."""
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^ \t\n\v\f\r]+", text or "")]
        for k in range(len(words) - min_words + 1):
            key = tuple(w for w, _, _ in words[k : k + min_words])
            if key in seen:
                for p in range(k, k + min_words):
                    out.setdefault(i, {}).setdefault(words[p][1:], set()).add(seen[key])
            seen.setdefault(key, i)
    return out


@pytest.mark.parametrize("min_words", [3, 12])
def test_passages_match_brute_force_over_all_runs(spark, min_words):
    """Passages pasted in mid-sentence, out of long sentences and rows without marks, İ and periodic text."""
    rng = random.Random(7)
    word = lambda: rng.choice(["", "É", "İ"]) + "".join(rng.choices("abcdefgh", k=rng.randint(1, 4)))
    plain = [[word() for _ in range(60)] for _ in range(6)]
    rows = []
    for n in range(60):
        own = [word() + rng.choice(["", "", ".", " |"]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 1, 2, 3])):
            passage = rng.choice(plain)
            begin = rng.randint(0, 40)
            at = rng.randint(0, len(own))
            own[at:at] = [w.upper() if rng.random() < 0.2 else w for w in passage[begin : begin + rng.randint(5, 60)]]
        rows.append((n, rng.choice([" ", "  ", "\n"]).join(own)))
    rows += [(100, ""), (101, rows[3][1]), (102, "the " * 40), (103, "a b c " * 30 + "the " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_runs(rows, min_words)
    texts, got = dict(rows), {}
    alone = repeated_spans(docs, unit="passage", min_words=min_words).collect()
    all_units = repeated_spans(docs, min_words=min_words).collect()
    assert sorted(map(tuple, alone)) == sorted(map(tuple, all_units))  # whole lines and paragraphs are runs too
    for r in all_units:
        inside = {p: f for p, f in want[r["doc_id"]].items() if r["start"] <= p[0] and p[1] <= r["end"]}
        assert r["first_doc_id"] == min(set().union(*inside.values()))
        got.setdefault(r["doc_id"], set()).update(k for k in range(r["start"], r["end"]) if texts[r["doc_id"]][k] not in " \n")
    assert got == {i: {k for a, b in own for k in range(a, b)} for i, own in want.items()}


def test_clashing_names(spark):
    text = " ".join(f"word{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text, "a", 1, 2, 3, 4), (2, "so " + text, "b", 1, 2, 3, 4)], "doc_id long, text string, kept_spans string, _cuts int, _doc int, start int, _span int")
    cleaned = remove_spans(docs, repeated_spans(docs))
    assert cleaned.columns == docs.columns
    assert sorted(tuple(r) for r in cleaned.collect()) == [(1, text, "a", 1, 2, 3, 4), (2, "so ", "b", 1, 2, 3, 4)]


def test_many_spans_in_a_long_text(spark):
    """Thousands of separate spans in one text are put together in one pass over them."""
    rng = random.Random(3)
    passages = [" ".join(f"p{n}x{k}" for k in range(6)) for n in range(4000)]
    long = " ".join(f"{p} own{rng.random()}" for p in passages)
    docs = spark.createDataFrame([(1, " zz ".join(passages)), (2, long)], "doc_id long, text string")
    spans = repeated_spans(docs, unit="passage", min_words=6).collect()
    assert len(spans) == 4000 and all(long[r["start"] : r["end"]] in set(passages) for r in spans[:50])


def test_passage_in_mid_sentence_without_marks(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, "Some first words " + passage + " and on."), (2, "Other ones before " + passage + " then more words | and | on")], "doc_id long, text string")
    assert [tuple(r) for r in repeated_spans(docs).collect()] == [(2, 18, 18 + len(passage), 1)]
