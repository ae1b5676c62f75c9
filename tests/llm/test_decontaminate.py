import random

from hypothesis import given, settings
from hypothesis import strategies as st

from parcelwise.llm.decontaminate import Matcher, Pattern, find_items, normalised, offsets, pieces


def least(item, text):
    """Least edit distance of the item to any substring, by the textbook table."""
    row = [0] * (len(text) + 1)
    for k, c in enumerate(item, 1):
        new = [k]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edits(a, b):
    row = list(range(len(b) + 1))
    for k, c in enumerate(a, 1):
        new = [k]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("ab ", min_size=1, max_size=9), st.text("ab c", max_size=25))
def test_distance(item, text):
    best = least(item, text)
    for budget in (best - 1, best, len(item)):
        if budget < 0:
            continue
        found = Pattern(item, budget).find(text)
        if best > budget:
            assert found is None
        elif best < len(item):
            distance, start, end = found
            assert distance == best == edits(item, text[start:end])


@settings(max_examples=200, deadline=None)
@given(st.text("aB_ .\nİß1é", max_size=20))
def test_offsets(text):
    plain = normalised(text)
    back = offsets(text)
    assert len(back) == len(plain)
    assert all(c == " " or c in text[at].lower() for c, at in zip(plain, back))


def test_pieces_cover_the_item():
    for n in range(1, 40):
        for k in range(n):
            own = pieces("x" * n, k)
            assert len(own) == k + 1 and sum(len(p) for _, p in own) == n and all(p for _, p in own)


def test_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(2, 6)))
    items = [(k, " ".join(word() for _ in range(12))) for k in range(6)] + [(6, None), (7, "?!"), (8, "tiny")]
    docs = []
    for n in range(120):
        text = [word() for _ in range(30)]
        if n % 3 == 0:
            inner = list(rng.choice(items[:6])[1])
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 9])):
                at = rng.randrange(len(inner))
                inner[at : at + rng.choice([0, 1])] = rng.choice("abcde ")
            text[10:10] = ["".join(inner).upper() if n % 2 else "".join(inner)]
        docs.append((n, ", ".join(text[:5]) + "\n" + "  ".join(text[5:])))
    docs += [(200, None), (201, ""), (202, "a tiny thing"), (203, "tinytiny"), (None, items[0][1]), (202, "a tiny thing")]
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*i, "s") for i in items], "item_id long, text string, doc_id string")
    want = set()
    for d, text in docs:
        for i, item in items:
            plain, own = normalised(text or ""), normalised(item or "")
            if own and plain and least(own, plain) <= int(0.05 * len(own)):
                want.add((d, i))
    assert len(want) > 20
    for block in (10**6, 100):
        got = find_items(table, bench, block_chars=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
    texts = dict(docs)
    for r in got:
        own = normalised(dict(items)[r["item_id"]])
        assert edits(own, normalised(texts[r["doc_id"]][r["start"] : r["end"]])) <= r["distance"] + 2
    assert find_items(table.limit(0), bench).collect() == [] and find_items(table, bench.limit(0)).collect() == []


def test_every_place_once():
    matcher = Matcher([("a", "some words of an item to be found")], 0.05)
    text = "x Some words, of an item to be found. y some words of an iten to be found"
    got = sorted(matcher.find(text), key=lambda r: r[1])
    assert [(text[s:e], d) for _, s, e, d in got] == [("Some words, of an item to be found", 0), ("some words of an iten to be found", 1)]


def test_equal_items_and_many_blocks(spark):
    """Equal texts are searched once and named each, in one block or in many; a NULL item id stays NULL."""
    texts = [f"item number {chr(97 + k)}{chr(98 + k)} asks what comes after {chr(97 + k) * 5}" for k in range(20)]
    items = [(k, t) for k, t in enumerate(texts)] + [(100, texts[0]), (101, texts[0]), (100, texts[0]), (None, texts[1])]
    docs = [(k, f"before {t.upper()} after") for k, t in enumerate(texts)] + [(0, f"before {texts[0].upper()} after")]
    table = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id long, text string, key string, block int")
    bench = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, key int")
    got = [sorted(map(repr, find_items(table, bench, block_chars=n).collect())) for n in (10**6, 400)]
    assert len(got[0]) == 2 * 4 + 2 + 18
    assert got[0] == got[1]


def test_very_long_text(spark):
    item = "the question that a very long text holds at its very end"
    text = "nothing but filler, " * 150_000
    docs = spark.createDataFrame([(1, text + item + "."), (2, text)], "doc_id long, text string")
    row = find_items(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [tuple(r) for r in row] == [(1, 7, len(text), len(text) + len(item), 0)]
