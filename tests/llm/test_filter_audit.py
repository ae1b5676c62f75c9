import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelwise.llm import filter_audit as fa

SCHEMA = "doc_id long, text string, source string, part string, mask int, copies string, key long, _hot_8 int"
LETTERS = "ABCDE"


def brute_masks(rows):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, text, part in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": text in least and (i is None or least[text] < i),
        }
        yield i, part or "", "".join(c for c in LETTERS if fails[c])


def brute(rows, labels):
    quality, toxic = defaultdict(int), defaultdict(int)
    for i, q, t in labels:
        quality[i] = max(quality[i], q == 1)
        toxic[i] = max(toxic[i], t == 1)
    docs = list(brute_masks(rows))
    out = {}
    for part in {p for _, p, _ in docs}:
        own = [(i, fails) for i, p, fails in docs if p == part]
        shapley = Counter()
        for order in permutations(LETTERS):
            left = own
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[1]]
                left = [d for d in left if c not in d[1]]
                failing = [d for d in own if c in d[1]]
                shapley[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(f == c for _, f in own),
                    sum(quality[i] for i, _ in gone if i is not None), sum(toxic[i] for i, _ in gone if i is not None),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def table(spark):
    rng = random.Random(7)
    word = lambda: rng.choice(["the", "Of", "a#b", "x", "é🙂", "tale", "zone", "it"]) + str(rng.randrange(rng.choice([3, 900])))
    head = " ".join(f"licence{k}" for k in range(60))
    texts = [" ".join(word() for _ in range(rng.choice([0, 1, 20, 49, 50, 51, 120]))) for _ in range(60)]
    texts += [head + f" {k} tail" for k in range(30)] + [head, head + " ", None, "", " ", "SHOUT " * 60, "a" * 9]
    texts += ["w" + " w".join(str(k) for k in range(9000)) + " é" * 50]
    rows = [(i, rng.choice(texts), rng.choice(["s0"] * 5 + ["s1", "s2", None, ""])) for i in rng.sample(range(-100, 2000), 500)]
    rows += [(None, rng.choice(texts), "s1") for _ in range(60)] + [(None, f"only {k % 3}", "s3") for k in range(9)]
    rows += [rows[0]] * 50 + [(rows[1][0], rows[1][1], "s9")] * 7 + [(rows[2][0], "other text", "s0")]
    rows += [(5_000 + k, texts[5], "s0") for k in range(400)]
    rng.shuffle(rows)
    labels = [(i, rng.randrange(2), rng.choice([0, 1, None])) for i, _, _ in rows[:300]] + [(None, 1, 1), (999_999, 1, 1)]
    df = spark.createDataFrame([(*r, "p", 99, "c", 7, 1) for r in rows], SCHEMA)
    return rows, labels, df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def audited(masked, labels):
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in fa.orders(fa.count_masks(masked, labels)).collect()}


def test_equals_brute_force(spark):
    rows, labels, df, label_table = table(spark)
    assert audited(fa.masks(df.repartition(5)), label_table) == brute(rows, labels)


def test_small_tries_and_cells(spark, monkeypatch):
    """Tries that are written out after a few texts, cells whose prefixes have to grow, many ranges."""
    monkeypatch.setattr(fa, "RANGE_BYTES", 20_000)
    monkeypatch.setattr(fa, "LEAST_CELL", 1)
    rows, labels, df, label_table = table(spark)
    want = brute(rows, labels)
    assert audited(fa.masks(df, trie_bytes=3_000, cell_bytes=2_000), label_table) == want
    assert audited(fa.masks(df.repartition(3), trie_bytes=1, cell_bytes=1), label_table) == want


def test_prefixes_grow_only_where_texts_differ(spark, monkeypatch):
    monkeypatch.setattr(fa, "LEAST_CELL", 2_000)
    head = "h" * 100
    rows = [(head + str(k % 40),) for k in range(400)] + [("same" * 50,)] * 300 + [(f"{k:08d} x",) for k in range(50)]
    df = spark.createDataFrame(rows, "text string")
    keys = fa._with_prefixes(df, 60_000, 2_000).select("text", "key").collect()
    assert all(r["text"].startswith(r["key"]) for r in keys)
    assert {len(r["key"]) for r in keys if r["text"].startswith("h")} == {101, 102}
    assert {len(r["key"]) for r in keys if r["text"].startswith("s")} == {8}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(fa.masks(docs), labels) == {}
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    got = audited(fa.masks(one), labels)
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and got["", "BACDE", 1] == (1, 0, 0, 0, 0, 0, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=12) | st.text("ab", max_size=30).map(str.encode), max_size=40))
def test_trie_holds_each_text_once(texts):
    trie = fa.Trie()
    for text in texts:
        node = trie.find(text)
        node.at_least = (node.at_least or Counter()) + Counter(["n"])
    assert {t: n.at_least["n"] for t, n in trie.terminals()} == Counter(texts)


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 400_000])
def test_long_texts_are_counted_in_stretches(n):
    text = ("word " * n).encode() + b"\x1c \x85"
    assert fa.failed(text) & 1 == (n + 2 < 50) and bool(fa.failed(text) & 2) == (n > 2)
