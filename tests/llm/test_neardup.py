import random

import numpy as np

from parcelwise.llm import neardup
from parcelwise.llm.neardup import least_matches, near_duplicates, shingle_set, signatures
from parcelwise.llm.words import WordHashes


def brute(rows, size, similarity=0.8):
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])))
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and i != j:
                common = len(a & b)
                if 100 * common >= round(100 * similarity) * (len(a) + len(b) - common):
                    p, q = find(i), find(j)
                    parent[max(p, q)] = min(p, q)
    return {i: (len(a), find(i)) for i, a in sets}


def corpus(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    rows, n = [], 0
    for group in range(25):
        base = [word() for _ in range(rng.choice([1, 3, 4, 5, 30, 120]))]
        for _ in range(rng.choice([1, 2, 3, 12])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = word()
            rows.append((n, " ".join(own).title() if rng.random() < 0.2 else "  ".join(own)))
            n += 1
    passage = [word() for _ in range(60)]
    rows += [(n + k, " ".join([word() for _ in range(30)] + passage)) for k in range(40)]
    n += 40
    chain = [word() for _ in range(100)]
    for k in range(25):  # a chain of near copies whose ends have little in common
        rows.append((n + k, " ".join(chain)))
        chain[4 * k : 4 * k + 2] = [word(), word()]
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "x"), (904, "X"), (905, "a b c"), (906, "A  B\nC")]
    rng.shuffle(rows)
    return rows


def test_components_match_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "k", 7) for r in rows], "doc_id long, text string, class string, n long").repartition(3)
    for size in (4, 5):
        want = brute(rows, size)
        got = {r["doc_id"]: r for r in near_duplicates(docs, words=size, block=8).collect()}
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
        assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(None, text), (None, text), (3, text), (3, text), (2, text), (9, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == [("2", 2, True), ("3", 2, False), ("3", 2, False), ("9", 9, True), ("None", None, True), ("None", None, True)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_signature_matches_follow_the_similarity():
    rng = np.random.default_rng(1)
    a = neardup._multipliers(64)
    seen = []
    for _ in range(300):
        common, x, y = (rng.integers(0, 2**63, n, np.int64).astype(np.uint64) for n in (400, 50, 50))
        s = signatures([np.concatenate([common, x]), np.concatenate([common, y])], a)
        seen.append((s[0] == s[1]).sum())
    assert abs(np.mean(seen) - 64 * 0.8) < 0.7 and abs(np.std(seen) - 3.2) < 0.5
    assert least_matches(64, 0.8) <= 36 and min(seen) >= least_matches(64, 0.8)


def test_sets():
    h = WordHashes()
    assert len(shingle_set(b"a b c d e", 4, h)) == 2 and len(shingle_set(b"a b", 4, h)) == 1 and not len(shingle_set(None, 4, h))
    assert shingle_set(b"A B c", 4, h) == shingle_set(b" a\nb C ", 4, h)
