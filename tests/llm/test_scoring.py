import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import attention
from parcelwise.llm.attention import Attention, _column_exp, _row_exp, _softmax, overlapping, windows
from parcelwise.llm.scoring import CLASSES, END, Language, _learn, _neighbours, score_texts


def test_gradients():
    rng = np.random.default_rng(0)
    model = Attention.fresh(7, 5, 4, 3, seed=2)
    for name in model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))
    symbols, targets = rng.integers(0, 7, (6, 6)), rng.integers(0, 5, (6, 3))
    counted = (rng.random((6, 3)) < 0.8).astype(float)
    loss, slopes = model.step(symbols, targets, counted)
    direct = -(model.log_probabilities(symbols, targets) * counted).sum() / counted.sum()
    assert loss == pytest.approx(direct, rel=1e-5)
    for name in model.NAMES:
        table = getattr(model, name)
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in table.shape)
            old = table[at]
            table[at] = old + 1e-5
            up = model.step(symbols, targets, counted)[0]
            table[at] = old - 1e-5
            down = model.step(symbols, targets, counted)[0]
            table[at] = old
            assert slopes[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_nothing_looks_ahead():
    model = Attention.fresh(9, 4, 8, 5, seed=1)
    rng = np.random.default_rng(3)
    symbols, targets = rng.integers(0, 9, (4, 10)), rng.integers(0, 4, (4, 5))
    before = model.log_probabilities(symbols, targets)
    for place in range(5):
        changed = symbols.copy()
        changed[:, 5 + place] = (changed[:, 5 + place] + 1) % 9
        after = model.log_probabilities(changed, targets)
        assert np.allclose(before[:, :place], after[:, :place]) and not np.allclose(before[:, place:], after[:, place:])


def test_every_place_is_scored_once_from_what_is_before():
    texts = [np.arange(1, n + 1) + 100 * k for k, n in enumerate((1, 4, 5, 13))]
    flat = np.concatenate([[0], *texts])
    read, scored, owners = overlapping(texts, 4)
    for k, own in enumerate(texts):
        mine = owners == k
        goals = flat[scored[mine]][scored[mine] >= 0]
        assert goals.tolist() == own.tolist()
        for r, s in zip(read[mine], scored[mine]):
            for j, goal in enumerate(s):
                if goal >= 0:
                    n = flat[goal] - 100 * k  # its number in the text, from 1
                    want = [x + 100 * k if x > 0 else 0 for x in range(n - 1 - 4 - j, n)]
                    assert flat[r[: 4 + j + 1]].tolist()[-len(want) :] == [w for w in want][-(4 + j + 1) :]


def test_probabilities_sum_to_one_and_training_helps():
    rng = np.random.default_rng(5)
    counts = np.zeros(END + 1, np.int64)
    texts = []
    for _ in range(60):
        ids = [int(rng.integers(0, 50))]
        for _ in range(200):
            ids.append((ids[-1] * 3 + 1) % 50 if rng.random() < 0.9 else int(rng.integers(0, 50)))
        texts.append(np.array([*ids, END]))
        np.add.at(counts, texts[-1], 1)
    ends = np.zeros(END + 1, bool)
    ends[::2] = True
    language, losses = _learn(texts, counts, ends, seed=1, steps=300)
    assert np.mean(losses[-10:]) < 0.6 * losses[0]
    prefix = texts[0][:6]
    base = language.log10_probabilities([prefix])[0]
    total = 0.0
    for at in range(0, END + 1, 4000):
        more = [np.append(prefix, k) for k in range(at, min(END + 1, at + 4000))]
        total += (10 ** (language.log10_probabilities(more) - base)).sum()
    assert total == pytest.approx(1, abs=1e-3)
    assert isinstance(language, Language) and language.class_of.max() < CLASSES


def test_slices_of_windows_give_the_same_step(monkeypatch):
    rng = np.random.default_rng(6)
    model = Attention.fresh(30, 11, 8, 4, seed=2)
    symbols, targets = rng.integers(0, 30, (23, 8)), rng.integers(0, 11, (23, 4))
    counted = (rng.random((23, 4)) < 0.8).astype(np.float32)
    loss, slopes = model.step(symbols, targets, counted)
    logs = model.log_probabilities(symbols, targets)
    for size in (1, 5, 23):
        monkeypatch.setattr(attention, "SLICE", size)
        again, other = model.step(symbols, targets, counted)
        assert again == pytest.approx(loss, rel=1e-5) and all(np.allclose(other[name], slopes[name], atol=1e-5) for name in model.NAMES)
        assert np.allclose(model.log_probabilities(symbols, targets), logs, atol=1e-5)


def test_scores_that_e_cannot_hold_keep_their_probabilities():
    scores = np.array([[[90, -200], [500, -201], [500, -200]]], np.float32)
    out, sums = _column_exp(scores.copy(), np.array([[0, 0], [0, 0], [0, -1e4]], np.float32))
    assert np.allclose((out / sums[:, None])[0].T, [[0, 0.5, 0.5], [0.7311, 0.2689, 0]], atol=1e-3)
    out, sums, logs = _row_exp(np.array([[0, 1, 2], [-900, -901, -900], [500, 0, -1e4]], np.float32))
    assert (out / sums[:, None])[1] == pytest.approx([0.4223, 0.1554, 0.4223], abs=1e-3)
    assert logs == pytest.approx([2.4076, -899.138, 500], abs=1e-2)


def plain_log10(language, ids):
    """One id after the other, every sum written out."""
    model, total = language.attention, 0.0
    half, width = model.half, model.query.shape[0]
    size = model.bias.shape[1]
    for t, goal in enumerate(ids):
        begin = t // half * half
        before = [language.symbol_of[ids[at]] if at >= 0 else 0 for at in range(begin - half - 1, t)]
        x = [model.embed[s].astype(float) + model.place[k] for k, s in enumerate(before)]
        weights = np.exp([x[-1] @ model.query @ (own @ model.key) / math.sqrt(width) for own in x])
        here = x[-1] + sum(w * (own @ model.value) for w, own in zip(weights / weights.sum(), x)) @ model.mix
        group, inner = divmod(int(language.class_of[goal]), size)
        first, second = np.exp(here @ model.top + model.top_bias), np.exp(here @ model.out[group] + model.bias[group])
        total += math.log10(first[group] / first.sum()) + math.log10(second[inner] / second.sum()) + language.within[goal] / math.log(10)
    return total


def test_scores_match_a_plain_loop():
    rng = np.random.default_rng(8)
    texts = [np.append(rng.integers(0, 40, n), END) for n in (0, 1, 15, 16, 17, 70, 300)]
    counts = np.bincount(np.concatenate(texts), minlength=END + 1)
    language, _ = _learn(texts, counts, np.arange(END + 1) % 2 == 0, seed=3, steps=30)
    assert language.log10_probabilities(texts) == pytest.approx([plain_log10(language, own) for own in texts], rel=1e-4)
    assert language.log10_probabilities(texts, most=3) == pytest.approx(language.log10_probabilities(texts), rel=1e-5)


def test_long_texts_in_pieces_are_scored_alike():
    rng = np.random.default_rng(9)
    model = Attention.fresh(100, 10, 8, 4, seed=2)
    texts = [rng.integers(1, 100, n) for n in (1, 7, 64, 65, 200, 331)]
    sums = []
    for most in (1 << 17, 16, 8):
        flat, read, scored, owners = windows(texts, 4, most)
        counted = scored >= 0
        assert np.bincount(owners, counted.sum(axis=1)).tolist() == [len(x) for x in texts]
        logs = model.log_probabilities(np.where(read > 0, flat[read], 0), flat[scored] % 10)
        sums.append(np.bincount(owners, (logs * counted).sum(axis=1)))
    assert sums[1] == pytest.approx(sums[0], rel=1e-5) and sums[2] == pytest.approx(sums[0], rel=1e-5)


def test_rows_far_apart_keep_their_probabilities():
    scores = np.array([[0, 1, 2], [-900, -901, -900], [500, 0, -1e4]], np.float32)
    p, logs = _softmax(scores.copy())
    assert p.sum(axis=1) == pytest.approx(1) and p[1] == pytest.approx([0.4223, 0.1554, 0.4223], abs=1e-3)
    assert logs == pytest.approx([2.4076, -899.138, 500], abs=1e-2)


def test_neighbours_match_a_plain_count():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 300, n) for n in (1, 2, 50, 4000)]
    common = rng.permutation(300)[:250]
    plain = np.zeros((len(common), 402), np.int64)
    place, mark = {int(x): k for k, x in enumerate(common)}, {int(x): k for k, x in enumerate(common[:200])}
    flat = [x for own in texts for x in (*own.tolist(), -1)]
    for left, right in zip(flat, flat[1:]):
        if left in place:
            plain[place[left], mark.get(right, 200)] += 1
        if right in place:
            plain[place[right], 201 + mark.get(left, 200)] += 1
    assert (_neighbours(texts, common, END + 1) == plain).all()


def plain_scores(rows, train):
    tokens = [(i, [w.decode() for w in (t or "").encode().lower().split()] + [None]) for i, t in rows]
    c = Counter(w for i, own in tokens if train(i) for w in own)
    n, v = sum(c.values()), len(c)
    return sorted((i if i is not None else -1, len(own), sum(w in c for w in own), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), 6)) for i, own in tokens)


@pytest.mark.parametrize("head", [1_000_000, 20, 0])
def test_base_scores_match_brute_force(spark, head):
    rows = [(i, " ".join(f"W{(i * k) % 17} common" if k % 3 else f"rare{i}x{k}" for k in range(i % 12))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "common words"), (3, rows[3][1]), (102, "unseen " * 500)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double").repartition(3)
    train = lambda i: i is not None and i % 3 != 0 and i != 102
    got = score_texts(docs, (F.col("doc_id") % 3 != 0) & (F.col("doc_id") != 102), head_words=head, steps=5).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == plain_scores(rows, train)
    assert all(r["score"] < 0 for r in got)


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = score_texts(docs, F.lit(False), steps=2).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["base_score"]) for r in got) == [(1, 0, 0.0), (3, 0, 0.0)]
    assert score_texts(docs.limit(0), F.lit(True), steps=2).collect() == []


def test_held_out_text_is_likelier_than_by_single_ids(spark):
    from parcelwise.llm.packing import TOKENIZER, id_table
    from parcelwise.llm.queries import op4_lm_scoring

    rows = {r["doc_id"]: r for r in op4_lm_scoring(spark, "/root/testdata/sf0.01").collect()}
    table = id_table(public_tokenizers.path(TOKENIZER))
    ids = {}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        ids[r["doc_id"]] = np.append(np.frombuffer(b"".join(map(table.__getitem__, r["text"].encode().split())), "<u4"), END)
    counts = np.full(END + 1, 0.5)
    for i, own in ids.items():
        if not rows[i]["held_out"]:
            np.add.at(counts, own, 1)
    logs = np.log10(counts / counts.sum())
    held = [i for i in ids if rows[i]["held_out"]]
    assert sum(rows[i]["score"] for i in held) > 0.85 * sum(logs[ids[i]].sum() for i in held)


def test_all_training_rows_shape_the_model(spark):
    """A source outside the sample, in long texts: its ids and their order are learned all the same."""
    rng = np.random.default_rng(4)
    names = [f"{a}{b}" for a in ("zorb", "quil", "vamp", "drex") for b in ("ine", "osk", "ula")]

    def chain(n):
        at, own = 0, []
        for _ in range(n):
            at = (at * 5 + 1) % 12 if rng.random() < 0.95 else int(rng.integers(0, 12))
            own.append(names[at])
        return own

    rows = [(k, " ".join(chain(400))) for k in range(120)]
    held = [(1000, " ".join(ordered := chain(400))), (1001, " ".join(rng.permutation(ordered)))]
    docs = spark.createDataFrame(rows + held, "doc_id long, text string").repartition(2)
    # No row is drawn for the start, so only what is counted and trained over all rows can tell order from none.
    got = {r["doc_id"]: r["score"] for r in score_texts(docs, F.col("doc_id") < 1000, sample_rows=0, steps=5).collect()}
    assert got[1000] > got[1001] + 15
