import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelwise.llm.packing import TOKENIZER, WordIds, cut, pack, words_of

PATH = public_tokenizers.path(TOKENIZER)
library = Tokenizer.from_file(PATH)
words = WordIds(PATH, limit=50)


PARTS = ["Zebra.", "street;", "stop!?", "x.y", "ẞig", *"aBé ßÀİΣς.,!?'\n\t\u3000\x1cćs<>|_1½µ漢🙂", "<|endoftext|>", "don't ", "WORD. "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25))
def test_words_give_the_ids_of_the_text(parts):
    text = "".join(parts)
    got = b"".join(map(words.__getitem__, text.encode().split()))
    assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


CASED = ["J\u030c T\u0308", "<|ENDOFTEXT|>", "İI\u0307", "É'S été", "Oieux###", "K%%%", "X\u0331", '"Hello," ', " a_b|", "Don'T", "ΑΣ."]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS + CASED), max_size=25))
def test_words_in_lower_case_give_the_ids_of_the_text(parts):
    text = "".join(parts)
    got = b"".join(map(words.__getitem__, words_of(text.encode())))
    assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_word_is_asked_of_the_model_once_however_it_is_written():
    own, asked = WordIds(PATH), []
    model = own.model
    own.model = type("Model", (), {"tokenize": lambda self, text: asked.append(text) or model.tokenize(text)})()
    own.tokenizer = None  # none of these needs it but the marks, which the model knows as well
    own[b"###"] = own[b"%%"] = own[b"..."] = b""
    for word in words_of(b"Street STREET street street### Street%% sTREET... street"):
        own[word]
    assert asked == ["street"] and len(own) == 3 + 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0, 3, 8])), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(steps):
    size = 16
    places = np.cumsum([0] + [s for s, _ in steps])
    penalties = np.array([0.0] + [p for _, p in steps])

    def cost(i, j):
        length = places[j] - places[i]
        return 0 if length in (2, 4, 8) else size - length

    best = [0.0]
    for j in range(1, len(places)):
        best.append(penalties[j] + min(best[i] + cost(i, j) for i in range(j) if places[j] - places[i] <= size))
    cuts = cut(places, penalties, size)
    assert cuts[0] == 0 and cuts[-1] == len(places) - 1
    assert all(places[b] - places[a] <= size for a, b in zip(cuts, cuts[1:]))
    assert sum(cost(a, b) + penalties[b] for a, b in zip(cuts, cuts[1:])) == pytest.approx(best[-1])


def test_every_token_once_in_gapless_sequences(spark):
    rows = [(i, f"Word number {i} of this text. " * (i % 23)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "endless " * 9000), (None, "no id."), (7, "twice."), (7, "twice.")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, start int").repartition(3)
    got = pack(docs, size=256, block_tokens=3000).collect()
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(library.encode(text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = {}, {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] > 0
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(want)
    for i, own in pieces.items():
        if len(want[i]) == 1:
            assert sum((ids for _, ids, _ in sorted(own)), []) == want[i][0]
            assert {n for *_, n in own} == {len(want[i][0])}
    assert sum(r["length"] for r in got) == sum(len(x) for v in want.values() for x in v)
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding < 0.05 * sum(r["length"] for r in got)


def test_empty_table_and_checksums(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    from parcelwise.llm.queries import packed_digests

    docs = spark.createDataFrame([(1, "A few words.")], "doc_id long, text string")
    ids = np.array(library.encode("A few words.", add_special_tokens=False).ids + [1], "<u4")
    assert packed_digests(docs).first()["ids_crc32"] == zlib.crc32(ids.tobytes())
