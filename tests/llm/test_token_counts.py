import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelwise.llm.token_counts import MODEL, count_tokens, safe_pieces

model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab  .\n\t▁é<s>🙂1")), max_size=60), st.integers(1, 12))
def test_pieces_add_up(text, size):
    assert sum(len(model.encode(p)) for p in safe_pieces(text, size)) == len(model.encode(text))


def test_counts_whole_texts(spark):
    long_text = "lorem ipsum  dolor </s> " * 9000
    rows = [(1, "Hello world", "x"), (2, None, "y"), (3, "", None), (None, "a", "z"), (5, long_text, "x"), (1, "Hello world", "x"), (6, "é" * 70_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.asDict() for r in count_tokens(docs, limit=2, batch_bytes=5000, piece_chars=700).collect()), key=str)
    want = [
        {"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": (n := len(model.encode(t or ""))), "over_limit": n > 2}
        for i, t, _ in rows
    ]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(empty).collect() == []
