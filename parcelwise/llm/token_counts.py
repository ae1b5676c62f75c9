"""Token counts of whole texts, by a public sentencepiece model.

Texts go to the library in batches of about equal bytes, and only lengths come back. A long
text is cut at safe boundaries first, so that no call holds more than a batch: before a space
that follows neither a space nor the model's space mark. No piece of the vocabulary continues
over such a place (checked when the model is loaded), so the pieces' lengths add up to the
length of the whole. The cut drops the space, as the library puts a mark before every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

MODEL = "piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16

_MARK = "▁"
_SAFE = re.compile(f"[^ {_MARK}] (?=.)", re.DOTALL)


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters whose token counts add up.

    A stretch without a safe boundary stays whole, however long it is.
    """
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size - 1)
        if not found:
            break
        yield text[start : found.start() + 1]
        start = found.start() + 2
    yield text[start:]


def _load(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if _MARK in p.lstrip(_MARK)]
    if crossing:
        raise ValueError(f"{path}: pieces go on over a space, texts cannot be cut there: {crossing[:3]}")
    return model


def count_tokens(
    docs: DataFrame,
    *,
    limit: int = 4096,
    model_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and whether that is over ``limit``.

    NULL text counts as empty: no bytes, no tokens. A NULL id stays NULL, repeated rows are
    counted each, an empty table gives an empty result; other columns are ignored. The model is
    read from ``model_path`` on the executors. No shuffle: a row depends on itself alone.
    """
    path = model_path or public_tokenizers.path(MODEL)
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(path)
        for batch in batches:
            n_tokens = np.zeros(batch.num_rows, np.int64)
            n_bytes = np.zeros(batch.num_rows, np.int64)
            pieces: list[str] = []
            owners: list[int] = []
            held = 0

            def flush() -> None:
                lengths = [len(ids) for ids in model.encode(pieces, num_threads=1)]
                np.add.at(n_tokens, owners, lengths)
                pieces.clear()
                owners.clear()

            for row, value in enumerate(batch.column(1)):
                text = value.as_py()
                if not text:
                    continue
                n_bytes[row] = len(text.encode())
                for piece in safe_pieces(text, piece_chars):
                    pieces.append(piece)
                    owners.append(row)
                    held += len(piece)
                    if held >= batch_bytes:
                        flush()
                        held = 0
            if pieces:
                flush()
            yield pa.record_batch(
                [batch.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return narrow.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
