"""Scores texts by a small language model and by a word model with add-one smoothing.

The language model works on subword ids. P(id | before) = P(class of id | before) * P(id | class): the class is
predicted by a causal self-attention model (``attention``); the second factor comes from counts over all training
rows. Classes are clusters of ids with like neighbours, counted over all training rows; rare ids share classes by whether
they end a word. The model is started in numpy on a bounded sample and then trained on every id of every training row:
in ``ROUNDS`` rounds, each over the rows of one fold, tasks take steps on their own rows and the weights they end with are
averaged by the ids they saw (so scores depend a little on how rows are dealt to tasks). Only weights, counts by id and
counts of neighbours reach the driver.

Texts are cut into words and ids once; counts, training and scoring read the written word hashes and ids.

The word model needs the training count of every word, and words are as many as the corpus makes them. The most
frequent of all rows' words (at most ``head_words``) go to every task; the others are joined, a row for each
occurrence. So no join key is hot, and nothing that grows goes through the driver.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.attention import Adam, Attention, windows
from parcelwise.llm.neardup import Work
from parcelwise.llm.packing import TOKENIZER, id_table
from parcelwise.llm.words import keep_heap, texts, tidy

HEAD_WORDS = 1_000_000
SAMPLE_ROWS = 800
SAMPLE_IDS = 1500
CLASSES = 96
SYMBOLS = 1500
WIDTH = 16
HALF = 16
STEPS = 800
ROUNDS = 4
ROUND_RATE = 0.006
#: Weights are summed as multiples of one part in so many, so that their order hardly matters.
_UNIT = 1 << 20
_MARKS = 200
TABLE_WORDS = 400_000
END = 49407
#: The word that closes every text; no word of a text holds white space.
END_WORD = b"\n"

_BUCKETS = 8  # of counts, per power of two


class _Numbers(dict):
    """Word to its number, by first sight."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Vocabulary:
    """Words seen by a Python worker: hash and ids of each; starts anew when it holds ``limit`` words."""

    def __init__(self, path: str, limit: int = TABLE_WORDS):
        self.table, self.limit = id_table(path), limit
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.hashes, self.starts = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, "<u2")

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, number of ids of each word, all ids)."""
        if len(self.numbers) > self.limit:
            self._clear()
        known = len(self.numbers)
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new = list(islice(self.numbers, known, None))
        if new:
            own = [np.uint32(END).tobytes() if w == END_WORD else self.table[w] for w in new]
            ends = np.cumsum(np.fromiter((len(x) // 4 for x in own), np.int64, len(own)))
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(own), "<u4").astype("<u2")])
        first = self.starts[numbers]
        lengths = self.starts[numbers + 1] - first
        before = np.cumsum(lengths) - lengths
        places = np.repeat(first - before, lengths)
        places += np.arange(len(places))
        return self.hashes[numbers], lengths, self.pool[places]


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _forget_words() -> None:
    """Workers outlive their tasks: what cutting texts needed goes before other work begins."""
    _vocabulary.cache_clear()
    id_table.cache_clear()


def _binary(limits: np.ndarray, values: np.ndarray) -> pa.Array:
    """Row k holds the bytes of ``values[limits[k]:limits[k + 1]]``."""
    offsets = (limits * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(limits) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _encoded(docs: DataFrame, path: str) -> DataFrame:
    """(``doc_id``, ``train``, ``draw``, ``fold``, ``words``, ``ids``) of ``doc_id``, ``train``, ``text``: hashes of the words, eight
    bytes each, and ids, two bytes each, of every row, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)

        def rows(part: pa.RecordBatch, words: list[bytes], sizes: list[int]) -> pa.RecordBatch:
            hashes, lengths, ids = vocabulary.read(words)
            at = np.cumsum([0, *sizes])
            id_at = np.concatenate([[0], np.cumsum(lengths)])[at]
            return pa.record_batch([*part.columns[:4], _binary(at, hashes), _binary(id_at, ids)], names=["doc_id", "train", "draw", "fold", "words", "ids"])

        for batch in batches:
            words, sizes, first = [], [], 0
            for k, text in enumerate(texts(batch, 4)):
                own = (text or b"").lower().split()
                words += own
                words.append(END_WORD)
                sizes.append(len(own) + 1)
                if len(words) > 200_000 or k + 1 == batch.num_rows:
                    yield rows(batch.slice(first, k + 1 - first), words, sizes)
                    words, sizes, first = [], [], k + 1

    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", "train", F.xxhash64("doc_id"), F.pmod(F.xxhash64("text"), F.lit(ROUNDS)).cast("int"), "text")
    return narrow.mapInArrow(tidy(run), f"doc_id {id_type}, train boolean, draw long, fold int, words binary, ids binary")


def _joined(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


def count_corpus(encoded: DataFrame) -> DataFrame:
    """(``kind``, ``key``, ``n_train``, ``n_all``): words by hash (kind 0) and ids (kind 1) over all rows of ``encoded``.

    Tasks add up before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget_words()
        id_counts = np.zeros(1 << 16, np.int64)
        held, n_held = [], 0

        def rows(kind: int, keys: np.ndarray, train: np.ndarray, all_: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(train), pa.array(all_)],
                names=["kind", "key", "n_train", "n_all"],
            )

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            keys, train, every = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], np.add.reduceat(train[order], first), np.add.reduceat(every[order], first)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                is_train = part.column(0)
                for trains, own in ((True, part.filter(is_train)), (False, part.filter(pa.compute.invert(is_train)))):
                    keys, n = np.unique(_joined(own.column(1), "<u8"), return_counts=True)
                    held.append((keys, n if trains else np.zeros(len(n), np.int64), n))
                    n_held += len(keys)
                    if trains:
                        id_counts += np.bincount(_joined(own.column(2), "<u2"), minlength=len(id_counts))
                if n_held > 4 * TABLE_WORDS:
                    held = [merged()]
                    n_held = len(held[0][0])
                    if n_held > TABLE_WORDS:
                        yield rows(0, *held[0])
                        held, n_held = [], 0
        if n_held:
            yield rows(0, *merged())
        used = np.flatnonzero(id_counts)
        yield rows(1, used, id_counts[used], id_counts[used])

    counted = encoded.select("train", "words", "ids").mapInArrow(tidy(run), "kind int, key long, n_train long, n_all long")
    return counted.groupBy("kind", "key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def _bucket(n: Column) -> Column:
    return F.floor(F.log2(n) * _BUCKETS).cast("int")


def _head(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (sorted) and training counts of the most frequent words, and the bucket they begin at."""
    sizes = sorted(words.groupBy(_bucket(F.col("n_all")).alias("b")).count().collect(), reverse=True)  # some hundred rows
    first, held = 10**6, 0
    for bucket, n in sizes:
        if held + n > most:
            break
        first, held = bucket, held + n
    table = words.where(_bucket(F.col("n_all")) >= first).select("key", "n_train").toArrow()
    keys = table["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table["n_train"].to_numpy()[order], first


@dataclass
class Language:
    attention: Attention
    symbol_of: np.ndarray  # by id
    class_of: np.ndarray
    within: np.ndarray  # log P(id | class)

    def log10_probabilities(self, texts: list[np.ndarray], most: int = 512) -> np.ndarray:
        """Of each text; its ids end with the end mark."""
        total = np.zeros(len(texts))
        flat, read, scored, owners = windows(texts, self.attention.half)
        symbols, classes, within = self.symbol_of[flat], self.class_of[flat], self.within[flat]
        symbols[0] = 0
        for at in range(0, len(read), most):
            goal = scored[at : at + most]
            logs = self.attention.log_probabilities(symbols.take(read[at : at + most]), classes.take(goal)) + within.take(goal)
            logs[goal < 0] = 0
            owner = owners[at : at + most]
            total[owner[0] : owner[-1] + 1] += np.bincount(owner - owner[0], logs.sum(axis=1))
        return total / np.log(10)


def _common(counts: np.ndarray, symbols: int) -> np.ndarray:
    """The commonest ids, which are symbols of their own."""
    common = np.argsort(-counts, kind="stable")[: symbols - 3]
    return common[counts[common] > 1]


def _neighbours(texts: list[np.ndarray], common: np.ndarray, n: int) -> np.ndarray:
    """By common id: how often each of the first of them, another id or a border stands left and right of it."""
    marks = _MARKS + 1
    place, mark = np.full(n + 1, len(common)), np.full(n + 1, _MARKS)
    place[common] = np.arange(len(common))
    mark[common[:_MARKS]] = np.arange(min(_MARKS, len(common)))
    flat = np.concatenate([x for own in texts for x in (own, [n])] or [np.zeros(0)]).astype(np.int64)
    row, column = (place * 2 * marks).take(flat), mark.take(flat)
    size = (len(common) + 1) * 2 * marks  # other ids and borders share the last row, which goes
    out = np.bincount(row[:-1] + column[1:], minlength=size)
    out += np.bincount(row[1:] + marks + column[:-1], minlength=size)
    return out.reshape(-1, 2 * marks)[: len(common)]


def _clusters(common: np.ndarray, neighbours: np.ndarray, ends: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(class, symbol) by id: common ids are symbols of their own, and are clustered by their neighbours."""
    alone = common[: max(0, classes // 2)]
    shape = np.sqrt(neighbours / np.maximum(neighbours.sum(axis=1, keepdims=True), 1))
    groups = max(1, classes - len(alone) - 2)
    rest = np.arange(len(alone), len(common))
    group = np.zeros(len(rest), int)
    if len(rest) > groups:
        centres = shape[rest[np.linspace(0, len(rest) - 1, groups).astype(int)]].copy()
        for _ in range(12):
            group = np.argmax(shape[rest] @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
            for g in range(groups):
                if (group == g).any():
                    centres[g] = shape[rest[group == g]].mean(axis=0)
    class_of = np.where(ends, classes - 1, classes - 2)
    class_of[alone] = np.arange(len(alone))
    class_of[common[rest]] = len(alone) + group
    symbol_of = np.where(ends, 2, 1)  # 0 stands before the start
    symbol_of[common] = 3 + np.arange(len(common))
    return class_of, symbol_of


def _learn(
    texts: list[np.ndarray], counts: np.ndarray, ends: np.ndarray, seed: int, steps: int, found: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[Language, list[float]]:
    """The model after ``steps`` on ``texts``; ``found`` are the common ids and their neighbours, else those of the texts."""
    if found is None:
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        common = _common(np.bincount(flat, minlength=len(counts)), SYMBOLS)
        found = common, _neighbours(texts, common, len(counts))
    class_of, symbol_of = _clusters(*found, ends, CLASSES)
    size = np.bincount(class_of, minlength=CLASSES)
    mass = np.bincount(class_of, counts + 0.5, CLASSES)
    within = np.log((counts + 0.5) / mass[class_of])
    attention = Attention.fresh(SYMBOLS, CLASSES, WIDTH, HALF, seed)
    attention.start_from(np.where(size > 0, mass, 0))
    language = Language(attention, symbol_of, class_of, within)
    if not texts:
        return language, []
    losses = attention.train(*_windows(language, texts), steps=steps, batch=256, rate=0.02, seed=seed)
    return language, losses


def _windows(language: Language, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, classes to predict, 1 where one is) of every window."""
    flat, read, scored, _ = windows(texts, language.attention.half)
    symbols = language.symbol_of[flat]
    symbols[0] = 0
    return symbols.take(read), language.class_of[flat].take(scored, mode="wrap"), (scored >= 0).astype(np.float32)


def _texts(column: pa.Array, most: int = 1 << 17) -> Iterator[list[np.ndarray]]:
    """The ids of rows, of so many rows at a time that they have more than ``most`` ids."""
    held, n = [], 0
    for value in column:
        held.append(np.frombuffer(value.as_py(), "<u2"))
        n += len(held[-1])
        if n > most:
            yield held
            held, n = [], 0
    if held:
        yield held


def _summed(df: DataFrame, size: int) -> np.ndarray:
    """``value`` summed by ``place``, of at most ``size`` places."""
    table = df.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size, table["value"].type.to_pandas_dtype())
    out[table["place"].to_numpy()] = table["value"].to_numpy()
    return out


def _all_neighbours(ids: DataFrame, common: np.ndarray, n: int) -> np.ndarray:
    width = 2 * (_MARKS + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(common), width), np.int64)
        for batch in batches:
            for own in _texts(batch.column(0)):
                total += _neighbours(own, common, n)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total.ravel()[used])], names=["place", "value"])

    return _summed(ids.select("ids").mapInArrow(run, "place long, value long"), len(common) * width).reshape(len(common), width)


def _train_on_all(language: Language, ids: DataFrame, seed: int) -> None:
    """One step for every batch of windows of every row; tasks' weights are averaged at the end of each round."""
    attention = language.attention
    shapes = [getattr(attention, name).shape for name in attention.NAMES]
    cuts = np.cumsum([int(np.prod(x)) for x in shapes])
    for fold in range(ROUNDS):
        shared = ids.sparkSession.sparkContext.broadcast(language)
        rate = ROUND_RATE * (1 - fold / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate, fold=fold) -> Iterator[pa.RecordBatch]:
            _forget_words()
            keep_heap()
            own = copy.deepcopy(shared.value)
            rng = np.random.default_rng([seed, fold])
            trainer, n = Adam(own.attention), 0
            for batch in batches:
                for texts_ids in _texts(batch.column(0)):
                    symbols, goals, counted = _windows(own, texts_ids)
                    n += sum(map(len, texts_ids))
                    order = rng.permutation(len(symbols))
                    for some in np.array_split(order, -(-len(order) // 256)):
                        trainer.step(symbols[some], goals[some], counted[some], rate)
            if n:
                weights = np.concatenate([getattr(own.attention, name).ravel() for name in own.attention.NAMES]).astype(np.float64)
                values = np.append(np.rint(weights * _UNIT) / _UNIT * n, n)
                yield pa.record_batch([pa.array(np.arange(len(values))), pa.array(values)], names=["place", "value"])

        sums = _summed(ids.where(F.col("fold") == fold).select("ids").mapInArrow(tidy(run), "place long, value double"), cuts[-1] + 1)
        if sums[-1]:
            means = (sums[:-1] / sums[-1]).astype(np.float32)
            for name, shape, values in zip(attention.NAMES, shapes, np.split(means, cuts[:-1])):
                setattr(attention, name, values.reshape(shape))
        shared.unpersist()


def score_texts(
    docs: DataFrame,
    train: Column,
    *,
    head_words: int = HEAD_WORDS,
    sample_rows: int = SAMPLE_ROWS,
    steps: int = STEPS,
    seed: int = 1,
    tokenizer_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. ``n_known`` counts those that
    the training rows have; ``base_score`` is the word model's log10 probability, ``score`` the language model's.
    Counts, sums, scores and training cover all rows and whole texts. The attention model starts with ``steps`` on at most about
    ``sample_rows`` training rows (smallest hashes), of each a stretch of ``SAMPLE_IDS`` ids at a hashed place; then it
    is trained on every training row once.

    NULL text counts as empty: its end alone. Repeated rows and NULL ids are scored like others, a NULL ``train`` is
    no training row; other columns are ignored, an empty table gives no row. Without training rows every count is 0.
    Long texts are read in pieces that repeat the ids before them, with the same score.
    """
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    work = Work(docs.sparkSession)
    narrow = docs.select(docs[id_col].alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), docs[text_col].alias("text"))
    encoded = work.keep(_encoded(narrow, path))
    counted = work.keep(count_corpus(encoded))
    words = counted.where("kind = 0")
    n_train, kinds = words.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count_if(F.col("n_train") > 0)).first()
    head_keys, head_counts, first_bucket = _head(words, head_words)

    id_counts = np.zeros(END + 1, np.int64)
    for r in counted.where("kind = 1").collect():  # one row for each id of the tokenizer at most
        id_counts[r["key"]] = r["n_train"]
    ends = id_table(path).word_ends()
    ids = encoded.where("train").select("draw", "fold", "ids")
    common = _common(id_counts, SYMBOLS)
    found = common, _all_neighbours(ids, common, len(id_counts))
    share = min(1.0, sample_rows / max(1, ids.count()))
    drawn = ids.where(F.pmod("draw", F.lit(1_000_003)) < share * 1_000_003)
    language, _ = _learn(_sample(drawn), id_counts, ends, seed, steps, found)
    _train_on_all(language, ids, seed)

    session = docs.sparkSession
    shared = session.sparkContext.broadcast((language, head_keys, np.log10(head_counts + 1.0), head_counts > 0))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget_words()
        keep_heap()
        language, keys, logs, known = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            first = 0
            for own in _texts(batch.column(3)):
                part = batch.slice(first, len(own))
                first += len(own)
                hashed = _joined(part.column(2), "<u8")
                sizes = np.fromiter((len(x.as_py()) // 8 for x in part.column(2)), np.int64, len(own))
                owner = np.repeat(np.arange(len(own)), sizes)
                order = np.argsort(hashed)  # neighbours are looked up together, so less of the long table passes the caches
                where = np.empty(len(hashed), np.int64)
                where[order] = np.minimum(np.searchsorted(keys, hashed[order]), max(0, len(keys) - 1))
                found = keys[where] == hashed if len(keys) else np.zeros(len(hashed), bool)
                add = lambda values: np.bincount(owner[found], values[where[found]], len(own))  # noqa: B023, E731
                tail_ends = np.cumsum(np.bincount(owner[~found], minlength=len(own)))
                tails = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], tail_ends]), pa.int32()), pa.array(hashed[~found].view(np.int64)))
                numbers = np.arange(row, row + len(own))
                row += len(own)
                yield pa.record_batch(
                    [*part.columns[:2], pa.array(numbers), pa.array(sizes), pa.array(add(known).astype(np.int64)), pa.array(add(logs).astype(float)), tails, pa.array(language.log10_probabilities(own))],
                    names=["doc_id", "train", "row", "n_tokens", "n_known", "head_logs", "tail", "score"],
                )

    scored = work.keep(
        encoded.select("doc_id", "train", "words", "ids").mapInArrow(
            tidy(run), f"doc_id {id_type}, train boolean, row long, n_tokens long, n_known long, head_logs double, tail array<long>, score double"
        )
    )
    rare = words.where(_bucket(F.col("n_all")) < first_bucket).where("n_train > 0").select("key", "n_train")
    tail = (
        scored.select("row", F.explode("tail").alias("key"))
        .join(rare, "key")
        .groupBy("row")
        .agg(F.count("*").alias("tail_known"), F.sum(F.log10(F.col("n_train") + 1.0)).alias("tail_logs"))
    )
    unseen = float(np.log10(n_train + kinds + 1))
    known_logs = F.col("head_logs") + F.coalesce("tail_logs", F.lit(0.0))
    return scored.drop("tail").join(tail, "row", "left").select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (known_logs - F.col("n_tokens") * unseen).alias("base_score"),
        "score",
    )


def _sample(drawn: DataFrame) -> list[np.ndarray]:
    """Ids of the drawn rows, of each a stretch of bounded length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for value in batch.column(1):
                ids = np.frombuffer(value.as_py(), "<u2")
                begin = (len(ids) * 7919) % max(1, len(ids) - SAMPLE_IDS + 1)
                own.append(ids[begin : begin + SAMPLE_IDS].tobytes())
            yield pa.record_batch([batch.column(0), pa.array(own, pa.binary())], names=["draw", "ids"])

    found = drawn.select("draw", "ids").mapInArrow(run, "draw long, ids binary")
    rows = sorted((r["draw"], bytes(r["ids"])) for r in found.collect())
    return [np.frombuffer(ids, "<u2").astype(np.int64) for _, ids in rows]
