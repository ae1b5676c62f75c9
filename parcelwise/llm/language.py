"""Language of whole texts by word-first backoff.

``fit`` counts words and character n-grams per language on a bounded sample of labelled rows and
keeps the most frequent of each. A text is scored word by word: a known word by its log frequency in
each language; an unseen word from left to right by the longest known n-gram at each place, from
``ORDERS[0]`` characters down to one, at a discount for every step down. The language with the
greatest sum wins, ties go to the first name. The score is the winner's share after a softmax of the
mean per scored unit, so it tells how clearly a text speaks, not how long it is.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.words import texts, tidy

ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"
SAMPLE_ROWS = 2000
MOST_WORDS = 20_000
MOST_GRAMS = 5_000
MOST_LANGUAGES = 200
#: Different units that a task counts before it passes them on.
COUNTED = 100_000
#: Each step from words to n-grams and to shorter n-grams weighs so much less.
DISCOUNT = 0.6

_WORD = regex.compile(r"[\p{L}\p{M}]*\p{L}[\p{L}\p{M}]*")
_WORD_OR_END = regex.compile(rf"{_WORD.pattern}|\n")


def words_of(text: str) -> list[str]:
    """Letters in lower case, with their marks; nothing else tells a language here."""
    return _WORD.findall(text.lower())


class Model:
    """Units of length 0 (words) and of each order, with their log frequency in the languages that have them.

    Only known cells (unit, language) are held, above the floor that a language without the unit has, so the model's
    size follows what each language knows and not the product of units and languages.
    """

    def __init__(self, languages: tuple[str, ...], units: dict[int, dict[str, dict[int, float]]], floors: dict[int, np.ndarray] | None = None):
        """``units``: by length and unit, the log frequency by language's number (a full array will do)."""
        self.languages = languages
        self.floors = np.zeros((max(ORDERS) + 1, len(languages)))
        for length, floor in (floors or {}).items():
            self.floors[length] = floor
        self.units: dict[int, dict[str, int]] = {}
        starts, langs, gains = [0], [], []
        for length, own in units.items():
            self.units[length] = {}
            for unit, values in own.items():
                self.units[length][unit] = len(starts) - 1
                for k, value in values.items() if isinstance(values, dict) else enumerate(values):
                    langs.append(k)
                    gains.append(value - self.floors[length][k])
                starts.append(len(langs))
        self.starts, self.langs, self.gains = np.array(starts), np.array(langs, np.int32), np.array(gains, float)

    def known(self, lang: int, length: int) -> frozenset[str]:
        """The units of a length that a language has."""
        rows = set(np.searchsorted(self.starts, np.flatnonzero(self.langs == lang), side="right").tolist())
        return frozenset(u for u, row in self.units.get(length, {}).items() if row + 1 in rows)

    def telling_order(self, lang: int) -> int:
        """The least order whose grams letters in any order would seldom hit, from the size of the language's alphabet."""
        letters = len(self.known(lang, 1))
        return next((n for n in sorted(ORDERS) if letters**n > 20 * MOST_GRAMS), max(ORDERS))

    def parts(self, word: str) -> Iterator[tuple[int, int, int]]:
        """(row, length, steps down from words) of the units that a word is scored by."""
        row = self.units[0].get(word)
        if row is not None:
            yield row, 0, 0
            return
        at = 0
        while at < len(word):
            for step, order in enumerate(ORDERS, 1):
                gram = word[at : at + order]
                row = self.units[order].get(gram) if len(gram) == order else None
                if row is not None:
                    yield row, order, step
                    at += order
                    break
            else:
                at += 1  # no language has this character

    def scores(self, words: list[str], owners: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Weighted log frequencies by owner and language, summed over the words of each owner, and their weights."""
        found = [(k, *part) for k, word in zip(owners, words, strict=True) for part in self.parts(word)]
        if not found:
            return np.zeros((n, len(self.languages))), np.zeros(n)
        owner, row, length, step = np.array(found).T
        weight = DISCOUNT ** step.astype(float)
        by_length = np.bincount(owner * len(self.floors) + length, weight, n * len(self.floors)).reshape(n, -1)
        sizes = self.starts[row + 1] - self.starts[row]
        cells = np.repeat(self.starts[row] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        places = np.repeat(owner, sizes) * len(self.languages) + self.langs[cells]
        gained = np.bincount(places, np.repeat(weight, sizes) * self.gains[cells], n * len(self.languages))
        return by_length @ self.floors + gained.reshape(n, -1), by_length.sum(axis=1)

    def score(self, word: str) -> tuple[np.ndarray, float]:
        """Weighted log frequencies of one word, and the weight of the units they come from."""
        scores, weights = self.scores([word], [0], 1)
        return scores[0], float(weights[0])


def fit(
    docs: DataFrame,
    labelled: Column,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
    most_words: int = MOST_WORDS,
    most_grams: int = MOST_GRAMS,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Learns from rows where ``labelled`` holds, language and text are known.

    Per language about ``sample_rows`` rows are read, those with the smallest hashes of their ids.
    The model has at most ``most_words`` words and ``most_grams`` n-grams of each order per
    language, ties by the unit itself, and the ``most_languages`` languages with most labelled rows, ties by name:
    some 20 bytes for each of these at most, and so much on the driver and in every worker.
    """
    rows = docs.select(
        docs[lang_col].alias("lang"), docs[text_col].alias("text"), F.xxhash64(docs[id_col]).alias("draw")
    ).where(labelled & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    sizes = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect())
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), {n: {} for n in (0, *ORDERS)})
    share = F.element_at(
        F.create_map(*(F.lit(x) for n in languages for x in (n, min(1.0, sample_rows / sizes[n])))), F.col("lang")
    )
    sample = rows.where(F.pmod("draw", F.lit(1_000_003)) < share * 1_000_003).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def given() -> pa.RecordBatch:
            keys = list(found)
            columns = [[k[i] for k in keys] for i in range(3)]
            out = pa.record_batch(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array([found[k] for k in keys], pa.int64())],
                names=["lang", "length", "unit", "n"],
            )
            found.clear()
            return out

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(words_of(text)).items():
                    found[lang, 0, word] += n
                    for order in ORDERS:
                        for k in range(len(word) - order + 1):
                            found[lang, order, word[k : k + order]] += n
                if len(found) > COUNTED:
                    yield given()
        if found:
            yield given()

    counted = sample.mapInArrow(tidy(count), "lang string, length int, unit string, n long").groupBy("lang", "length", "unit").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang", "length").orderBy(F.desc("n"), "unit")
    kept = counted.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= F.when(F.col("length") == 0, most_words).otherwise(most_grams)
    )
    index = {name: k for k, name in enumerate(languages)}
    counts: dict[int, dict[str, dict[int, float]]] = {n: {} for n in (0, *ORDERS)}
    totals = {n: np.zeros(len(languages)) for n in counts}
    for lang, length, unit, n in kept.select("lang", "length", "unit", "n").toLocalIterator():
        counts[length].setdefault(unit, {})[index[lang]] = n
        totals[length][index[lang]] += n
    floors = {}
    for length, own in counts.items():
        all_ = totals[length] + 0.5 * (len(own) + 1)
        floors[length] = np.log(0.5 / all_)
        for values in own.values():
            for k, n in values.items():
                values[k] = math.log((n + 0.5) / all_[k])
    return Model(languages, counts, floors)


class _Chunks(dict):
    """What stands between white space, to the row of its scores; starts anew when its rows are used up."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        width = len(model.languages) + 2
        self.scores = np.zeros((max(2_000, min(120_000, 1_200_000 // width)), width))  # by language, weight, whether it has letters
        self.letters: dict[int, _Letters] = {}

    def _learn(self, chunks: list[bytes]) -> None:
        words, owners, k = [], [], 0
        for found in _WORD_OR_END.findall(b"\n".join(chunks).decode().lower()):
            if found == "\n":
                k += 1
            else:
                words.append(found)
                owners.append(k)
        begin, n = len(self), len(chunks)
        scores, weights = self.model.scores(words, owners, n)
        self.scores[begin : begin + n, :-2] = scores
        self.scores[begin : begin + n, -2] = weights
        self.scores[begin : begin + n, -1] = np.bincount(owners, minlength=n) > 0 if owners else 0
        self.update(zip(chunks, range(begin, begin + n), strict=True))

    def total(self, chunks: list[bytes]) -> np.ndarray:
        """The sum of the chunks' scores."""
        sums, most = np.zeros(self.scores.shape[1]), len(self.scores) // 4
        for at in range(0, len(chunks), most):
            part = chunks[at : at + most]
            new = [c for c in set(part) if c not in self]
            if len(self) + len(new) > len(self.scores):
                self.clear()
                new = list(set(part))
            if new:
                self._learn(new)
            sums += self.scores[list(map(self.__getitem__, part))].sum(axis=0)
        return sums

    def known(self, chunks: list[bytes], lang: int) -> float:
        """The share of letters that the language knows."""
        if lang not in self.letters:
            if len(self.letters) >= 4:  # tables of so many languages at once
                self.letters.clear()
            self.letters[lang] = _Letters(self.model, lang)
        both = sum(map(self.letters[lang].__getitem__, chunks))
        return (both >> 40) / max(1, both & ((1 << 40) - 1))


class _Letters(dict):
    """What stands between white space, to its letters and (from bit 40 on) those that lie in a word, or else in a gram
    of the telling order, that the language has."""

    def __init__(self, model: Model, lang: int, limit: int = 30_000):
        super().__init__()
        self.limit, self.order = limit, model.telling_order(lang)
        self.words, self.grams = model.known(lang, 0), model.known(lang, self.order)

    def __missing__(self, chunk: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        known = letters = 0
        for word in words_of(chunk.decode()):
            letters += len(word)
            if word in self.words:
                known += len(word)
                continue
            covered = 0
            for k in range(len(word) - self.order + 1):
                if word[k : k + self.order] in self.grams:
                    known += k + self.order - max(covered, k)
                    covered = k + self.order
        value = self[chunk] = known << 40 | letters
        return value


def predict(docs: DataFrame, model: Model, *, evidence: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred`` and ``score`` (0 to 1); only the text is looked at. With ``evidence`` also
    ``known``: the share of letters in words of the predicted language or in its grams of the order that letters in any order
    seldom hit (0 to 1). It is near 1 for clean texts of any length, near 0 for other scripts and letter noise.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing has been learned; a text
    of letters that no language has gets the first language with an even score. Repeated rows and NULL ids are
    treated like others, other columns are ignored, an empty table gives no row. No shuffle.
    """
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        table = _Chunks(learned)
        for batch in batches:
            names, scores, known = [], [], []
            for text in texts(batch):
                chunks = text.split() if text else []
                sums = table.total(chunks) if chunks and learned.languages else None
                if sums is None or not sums[-1]:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    known.append(0.0)
                    continue
                mean = sums[:-2] / max(sums[-2], 1e-9)
                share = np.exp(mean - mean.max())
                best = int(np.argmax(sums[:-2]))
                names.append(learned.languages[best])
                scores.append(float(share[best] / share.sum()))
                known.append(table.known(chunks, best) if evidence else 0.0)
            columns = {"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
            if evidence:
                columns["known"] = pa.array(known, pa.float64())
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return narrow.mapInArrow(tidy(run), f"doc_id {id_type}, lang_pred string, score double" + ", known double" * evidence)
