"""Hard negatives by exact integer inner products, many candidates packed into one wide integer.

Components are floored to whole numbers and made non-negative by a bias. The same component of a block of candidates then
stands in separate fields of one wide Python integer. Multiplying that by an anchor's component multiplies all fields at
once, and the sum over the components holds one inner product per field, as the fields are wide enough for the greatest
possible sum. Fields are whole words of bytes, so unpacking is a reinterpretation of the integer's bytes; taking the
biases out again is exact.

Anchors and rows meet in cells, blocks of anchors by stripes of rows, dealt by hashes of the id: a cell holds a bounded
number of components, however many rows a label has. Positives first (cells of one label), the few best of every cell
merged by a window; then negatives within the limits that each positive sets (cells of all labels).
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.sources.scratch import scratch_folder, written

#: Anchors and vector components (of all rows together) that a cell holds, on average.
ANCHORS = 256
COMPONENTS = 1 << 20
#: Candidates in one wide integer.
PACKED = 2048


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, as 64-bit integers where these hold it, as Python integers otherwise."""
    floored = np.floor(vectors.astype(np.float64) * scale)
    if floored.size == 0 or np.abs(floored).max() < 2**61:
        return floored.astype(np.int64)
    return np.array([[int(x) for x in row] for row in floored], object).reshape(floored.shape)


class Packed:
    """A block of candidates, packed for anchors whose components lie between ``least`` and ``most``."""

    def __init__(self, rows: np.ndarray, least: int, most: int):
        self.n, self.size = rows.shape
        self.anchor_bias, self.bias = -least, -int(rows.min()) if rows.size else 0
        greatest = (int(rows.max()) + self.bias if rows.size else 0, most - least)
        bits = max(1, self.size * greatest[0] * greatest[1]).bit_length()
        bits = max(bits, greatest[0].bit_length())
        self.width = 4 if bits <= 32 else 8 * ((bits + 2) // 64 + 1)
        lifted = (rows if self.width <= 8 else rows.astype(object)) + self.bias
        self.sums = lifted.sum(axis=1)
        self.packed = [self._pack(lifted[:, d]) for d in range(self.size)]

    def _pack(self, column: np.ndarray) -> int:
        if self.width <= 8:
            return int.from_bytes(column.astype(f"<u{self.width}").tobytes(), "little")
        return int.from_bytes(b"".join(int(x).to_bytes(self.width, "little") for x in column), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of the anchor and every candidate."""
        if not self.size:
            return np.zeros(self.n, np.int64)
        lifted = [x + self.anchor_bias for x in anchor]
        fields = sum(map(operator.mul, lifted, self.packed)).to_bytes(self.width * self.n, "little")
        if self.width <= 8:
            found = np.frombuffer(fields, f"<u{self.width}").astype(np.int64)
        else:
            w = self.width
            found = np.array([int.from_bytes(fields[i : i + w], "little") for i in range(0, w * self.n, w)] + [0], object)[:-1]
        rest = self.bias * sum(lifted) - self.size * self.anchor_bias * self.bias
        out = found - self.anchor_bias * self.sums - rest
        if out.dtype == object and max(map(abs, out), default=0) < 2**63:
            return out.astype(np.int64)
        return out


def best(scores: np.ndarray, among: np.ndarray, k: int) -> list[int]:
    """The places ``among`` of the ``k`` greatest scores, greatest first; of equal ones the earlier places."""
    values = scores[among]
    if len(values) > k:
        least = np.partition(values, len(values) - k)[len(values) - k] if values.dtype != object else sorted(values)[-k]
        above, equal = among[values > least], among[values == least]
        among = np.concatenate([above, equal[: k - len(above)]])
    return sorted(among.tolist(), key=lambda i: (-scores[i], i))


def _limits(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole number between ``low`` and ``high`` hundredths of ``score``."""
    return -(-low * score // 100), high * score // 100


def _matrix(column: pa.ChunkedArray, rows: np.ndarray, scale: int) -> np.ndarray:
    listed = column.combine_chunks().take(pa.array(rows))
    size = len(listed[0]) if len(listed) else 0
    return whole(listed.flatten().to_numpy(zero_copy_only=False).reshape(len(listed), size), scale)


def _meet(scale: int, positives: int, negatives: int, low: int, high: int, first: bool):
    """What a cell does: the first of its positives (``first``), or of its negatives within each positive's limits."""

    def positives_of(anchor: int, scores: np.ndarray, other: np.ndarray, ids: np.ndarray, out: dict) -> None:
        for i in best(scores, np.flatnonzero(other), positives):
            out["anchor_id"].append(anchor)
            out["positive_id"].append(int(ids[i]))
            out["positive_score"].append(int(scores[i]))

    def negatives_of(anchor: int, known: list[dict], scores: np.ndarray, other: np.ndarray, ids: np.ndarray, out: dict) -> None:
        for positive in known:
            least, most = _limits(positive["positive_score"], low, high)
            for i in best(scores, np.flatnonzero(other & (scores >= least) & (scores <= most)), negatives):
                out["anchor_id"].append(anchor)
                out["positive_id"].append(positive["positive_id"])
                out["positive_score"].append(positive["positive_score"])
                out["negative_id"].append(int(ids[i]))
                out["negative_score"].append(int(scores[i]))

    def run(cell: pa.Table) -> pa.Table:
        is_anchor = cell["is_anchor"].to_numpy(zero_copy_only=False)
        ids = cell["vec_id"].to_numpy()
        labels = cell["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        anchors, rows = np.flatnonzero(is_anchor), np.flatnonzero(~is_anchor)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        out = {name: [] for name in (_POSITIVE if first else _NEGATIVE).names}
        if len(anchors) and len(rows):
            vectors = _matrix(cell["vector"], anchors, scale)
            least, most = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
            for at in range(0, len(rows), PACKED):
                block = rows[at : at + PACKED]
                packed = Packed(_matrix(cell["vector"], block, scale), least, most)
                for k, vector in zip(anchors.tolist(), vectors.tolist(), strict=True):
                    scores = packed.scores(vector)
                    if first:
                        positives_of(int(ids[k]), scores, ids[block] != ids[k], ids[block], out)
                    else:
                        negatives_of(int(ids[k]), cell["positives"][k].as_py(), scores, labels[block] != labels[k], ids[block], out)
        return pa.table(out, schema=_POSITIVE if first else _NEGATIVE)

    return run


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_NEGATIVE = pa.schema([*_POSITIVE, ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _cells(rows: DataFrame, anchors: DataFrame, by: list[str]) -> DataFrame:
    """Anchors and rows of equal ``by``, each in every cell where it meets the others."""
    stripe = F.greatest(F.lit(1), F.floor(F.lit(COMPONENTS) / F.greatest(F.max("size"), F.lit(1))))
    blocks = anchors.groupBy(*by).agg(F.ceil(F.count("*") / ANCHORS).alias("_blocks"))
    stripes = rows.groupBy(*by).agg(F.ceil(F.count("*") / stripe).alias("_stripes"))
    grid = blocks.join(stripes, by)
    own = lambda of, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(of))
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    dealt = lambda df, block, stripe, is_anchor: df.join(grid, by).select(
        *df.columns, block.alias("_block"), F.lit(is_anchor).alias("is_anchor"), F.col("_stripes")
    ).select("*", stripe.alias("_stripe")).drop("_stripes")
    return dealt(anchors, own("_blocks", 1), every("_stripes"), True).unionByName(
        dealt(rows, every("_blocks"), own("_stripes", 2), False), allowMissingColumns=True
    )


def mine(
    rows: DataFrame,
    is_anchor: Column,
    *,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each anchor and each of its positives the first hard negatives, ranked from 1.

    ``is_anchor`` says of a row's id (the column ``vec_id``) whether it is an anchor. A score is the inner product of the
    floored components, greater ones first, ties by the smaller id. An anchor's positives are the first ``positives``
    other rows of its label, its negatives rows of other labels whose score lies between ``low`` and ``high`` hundredths
    of the positive's. Columns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``; an anchor without negatives has no row.

    Rows with a NULL id, label, vector or component, or one that isn't finite (before or after scaling), take no part.
    Rows that share an id are one row, the one with the least label, then vector. Vectors of different lengths never
    meet; empty ones score 0. A score that 64 bits can't hold is an error. Other columns are ignored; an empty table
    gives an empty one.
    """
    spark = rows.sparkSession
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float("inf"))
    named = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[label_col].alias("label"), rows[vector_col].alias("vector"))
    named = named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    once = named.where(F.forall("vector", finite)).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("_row"))
    once = written(once.select("vec_id", "_row.*", F.size("_row.vector").alias("size")), scratch_folder(spark))

    run = lambda first: _meet(scale, positives, negatives, low, high, first)
    anchors = once.where(is_anchor)
    near = _cells(once, anchors, ["label", "size"]).select("size", "label", "_block", "_stripe", "is_anchor", "vec_id", "vector")
    # Cells are few bytes and much work: they are dealt to as many tasks as a shuffle has, and stay apart.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = near.repartition(tasks, "label", "size", "_block", "_stripe").groupBy("label", "size", "_block", "_stripe").applyInArrow(
        run(True), "anchor_id long, positive_id long, positive_score long"
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= positives)
    listed = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    listed = written(listed, scratch_folder(spark)).withColumnRenamed("anchor_id", "vec_id")

    far = _cells(once, anchors.join(listed, "vec_id"), ["size"])
    found = far.repartition(tasks, "size", "_block", "_stripe").groupBy("size", "_block", "_stripe").applyInArrow(
        run(False), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
