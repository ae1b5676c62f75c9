"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions alone.

The sketch of a text is the sorted list of the ``k`` least among its distinct shingle hashes (the first 64 bits of the
MD5 of a run of words, as 16 hex digits, which sort like numbers). Sketches of the parts of a collection merge into the
sketch of the whole: the ``k`` least of their union. From sketches alone come the resemblance of two shingle sets
(common share of the union's ``k`` least), their containment, and the number of distinct shingles (exact below ``k``,
else from how small the greatest kept hash is).

Words are ``[^\\x20\\x09-\\x0D]+`` in lower case; fewer words than a shingle has are one shingle; no word, no shingle.

The document after another in the order of ids is found without a sort of everything: ids are cut into buckets at
quantiles, and the greatest row of a bucket is also sent, as a guest, to the bucket above it. So a text is shuffled once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.sources.scratch import scratch_folder, written

K = 128
WORDS = 5
HEX = 16
#: Sketches that are merged by one task at once, on average.
FAN_IN = 64
BUCKET_ROWS = 100_000
MOST_BUCKETS = 20_000


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def sketch(text: Column, *, words: int = WORDS, k: int = K) -> Column:
    """The sketch of a text; NULL counts as empty, and a text without words has an empty sketch."""
    split = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # Past the end of a short text ``get`` is NULL, which ``concat_ws`` leaves out.
    hashes = lambda w: F.when(
        F.size(w) > 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - words, F.lit(0))),
            lambda i: F.substring(F.md5(F.concat_ws(" ", *(F.get(w, i + j) for j in range(words))).cast("binary")), 1, HEX),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.slice(F.sort_array(F.array_distinct(_bound(split, hashes))), 1, k)


def merge(a: Column, b: Column, *, k: int = K) -> Column:
    """The sketch of what either sketch stands for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, *, k: int = K) -> Column:
    """Estimated |A and B| / |A or B|: 1 for two empty sketches, 0 if one is empty."""
    share = lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u)
    )
    return _bound(merge(a, b, k=k), share)


def distinct_shingles(a: Column, *, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact where there are fewer than ``k``."""
    last = F.conv(F.substring(F.element_at(a, -1), 1, 13), 16, 10).cast("double") + 1
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(16**13) / last)


def containment(a: Column, b: Column, *, k: int = K) -> Column:
    """Estimated |A and B| / |A|, at most 1; an empty A lies in anything."""
    common = resemblance(a, b, k=k) * distinct_shingles(merge(a, b, k=k), k=k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k=k)))


def fingerprint(a: Column) -> Column:
    """A sketch as one string."""
    return F.array_join(a, "")


def read_fingerprint(text: Column) -> Column:
    """The sketch in a fingerprint."""
    starts = F.sequence(F.lit(1), F.char_length(text), F.lit(HEX))
    return F.when(F.char_length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda i: F.substr(text, i, F.lit(HEX)))
    )


def merge_groups(rows: DataFrame, group_cols: list[str], sketch_col: str, *, k: int = K) -> DataFrame:
    """One sketch per group of rows that carry sketches: ``group_cols`` and ``sketch``.

    Rows are dealt into packs of about ``FAN_IN`` by a hash of their sketch; every round merges packs, until a group is
    one. So no task sees more than a pack, however large the group; equal sketches, which a hash can't part, go first,
    by an aggregate. NULL group values are a group. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    packs = rows.select(*group_cols, F.col(sketch_col).alias("sketch")).distinct()
    packs = written(packs, scratch_folder(spark))
    largest = packs.groupBy(*group_cols).count().agg(F.max("count")).first()[0] or 0
    parts = math.ceil(largest / FAN_IN)
    while True:
        pack = F.pmod(F.xxhash64("sketch"), F.lit(parts or 1))
        whole = F.aggregate("sketch", F.array().cast("array<string>"), lambda a, b: merge(a, b, k=k))
        packs = packs.groupBy(*group_cols, pack.alias("_pack")).agg(F.collect_list("sketch").alias("sketch"))
        packs = packs.select(*group_cols, whole.alias("sketch"))
        if parts <= 1:
            return packs
        packs = written(packs, scratch_folder(spark))
        parts = math.ceil(parts / FAN_IN)


def _bucket(bounds: list[int], value: Column) -> Column:
    """How many of the sorted ``bounds`` are less than ``value``, by halving."""
    listed = F.array(*(F.lit(b) for b in bounds)) if len(bounds) < 50 else F.from_json(F.lit(str(bounds)), "array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds)).bit_length()))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        open_ = at["low"] < at["high"]
        less = F.get(listed, middle) < value
        return F.struct(
            F.when(open_ & less, middle + 1).otherwise(at["low"]).alias("low"),
            F.when(open_ & ~less, middle).otherwise(at["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    return F.aggregate(steps, start, halve, lambda at: at["low"])


def with_next(docs: DataFrame, carried: list[Column], derived: list[Column], *, id_col: str = "doc_id") -> DataFrame:
    """The rows with a whole-number id as ``doc_id``, the ``carried`` columns as ``here`` and those of the next row as
    ``next``: the row with the next smaller id, after the least the greatest; among equal ids by the carried columns.
    ``derived`` columns, functions of ``here``, join both; they are computed after the shuffle, so they don't travel.

    Rows without an id have no place in the order, and ``next`` is NULL there.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.struct(*carried).alias("here"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = docs.select(docs[id_col].cast("long").alias("_id")).where("_id IS NOT NULL")
    n = known.count()
    buckets = min(MOST_BUCKETS, max(4 * partitions, math.ceil(n / BUCKET_ROWS)))
    shares = [(i + 1) / buckets for i in range(buckets)]
    found = known.agg(F.percentile_approx("_id", shares, F.lit(10 * buckets)), F.max("_id")).first()
    bounds = sorted({*(found[0] or []), *([found[1]] if n else [])})
    if not bounds:
        rows = rows.withColumn("here", F.struct("here.*", *derived))
        return rows.withColumn("next", F.lit(None).cast(rows.schema["here"].dataType))
    # Quantiles are ids that occur, so each bound is the greatest id of its bucket.
    own = F.when(F.col("doc_id").isNull(), F.lit(-1) - F.pmod(F.xxhash64("here"), F.lit(buckets))).otherwise(_bucket(bounds, F.col("doc_id")))
    placed = rows.select("doc_id", "here", own.cast("int").alias("_own"))
    above = F.when(F.col("_own") == len(bounds) - 1, F.lit(0)).otherwise(F.col("_own") + 1)
    is_bound = F.col("doc_id").isNotNull() & (F.col("doc_id") == F.get(F.from_json(F.lit(str(bounds)), "array<bigint>"), F.greatest("_own", F.lit(0))))
    place = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))
    both = F.when(is_bound, F.array(place(F.col("_own"), False), place(above, True))).otherwise(F.array(place(F.col("_own"), False)))
    dealt = placed.select("doc_id", "here", F.explode(both).alias("_at")).select("doc_id", "here", "_at.*").repartition("bucket")
    dealt = dealt.withColumn("here", F.struct("here.*", *derived))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc(), "here")
    after = F.when(F.col("doc_id").isNotNull(), F.lead("here").over(order))
    return dealt.withColumn("next", after).where("NOT guest").select("doc_id", "here", "next")


def fingerprints(docs: DataFrame, *, words: int = WORDS, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the sketches of its text, of its edited text and of the next document's text.

    Columns ``doc_id``, ``text`` (NULL as empty), ``sketch``, ``edited``, ``edited_sketch``, ``next_sketch``. The next
    document is that of ``with_next``. In the edited text the last half of the code points, rounded down, is replaced by
    as many from the start of the next text, or all of it. Without an id there is no next text: it counts as empty.
    Repeated rows stay; an empty table gives none. A text is held whole in one row, its words as an array beside it.
    """
    rows = with_next(
        docs,
        [F.coalesce(docs[text_col], F.lit("")).alias("text")],
        [sketch(F.col("here.text"), words=words, k=k).alias("sketch")],
        id_col=id_col,
    )
    n = F.char_length("here.text")
    half = F.floor(n / 2).cast("int")
    after = F.coalesce("next.text", F.lit(""))
    edited = F.concat(F.substr("here.text", F.lit(1), n - half), F.substr(after, F.lit(1), half))
    return rows.select(
        "doc_id",
        F.col("here.text").alias("text"),
        F.col("here.sketch").alias("sketch"),
        edited.alias("edited"),
        F.coalesce("next.sketch", F.array().cast("array<string>")).alias("next_sketch"),
    ).withColumn("edited_sketch", sketch(F.col("edited"), words=words, k=k))
