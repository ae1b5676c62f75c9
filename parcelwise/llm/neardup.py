"""Near duplicates by a signature-coordinate inverted join, links confirmed on the full sets.

1. *Sketch* (one Arrow pass): every text becomes its set of word windows (64-bit hashes); of that come the
   number of windows, a digest of the whole set, and a MinHash signature of ``coordinates`` values.
   Texts with the same set are one class from here on.
2. *Post*: a class is posted under each (coordinate, value) pair. Pairs that only one class has
   cannot collide and go. Two classes of similarity s agree in a binomial number of coordinates; with the match
   threshold of ``least_matches`` a true pair is missed with a probability below 1e-7.
3. *Prefix*: a class with m shared pairs needs ``least`` matches among them, so only its m - least + 1
   rarest can be the first to collide; classes with m < least have no partner at all. Values that very
   many documents have are the last of each list and mostly skipped.
4. *Merge* collisions into families, the components of all pairs above the threshold: first every posting's
   smallest class is compared with its members (linear in the postings); then, only in postings that still hold several
   families, the members outside the largest are compared with all others in blocks, which give no
   pairs but the few that span what they connect.
5. *Confirm*: families are compared on the full sets, again in blocks, best pairs first, skipping pairs that are
   connected already. A large family is first compared with its least class, so that only what that doesn't
   connect is compared with all. Links come out as a spanning forest. Nothing is capped.

Intermediate tables are Parquet in the cluster's shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.words import WordHashes, mixed, tidy, windows
from parcelwise.sources.scratch import scratch_folder, written

COORDINATES = 64
BLOCK = 256
MISS = 1e-7


def least_matches(coordinates: int, similarity: float, miss: float = MISS) -> int:
    """The greatest threshold that a pair of this similarity fails with a probability below ``miss``."""
    below = 0.0
    for t in range(coordinates + 1):
        below += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if below >= miss:
            return max(1, t)
    return coordinates


def shingle_set(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's word windows, letters A-Z in lower case."""
    return np.unique(windows(hashes.of((text or b"").lower().split()), size))


def signatures(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """One row per set that isn't empty: the least value of each coordinate's permutation."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    everything = np.concatenate(sets)
    out = np.empty((len(sets), len(multipliers)), np.uint64)
    for k, a in enumerate(multipliers):
        out[:, k] = np.minimum.reduceat(everything * a, starts)
    return out


def _multipliers(coordinates: int) -> np.ndarray:
    return mixed(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)


def sketch(docs: DataFrame, words: int, coordinates: int, id_col: str, text_col: str) -> DataFrame:
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes, multipliers = WordHashes(), _multipliers(coordinates)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t.as_py().encode() if t.is_valid else None, words, hashes) for t in part.column(1)]
                full = [s for s in sets if len(s)]
                own = signatures(full, multipliers) if full else np.empty((0, coordinates), np.uint64)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in full]
                filled = np.array([len(s) > 0 for s in sets])
                where = np.cumsum(filled) - 1
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                where = np.where(filled, where, 0)

                def column(values: np.ndarray) -> pa.Array:
                    values = values[where] if len(values) else np.zeros(len(sets), values.dtype)
                    return pa.array(values, mask=~filled)

                offsets = np.concatenate([[0], np.cumsum(filled) * coordinates]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(own.view(np.int64).ravel()))
                yield pa.record_batch(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), column(halves[:, 0]), column(halves[:, 1]), lists],
                    names=["doc_id", "n_shingles", "h1", "h2", "signature"],
                )

    return narrow.mapInArrow(tidy(run), f"doc_id {id_type}, n_shingles long, h1 long, h2 long, signature array<long>")


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``class`` and its set as bytes; ``docs`` has ``class`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingle_set(t.as_py().encode() if t.is_valid else None, words, hashes).tobytes() for t in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array(sets, pa.binary())], names=["class", "full"])

    kind = docs.schema["class"].dataType.simpleString()
    return docs.select("class", "text").mapInArrow(tidy(run), f"class {kind}, full binary")


def _similar(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    """Whether two sorted sets are as similar as asked for."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * common >= per_cent * (len(x) + len(y) - common)


class Work:
    """Numbered tables of one call in the shared folder."""

    def __init__(self, spark):
        self.spark, self.folder, self.n = spark, scratch_folder(spark), 0

    def keep(self, df: DataFrame, few: bool = False) -> DataFrame:
        """The table, written; ``few``: its rows are names only, so an eighth of the usual partitions will do."""
        self.n += 1
        if few:
            df = df.coalesce(max(8, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8))
        return written(df, f"{self.folder}/{self.n}")


def components(nodes: DataFrame, edges: DataFrame, work: Work) -> DataFrame:
    """``class`` to ``component``, the least that edges lead to.

    ``nodes`` has both from before; ``edges`` (a, b) are between names of components. Only names in edges take part:
    each takes the least name among its neighbours and their names so far, then that name's own (pointer jumping),
    until nothing changes: a logarithmic number of rounds for the star-like graphs met here.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = work.keep(both, few=True)
    names = work.keep(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), few=True)
    while True:
        near = both.join(names.select(F.col("a").alias("b"), "low"), "b").groupBy("a").agg(F.min("low").alias("near"))
        step = names.join(near, "a").select("a", F.col("low").alias("was"), F.least("low", "near").alias("low"))
        up = names.select(F.col("a").alias("low"), F.col("low").alias("lower"))
        moved = work.keep(step.join(up, "low").select("a", "was", F.least("low", "lower").alias("low")), few=True)
        if moved.where("low < was").isEmpty():
            break
        names = moved.select("a", "low")
    named = nodes.join(names, nodes["component"] == names["a"], "left")
    return work.keep(named.select("class", F.coalesce("low", "component").alias("component")))


def _pair_blocks(rows: DataFrame, group: str, block: int) -> DataFrame:
    """Rows of groups with several components, dealt out so that each pair of components meets.

    Adds ``i``, ``j`` (the pair of blocks to compare) and ``block`` (the row's own). Members of a group's largest component
    are not compared with each other: they meet only the blocks of the others.
    """
    each = rows.groupBy(group, "component").agg(F.count("*").alias("n"))
    sizes = each.groupBy(group).agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main")
    )
    sizes = sizes.where("parts > 1").select(
        F.col(group).alias("_group"),
        F.col("main.component").alias("main"),
        F.ceil(F.col("main.n") / block).cast("int").alias("main_blocks"),
        F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("other_blocks"),
        (F.col("n") <= block).alias("small"),
    )
    rows = rows.join(sizes, rows[group] == sizes["_group"])
    spread, inside = F.xxhash64("class"), F.col("component") == F.col("main")
    own = F.when(inside, F.pmod(spread, "main_blocks")).otherwise(F.col("main_blocks") + F.pmod(spread, "other_blocks"))
    last = F.col("main_blocks") + F.col("other_blocks") - 1
    meets = F.when(inside, F.sequence(F.col("main_blocks"), last)).otherwise(F.sequence(F.lit(0), last))
    one = F.array(F.lit(0))
    rows = rows.withColumn("block", F.when(F.col("small"), 0).otherwise(own).cast("int"))
    rows = rows.withColumn("with", F.explode(F.when(F.col("small"), one).otherwise(meets)))
    return rows.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))


class _Compare:
    """Spanning edges between the components that meet in a pair of blocks.

    Input is sorted by group, ``i``, ``j``; a group's rows may go on in the next batch. With ``full`` sets every edge is
    confirmed on them, without them agreeing signatures are enough.
    """

    def __init__(self, least: int, similarity: float, full: bool):
        self.least, self.similarity, self.full = least, similarity, full

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            groups = np.stack([table.column(k).to_numpy() for k in range(3)])
            starts = np.append(0, np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1)
            yield from self._groups(table.slice(0, starts[-1]), starts[:-1])
            rest = table.slice(starts[-1])
        if rest is not None:
            yield from self._groups(rest, np.zeros(1, np.int64))

    def _groups(self, table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        i, j, block, names, component, n = (table.column(k).to_numpy() for k in (1, 2, 3, 4, 5, 6))
        prints = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint8).reshape(table.num_rows, -1)
        full = table.column(8) if self.full else None
        edges: list[tuple] = []
        for s, e in zip(starts.tolist(), np.append(starts[1:], table.num_rows).tolist()):
            everyone = np.arange(s, e)
            left, right = everyone[block[s:e] == i[s]], everyone[block[s:e] == j[s]]
            found = []
            for at in range(0, len(left), 32):
                x, y = np.nonzero(component[left[at : at + 32]][:, None] != component[right][None, :])
                x, y = left[at : at + 32][x], right[y]
                fits = np.minimum(n[x], n[y]) >= self.similarity * np.maximum(n[x], n[y]) - 1e-9
                if i[s] == j[s]:
                    fits &= names[x] < names[y]
                x, y = x[fits], y[fits]
                matches = (prints[x] == prints[y]).sum(axis=1)
                good = matches >= self.least
                found.append((x[good], y[good], matches[good]))
            if any(len(x) for x, _, _ in found):
                x, y, matches = (np.concatenate(part) for part in zip(*found))
                edges += self._forest(x, y, np.argsort(-matches, kind="stable"), component, full)
        if edges:
            yield pa.record_batch([pa.array(c) for c in zip(*edges)], names=["a", "b"])

    def _forest(self, x, y, order, component, full) -> list[tuple]:
        parent: dict = {}

        def root(c):
            while (up := parent.get(c, c)) != c:
                parent[c] = c = parent.get(up, up)
            return c

        per_cent, edges, sets = round(100 * self.similarity), [], {}

        def own(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = np.frombuffer(full[k].as_py(), np.uint64)
            return sets[k]

        ends = list(zip(component[x[order]].tolist(), component[y[order]].tolist(), x[order].tolist(), y[order].tolist()))
        for c, d, p, q in ends:
            c, d = root(c), root(d)
            if c != d and (full is None or _similar(own(p), own(q), per_cent)):
                parent[max(c, d)] = min(c, d)
                edges.append((min(c, d), max(c, d)))
        return edges


def _spanning(rows: DataFrame, group: str, least: int, similarity: float, block: int) -> DataFrame:
    """Edges (a, b) between components of each group; ``rows`` may have ``full`` sets."""
    kind = rows.schema["class"].dataType.simpleString()
    full = "full" in rows.columns
    placed = _pair_blocks(rows, group, block).select(
        group, "i", "j", "block", "class", "component", "n_shingles", "prints", *(["full"] if full else [])
    )
    ordered = placed.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")
    return ordered.mapInArrow(_Compare(least, similarity, full).__call__, f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    similarity: float = 0.8,
    coordinates: int = COORDINATES,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (least id linked, itself included), ``kept``.

    Words stand between ASCII white space, A-Z in lower case. A text with fewer than ``words`` words is one window;
    NULL, empty and blank texts have no window and are linked with nothing. Rows that repeat an id are one
    document to the links, each is returned. A NULL id cannot be named: such rows are linked with nothing,
    have no ``component_id`` and are kept. Other columns are ignored; an empty table gives no row.
    """
    spark, work = docs.sparkSession, Work(docs.sparkSession)
    least = least_matches(coordinates, similarity)
    sketches = work.keep(sketch(docs, words, coordinates, id_col, text_col))
    named = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    # Documents with the same set are one class; its name is the least id.
    groups = work.keep(named.groupBy("h1", "h2").agg(F.min("doc_id").alias("class")))
    classes = named.join(groups.select(F.col("class").alias("doc_id"), "h1", "h2"), ["doc_id", "h1", "h2"]).dropDuplicates(["doc_id"])
    posted = classes.select(F.col("doc_id").alias("class"), F.posexplode("signature").alias("at", "value")).select(
        "class", F.xxhash64("at", "value").alias("key")
    )
    shared = work.keep(posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    own = (
        posted.join(shared, "key")
        .groupBy("class")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("shared"))  # at most one per coordinate
        .where(F.size("shared") >= least)
        .select("class", F.slice("shared", F.lit(1), F.size("shared") - least + 1).alias("prefix"))
    )
    live = work.keep(own)
    low_bytes = F.transform("signature", lambda v: F.lpad(F.hex(v.bitwiseAND(F.lit(255))), 2, "0"))
    prints = classes.join(live.select(F.col("class").alias("doc_id")), "doc_id", "left_semi").select(
        F.col("doc_id").alias("class"), "n_shingles", F.unhex(F.array_join(low_bytes, "")).alias("prints")
    )
    members = work.keep(live.join(prints, "class"))
    if members.isEmpty():
        label = members.select("class", F.col("class").alias("component"))
    else:
        label = _linked(docs, members, work, least, words, similarity, block, id_col, text_col)
    links = groups.join(label, "class", "left").select("h1", "h2", F.coalesce("component", "class").alias("component_id"))
    links = work.keep(links)
    out = sketches.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("h1")).alias("h1"), "h2"
    ).join(links, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _families(members: DataFrame, work: Work, least: int, similarity: float, block: int) -> DataFrame:
    """``class`` to ``component``: the components of all pairs whose signatures agree often enough."""
    postings = work.keep(members.select("class", "n_shingles", "prints", F.explode("prefix.key").alias("key")))
    label = members.select("class", F.col("class").alias("component"))
    hubs = work.keep(postings.groupBy("key").agg(F.min("class").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n"))
    star = postings.select("class", "key").join(hubs, "key").where("class > hub").select("class", "hub").distinct()
    sides = members.select("class", "n_shingles", "prints")
    star = star.join(sides, "class").join(
        sides.select(F.col("class").alias("hub"), F.col("n_shingles").alias("hub_n"), F.col("prints").alias("hub_prints")), "hub"
    )
    fits = F.least("n_shingles", "hub_n") >= similarity * F.greatest("n_shingles", "hub_n") - 1e-9
    star = work.keep(_with_matches(star.where(fits), least))
    # A class shares its component with the least hub it agrees with; what that leaves open is told by postings that
    # still hold several, as one that a single component has holds nothing new.
    first = star.groupBy("b").agg(F.min("a").alias("hub"))
    label = label.join(first, label["class"] == first["b"], "left").select("class", F.coalesce("hub", "class").alias("component"))
    more = _spanning(postings.join(work.keep(label), "class"), "key", least, similarity, block)
    return components(members.select("class", F.col("class").alias("component")), star.select("a", "b").union(more), work)


def _linked(docs, members, work, least, words, similarity, block, id_col, text_col) -> DataFrame:
    """``class`` to ``component`` over links confirmed on the full sets, for classes that have any candidate."""
    family = _families(members, work, least, similarity, block).withColumnRenamed("component", "family")
    sizes = work.keep(family.groupBy("family").agg(F.count("*").alias("size")).where("size > 1"))
    family = work.keep(family.join(sizes, "family"))
    source = docs.select(docs[id_col].alias("class"), docs[text_col].alias("text"))
    sets = _full_sets(source.join(family.select("class"), "class", "left_semi"), words).dropDuplicates(["class"])
    rows = work.keep(family.join(members.select("class", "n_shingles", "prints"), "class").join(sets, "class"))
    label = rows.select("class", F.col("class").alias("component"))
    large = rows.where(F.col("size") > 4 * block)
    hub = _hub_links(large, similarity, block)  # a star, so its components are known
    label = label.join(hub, label["class"] == hub["b"], "left").select("class", F.coalesce("a", "component").alias("component"))
    label = work.keep(label)
    return components(label, _spanning(rows.join(label, "class"), "family", least, similarity, block), work)


def _hub_links(rows: DataFrame, similarity: float, block: int) -> DataFrame:
    """Members of large families that are linked with the least of them, which is dealt out as often as needed."""
    per_cent, kind = round(100 * similarity), rows.schema["class"].dataType.simpleString()
    salts = F.ceil(F.col("size") / block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                _similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), per_cent)
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    hubs = rows.where("class = family").select(
        F.col("class").alias("a"), F.col("full").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")
    )
    others = rows.where("class <> family").select(
        F.col("family").alias("a"), F.col("class").alias("b"), F.col("full").alias("y"), F.pmod(F.xxhash64("class"), salts).alias("salt")
    )
    return others.join(hubs, ["a", "salt"]).select("a", "b", "x", "y").mapInArrow(tidy(run), f"a {kind}, b {kind}")


def _with_matches(star: DataFrame, least: int) -> DataFrame:
    kind = star.schema["class"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            y = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            matches = (x == y).sum(axis=1).astype(np.int32)
            good = pa.array(matches >= least)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(matches)], names=["a", "b", "matches"]).filter(good)

    return star.select("hub", "class", "hub_prints", "prints").mapInArrow(tidy(run), f"a {kind}, b {kind}, matches int")
