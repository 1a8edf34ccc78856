"""N-gram Jaccard join with set-relation skipping.

A document is the set of its distinct word ``k``-grams (64-bit hashes). Two
documents link when ``100 * intersection >= pct * union``; the result is each
document's component of links. The join is exact.

1. Equal sets (two independent 64-bit sums of their hashed members) are one
   node, so copies never meet each other. One row per document is enough for it.
2. A fixed-size table of occurrence counts over all documents orders the
   grams, rare ones first. A set is indexed under its first grams only: sets
   that link share ``SHARED`` of those (fewer for tiny sets).
3. Index lists of up to ``SHORT_LIST`` sets give candidate pairs, skipped by
   length, by position in both sets, and by the number of lists they share. To
   count links all of them are compared; for the components alone a set's
   candidates are settled in two rounds: first the one with the smallest id,
   then only those that the links of the first round leave in other components.
4. Longer lists are cut into blocks by length and hash; blocks whose lengths
   cannot link are never paired. Within two blocks, whole groups of equal
   length and position are skipped by the positional bound, a pair is looked
   at only in the first long list it shares, and the overlaps of a set with
   the other block are derived from those of a highly similar set before it:
   only the grams in which the two differ are looked up. A task returns a
   spanning forest and, per set, the number of documents it links to.

Sets travel only for documents that have candidates. Everything that goes to
the driver or is broadcast has a fixed size (``SKETCH_BITS``, ``FILTER_BITS``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    arrow_map,
    bit_table,
    fresh,
    hash_strings,
    heavy_join,
    load,
    materialise,
    mix,
    shingle_hashes,
    text_chunks,
    word_codes,
    words_of,
)
from .components import Forest, components

SKETCH_BITS = 20
FILTER_BITS = 23
SHARED = 3
SHORT_LIST = 48
BLOCK = 1024  # sets in a block, of at most BLOCK_GRAMS grams together (about)
BLOCK_GRAMS = 2_000_000


# ---------------------------------------------------------------- sets
def sets_of(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-gram hashes of each text, A-Z lower-cased."""
    flat, offsets = words_of(texts, lower=True)
    codes, distinct = word_codes(flat)
    h = mix(hash_strings(distinct))[codes] if len(codes) else np.zeros(0, np.uint64)
    whole = shingle_hashes(h, k) if len(h) >= k else np.zeros(0, np.uint64)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield np.unique(whole[a:b - k + 1] if b - a >= k else shingle_hashes(h[a:b], k))


def least_overlap(n, pct: int):
    """Overlap that a set of ``n`` has at least with any set it links to."""
    return -(-pct * n // 100)


def prefix_size(n, pct: int):
    alpha = least_overlap(n, pct)
    return n - alpha + np.minimum(SHARED, alpha)


def ordered(s: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The set in global order: by count of its table cell, then by hash."""
    count = sketch[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return s[np.argsort(count, kind="stable")]


def _profiles(docs: DataFrame, k: int) -> DataFrame:
    """kind 0: doc_id, n, f1, f2 per document. kind 1: per task the counts of its grams, in compressed blocks."""
    block = 1 << (SKETCH_BITS - 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in text_chunks(batches):
            n, f1, f2 = [], [], []
            for s in sets_of(batch.column("text"), k):
                n.append(len(s))
                f1.append(int(mix(s).sum(dtype=np.uint64)))
                f2.append(int(mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)))
                np.add.at(counts, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(m, np.int32)), batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)),
                 pa.nulls(m, pa.binary())], names)
        for i in range(64):
            part = counts[i * block:(i + 1) * block]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([1], pa.int32()), pa.nulls(1, pa.int64()), pa.array([i], pa.int64()),
                     pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names)

    names = ["kind", "doc_id", "n", "f1", "f2", "counts"]
    return docs.transform(arrow_map, run, "kind int, doc_id long, n long, f1 long, f2 long, counts binary")


def _sketch(profiles: DataFrame) -> np.ndarray:
    """Sum of the count blocks of all tasks, in two steps so that no task gets more than a bounded number of them."""
    block = 1 << (SKETCH_BITS - 6)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(block, np.uint64)
        for data in rows["counts"]:
            total += np.frombuffer(zlib.decompress(data), np.uint32)
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pd.DataFrame({"n": [rows["n"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

    parts = profiles.filter("kind = 1").select("n", "counts").withColumn("part", F.spark_partition_id() % 1024)
    parts = parts.groupBy("n", "part").applyInPandas(add, "n long, counts binary")
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts.groupBy("n").applyInPandas(add, "n long, counts binary").collect():  # 64 rows of fixed size
        out[r["n"] * block:(r["n"] + 1) * block] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return out


# ---------------------------------------------------------------- index
def _entries(texts: DataFrame, sketch, k: int, pct: int) -> DataFrame:
    """Index entries (gram, id, n, pos) of the prefix of every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            grams, sizes, lengths, places = [], [], [], []
            for s in sets_of(batch.column("text"), k):
                p = int(prefix_size(len(s), pct)) if len(s) else 0
                grams.append(ordered(s, sketch.value)[:p])
                places.append(np.arange(p, dtype=np.int32))
                sizes.append(p)
                lengths.append(len(s))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.repeat(ids, sizes)),
                 pa.array(np.repeat(np.array(lengths, np.int32), sizes)), pa.array(np.concatenate(places))],
                ["gram", "id", "n", "pos"])

    return texts.transform(arrow_map, run, "gram long, id long, n int, pos int")


def _needed_sets(docs: DataFrame, ids: DataFrame, sketch, k: int) -> DataFrame:
    """(id, s) of the documents in ``ids``: the set in global order. A bit table of fixed size lets
    (nearly) only those documents be hashed; the joins that follow are exact."""
    spark = docs.sparkSession
    cell = F.shiftrightunsigned(F.xxhash64("id"), 64 - FILTER_BITS).cast("int")
    bits = spark.sparkContext.broadcast(bit_table(ids.select(cell.alias("cell")), FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            at = batch.column("cell").to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array((table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for part in text_chunks(iter([batch])):
                sets = [ordered(s, sketch.value).tobytes() for s in sets_of(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], ["id", "s"])

    found = docs.select(F.col("doc_id").alias("id"), "text").withColumn("cell", cell).transform(
        arrow_map, run, "id long, s binary")
    return found.join(ids, "id", "left_semi").distinct()


# ---------------------------------------------------------------- short lists
def _candidates(entries: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b), a < b, of the short lists that length, position and number of shared lists allow."""
    x = entries.select("gram", F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    y = entries.select("gram", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    need = F.ceil(F.lit(pct) * (F.col("na") + F.col("nb")) / F.lit(100 + pct))
    bound = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    pairs = x.join(y, "gram").filter(
        (F.col("a") < F.col("b")) & (F.lit(100) * F.least("na", "nb") >= F.lit(pct) * F.greatest("na", "nb"))
        & (bound >= need))
    shared = F.least(F.lit(SHARED), F.ceil(F.lit(pct) * F.col("na") / 100), F.ceil(F.lit(pct) * F.col("nb") / 100))
    return pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("lists")) \
        .filter(F.col("lists") >= shared).select("a", "b").distinct()


def links(x: np.ndarray, y: np.ndarray, pct: int) -> bool:
    """Whether two sorted sets link."""
    if pct * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    both = len(x) + len(y)
    common = both - len(np.unique(np.concatenate((x, y))))
    return 100 * common >= pct * (both - common)


def _verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Pairs that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), pct)
                  for x, y in zip(_bytes(batch.column("x")), _bytes(batch.column("y")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y")
    return full.transform(arrow_map, run, "a long, b long")


def _bytes(column: pa.Array) -> Iterator[memoryview]:
    for v in column:
        yield v.as_buffer()


# ---------------------------------------------------------------- long lists
def overlaps(sets: list[np.ndarray], others: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Overlaps of each set with all others, one row at a time.

    The others are an inverted index. A set that differs from the last fully computed one in fewer grams than
    it has itself derives its row from that one's: plus the lists of the grams it has more, minus those of the
    grams it lacks."""
    owner = np.repeat(np.arange(len(others)), [len(o) for o in others])
    grams = np.concatenate(others) if others else np.zeros(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]

    def counted(some: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(grams, some, "left"), np.searchsorted(grams, some, "right")
        size = hi - lo
        lo, size = lo[size > 0], size[size > 0]
        if len(lo) == 0:
            return np.zeros(len(others), np.int64)
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        return np.bincount(owner[at], minlength=len(others))

    leader, row = None, None
    for s in sets:
        if leader is not None:
            more = np.setdiff1d(s, leader, assume_unique=True)
            less = np.setdiff1d(leader, s, assume_unique=True)
            if len(more) + len(less) < len(s):
                yield row + counted(more) - counted(less)
                continue
        leader, row = s, counted(s)
        yield row


def join_blocks(left: pd.DataFrame, right: pd.DataFrame, gram: int, same: bool, pct: int
                ) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Spanning forest of the links between two blocks of one long list, and per id the weight of the sets it links
    to. Columns: id, n, pos, s, weight, heavy (the long lists of the set, in global order of its grams)."""
    # skipped as whole groups of equal (length, position): bound of the overlap below what a link needs
    keys = [f.groupby(["n", "pos"], sort=True).indices for f in (left, right)]
    allowed = np.zeros((len(left), len(right)), bool)
    for (na, pa_), rows in keys[0].items():
        for (nb, pb), cols in keys[1].items():
            need = -(-pct * (na + nb) // (100 + pct))
            if 100 * min(na, nb) >= pct * max(na, nb) and min(pa_, pb) + min(na - pa_, nb - pb) >= need:
                allowed[np.ix_(rows, cols)] = True
    # a pair belongs to the first long list that it shares
    before = [[set(h[:h.index(gram)]) for h in f["heavy"]] for f in (left, right)]
    known = {g: i for i, g in enumerate(sorted(set().union(*before[0]) & set().union(*before[1])))}
    if known:
        marks = []
        for side in before:
            m = np.zeros((len(side), len(known)), np.float32)
            for i, gs in enumerate(side):
                m[i, [known[g] for g in gs if g in known]] = 1
            marks.append(m)
        allowed &= (marks[0] @ marks[1].T) == 0
    ids = left["id"].to_numpy(), right["id"].to_numpy()
    allowed &= (ids[0][:, None] < ids[1][None, :]) if same else (ids[0][:, None] != ids[1][None, :])
    if not allowed.any():
        return [], {}
    forest, out = Forest(), []
    weights = left["weight"].to_numpy(np.int64), right["weight"].to_numpy(np.int64)
    linked = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    n = left["n"].to_numpy(), right["n"].to_numpy()
    sets = [[np.sort(np.frombuffer(s, np.uint64)) for s in f["s"]] for f in (left, right)]
    rows = np.flatnonzero(allowed.any(axis=1))
    for i, row in zip(rows.tolist(), overlaps([sets[0][i] for i in rows], sets[1]), strict=True):
        hit = allowed[i] & (100 * row >= pct * (n[0][i] + n[1] - row))
        linked[0][i] += int(weights[1][hit].sum())
        linked[1][hit] += weights[0][i]
        for j in np.flatnonzero(hit).tolist():
            a, b = int(ids[0][i]), int(ids[1][j])
            if forest.join(a, b):
                out.append((a, b))
    counts: dict[int, int] = {}
    for side in (0, 1):
        for i in np.flatnonzero(linked[side]).tolist():
            counts[int(ids[side][i])] = counts.get(int(ids[side][i]), 0) + int(linked[side][i])
    return out, counts


def _heavy(entries: DataFrame) -> DataFrame:
    """(id, heavy): the long lists of each set, in global order of its grams; at most a prefix."""
    return entries.groupBy("id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "gram"))), lambda x: x["gram"]).alias("heavy"))


def _long_lists(entries: DataFrame, sets: DataFrame, weights: DataFrame, pct: int) -> DataFrame:
    """Links within long lists (gram, id, n, pos, size): rows (a, b, null) of a forest, and rows (a, null, weight of
    the sets that a links to)."""
    heavy = _heavy(entries).join(weights, "id")
    # sets that link have the same length class or neighbouring ones
    entries = entries.withColumn("class", F.floor(F.ln("n") / float(np.log(100 / pct)) + 1e-9).cast("int")) \
        if pct < 100 else entries.withColumn("class", F.col("n"))
    width = materialise(entries.sparkSession, entries.groupBy("gram", "class").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("members")), "jaccard-widths")
    entries = heavy_join(entries, width, ["gram", "class"], "members").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks", "members", "size")
    # block pairs: within a class each pair once, between neighbouring classes all
    one = width.select("gram", "class", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    l, r = one.alias("l"), one.alias("r")
    left = F.struct(F.lit(0).alias("side"), F.col("l.class").alias("class"), F.col("l.block").alias("block"))
    right = F.struct(F.lit(1).alias("side"), F.col("r.class").alias("class"), F.col("r.block").alias("block"))
    same = (F.col("l.class") == F.col("r.class")) & (F.col("l.block") == F.col("r.block"))
    jobs = l.join(r, (F.col("l.gram") == F.col("r.gram")) & (
        ((F.col("l.class") == F.col("r.class")) & (F.col("l.block") <= F.col("r.block")))
        | (F.col("l.class") + 1 == F.col("r.class")))).select(
        F.col("l.gram").alias("gram"), F.xxhash64("l.gram", "l.class", "l.block", "r.class", "r.block").alias("job"),
        F.explode(F.when(same, F.array(left)).otherwise(F.array(left, right))).alias("x")) \
        .select("gram", "job", "x.side", "x.class", "x.block")
    members = jobs.join(entries, ["gram", "class", "block"]).join(heavy, "id").join(sets, "id") \
        .select("gram", "job", "side", "id", "n", "pos", "heavy", "weight", "s")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        gram = int(rows["gram"].iloc[0])
        rows["heavy"] = [h.tolist() for h in rows["heavy"]]
        rows = rows.sort_values(["n", "pos", "id"], kind="stable")
        left, right = (rows[rows["side"] == i].reset_index(drop=True) for i in (0, 1))
        same = len(right) == 0  # a block with itself
        found, counts = join_blocks(left, left if same else right, gram, same, pct)
        rows = [(a, b, None) for a, b in found] + [(a, None, n) for a, n in counts.items()]
        return pd.DataFrame(rows, columns=["a", "b", "n_links"], dtype="Int64")

    return members.groupBy("gram", "job").applyInPandas(run, "a long, b long, n_links long")


# ---------------------------------------------------------------- whole join
def _repeated(rows: DataFrame) -> DataFrame:
    """doc_id of the rows that repeat one, written."""
    again = rows.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    return materialise(rows.sparkSession, again, "repeated-ids")


def join(docs: DataFrame, k: int = 4, pct: int = 85, count_links: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and with ``count_links`` n_links, the number of other
    documents that it links to (rows that share a doc_id: those of each row's own text). Without the counts,
    candidates whose ends are connected already are not compared.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Fewer than ``k`` words: the whole sequence is the
    one member. No words or null text: the empty set, linked with nothing. Null doc_id: never linked,
    component null. Rows that share a doc_id are one document with the links of all of them. Other columns of
    ``docs`` are ignored; no rows in, no rows out."""
    if not 0 < pct <= 100 or k < 1:
        raise ValueError("need 0 < pct <= 100 and k >= 1")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = materialise(spark, _profiles(docs, k), "jaccard-profiles")
    sketch = spark.sparkContext.broadcast(_sketch(profiles))
    rows = profiles.filter("kind = 0").drop("kind", "counts")

    # equal sets are one node, named by their smallest doc_id
    named = rows.filter("n > 0 and doc_id is not null")
    same = ["f1", "f2", "n"]
    nodes = materialise(spark, named.groupBy(*same).agg(
        F.min("doc_id").alias("node"),
        (F.count_distinct("doc_id") if count_links else F.count(F.lit(1))).alias("weight")), "jaccard-nodes")
    weights = nodes.groupBy(F.col("node").alias("id")).agg(F.max("weight").alias("weight"))
    twice = heavy_join(named, nodes, same, "weight").groupBy("doc_id").agg(
        F.min("node").alias("a"), F.collect_set("node").alias("all")).filter(F.size("all") > 1) \
        .select("a", F.explode("all").alias("b")).filter("a <> b")  # rows that share an id but not the text

    texts = docs.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    again = _repeated(named)
    if not again.isEmpty():  # equal rows are read once (only rows that repeat an id are grouped)
        texts = texts.join(again, "doc_id", "left_anti").unionByName(
            texts.join(again, "doc_id", "left_semi").distinct())
    entries = materialise(spark, _entries(texts, sketch, k, pct), "jaccard-entries")  # read twice
    sizes = materialise(spark, entries.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"),
                        "jaccard-sizes")
    entries = materialise(spark, heavy_join(entries, sizes, ["gram"], "size"), "jaccard-index")
    short, long = entries.filter(F.col("size") <= SHORT_LIST).drop("size"), entries.filter(F.col("size") > SHORT_LIST)

    pairs = _candidates(short, pct)
    if count_links:  # a pair that shares a long list is found, and counted, there
        heavy = _heavy(long)
        both = pairs.join(heavy.select(F.col("id").alias("a"), F.col("heavy").alias("ha")), "a", "left").join(
            heavy.select(F.col("id").alias("b"), F.col("heavy").alias("hb")), "b", "left")
        pairs = both.filter(~F.coalesce(F.arrays_overlap("ha", "hb"), F.lit(False))).select("a", "b")
    pairs = materialise(spark, pairs, "jaccard-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(long.select("id")).distinct()
    ids = materialise(spark, ids, "jaccard-ids")
    sets = materialise(spark, _needed_sets(docs, ids, sketch, k), "jaccard-sets")

    # first every set with its smallest candidate, then what that leaves unconnected
    first = pairs if count_links else pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    compared = materialise(spark, _verified(first, sets, pct), "jaccard-links")
    lists = materialise(spark, _long_lists(long, sets, weights, pct), "jaccard-lists")
    found = compared.unionByName(lists.filter("b is not null").select("a", "b")).unionByName(twice)
    part = components(materialise(spark, found, "jaccard-edges"))
    if count_links:
        a, b = (compared.join(weights.withColumnRenamed("id", other), other).select(
            F.col(own).alias("id"), F.col("weight").alias("n_links")) for own, other in (("a", "b"), ("b", "a")))
        counts = a.unionByName(b).unionByName(lists.filter("b is null").select(F.col("a").alias("id"), "n_links")) \
            .groupBy("id").agg(F.sum("n_links").alias("n_links"))
        return _members(rows, nodes, part, counts)
    a = part.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = part.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    open_ = pairs.join(a, "a", "left").join(b, "b", "left").filter(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    # written: with the comparison and the contraction in one stage every task would hold two Python workers, and
    # executors keep all workers that they ever started
    rest = materialise(spark, _verified(open_.join(first, ["a", "b"], "left_anti"), sets, pct), "jaccard-rest")
    part = components(part.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(rest))

    return _members(rows, nodes, part, None)


def _members(rows: DataFrame, nodes: DataFrame, part: DataFrame, counts: DataFrame | None) -> DataFrame:
    """The result of every row: that of its node (all rows of a class of equal sets share it, however many)."""
    found = nodes.join(part.withColumnRenamed("id", "node"), "node", "left")
    if counts is not None:
        found = found.join(counts.withColumnRenamed("id", "node"), "node", "left")
    links = F.lit(None).cast("long") if counts is None else F.col("weight") - 1 + F.coalesce("n_links", F.lit(0))
    found = materialise(rows.sparkSession, found.select(
        "f1", "f2", "n", "weight", F.coalesce("component", "node").alias("component_id"), links.alias("n_links")),
        "jaccard-classes")
    in_class = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", *([] if counts is None else ["n_links"])]
    alone = rows.filter(~in_class).withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
    return heavy_join(rows.filter(in_class), found, ["f1", "f2", "n"], "weight").select(*columns) \
        .unionByName(alone.select(*columns))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(load(spark, sf_dir, "documents"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of near-duplicates (five-word shingles, similarity of 0.8 or more,
    connected) stays, the one with the smallest doc_id (rows without one come last); rows without words stay.

    The join runs on texts: its id is a 64-bit key of doc_id and text, so a repeated doc_id ties no texts
    together and rows without one are joined like all others."""
    key = F.xxhash64(F.col("doc_id").cast("long"), "text")
    name = fresh(docs, "key")
    groups = join(docs.select(key.alias("doc_id"), "text"), k=5, pct=80, count_links=False) \
        .filter("n_shingles > 0").select(F.col("doc_id").alias(name), "component_id")
    groups = materialise(spark, groups, "near-duplicate-groups")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias(name)).distinct()
    members = groups.distinct().join(ids, name)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", name))
    stay = members.groupBy("component_id").agg(least.alias("least")).select(F.col(f"least.{name}").alias(name))
    # written, so that Spark knows their size when it picks the joins
    gone = materialise(spark, members.select(name).distinct().join(stay, name, "left_anti"), "near-duplicates")
    kept = docs.withColumn(name, key).join(gone, name, "left_anti")
    # equal rows share a key (only they are grouped): one stays
    again = materialise(spark, groups.groupBy(name).count().filter("count > 1").select(name), "repeated-rows")
    once = kept.join(again, name, "left_semi").dropDuplicates([name])
    return kept.join(again, name, "left_anti").unionByName(once).select(docs.columns)
