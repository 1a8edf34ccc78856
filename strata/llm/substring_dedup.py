"""Substring dedup: passages of ``window`` words or more that begin earlier in a smaller document are removed.

A window is ``window`` consecutive words of one document. It is found when a
document with a smaller doc_id holds the same words somewhere. FM-indexes of
bounded size (shards) are searched for the windows of streamed passages:

1. every window has a seed: the least hash of its grams of k words. Equal windows
   have equal seeds, and neighbouring windows mostly share theirs. Per seed the
   smallest document is its owner; a seed of one document only leads nowhere;
2. each owner's passages around its seeds go to the index of its shard, and the
   passages of all other documents around those seeds are streamed to that shard.
   A shard that gets many streamed words is dealt over several tasks, each with
   a copy of the (bounded) index;
3. matching statistics of the streamed passages, by backward search, give the
   windows that the index holds in a smaller document: these are found;
4. what is not found goes to the next round with longer grams. In the last
   rounds a gram is the whole window, so its owner holds it.

This is complete: if e < d hold the same window and its owner o does not, then e
and d were searched in the same index, so either both found it there or both go
on to the next round. No group is collected and no pairs are made; owners come
from a minimum with partial aggregation, and seeds with more than 1/1024 of all
rows are joined through a broadcast table of at most 1,024 rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, hash_strings, load, materialise, mix, text_chunks, word_codes, words_of
from .fm_index import NO_OWNER, FMIndex

WINDOW = 50
SHARD_WORDS = 1 << 19  # words of an index, about
STREAM_WORDS = 1 << 21  # streamed words of a task's share of a shard, about
LOAD_CELLS = 1 << 16  # shards share this many counters of streamed words
CHUNK_WORDS = 1 << 18  # streamed words that are searched in one go
PIECE = 256  # windows of a piece; pieces are searched in step
HEAVY = 1024  # a seed with more than 1 / HEAVY of all rows is joined by broadcast

_STEP = np.uint64(0x9E3779B97F4A7C15)
_RANGE = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_RANGES = "array<struct<first:long,last:long>>"
ROW = ["doc", "r1", "r2"]  # a row of the input: its id and two hashes of its text


# ---------------------------------------------------------------- windows and seeds
def _gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on (meaningless where a text ends before)."""
    done, level, size, out = 0, h, 1, None
    while size <= k:
        if k & size:
            if out is None:
                out = level
            else:
                n = len(level) - done
                out = mix(out[:n] * _STEP + level[done:done + n])
            done += size
        level = mix(level[:-size] * _STEP + level[size:]) if len(level) > size else level[:0]
        size *= 2
    return out[:max(len(h) - k + 1, 0)]


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def _mask(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """True at the places of the ranges."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + 1, -1)
    return np.cumsum(edges[:-1]) > 0


def _pending(lists: pa.Array, offsets: np.ndarray, window: int) -> np.ndarray:
    """True at the places where a pending window begins, from a column of ranges of windows, one list per text."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), counts)
    first = flat.field("first").to_numpy(zero_copy_only=False) + offsets[row]
    last = np.minimum(flat.field("last").to_numpy(zero_copy_only=False) + offsets[row], offsets[row + 1] - window)
    real = first <= last
    return _mask(int(offsets[-1]), first[real], last[real])


def _runs(at: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of neighbouring places with equal values."""
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.diff(at) != 1
    for o in others:
        new |= o[1:] != o[:-1]
    cut = np.flatnonzero(new)
    return np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(at) - 1]))


def _range_lists(first: np.ndarray, last: np.ndarray, part: np.ndarray, rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(part, np.arange(rows + 1)), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64))], ["first", "last"]))


def seed_rows(passages: DataFrame, window: int, k: int, salt: int) -> DataFrame:
    """Per passage its seeds: the least gram hash of each pending window, with the range of windows it holds for."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            flat, offsets = words_of(batch.column("text"))
            n = len(flat)
            if n < window:
                continue
            codes, words = word_codes(flat)
            grams = _gram_hashes(mix(hash_strings(words) ^ np.uint64(salt))[codes], k)
            least = _sliding_min(grams, window - k + 1)
            pending = _pending(batch.column("todo"), offsets, window)
            part = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            at = np.flatnonzero(pending)
            a, z = _runs(at, least[at], part[at])
            first, row = at[a], part[at[a]]
            has = np.unique(row)
            seeds = pa.StructArray.from_arrays(
                [pa.array(least[first].view(np.int64)), pa.array(first - offsets[row]),
                 pa.array(at[z] - offsets[row])], ["seed", "first", "last"])
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([np.searchsorted(row, has), [len(row)]]), pa.int32()), seeds)
            taken = batch.select([*ROW, "start"]).take(pa.array(has))
            yield pa.RecordBatch.from_arrays([*taken.columns, lists], [*ROW, "start", "seeds"])

    return arrow_map(passages.select(*ROW, "start", "text", "todo"), find,
                     "doc long, r1 long, r2 long, start long, seeds array<struct<seed:long,first:long,last:long>>")


def _owned(spark: SparkSession, seeds: DataFrame) -> DataFrame:
    """(row, start, first, last, owner) of the seeds that two documents or more hold."""
    rows = seeds.select(*ROW, "start", F.explode("seeds").alias("s")).select(*ROW, "start", "s.*")
    owners = rows.groupBy("seed").agg(F.min("doc").alias("owner"), F.max("doc").alias("top"),
                                      F.count(F.lit(1)).alias("n")).filter("owner < top")
    owners = materialise(spark, owners.select("seed", "owner", "n"), "passage-owners")
    total = seeds.agg(F.sum(F.size("seeds"))).first()[0] or 0
    heavy = owners.filter(F.col("n") * HEAVY > total).select("seed", "owner")  # fewer than HEAVY rows
    light = owners.filter(F.col("n") * HEAVY <= total).select("seed", "owner")
    hot = F.broadcast(heavy)
    return rows.join(hot, "seed").unionByName(
        rows.join(F.broadcast(heavy.select("seed")), "seed", "left_anti").join(light, "seed")).drop("seed")


# ---------------------------------------------------------------- passages
def _cuts(ranges: list[tuple[int, int]], window: int) -> Iterator[tuple[int, int, list[dict]]]:
    """(begin, end, ranges counted from begin) of the stretches of words that sorted window ranges cover."""
    begin, end, own = 0, -1, []
    for first, last in ranges:
        if own and first < end:
            end = max(end, last + window)
        else:
            if own:
                yield begin, end, own
            begin, end, own = first, last + window, []
        own.append({"first": first - begin, "last": last - begin})
    if own:
        yield begin, end, own


_PASSAGE = "owner long, doc long, r1 long, r2 long, start long, text string, n long, todo " + _RANGES


def _cut(passages: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """The passages' parts around seeds with an owner: one row per stretch and owner."""
    own = marks.groupBy(*ROW, "start").agg(F.collect_set(F.struct("owner", "first", "last")).alias("marks"))
    schema = pa.schema([("owner", pa.int64()), ("doc", pa.int64()), ("r1", pa.int64()), ("r2", pa.int64()),
                        ("start", pa.int64()), ("text", pa.string()), ("n", pa.int64()), ("todo", pa.list_(_RANGE))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            columns = {c: batch.column(c).to_pylist() for c in [*ROW, "start"]}
            texts = batch.column("text").cast(pa.large_binary())
            out: dict[str, list] = {name: [] for name in schema.names}
            for i in range(batch.num_rows):
                words = texts[i].as_py().split()
                by_owner: dict[int, list] = {}
                for m in batch.column("marks")[i].as_py():
                    by_owner.setdefault(m["owner"], []).append((m["first"], m["last"]))
                for owner, ranges in sorted(by_owner.items()):
                    for begin, end, todo in _cuts(sorted(ranges), window):
                        for name, value in (("owner", owner), ("doc", columns["doc"][i]), ("r1", columns["r1"][i]),
                                            ("r2", columns["r2"][i]), ("start", columns["start"][i] + begin),
                                            ("text", b" ".join(words[begin:end]).decode()), ("n", end - begin),
                                            ("todo", todo)):
                            out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    joined = passages.select(*ROW, "start", "text").join(own, [*ROW, "start"])
    return arrow_map(joined, cut, _PASSAGE)


# ---------------------------------------------------------------- search
class _Shard:
    """The index of one shard and the passages that are streamed to it."""

    def __init__(self, window: int):
        self.window, self.parts, self.index, self.held, self.words = window, [], None, [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def stream(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.held.append(batch)
        self.words += pc.sum(batch.column("n")).as_py()
        if self.words >= CHUNK_WORDS:
            yield from self.flush()

    def _build(self) -> None:
        whole = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        self.parts = []
        flat, offsets = words_of(whole.column("text"))
        codes, self.vocabulary = word_codes(flat)
        sizes = np.diff(offsets)
        seq = np.zeros(len(codes) + len(sizes), np.int64)
        seq[np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)] = codes + 1
        self.index = FMIndex(seq, np.repeat(whole.column("doc").to_numpy(), sizes + 1), self.window)

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Found and pending windows of the passages held so far."""
        if not self.held:
            return
        if self.index is None:
            self._build()
        batch = pa.Table.from_batches(self.held).combine_chunks().to_batches()[0]
        self.held, self.words = [], 0
        window = self.window
        flat, offsets = words_of(batch.column("text"))
        query = pc.fill_null(pc.add(pc.index_in(flat, value_set=self.vocabulary), 1), 0).to_numpy(
            zero_copy_only=False).astype(np.int64)
        pending = _pending(batch.column("todo"), offsets, window)
        # pieces of the passages, each with its own windows
        count = np.maximum(np.diff(offsets) - window + PIECE, 0) // PIECE
        row = np.repeat(np.arange(batch.num_rows), count)
        begin = offsets[row] + (np.arange(len(row)) - (np.cumsum(count) - count)[row]) * PIECE
        end = np.minimum(begin + PIECE + window - 1, offsets[row + 1])
        least = self.index.least_owner(query, begin, end)
        part = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        doc = batch.column("doc").to_numpy()
        found = pending & (least != NO_OWNER) & (least < doc[part])
        yield from self._rows(batch, part, offsets, found, pending & ~found)

    def _rows(self, batch, part, offsets, found, rest) -> Iterator[pa.RecordBatch]:
        start = batch.column("start").to_numpy()
        at = np.flatnonzero(found)
        a, z = _runs(at, part[at])
        row = part[at[a]]
        move = start[row] - offsets[row]
        has = np.unique(row)
        if len(has):
            lists = _range_lists(at[a] + move, at[z] + move, np.searchsorted(has, row), len(has))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(ROW).take(pa.array(has)).columns, pa.nulls(len(has), pa.int64()), lists,
                 pa.nulls(len(has), pa.string()), pa.nulls(len(has), pa.list_(_RANGE))], _FOUND.names)
        at = np.flatnonzero(rest)
        a, z = _runs(at, part[at])
        row = part[at[a]]
        first, last = (at[a] - offsets[row]).tolist(), (at[z] - offsets[row]).tolist()
        edge = np.flatnonzero(np.diff(row, prepend=-1, append=-1)).tolist() if len(row) else []
        out: dict[str, list] = {name: [] for name in _FOUND.names}
        texts = batch.column("text").cast(pa.binary())
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            i = int(row[x])
            words = texts[i].as_py().split()
            ids = [batch.column(c)[i].as_py() for c in ROW]
            for begin, end, todo in _cuts(list(zip(first[x:y], last[x:y], strict=True)), self.window):
                for name, value in zip(_FOUND.names, [*ids, int(start[i]) + begin, None,
                                                      b" ".join(words[begin:end]).decode(), todo], strict=True):
                    out[name].append(value)
        if out["doc"]:
            yield pa.RecordBatch.from_pydict(out, schema=_FOUND)


_FOUND = pa.schema([("doc", pa.int64()), ("r1", pa.int64()), ("r2", pa.int64()), ("start", pa.int64()),
                    ("found", pa.list_(_RANGE)), ("text", pa.string()), ("todo", pa.list_(_RANGE))])


def _search(spark: SparkSession, parts: DataFrame, window: int) -> DataFrame:
    """Rows with ``found`` windows, and rows with passages of windows that are still pending."""
    indexed = F.col("doc") == F.col("owner")
    words = parts.agg(F.sum(F.when(indexed, F.col("n")))).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    parts = parts.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards))) \
        .withColumn("cell", F.pmod("shard", F.lit(LOAD_CELLS))).withColumn("streamed", ~indexed)
    loads = parts.filter("streamed").groupBy("cell").agg(
        F.ceil(F.sum("n") / STREAM_WORDS).cast("int").alias("shares"))  # at most LOAD_CELLS rows
    dealt = parts.join(F.broadcast(loads), "cell")
    salt = F.when(F.col("streamed"), F.array(F.pmod(F.xxhash64(*ROW, "start"), F.col("shares")).cast("int"))) \
        .otherwise(F.sequence(F.lit(0), F.col("shares") - 1))
    dealt = dealt.withColumn("share", F.explode(salt)).select(
        "shard", "share", "streamed", *ROW, "start", "text", "n", "todo") \
        .repartition("shard", "share").sortWithinPartitions("shard", "share", "streamed")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, _Shard(window)
        for batch in text_chunks(batches):
            marks = np.stack([batch.column("shard").to_numpy(), batch.column("share").to_numpy().astype(np.int64),
                              batch.column("streamed").to_numpy(zero_copy_only=False).astype(np.int64)])
            cut = np.flatnonzero((np.diff(marks, axis=1) != 0).any(axis=0)) + 1
            for a, z in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
                if key != tuple(marks[:2, a]):
                    yield from shard.flush()
                    key, shard = tuple(marks[:2, a]), _Shard(window)
                rows = batch.slice(a, z - a)
                if marks[2, a]:
                    yield from shard.stream(rows)
                else:
                    shard.add(rows)
        yield from shard.flush()

    return arrow_map(dealt, search, f"doc long, r1 long, r2 long, start long, found {_RANGES}, text string, "
                                    f"todo {_RANGES}")


# ---------------------------------------------------------------- operator
def row_key(doc_id: Column, text: Column) -> list[Column]:
    return [doc_id.cast("long").alias("doc"), F.xxhash64(text).alias("r1"),
            F.xxhash64(F.lit("row"), text).alias("r2")]


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, r1, r2, found): per different (doc_id, text) with repeated windows the ranges of their first words.

    ``row_key`` gives the same three columns for a row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()) \
        .select(*row_key(F.col("doc_id"), F.col("text")), "text")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.lit((1 << 31) - 1).cast("long").alias("last")))
    passages = rows.withColumn("start", F.lit(0).cast("long"))
    found = None
    rounds = [max(window // 3, 1), max(2 * window // 3, 1)]
    number = 0
    while True:
        k = rounds[number] if number < len(rounds) else window
        todo = passages if number else passages.withColumn("todo", whole)
        seeds = materialise(spark, seed_rows(todo, window, k, number), "passage-seeds")
        marks = _owned(spark, seeds)
        if not number:  # a repeated row is one row
            passages = passages.dropDuplicates([*ROW, "start"])
        parts = materialise(spark, _cut(passages, marks, window), "passage-parts")
        result = materialise(spark, _search(spark, parts, window), "passage-matches")
        hits = result.filter("found is not null").select(*ROW, "found")
        found = hits if found is None else found.unionByName(hits)
        passages = result.filter("found is null").select(*ROW, "start", "text", "todo")
        number += 1
        if number > len(rounds) and passages.isEmpty():
            break
    return found.groupBy(*ROW).agg(F.flatten(F.collect_list("found")).alias("found"))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words that stay, joined by one space) and
    removed (ranges of removed words, first and last).

    A document with fewer words than the window, and a null, empty or blank text, loses nothing. A row without a
    doc_id is neither smaller nor larger than any: it loses nothing and no other row loses anything for it. Rows with
    the same doc_id are not compared with each other. Other columns are ignored."""
    found = repeated_windows(docs, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            sizes, gone, kept, removed = [], [], [], []
            for text, ranges in zip(texts, batch.column("found").to_pylist(), strict=True):
                words = (text or b"").split()  # bytes: splits at ASCII white space
                sizes.append(len(words))
                spans = []
                if ranges:
                    drop = _mask(len(words), np.array([r["first"] for r in ranges]),
                                 np.array([r["last"] for r in ranges]) + window - 1)
                    at = np.flatnonzero(drop)
                    a, z = _runs(at)
                    spans = [{"first": x, "last": y} for x, y in zip(at[a].tolist(), at[z].tolist(), strict=True)]
                    gone.append(len(at))
                    words = [words[i] for i in np.flatnonzero(~drop).tolist()]
                else:
                    gone.append(0)
                kept.append(b" ".join(words))
                removed.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, pa.list_(_RANGE))],
                ["doc_id", "n_words", "n_removed", "kept", "removed"])

    rows = docs.select("text", *row_key(F.col("doc_id"), F.col("text")))
    return rows.join(found, ROW, "left").select(F.col("doc").alias("doc_id"), "text", "found").transform(
        arrow_map, keep, f"doc_id long, n_words long, n_removed long, kept string, removed {_RANGES}")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay when passages of 50 words or more that a smaller document holds are removed."""
    kept = dedup(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)
                       .alias("kept_sha256"), F.size("removed").alias("n_passages"))
