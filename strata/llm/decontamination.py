"""Benchmark decontamination by greedy string tiling.

Words are lower-cased and lose signs at their ends. A document and a benchmark
item are compared if they share a seed, a run of ``MIN_MATCH`` words:

1. a bit table of fixed size over the hashes of all benchmark seeds is sent to
   the executors; one pass over the documents keeps the seeds that hit it, and
   the word hashes of the documents that have any (written to the shared folder);
2. those seeds are equi-joined with the benchmark's, which removes what the
   table let through by chance: pairs (document, item), each once;
3. each pair is tiled: the longest common run of unmarked words (found by
   Karp-Rabin hashes of windows, then compared word by word) is marked in both,
   again and again down to ``MIN_MATCH`` words. Tiles may come in any order, so
   passages with moved parts are found as well;
4. the pair is a leak if tiles cover at least ``LEAST_COVERAGE`` of the item.

Nothing grows with the documents but steps that Spark partitions by document;
both join sides of the benchmark are written first, so Spark knows their size
and broadcasts them only below its own threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    arrow_map,
    bit_table,
    fresh,
    hash_strings,
    load,
    materialise,
    mix,
    shingle_hashes,
    text_chunks,
    word_codes,
    words_of,
)

MIN_MATCH = 5
LEAST_COVERAGE = 0.5
TABLE_BITS = 26  # 8 MB; a larger benchmark only lets more chance seeds through step 1
SIGNS = ".,;:!?()[]{}<>\"'`*_-|/\\#$%&+=~^"
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and the start of each text in it."""
    flat, offsets = words_of(texts)
    codes, distinct = word_codes(flat)
    plain = pc.utf8_trim(pc.utf8_lower(distinct), characters=SIGNS)
    h = mix(hash_strings(plain))
    if len(codes) == 0:
        return np.zeros(0, np.uint64), offsets
    keep = pc.greater(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)[codes]
    return h[codes][keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(12, int(n).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _POWERS[size]


class _Side:
    """Token sequence with marks and Karp-Rabin hashes of its windows."""

    def __init__(self, tokens: np.ndarray):
        self.tokens = tokens
        self.marked = np.zeros(len(tokens), bool)
        up, self.down = _powers(len(tokens) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens * up[:len(tokens)], dtype=np.uint64)))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows without a marked word."""
        n = len(self.tokens) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        marks = np.concatenate(([0], np.cumsum(self.marked)))
        starts = np.flatnonzero(marks[size:] == marks[:n])
        return starts, (self.sums[starts + size] - self.sums[starts]) * self.down[starts]


def _equal(item: _Side, doc: _Side, i: int, t: int, size: int) -> bool:
    return np.array_equal(item.tokens[i:i + size], doc.tokens[t:t + size])


def _by_hash(starts: np.ndarray, hashes: np.ndarray, wanted: np.ndarray) -> dict[int, list[int]]:
    """Starts (ascending) of the windows with a wanted hash."""
    keep = np.isin(hashes, wanted)
    out: dict[int, list[int]] = {}
    for t, x in zip(starts[keep].tolist(), hashes[keep].tolist(), strict=True):
        out.setdefault(x, []).append(t)
    return out


def _any_common(item: _Side, doc: _Side, size: int) -> bool:
    """Whether some window of ``size`` unmarked words stands in both. Windows are compared word by word only
    where their hashes agree, and mostly the first comparison decides."""
    at, h = item.windows(size)
    to, g = doc.windows(size)
    shared = np.intersect1d(h, g)
    if len(shared) == 0:
        return False
    left, right = _by_hash(at, h, shared), _by_hash(to, g, shared)
    return any(_equal(item, doc, i, t, size) for x in left for i in left[x] for t in right[x])


def _mark_common(item: _Side, doc: _Side, size: int) -> list[tuple[int, int, int]]:
    """Mark equal windows of ``size`` words that do not overlap: by item start the first document start that is
    free. A document start that is taken stays taken, so each is passed once however often a word repeats."""
    at, h = item.windows(size)
    to, g = doc.windows(size)
    places = _by_hash(to, g, h)
    first = dict.fromkeys(places, 0)
    out = []
    for i, x in zip(at.tolist(), h.tolist(), strict=True):
        own = places.get(x)
        if own is None or item.marked[i:i + size].any():
            continue
        while first[x] < len(own) and doc.marked[own[first[x]]:own[first[x]] + size].any():
            first[x] += 1
        for t in own[first[x]:]:
            if not doc.marked[t:t + size].any() and _equal(item, doc, i, t, size):
                item.marked[i:i + size] = True
                doc.marked[t:t + size] = True
                out.append((i, t, size))
                break
    return out


def most_coverage(item_tokens: np.ndarray, doc_tokens: np.ndarray, least: int = MIN_MATCH) -> int:
    """Words of the item in windows of ``least`` words that the document may hold: tiles cover no more."""
    item, doc = _Side(item_tokens), _Side(doc_tokens)
    at, h = item.windows(least)
    at = at[np.isin(h, doc.windows(least)[1])]
    edges = np.zeros(len(item_tokens) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + least, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def tiles(item_tokens: np.ndarray, doc_tokens: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item start, document start, length), longest first; ties by item start, then
    document start. A longest match is looked for by halving the range of lengths: where a long common
    window exists, shorter ones do."""
    item, doc = _Side(item_tokens), _Side(doc_tokens)
    out: list[tuple[int, int, int]] = []
    high = min(len(item_tokens), len(doc_tokens))
    while high >= least and _any_common(item, doc, least):
        low, top = least, high
        while low < top:
            middle = (low + top + 1) // 2
            if _any_common(item, doc, middle):
                low = middle
            else:
                top = middle - 1
        out += _mark_common(item, doc, low)
        high = low
    return out


def _seed_rows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with their word hashes, and their seeds (h, item_id), both written."""
    spark = benchmark.sparkSession

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            h, offsets = token_hashes(batch.column("text"))
            parts = [h[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            seeds = [np.unique(shingle_hashes(p, MIN_MATCH)).view(np.int64).tolist() if len(p) >= MIN_MATCH else []
                     for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([p.tobytes() for p in parts], pa.binary()),
                 pa.array(seeds, pa.list_(pa.int64()))], ["item_id", "item_tokens", "seeds"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").transform(
        arrow_map, items, "item_id long, item_tokens binary, seeds array<long>")
    rows = materialise(spark, rows.withColumn("item", F.monotonically_increasing_id()), "benchmark-items")
    seeds = materialise(spark, rows.select("item", F.explode("seeds").alias("h")), "benchmark-seeds")
    return rows.drop("seeds"), seeds


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = LEAST_COVERAGE) -> DataFrame:
    """One row per leak: doc_id, item_id, item_words, covered_words, n_tiles, longest_tile, coverage.

    Documents without a leak have no row. Null and empty texts, and items of fewer than ``MIN_MATCH`` words,
    have no leaks. Repeated documents or items give repeated rows; other columns are ignored."""
    spark = docs.sparkSession
    items, seeds = _seed_rows(benchmark)
    cells = seeds.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).cast("int").alias("cell"))
    shared = spark.sparkContext.broadcast(bit_table(cells, TABLE_BITS))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in text_chunks(batches):
            h, offsets = token_hashes(batch.column("text"))
            s = shingle_hashes(h, MIN_MATCH) if len(h) >= MIN_MATCH else np.zeros(0, np.uint64)
            cell = (s >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            at = np.flatnonzero(bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)
            row = np.searchsorted(offsets, at, side="right") - 1
            inside = at + MIN_MATCH <= offsets[row + 1]  # not across two texts
            at, row = at[inside], row[inside]
            rows = np.unique(row)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)),
                     pa.array([h[offsets[r]:offsets[r + 1]].tobytes() for r in rows.tolist()], pa.binary()),
                     pa.array([np.unique(s[at[row == r]]).view(np.int64).tolist() for r in rows.tolist()],
                              pa.list_(pa.int64()))], ["doc_id", "tokens", "seeds"])

    hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(
        arrow_map, find, "doc_id long, tokens binary, seeds array<long>")
    hits = materialise(spark, hits.withColumn("row", F.monotonically_increasing_id()), "leak-hits")
    pairs = hits.select("row", F.explode("seeds").alias("h")).join(seeds, "h").select("row", "item").distinct()

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                item = np.frombuffer(batch.column("item_tokens")[i].as_py(), np.uint64)
                doc = np.frombuffer(batch.column("tokens")[i].as_py(), np.uint64)
                if most_coverage(item, doc) < coverage * len(item):
                    continue
                lengths = [n for _, _, n in tiles(item, doc)]
                if lengths and sum(lengths) >= coverage * len(item):
                    out.append({"doc_id": batch.column("doc_id")[i].as_py(),
                                "item_id": batch.column("item_id")[i].as_py(), "item_words": len(item),
                                "covered_words": sum(lengths), "n_tiles": len(lengths), "longest_tile": max(lengths),
                                "coverage": sum(lengths) / len(item)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int32()),
                        ("covered_words", pa.int32()), ("n_tiles", pa.int32()), ("longest_tile", pa.int32()),
                        ("coverage", pa.float64())])
    return pairs.join(hits.select("row", "doc_id", "tokens"), "row").join(items, "item") \
        .select("doc_id", "item_id", "tokens", "item_tokens").transform(
        arrow_map, tile, "doc_id long, item_id long, item_words int, covered_words int, n_tiles int, longest_tile int, "
              "coverage double")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text holds a benchmark item go. Whether it does depends on the text alone, so
    leaks are carried by a 64-bit digest of the text: rows without a doc_id, or with a repeated one, are judged
    one by one."""
    digest, name = F.xxhash64("text"), fresh(docs, "digest")
    found = leaks(docs.select(digest.alias("doc_id"), "text"), load(spark, sf_dir, "benchmark")) \
        .select(F.col("doc_id").alias(name)).distinct()
    # written, so that Spark knows its size when it picks the join
    found = materialise(spark, found, "leaked")
    return docs.withColumn(name, digest).join(found, name, "left_anti").select(docs.columns)
