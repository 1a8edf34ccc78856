"""Periodic runs of words: maximal repetitions found through Lyndon roots.

A run is a stretch of consecutive words with smallest period q that is at least
``2 * q`` (and ``min_length``) words long and that no neighbouring word extends.
Every run holds a Lyndon root: the longest Lyndon word that begins at some
position, under the order of the words or under its reverse. So:

1. stretches that can hold a run are cut out: every 4-gram of a run but three in
   a row occurs again in the same run, so a stretch is a chain of repeated
   4-grams with gaps of three at most. Nothing else can be in a run;
2. the Lyndon array of the stretches is made under both orders. The first phase
   of Baier's suffix sorter yields it directly: suffixes are grouped by their
   first word, groups are taken from the greatest down, each suffix of a group
   points at the nearest smaller suffix before it, and the suffixes pointed at
   move to a new group whose context is longer by the contexts that point at
   them. The context of a group when it is taken is the longest Lyndon word;
3. each root is extended to both sides by longest common extensions, read off
   names of all blocks of 1, 2, 4, ... words (equal blocks have equal names, no
   hashing), for all roots of a chunk at a time.

The work on a text is in proportion to its length times the logarithm of its
longest stretch; texts are independent of each other, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, load, mix, text_chunks, word_codes, words_of

MIN_LENGTH = 12
_GRAM = 4  # a run of 12 words or more has a repeated 4-gram at its first and at its last place
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- stretches
def _repeated_grams(seq: np.ndarray, part: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where a 4-gram begins that occurs twice or more in its part (or shares its hash with one that does)."""
    n = len(seq) - _GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = mix(seq.astype(np.uint64) + np.uint64(1))
    pairs = mix(h[:-1] * _STEP + h[1:])
    grams = mix((pairs[:-2] * _STEP + pairs[2:]) ^ mix(part[:n].astype(np.uint64) * _STEP))
    at = np.flatnonzero(np.arange(n) + _GRAM <= ends[part[:n]])  # not across two parts
    grams = grams[at]
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return at[twice]


def _stretches(seq: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int) -> np.ndarray:
    """(k, 2) array of begin and end of the stretches of ``seq`` that can hold runs; parts are [starts, ends)."""
    bounds = np.stack([starts, ends], axis=1)
    for _ in range(2):  # the second time only what recurs inside the same stretch counts
        bounds = bounds[bounds[:, 1] - bounds[:, 0] >= min_length]
        sizes = bounds[:, 1] - bounds[:, 0]
        if len(bounds) == 0:
            return bounds
        own_ends = np.cumsum(sizes)
        shift = bounds[:, 0] - (own_ends - sizes)  # place in ``seq`` minus place in the list of these parts
        part = np.repeat(np.arange(len(bounds)), sizes)
        at = _repeated_grams(seq[np.arange(len(part)) + shift[part]], part, own_ends)
        if len(at) == 0:
            return np.zeros((0, 2), np.int64)
        cut = np.flatnonzero((np.diff(at) > _GRAM) | (np.diff(part[at]) != 0))
        first, last = at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]
        bounds = np.stack([first + shift[part[first]], last + _GRAM + shift[part[last]]], axis=1)
    return bounds[bounds[:, 1] - bounds[:, 0] >= min_length]


# ---------------------------------------------------------------- Lyndon arrays
def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place (rank 0 separates texts: 1 there).

    Phase one of Baier's suffix sorter. Ranks are 0, 1, 2, ... without gaps."""
    n = len(ranks)
    top = max(ranks, default=0)
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    group = list(ranks)
    below = list(range(-1, top))
    above = [*range(1, top + 1), -1]
    length = [1] * n
    open_ = -2
    before = [open_] * n  # nearest smaller suffix to the left, once the own group has been taken
    current = top
    while current > 0:
        taken = [i for i in members[current] if group[i] == current]
        members[current] = []
        if taken:
            context = length[taken[0]]
            moved: dict[tuple[int, int], list[int]] = {}
            last, count = -1, 0
            for i in taken:  # ascending, so the places pointed at ascend too
                j = i - 1
                while j >= 0 and before[j] != open_:
                    j = before[j]
                before[i] = j
                if j == last:
                    count += 1
                    continue
                if last >= 0 and ranks[last]:
                    moved.setdefault((count, group[last]), []).append(last)
                last, count = j, 1
            if last >= 0 and ranks[last]:
                moved.setdefault((count, group[last]), []).append(last)
            for times, old in sorted(moved, reverse=True):  # more pointers: greater, so placed first, pushed up last
                new = len(members)
                rows = moved[times, old]
                members.append(rows)
                for j in rows:
                    group[j] = new
                    length[j] += times * context
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                below[up] = new
        current = below[current]
    return length


# ---------------------------------------------------------------- extension
def _block_names(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[k][i] == names[k][j] exactly if the blocks of 2**k codes at i and j are equal."""
    names = [codes.astype(np.int32)]
    while 1 << len(names) <= longest:
        low, half = names[-1], 1 << (len(names) - 1)
        if len(low) <= half:
            break
        pair = low[:-half].astype(np.int64) * (int(low.max()) + 1) + low[half:]
        names.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
    return names


def _common_extension(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, room: np.ndarray,
                      backward: bool) -> np.ndarray:
    """Longest common extension of the places a and b, ``room`` at most, to the right or (from a-1 and b-1) to
    the left."""
    done = np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        size, table = 1 << k, names[k]
        step = np.flatnonzero(done + size <= room)
        x, y = (a[step] - done[step] - size, b[step] - done[step] - size) if backward else \
            (a[step] + done[step], b[step] + done[step])
        done[step[table[x] == table[y]]] += size
    return done


def find_runs(seq: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(k, 4) array of text number, start, length, period of every run of the texts ``seq[offsets[i]:offsets[i+1]]``,
    ordered by text, start and period. ``min_length`` is 12 at least."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs shorter than {MIN_LENGTH} words are not sought")
    stretches = _stretches(seq, offsets[:-1], offsets[1:], min_length)
    if len(stretches) == 0:
        return np.zeros((0, 4), np.int64)
    sizes = stretches[:, 1] - stretches[:, 0]
    # the stretches in a row, a separator before each
    begin = np.cumsum(sizes + 1) - sizes
    part = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(part)) + part + 1
    place = at - begin[part] + stretches[part, 0]
    _, dense = np.unique(seq[place], return_inverse=True)
    most = int(dense.max()) + 1
    codes = np.zeros(len(part) + len(sizes), np.int64)
    codes[at] = dense + 1
    root, period = [], []
    for ranks in (codes, np.where(codes > 0, most + 1 - codes, 0)):
        found = np.array(lyndon_array(ranks.tolist()), np.int64)[at]
        root.append(at)
        period.append(found)
    # equal roots of both orders (single words mostly) are extended once
    root, period = np.concatenate(root), np.concatenate(period)
    own = np.concatenate([part, part])
    low, high = begin[own], begin[own] + sizes[own]
    inside = root + period < high
    root, period, own, low, high = (x[inside] for x in (root, period, own, low, high))
    names = _block_names(codes, int(sizes.max()))
    right = _common_extension(names, root, root + period, high - root - period, False)
    left = _common_extension(names, root, root + period, root - low, True)
    start, size = root - left, left + period + right
    good = size >= np.maximum(min_length, 2 * period)
    start = start[good] - begin[own[good]] + stretches[own[good], 0]
    text = np.searchsorted(offsets, start, side="right") - 1
    rows = np.stack([text, start - offsets[text], size[good], period[good]], axis=1)
    rows = np.unique(rows, axis=0)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period by start, then period) and
    collapsed (the words that stay when of each run only the first period is kept, joined by one space).

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Texts of any length are taken
    whole; a null doc_id is passed on, repeated rows give repeated results, and other columns are ignored."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            flat, offsets = words_of(batch.column("text"))
            codes, _ = word_codes(flat)
            found = find_runs(codes, offsets, min_length)
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            collapsed, lists = [], [[] for _ in texts]
            for text, start, length, period in found.tolist():
                lists[text].append({"start": start, "length": length, "period": period})
            for i, text in enumerate(texts):
                if not lists[i]:
                    collapsed.append(b" ".join((text or b"").split()))  # bytes: splits at ASCII white space
                    continue
                words = text.split()
                drop = np.zeros(len(words) + 1, np.int64)
                for r in lists[i]:
                    drop[r["start"] + r["period"]] += 1
                    drop[r["start"] + r["length"]] -= 1
                keep = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
                collapsed.append(b" ".join([words[k] for k in keep.tolist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(lists, _RUNS),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(
        arrow_map, runs, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                         "collapsed string")


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def with_periodic_tails(doc_id: Column, text: Column) -> Column:
    """The query's input: in a tenth of the documents (by checksum h of the id) the words from number a on repeat
    the p words that begin there."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[ \t\n\x0b\x0c\r]+"), lambda w: w != "")
    n = F.size(words).cast("long")

    def tail(w: Column) -> Column:
        size = F.size(w).cast("long")
        a = F.pmod(g, size)
        p = F.lit(1) + F.floor((size - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), size - 1), lambda i: F.element_at(
            w, (F.when(i < a, i).otherwise(a + F.pmod(i - a, p)) + 1).cast("int"))), " ")

    # the words are bound once by the one-element array
    tailed = F.element_at(F.transform(F.array(words), tail), 1)
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), tailed).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents with periodic tails: their number, the longest one, and digests of all runs and of the
    collapsed text. A document without an id has no checksum and keeps its words."""
    docs = load(spark, sf_dir, "documents").select("doc_id", with_periodic_tails(F.col("doc_id"), F.col("text"))
                                                   .alias("text"))
    found = periodic_runs(docs)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
