"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features per text: density and strength of lexicon words, second-person words
and how near they stand to lexicon words, capitals, punctuation, obfuscated
spellings. The lexicon has a fixed seed list and terms (words and word
beginnings) found in the training rows: a term enters if its documents are
toxic far more often than chance (log-likelihood ratio). Terms, trees and
calibration are fitted on separate parts of the training rows, at most
``MAX_TRAIN_ROWS`` in all; terms are counted on the executors and only
``LEXICON_SIZE`` of them and one dense row per training text reach the driver.

Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Boosted, fit_boosted, fit_isotonic
from .common import arrow_map, fold, load, text_chunks, word_codes, words_of
from .training import training_rows

MAX_TRAIN_ROWS = 8000
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
LEXICON_SIZE = 4000
PREFIXES = (3, 4, 5, 6)
LEAST_LLR = 14.0
STEM_WORDS = 4
LEAST_ODDS = {"w": 3.0, "p": 4.0}  # least log odds of a word and of a word beginning

# Seed insults and second-person words in four languages, written in lower case.
SEED = (
    "idiot", "idiots", "stupid", "moron", "morons", "loser", "losers", "scum", "trash", "pathetic", "worthless",
    "disgusting", "clown", "dumb", "fool", "jerk", "imbecile", "crétin", "débile", "abruti", "imbécile", "connard",
    "dumm", "dummkopf", "trottel", "blödmann", "vollidiot", "arschloch", "estúpido", "estúpida", "imbécil", "idiota",
    "tonto", "payaso",
)
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "du",
    "dich", "dir", "dein", "deine", "ihr", "euch", "tú", "ti", "tus", "usted", "ustedes", "vosotros",
)
# Characters that stand for letters in obfuscated spellings.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

EDGE = ".,;:!?()[]{}\"'"
NAMES = ("lexicon_density", "lexicon_strength", "lexicon_sum", "lexicon_hits", "lexicon_kinds", "seed_density",
         "second_density", "second_near", "capitals", "exclamations", "punctuation", "mixed", "obfuscated", "stretched",
         "length")
_STRETCHED = "|".join(chr(c) * 3 for c in range(ord("a"), ord("z") + 1))
_MIXED = r"\p{L}[0-9@$!*_.+-]+\p{L}|^[0-9@$!]+\p{L}+$"


def plain(word: str) -> str:
    """An obfuscated word in plain letters."""
    return re.sub(r"[^\w]|_", "", "".join(LOOKALIKES.get(c, c) for c in word))


@dataclass
class Lexicon:
    words: dict[str, float]
    prefixes: dict[str, float]

    def weights(self, core: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Strongest term of each word, and a number for the term (0: none)."""
        best, kind = np.zeros(len(core)), np.zeros(len(core), np.int64)
        length = pc.utf8_length(core).to_numpy(zero_copy_only=False)
        shift = 1
        for k in (None, *PREFIXES):
            table = self.words if k is None else {p: w for p, w in self.prefixes.items() if len(p) == k}
            if not table:
                continue
            terms = pa.array(list(table), pa.large_string())
            part = core if k is None else pc.utf8_slice_codeunits(core, 0, k)
            at = pc.fill_null(pc.index_in(part, value_set=terms), -1).to_numpy(zero_copy_only=False)
            w = np.where(at >= 0, np.array([*table.values(), 0.0])[at], 0.0)
            if k is not None:
                w[length <= k] = 0.0
            better = w > best
            best[better], kind[better] = w[better], shift + at[better]
            shift += len(table)
        return best, kind


def _cores(distinct: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGE)


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of ``NAMES`` per text; an empty or null text has zeros."""
    flat, offsets = words_of(texts)
    n = len(offsets) - 1
    if len(flat) == 0:
        return np.zeros((n, len(NAMES)))
    codes, distinct = word_codes(flat)
    core = _cores(distinct)
    weight, kind = lexicon.weights(core)
    mixed = pc.match_substring_regex(core, _MIXED).to_numpy(zero_copy_only=False)
    hidden = np.zeros(len(core))
    if mixed.any():
        some = np.flatnonzero(mixed)
        clear = pa.array([plain(core[i].as_py()) for i in some.tolist()], pa.large_string())
        seed = pc.is_in(clear, value_set=pa.array(SEED, pa.large_string())).to_numpy(zero_copy_only=False)
        hidden[some] = np.maximum(seed * 5.0, lexicon.weights(clear)[0])
    flags = np.stack([
        weight > 0,
        weight,
        pc.is_in(core, value_set=pa.array(SEED, pa.large_string())).to_numpy(zero_copy_only=False),
        pc.is_in(core, value_set=pa.array(SECOND_PERSON, pa.large_string())).to_numpy(zero_copy_only=False),
        pc.utf8_is_upper(distinct).to_numpy(zero_copy_only=False)
        & (pc.utf8_length(distinct).to_numpy(zero_copy_only=False) > 1),
        pc.count_substring(distinct, "!").to_numpy(zero_copy_only=False),
        pc.count_substring_regex(distinct, r"[^\p{L}\p{N}]").to_numpy(zero_copy_only=False),
        mixed,
        hidden > 0,
        pc.match_substring_regex(core, _STRETCHED).to_numpy(zero_copy_only=False),
    ], axis=1).astype(np.float32)
    size = np.diff(offsets)
    per = np.maximum(size, 1)[:, None]
    counts = np.empty((n, flags.shape[1]))
    for j in range(flags.shape[1]):
        total = np.concatenate(([0.0], np.cumsum(flags[codes, j], dtype=np.float64)))
        counts[:, j] = total[offsets[1:]] - total[offsets[:-1]]
    share = counts / per
    strength, kinds, near = np.zeros(n), np.zeros(n), np.zeros(n)
    hit = np.flatnonzero((weight[codes] > 0) | (hidden[codes] > 0))
    if len(hit):
        doc = np.searchsorted(offsets, hit, side="right") - 1
        strong = np.maximum(weight, hidden)[codes[hit]]
        np.maximum.at(strength, doc, strong)
        pairs = np.unique(doc * (int(kind.max()) + 1) + kind[codes[hit]])
        np.add.at(kinds, pairs // (int(kind.max()) + 1), 1)
        second = np.flatnonzero(flags[codes, 3] > 0)
        if len(second):
            for step in (0, -1):  # the nearest second-person word after and before each hit
                at = np.clip(np.searchsorted(second, hit) + step, 0, len(second) - 1)
                far = np.abs(second[at] - hit)
                same = (second[at] >= offsets[doc]) & (second[at] < offsets[doc + 1])
                np.maximum.at(near, doc[same], 1 / (1 + far[same]))
    return np.stack([
        share[:, 0], strength, share[:, 1], np.log1p(counts[:, 0]), kinds, share[:, 2], share[:, 3], near, share[:, 4],
        share[:, 5], share[:, 6], share[:, 7], share[:, 8], share[:, 9], np.log1p(size)], axis=1)


def terms_of(text: str | None) -> set[str]:
    """Words (marked w:) and word beginnings (marked p:) of a text."""
    out: set[str] = set()
    for word in set((text or "").lower().split()):
        core = word.strip(EDGE)
        if core and not any(c.isdigit() for c in core):
            out.add("w:" + core)
            out.update("p:" + core[:k] for k in PREFIXES if len(core) > k)
    return out


def choose_terms(counts: list[tuple[str, int, int]], toxic: int, clean: int, size: int = LEXICON_SIZE) -> Lexicon:
    """Terms whose documents are toxic more often than the share of toxic documents explains. A word beginning
    counts only if several words have it (else the word itself says enough). Ties by the term."""
    rate = toxic / max(toxic + clean, 1)
    chosen = []
    stems = Counter(t[2:2 + k] for t, _, _ in counts if t[0] == "w" for k in PREFIXES if len(t) > k + 2)
    for term, a, b in counts:
        if term[0] == "p" and stems[term[2:]] < STEM_WORDS:
            continue
        n = a + b
        if not 0 < rate < 1 or a / n <= min(3 * rate, (1 + rate) / 2):
            continue
        llr = a * math.log(a / (n * rate)) + (b * math.log(b / (n * (1 - rate))) if b else 0.0)
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if llr >= LEAST_LLR and odds >= LEAST_ODDS[term[0]]:
            chosen.append((llr, term, odds))
    chosen.sort(key=lambda x: (-x[0], x[1]))
    chosen = chosen[:size]
    return Lexicon({t[2:]: o for _, t, o in chosen if t[0] == "w"}, {t[2:]: o for _, t, o in chosen if t[0] == "p"})


@dataclass
class Model:
    lexicon: Lexicon
    trees: Boosted
    knots: np.ndarray
    shares: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        raw = self.trees.raw(features(texts, self.lexicon))
        # texts on a flat step of the calibration keep their order by a small part of the raw probability
        return 0.98 * np.interp(raw, self.knots, self.shares) + 0.02 / (1 + np.exp(-np.clip(raw, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, lexicon: Lexicon) -> Model:
    """Three of four rows fit the trees, the others the calibration. Without both classes in both parts the
    score is the share of label 1 (0 without rows) for every text."""
    cal = np.arange(len(y)) % 4 == 3
    if min((len(set(y[part].tolist())) for part in (cal, ~cal)), default=0) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(lexicon, Boosted(), np.array([0.0]), np.array([share]))
    trees = fit_boosted(x[~cal], y[~cal])
    knots, shares = fit_isotonic(trees.raw(x[cal]), y[cal], prior=10.0)
    return Model(lexicon, trees, knots, shares)


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN_ROWS) -> Model:
    rows = training_rows(docs, labels, "toxic", FOLDS, HELD, limit)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))  # 0-5: terms, 6-9: trees and calibration
    # copies of a text say nothing new about its words
    for_terms = rows.filter(part < 6).groupBy("text").agg(F.max("label").alias("label"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        sizes = [0, 0]
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found[label].update(terms_of(text))
                sizes[label] += 1
        found[0]["#rows"], found[1]["#rows"] = sizes
        terms = sorted(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([found[1][t] for t in terms], pa.int64()),
             pa.array([found[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"])

    counts = for_terms.transform(arrow_map, counted, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # a term needs this many toxic documents to pass the ratio test at any rate of at least 1 %
    counts = counts.filter((F.col("term") == "#rows") | (F.col("toxic") >= 4)
                           & (F.col("toxic") > F.col("clean"))).collect()
    sizes = next(((r["toxic"], r["clean"]) for r in counts if r["term"] == "#rows"), (0, 0))
    lexicon = choose_terms([(r["term"], r["toxic"], r["clean"]) for r in counts if r["term"] != "#rows"], *sizes)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            x = features(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "label", "x"])

    found = rows.filter(part >= 6).select("doc_id", "text", "label").transform(
        arrow_map, dense, "doc_id long, label int, x array<double>").collect()
    found.sort(key=lambda r: r["doc_id"])
    found = [found[i] for i in np.random.default_rng(13).permutation(len(found)).tolist()]
    x = np.array([r["x"] for r in found]).reshape(len(found), len(NAMES))
    return fit(x, np.array([r["label"] for r in found], dtype=np.int64), lexicon)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Empty and null texts get the score of a
    text without words; a null doc_id is not held out. Repeated rows give repeated results; other columns of
    ``docs`` are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            s = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold("doc_id", FOLDS) == HELD, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").transform(
        arrow_map, scored, "doc_id long, held_out boolean, score double, predicted int")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score(docs, train(docs, load(spark, sf_dir, "labels")))
