"""Substring dedup and its FM-index against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from strata.llm import substring_dedup
from strata.llm.common import load
from strata.llm.fm_index import NO_OWNER, FMIndex, WaveletMatrix
from strata.llm.substring_dedup import _gram_hashes, _sliding_min, dedup, op13_substring_dedup

from .conftest import ODD_TEXTS


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept) of each row."""
    least = {}
    for d, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[i:i + window])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, text in rows:
        w = words(text)
        drop = set()
        for i in range(len(w) - window + 1 if d is not None else 0):
            if least[tuple(w[i:i + window])] < d:
                drop.update(range(i, i + window))
        out.append((d, len(w), len(drop), " ".join(x for i, x in enumerate(w) if i not in drop)))
    return out


def result(df):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()]


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    for n, symbols in ((1, 1), (64, 2), (200, 7), (1000, 300)):
        seq = rng.integers(0, symbols, n)
        matrix = WaveletMatrix(seq, symbols)
        at, symbol = rng.integers(0, n + 1, 500), rng.integers(0, symbols, 500)
        assert matrix.rank(symbol, at).tolist() == [int((seq[:a] == s).sum()) for a, s in zip(at, symbol, strict=True)]


def test_hashes_of_grams_and_sliding_minima():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2 ** 63, 90).astype(np.uint64)
    h[50:] = h[10:50]
    for k in (1, 2, 3, 7, 16, 33, 50):
        g = _gram_hashes(h, k)
        assert len(g) == 91 - k and (k > 40 or (g[50:91 - k] == g[10:51 - k]).all())
        assert len(set(g.tolist())) == len({tuple(h[i:i + k].tolist()) for i in range(len(g))})
    for width in (1, 2, 5, 35):
        assert _sliding_min(h, width).tolist() == [h[i:i + width].min() for i in range(91 - width)]
    assert len(_gram_hashes(h[:3], 50)) == 0


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 8])
def test_index_finds_the_smallest_owner(depth):
    rnd = random.Random(depth)
    for _ in range(60):
        letters = rnd.randint(1, 5)
        passages = [[rnd.randint(1, letters) for _ in range(rnd.randint(1, 30))] for _ in range(rnd.randint(1, 8))]
        owners = [rnd.randint(0, 20) for _ in passages]
        seq = np.array([x for p in passages for x in [*p, 0]], np.int64)
        owner = np.repeat(owners, [len(p) + 1 for p in passages]).astype(np.int64)
        index = FMIndex(seq, owner, depth)
        pieces = [[rnd.randint(0, letters) for _ in range(rnd.randint(0, 25))] for _ in range(6)]
        pieces.append(passages[0])
        ends = np.cumsum([len(p) for p in pieces])
        query = np.array([x for p in pieces for x in p], np.int64)
        got = index.least_owner(query, ends - [len(p) for p in pieces], ends)
        want = []
        for p in pieces:
            for i in range(len(p)):
                hits = [o for q, o in zip(passages, owners, strict=True) if i + depth <= len(p)
                        and any(q[j:j + depth] == p[i:i + depth] for j in range(len(q) - depth + 1))]
                want.append(min(hits, default=NO_OWNER))
        assert got.tolist() == want


def _corpus(rnd, n, letters):
    """Texts with copied, reordered and edited passages."""
    texts = []
    for _ in range(n):
        w = [f"w{rnd.randrange(letters)}" for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            if texts:
                source = rnd.choice(texts[-20:] + texts[:3])
                a = rnd.randint(0, len(source))
                copy = source[a:a + rnd.randint(1, 50)]
                if copy and rnd.random() < 0.4:
                    copy[rnd.randrange(len(copy))] = "edit"
                at = rnd.randint(0, len(w))
                w[at:at] = copy
        texts.append(w)
    return texts


@pytest.mark.parametrize(("window", "letters"), [(3, 4), (8, 3), (12, 1000)])
def test_small_shards_and_shares(spark, monkeypatch, window, letters):
    """Many shards, shares and pieces, hot seeds and one very common passage."""
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 300)
    monkeypatch.setattr(substring_dedup, "STREAM_WORDS", 500)
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", 200)
    monkeypatch.setattr(substring_dedup, "PIECE", 7)
    monkeypatch.setattr(substring_dedup, "HEAVY", 30)
    rnd = random.Random(window)
    rows = [(rnd.randint(-40, 400), " ".join(t)) for t in _corpus(rnd, 260, letters)]
    rows += [(500 + i, f"a{i} b{i} " + " ".join(f"common{j}" for j in range(window + 2)) + f" c{i}")
             for i in range(90)]
    rows += rows[:10]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, window)
    assert sum(r[2] for r in want) > 1000
    assert sorted(result(dedup(df, window))) == sorted(want)


def test_query_matches_brute_force(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, sf_small, "documents").collect()]
    want = {d: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute(rows, 50)}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in op13_substring_dedup(spark, sf_small).collect()}
    assert got == want and sum(g[1] > 0 for g in got.values()) > 3


def test_odd_and_no_documents(spark, odd_docs, no_docs):
    assert dedup(no_docs).collect() == []
    for window in (50, 4):
        got = result(dedup(odd_docs, window))
        assert sorted(map(str, got)) == sorted(map(str, brute(ODD_TEXTS, window)))
    same = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x a b c d e"), (None, "a b c d e f"), (2, None),
            (3, "a b c d e"), (-5, "e f g h")]
    got = result(dedup(spark.createDataFrame(same, "doc_id long, text string"), 4))
    assert sorted(map(str, got)) == sorted(map(str, brute(same, 4)))
