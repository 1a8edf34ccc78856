"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np

from strata.llm.common import load
from strata.llm.runs import find_runs, lyndon_array, op11_runs, periodic_runs

from .conftest import ODD_TEXTS


def brute_runs(w, least=12):
    """Maximal repetitions by trying every period at every place."""
    out = {}
    n = len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_lyndon(ranks):
    out = []
    for i in range(len(ranks)):
        best = 1
        for j in range(i + 1, len(ranks) + 1):
            u = ranks[i:j]
            if 0 not in u and all(u < u[k:] for k in range(1, len(u))):
                best = j - i
        out.append(best)
    return out


def test_lyndon_arrays():
    rnd = random.Random(5)
    for _ in range(600):
        letters = rnd.randint(1, 4)
        seq = [rnd.randint(0, letters) for _ in range(rnd.randint(0, 24))]
        used = sorted(set(seq) | {0})
        ranks = [used.index(x) for x in seq]
        assert lyndon_array(ranks) == brute_lyndon(ranks), ranks


def _texts(rnd):
    for _ in range(400):
        words = [rnd.randint(0, rnd.choice([1, 2, 3, 8, 30])) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):  # plant repetitions, some broken by one word
            root = [rnd.randint(0, 5) for _ in range(rnd.randint(1, 9))]
            stretch = (root * 6)[:rnd.randint(1, len(root) * 6)]
            if rnd.random() < 0.3:
                stretch[rnd.randrange(len(stretch))] = 99
            at = rnd.randint(0, len(words))
            words[at:at] = stretch
        yield words


def test_runs_match_brute_force():
    texts = list(_texts(random.Random(6)))
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    found = find_runs(np.array([x for t in texts for x in t], np.int64), offsets)
    got = {}
    for text, start, length, period in found.tolist():
        got.setdefault(text, []).append((start, length, period))
    for i, t in enumerate(texts):
        assert got.get(i, []) == brute_runs(t), t


def test_one_word_and_fibonacci_words():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    for w in (fib[-1], [7] * 5000, list(range(500)) * 2, []):
        found = find_runs(np.array(w, np.int64), np.array([0, len(w)], np.int64))
        want = [(0, 5000, 1)] if len(w) == 5000 else brute_runs(w)
        assert [tuple(r[1:]) for r in found.tolist()] == want


def expected(doc_id, text):
    """The query's row by the contract's words."""
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_brute_force(spark, sf_small, tmp_path):
    short = load(spark, sf_small, "documents").filter("length(text) < 6000")
    rows = [(r["doc_id"], r["text"]) for r in short.select("doc_id", "text").collect()]
    rows += [(10_000 + i, " ".join(f"w{x}" for x in t)) for i, t in enumerate(_texts(random.Random(8)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op11_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and sum(v[0] for v in got.values()) > 100
    for doc_id, text in rows:
        assert got[doc_id] == expected(doc_id, text), doc_id


def test_odd_and_no_documents(spark, odd_docs, no_docs, tmp_path):
    assert periodic_runs(no_docs).collect() == []
    rows = periodic_runs(odd_docs).collect()
    assert len(rows) == len(ODD_TEXTS)
    long = next(r for r in rows if r["doc_id"] == 5)
    assert long["n_words"] == 30_000 and [tuple(x) for x in long["runs"]] == [(0, 30_000, 10)]
    assert long["collapsed"] == "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r[c] for c in COLUMNS) for r in op11_runs(spark, str(tmp_path)).collect()
                 if r["doc_id"] != 5)
    want = sorted(expected(i, t) for i, t in ODD_TEXTS if i != 5)
    assert sorted(map(str, got)) == sorted(map(str, want))
