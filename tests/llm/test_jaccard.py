"""Jaccard join and components against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import jaccard_join
from strata.llm.common import load
from strata.llm.components import components

from .conftest import by_id

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k, pct):
    """doc_id -> (set size, smallest linked id)."""
    sets, lists = {}, defaultdict(list)
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[d] = frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in sorted(sets):
        s = sets[d]
        for x, common in Counter(x for g in s for x in lists[g]).items():
            if 100 * common >= pct * (len(s) + len(sets[x]) - common):
                a, b = sorted((find(x), find(d)))
                root[b] = a
        for g in s:
            lists[g].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def brute_links(rows, k, pct):
    """doc_id -> number of other documents it links to."""
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[d] = frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    out = dict.fromkeys(sets, 0)
    ids = [d for d in sets if sets[d]]
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= pct * (len(sets[a]) + len(sets[b]) - common):
                out[a] += 1
                out[b] += 1
    return out


def _near_copies(seed, count, length):
    """Copies of one text with more and more words replaced, and some of their exact copies."""
    rnd = random.Random(seed)
    words = [f"w{seed}x{i}" for i in range(length)]
    out = []
    for i in range(count):
        w = list(words)
        for _ in range(rnd.randint(0, max(1, length // 25))):
            w[rnd.randrange(length)] = f"e{seed}x{i}x{rnd.randrange(9)}"
        if i % 7 == 3:
            w = w[:length - rnd.randrange(length // 8)]
        out.append(" ".join(w))
        if i % 5 == 0:
            out.append(out[-1].upper())
    return out


@pytest.mark.parametrize("k,pct", [(4, 85), (5, 80)])
def test_matches_brute_force(spark, sf_small, k, pct):
    docs = load(spark, sf_small, "documents").select("doc_id", "text")
    result, rows = jaccard_join.join(docs, k, pct).collect(), [tuple(r) for r in docs.collect()]
    assert {r[0]: (r[1], r[2]) for r in result} == brute(rows, k, pct)
    assert {r["doc_id"]: r["n_links"] for r in result} == brute_links(rows, k, pct)


def test_long_lists_match_brute_force(spark, monkeypatch):
    """Short lists of at most 4 and blocks of 6, so that groups of copies go through the block join."""
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 6)
    texts = [t for seed in range(3) for t in _near_copies(seed, 40, 60 + 30 * seed)]
    random.Random(5).shuffle(texts)
    rows = list(enumerate(texts))
    want = brute(rows, 4, 85)
    assert len({c for _, c in want.values()}) > 5  # some copies are too different to link
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_join.join(df).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == want
    links = brute_links(rows, 4, 85)
    assert {r["doc_id"]: r["n_links"] for r in got} == links and sum(links.values()) > 500
    plain = jaccard_join.join(df, count_links=False)
    assert {r[0]: (r[1], r[2]) for r in plain.collect()} == want and "n_links" not in plain.columns


def test_block_overlaps_are_derived_exactly():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 60, 80, dtype=np.uint64)
    sets = [np.unique(np.concatenate((rnd.permutation(base)[:70 + i % 9], rnd.integers(0, 1 << 60, i % 13, dtype=np.uint64))))
            for i in range(30)]
    for s, row in zip(sets, jaccard_join.overlaps(sets, sets), strict=True):
        assert row.tolist() == [len(np.intersect1d(s, o)) for o in sets]


def test_odd_documents(odd_docs, no_docs):
    rows = by_id(jaccard_join.join(odd_docs), "doc_id", "n_shingles", "component_id")
    got = {r[0]: r[1:] for r in rows}
    assert len(rows) == odd_docs.count()
    assert got[1] == got[2] == (11, 1)
    assert rows.count((2, 11, 1)) == 2
    assert got[3] == (0, 3) and got[4] == (0, 4) and got[13] == (0, 13) and got[6] == (0, 6)
    assert got[5] == (10, 5) and got[9] == (1, 9)
    assert got[7] == (1, 7) and got[8] == (1, 7)  # "one two": a vertical tab parts words as a space does
    assert got[None][1] is None
    assert jaccard_join.join(no_docs).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    a, b = _near_copies(8, 1, 50)[0], _near_copies(9, 1, 50)[0]
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (7, b)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard_join.join(df).collect()} == {1}


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 200)] \
        + [(rnd.randrange(1000, 1300), rnd.randrange(1000, 1300)) for _ in range(250)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each_group(spark, sf_small):
    docs = load(spark, sf_small, "documents")
    kept = jaccard_join.near_duplicate_stage(spark, docs, sf_small)
    assert kept.columns == docs.columns
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_stage_on_odd_documents(spark, odd_docs, no_docs):
    kept = jaccard_join.near_duplicate_stage(spark, odd_docs, "").collect()
    ids = [r["doc_id"] for r in kept]
    # 2 goes with 1 and 8 with 7; rows without an id or a word stay
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13]
    assert None in ids and len(ids) == len(set(ids))
    assert jaccard_join.near_duplicate_stage(spark, no_docs, "").count() == 0


def test_stage_keeps_one_row_of_each_group_of_texts(spark):
    a, b, c = (_near_copies(seed, 1, 50)[0] for seed in (11, 12, 13))
    rows = [(1, a), (5, a), (5, b), (7, b), (7, b), (None, c), (None, c), (None, c.upper()), (None, b), (3, ""),
            (None, None), (None, a + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = by_id(jaccard_join.near_duplicate_stage(spark, df, ""), "doc_id", "text")
    assert [r for r in kept if not r[1]] == [(None, None), (3, "")]
    kept = [r for r in kept if r[1]]
    assert (1, a) in kept and (5, b) in kept and len(kept) == 3
    assert [(d, t.lower()) for d, t in kept if d is None] == [(None, c)]
