"""Quality rules, license scan, sharding and URL filter on small fixtures."""

import random
import re
import struct
import zlib

import duckdb
import pytest
import xxhash

from strata.llm import license_scan, quality_rules, sharding, url_filter
from strata.llm.common import load

from .conftest import by_id


# ---------------------------------------------------------------- quality rules
def _measures(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = {i + j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(marked)


def test_measures_match_brute_force(spark):
    texts = [None, "", "a b c d e a b c d e", "a a a a a a", "# $x |y <z> é日", "a b c d e f a b c d e f a b c d",
             "w1 w2 w3 w4 w5 w6 " * 9, "l1 x\nl1 x\n\n \nl1 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(quality_rules.judge(df), "doc_id", "n_words", "word_chars", "n_symbols", "n_repeat_words")
    assert got == [(i, *_measures(t)) for i, t in enumerate(texts)]
    assert by_id(quality_rules.judge(df), "doc_id", "n_dup_lines")[-1] == (7, 2)


def test_rules_projection_has_no_python_and_no_shuffle(spark, sf_small):
    df = quality_rules.judge(load(spark, sf_small, "documents"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_documents(odd_docs, no_docs):
    rows = {(r["doc_id"], r["n_words"], r["kept"]) for r in quality_rules.judge(odd_docs).collect()}
    assert (3, 0, False) in rows and (4, 0, False) in rows and (5, 30_000, False) in rows
    assert quality_rules.judge(odd_docs).count() == odd_docs.count()
    assert quality_rules.judge(no_docs).count() == 0


# ---------------------------------------------------------------- license scan
def test_license_labels(odd_docs, no_docs):
    got = {r["doc_id"]: r for r in license_scan.scan(odd_docs).collect()}
    r = got[12]
    assert r["n_base"] == 3 and r["base_labels"] == "apache-2,cc-by-nc,mit" and r["score"] == 1.0
    assert (r["first_word"], r["last_word"]) == (1, 10)
    assert got[4]["n_words"] == 0 and got[4]["labels"] == "" and got[4]["first_word"] is None
    assert license_scan.scan(odd_docs).count() == odd_docs.count()
    assert license_scan.scan(no_docs).count() == 0


def test_blocks_that_end_before_a_banned_word(spark):
    """Compared with the definition (every block): a template right before another license's word is found if words
    that are not its own stand before it."""
    gpl = "this work is licensed under the gnu general public license version"
    texts = [f"x x x {gpl} lesser", f"x x {gpl} lesser", f"{gpl} x x x lesser", f"lesser {gpl} x x x library",
             f"lesser x x x {gpl} affero x", "x licensed under cc by nc 4 0 nd", "sa licensed under cc by nc 4 0 x x nd",
             "x x licensed under cc by nc 4 0 sa"]
    draw = random.Random(5)
    for _ in range(300):
        label, sentence, _, banned = draw.choice([t for t in license_scan.TEMPLATES if t[3]])
        words = sentence.split()
        for _ in range(draw.randint(0, 6)):
            words.insert(draw.choice([0, len(words), draw.randint(0, len(words))]), draw.choice(["x", *banned.split()]))
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    names = ("doc_id", "labels", "score")
    got = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")), *names)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({license_scan.SQL})").fetchall())
    assert "gpl" in got[0][1].split(",") and "gpl" not in got[1][1].split(",")
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want])


def _labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(df).collect()}
    return [got[i] for i in range(len(texts))]


BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that " \
      "the following conditions are met"
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated " \
      "documentation files (the \"Software\"), to deal\nin the Software without restriction, including"


def test_containment_threshold_is_exact(spark):
    bsd = next(t for t in license_scan.compiled(license_scan.TEMPLATES, {}) if t.label == "bsd")
    spare = [w for w in bsd.words if w not in bsd.needed]
    keep = len(bsd.words) - bsd.least  # words that may be missing
    most = [*bsd.needed, *spare[keep:]]
    texts = [" ".join(most), " ".join(most[:-1]), "\n".join(reversed(most)) + " more words",
             " ".join([*bsd.needed[1:], *spare]),                       # a naming word is missing
             " ".join(most[:3] + ["x"] * bsd.width + most[3:])]          # not in one block
    assert len(most) == bsd.least and _labels(spark, texts) == ["bsd", "", "bsd", "", ""]


def test_licenses_are_told_apart(spark):
    texts = ["This work is licensed under the GNU General Public License, version 3.",
             "Licensed under the GNU Lesser General Public License, version 2.1",
             "This work is licensed under the GNU Lesser General Public License, version 3.",
             "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC-SA 4.0.",
             "released under the license", MIT, "Released\nunder the MIT\nLicense", BSD.replace(" ", "\n"),
             "Licensed under the Creative Commons Attribution 4.0 International License",
             "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License",
             "success once more by the license of the committee, licensed under 40 terms"]
    assert _labels(spark, texts) == ["gpl", "lgpl", "lgpl", "cc-by-nc", "cc-by-sa", "cc-by-nc", "", "mit", "mit", "bsd",
                                     "cc-by", "", ""]


def test_every_template_word_is_counted_as_a_whole_word(spark, monkeypatch):
    texts = ["permit nothing, committee", "MIT\x00License", "mit; accept by-law", None, "", "cc\u00e9 CC", "the\tthe the"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = {}
    count = license_scan.word_order
    monkeypatch.setattr(license_scan, "word_order", lambda docs, vocabulary: seen.setdefault("n", count(docs, vocabulary)))
    rows = license_scan.scan(df).collect()
    assert set(seen["n"]) == {w for t in license_scan.TEMPLATES for w in t[1].split()}
    words = [set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())) for t in texts]
    assert seen["n"] == {w: sum(w in ws for ws in words) for w in seen["n"]}
    assert (seen["n"]["mit"], seen["n"]["cc"], seen["n"]["the"], seen["n"]["license"]) == (2, 1, 1, 1)
    assert {r["doc_id"]: r["n_words"] for r in rows} == {0: 3, 1: 2, 2: 4, 3: 0, 4: 0, 5: 2, 6: 3}


def test_documents_near_a_template_match_the_definition(spark):
    """Every document takes part, also one that lacks a word: compared with the definition (every block)."""
    draw = random.Random(9)
    texts = []
    for label, sentence, _, banned in license_scan.TEMPLATES * 12:
        words = sentence.split()
        for _ in range(draw.randint(0, 5)):
            at = draw.randrange(len(words))
            draw.choice([lambda: words.pop(at), lambda: words.insert(at, draw.choice(["x", "mitten", *banned.split()])),
                         lambda: words.__setitem__(at, words[at].upper() + "s" * draw.randint(0, 1))])()
        texts.append(draw.choice([" ", "\n", "; ", "\x00"]).join(words))
    rows = list(enumerate(texts))
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    got = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")), *names)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({license_scan.SQL})").fetchall())
    assert got == want and 20 < sum(r[-1] != "" for r in got) < len(got) - 20


# ---------------------------------------------------------------- sharding
def _shard(doc_id, n):
    """Rendezvous by Spark's xxhash64 of (long, int), equal weights: the largest hash fraction wins."""
    def h(i):
        seed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
        return xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed) >> 11
    return max(range(n), key=lambda i: (h(i), -i))


def test_sharding_matches_brute_force(spark, sf_small):
    docs = load(spark, sf_small, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = sharding.assign(docs).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["shard"] == _shard(r["doc_id"], 24) and r["grown_shard"] == _shard(r["doc_id"], 25)
        assert r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_weights_and_odd_rows(spark, odd_docs, no_docs):
    ids = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text")
    counts = {r["shard"]: r["count"] for r in sharding.assign(ids, weights=[1, 2, 1]).groupBy("shard").count().collect()}
    assert abs(counts[1] / 20_000 - 0.5) < 0.02 and abs(counts[0] / 20_000 - 0.25) < 0.02
    rows = sharding.assign(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(8, 0)}
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.assign(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(odd_docs, weights=[1, 0])


def test_rows_without_an_id_are_numbered_in_many_buckets(spark):
    """Texts of one id run through the buckets: neighbours in (size, checksum) do not get neighbouring slots."""
    docs = spark.range(2000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CONCAT('text ', id) AS text")
    rows = sharding.assign(docs).collect()
    assert len({r["shard"] for r in rows}) == 1 and sorted(r["slot"] for r in rows) == list(range(2000))
    by_slot = [(r["size"], r["text_crc32"]) for r in sorted(rows, key=lambda r: r["slot"])]
    falls = sum(a > b for a, b in zip(by_slot[:-1], by_slot[1:], strict=True))
    assert falls > 200  # one bucket is sorted throughout: no fall


# ---------------------------------------------------------------- URL filter
URLS = [
    (1, "http://WWW.Example.com/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (2, "https://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
    (3, "https://a.b.example.com/en/1/2/3", "a.b.example.com", "/en/1/2/3", "example.com/en/", "block"),
    (4, "https://example.com/en", "example.com", "/en", "com/", "allow"),
    (5, "https://x.net/es/?q", "x.net", "/es/", "net/es/", "block"),
    (6, "https://x.net/de/", "x.net", "/de/", None, "allow"),
    (7, "https://spam-farm.example.org/a", "spam-farm.example.org", "/a", None, "block"),
    (8, "https://notspam-farm.example.org/a", "notspam-farm.example.org", "/a", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "no scheme.com/", "", "", None, "allow"),
    (11, "x://", "", "", None, "allow"),
    (12, "http://example.com", "example.com", "", None, "allow"),
    (13, "http://mycom/", "mycom", "/", None, "allow"),
    (14, "http://com/", "com", "/", "com/", "allow"),
    (15, "http://É.COM:80/en/", "É.com:80", "/en/", None, "allow"),
    (2, "https://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
    (16, "http://a.com/" + "d/" * 5000, "a.com", "/" + "d/" * 5000, "com/", "allow"),
    (17, "http://" + "s." * 3000 + "com/q", "s." * 3000 + "com", "/q", "com/", "allow"),
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(u[0], u[1], "x", "y") for u in URLS], "page_id long, url string, prefix string, rid string")
    got = by_id(url_filter.judge(pages), "page_id", "host", "path", "rule", "verdict")
    assert sorted(got, key=repr) == sorted(
        ((u[0], *u[2:]) for u in URLS), key=repr)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_bad_rules_are_refused(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    for rule in (url_filter.Rule("deny", "a.com/"), url_filter.Rule("allow", "a.com"), url_filter.Rule("allow", "A.com/")):
        with pytest.raises(ValueError):
            url_filter.judge(pages, [rule])
    assert url_filter.judge(pages, []).first()["verdict"] == "allow"
