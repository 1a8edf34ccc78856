"""License scan: exact set-similarity containment join of text blocks and license templates (native).

Base: places in a document's word sequence where the words of a phrase stand
consecutively. Method: a template is a set of words; a block is a run of words,
across line ends, a quarter longer than the template's sentence. A block carries
the template's label if it holds all of the template's words (``CONTAINMENT_PCT``
per cent of them for sentences of ``LONG`` different words or more), the words
that name the license among them, and none of the words that would name another
one. The join is exact and works inside each row, against the templates as
literals, so nothing is shuffled:

* words are ordered by the number of documents that hold them, rarest first
  (every word of the templates, as a whole word, counted over all documents;
  ties by the word);
* the words of every document are taken, and phrases are looked for in all;
* a block is looked at where it begins with a word of the template, and where
  it ends right before a word that the template bans: every other block holds
  no more words of the template than one of these;
* length filter: it has at least as many places with words of the template as
  the overlap ``a`` that is asked for;
* positional filter: a block that begins at such a place can only reach ``a`` if
  the place ``a - 1`` further on in that list still lies inside the block;
* prefix filter: a block that reaches ``a`` of ``m`` words shares one of the
  template's first ``m - a + 1``, and so does its document;
* the overlap of what remains is counted exactly.

The templates are a parameter given as a Python tuple (a table of fixed size),
so the plan and the word counts that reach the driver (one per distinct template
word) do not grow with the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load
from .quality_rules import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"  # no other letters are lower-cased
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())  # ASCII that is in no word
CONTAINMENT_PCT = 80

# Base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
LONG = 12
# Label, words of a characteristic sentence of the license or of its usual notice, words that name
# the license (asked for in any case), words that name another one (must not be in the block).
TEMPLATES = (
    ("mit", "released under the mit license", "mit license", ""),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction",
     "permission hereby granted charge software", ""),
    ("apache-2", "licensed under the apache license version 2 0", "apache license", ""),
    ("gpl", "this work is licensed under the gnu general public license version", "gnu general public license",
     "lesser library affero"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation", "gnu general public license",
     "lesser library affero"),
    ("lgpl", "licensed under the gnu lesser general public license version", "gnu lesser general public license", ""),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license", ""),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", "redistribution source binary permitted conditions", ""),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", "permission purpose fee hereby granted", ""),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", "sa nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa", "nc nd"),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", "creative commons attribution",
     "noncommercial sharealike noderivatives noderivs"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work",
     "waived copyright related rights", ""),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered public domain", ""),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]  # distinct, rarest first
    least: int  # words that a block must hold
    needed: tuple[str, ...]  # words that it must hold in any case, rarest first
    banned: tuple[str, ...]
    width: int  # words of a block

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[:len(self.words) - self.least + 1]


def compiled(templates, documents_with: dict[str, int]) -> list[Template]:
    """Templates with their words in global order (words without a count last)."""
    def ordered(ws) -> tuple[str, ...]:
        return tuple(sorted(set(ws), key=lambda w: (w not in documents_with, documents_with.get(w, 0), w)))

    out = []
    for label, sentence, named, banned in templates:
        ws = ordered(sentence.split())
        least = -(-len(ws) * CONTAINMENT_PCT // 100) if len(ws) >= LONG else len(ws)
        size = len(sentence.split())
        out.append(Template(label, ws, least, ordered(named.split()) if least < len(ws) else ws,
                            tuple(banned.split()), size + -(-size // 4)))
    return out


def spaced(text: Column) -> Column:
    """The words in lower case, each between spaces; null: no words."""
    apart = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.concat(F.lit(" "), apart, F.lit(" "))


def words_of(apart: Column) -> Column:
    return F.array_remove(F.split(apart, " "), "")


def holds(apart: Column, word: str) -> Column:
    return F.contains(apart, F.lit(f" {word} "))


def word_order(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents that hold each word of the (fixed) vocabulary."""
    apart = docs.select(spaced(F.col("text")).alias("apart"))
    return apart.agg(*[F.count_if(holds(F.col("apart"), w)).alias(w) for w in vocabulary]).first().asDict()


def _phrase_places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    at = F.sequence(F.lit(0), F.size(words) - len(parts))
    return F.when(F.size(words) >= len(parts), F.filter(at, lambda i: _all(
        F.get(words, i + j) == p for j, p in enumerate(parts)))).otherwise(F.array().cast("array<int>"))


def _all(conds) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def _containment(words: Column, t: Template) -> Column:
    """Largest share of the template's words in a block that meets the threshold (null: there is none)."""
    own = F.array(*[F.lit(w) for w in t.words])
    at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(own, F.get(words, i)))

    def share(block: Column) -> Column:
        good = F.arrays_overlap(block, F.array(*[F.lit(w) for w in t.prefix]))
        for w in t.needed:
            good = good & F.array_contains(block, F.lit(w))
        for w in t.banned:
            good = good & ~F.array_contains(block, F.lit(w))
        overlap = F.size(F.array_intersect(own, block))
        return F.when(good, F.when(overlap >= t.least, overlap / F.lit(len(t.words))))

    def blocks(places: Column) -> Column:
        inside = F.filter(F.sequence(F.lit(0), F.size(places) - t.least), lambda j: F.get(
            places, j + (t.least - 1)) - F.get(places, j) < t.width)
        shares = F.transform(inside, lambda j: share(F.slice(words, F.get(places, j) + 1, t.width)))
        if not t.banned:
            return shares
        # a block moved on to its first own word holds as many of them, unless it meets a banned word on the way
        ends = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (i >= t.width) & F.array_contains(
            F.array(*[F.lit(w) for w in t.banned]), F.get(words, i)))
        return F.concat(shares, F.transform(ends, lambda i: share(F.slice(words, i - t.width + 1, t.width))))

    return F.array_max(let(at, lambda places: F.when(F.size(places) >= t.least, blocks(places))))


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    ``score`` is the largest containment of any template that a block reaches
    (1 where a base phrase stands, 0 without labels). Empty or null
    texts: no words, no labels, score 0. Repeated rows give repeated results;
    other columns of ``docs`` are ignored."""
    vocabulary = sorted({w for _, sentence, _, _ in templates for w in sentence.split()})
    sets = compiled(templates, word_order(docs, vocabulary))
    docs = docs.select("doc_id", spaced(F.col("text")).alias("apart"))
    docs = docs.select("doc_id", "apart", words_of(F.col("apart")).alias("words"))
    words = F.col("words")

    def shares_prefix(t: Template) -> Column:
        out = F.lit(False)
        for w in t.prefix:
            out = out | holds(F.col("apart"), w)
        return out

    places = [_phrase_places(words, p).alias(f"p{i}") for i, p in enumerate(PHRASES)]
    shares = [F.when(shares_prefix(t), _containment(words, t)).alias(f"t{i}") for i, t in enumerate(sets)]
    rows = docs.select("doc_id", F.size(words).cast("long").alias("n_words"), F.struct(*places, *shares).alias("f"))
    every = F.concat(*[F.col(f"f.p{i}") for i in range(len(PHRASES))])
    base = [F.when(F.size(f"f.p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]
    own = [F.when(F.col(f"f.t{i}").isNotNull(), F.lit(t.label)) for i, t in enumerate(sets)]
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")
    n_base = F.size(every).cast("long")
    return rows.select(
        "doc_id", "n_words", n_base.alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), listed(base).alias("base_labels"),
        listed(base + own).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce(F.greatest(*[F.col(f"f.t{i}") for i in range(len(sets))]),
                                                            F.lit(0.0))).alias("score"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(load(spark, sf_dir, "documents"))


def _sql() -> str:
    """The definition: every block of every template, without filters (but that a block's words are in the text)."""
    def listed(ws) -> str:
        return "[" + ", ".join(f"'{w}'" for w in ws) + "]::VARCHAR[]"

    phrases = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
    sets = ", ".join(f"('{t.label}', {listed(t.words)}, {t.least}, {listed(t.needed)}, {listed(t.banned)}, {t.width})"
                     for t in compiled(TEMPLATES, {}))
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {low} AS text FROM documents),
seq AS (SELECT rid, doc_id, regexp_extract_all(text, '{word}') AS ws FROM d),
places AS (
  SELECT rid, p.label, s.i FROM seq, (VALUES {phrases}) AS p(phrase, label),
    LATERAL (SELECT unnest(range(len(ws))) AS i) s
  WHERE array_to_string(ws[s.i + 1:s.i + len(string_split(p.phrase, ' '))], ' ') = p.phrase),
base AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY rid),
blocks AS (
  SELECT rid, t.*, ws[s.i + 1:s.i + t.width] AS b
  FROM seq, (VALUES {sets}) AS t(label, words, least, needed, banned, width),
    LATERAL (SELECT unnest(range(len(ws))) AS i) s
  WHERE list_has_all(ws, t.needed)),
shares AS (SELECT rid, label, len(list_intersect(list_distinct(b), words)) AS o, len(words) AS m, least FROM blocks
           WHERE list_has_all(b, needed) AND NOT list_has_any(b, banned)),
own AS (SELECT rid, list(DISTINCT label) AS labels, max(CAST(o AS DOUBLE) / m) AS part FROM shares
        WHERE o >= least GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(part, 0) END AS score
FROM seq LEFT JOIN base USING (rid) LEFT JOIN own USING (rid)
"""


SQL = _sql()
