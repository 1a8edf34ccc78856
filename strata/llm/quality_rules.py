"""Quality rules: one threshold table compiled into one projection (native).

``RULES`` lists ratios with their bounds. ``compile_rules`` turns the table
into one boolean expression per rule over the measures of ``measures``; no
rule runs user code and no row is shuffled. Every measure is an integer and
every ratio is compared as integers, so the verdict has no rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5

# Frequent function words of four languages, written in lower case.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "it", "that", "for", "on", "with", "as", "by", "are", "was", "this",
           "at", "be", "from", "or", "an", "a"),
    "fr": ("le", "la", "les", "de", "des", "du", "et", "un", "une", "en", "que", "qui", "dans", "pour", "par", "sur",
           "au", "est"),
    "de": ("der", "die", "das", "und", "in", "zu", "den", "dem", "nicht", "von", "sie", "ist", "sich", "mit", "ein",
           "eine", "im", "für", "auf"),
    "es": ("el", "la", "los", "las", "de", "del", "que", "y", "en", "un", "una", "se", "por", "con", "no", "su",
           "para", "al"),
}


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * top / base <= high`` (either bound may be missing)."""

    name: str
    top: str
    base: str
    low: int | None = None
    high: int | None = None


# Measures a rule may name: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words,
# n_late_words (words after the first 20, so that a short text may do without stop words), one.
RULES = (
    Rule("words", "n_words", "one", low=10 * 100),
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols_per_word", "n_symbols", "n_words", high=20),
    Rule("stop_words", "n_stop_words", "n_late_words", low=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also when the body
    looks at it from inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words covered by windows of five words that occur twice or more.

    Windows are compared by a 64-bit hash of their five word hashes. Texts without a repeated window (most) stop after a distinct count;
    the others sort (window, position) and add up the parts of the marked
    windows that earlier ones do not cover: n log n for any text length."""
    k = WINDOW

    def counted(wins: Column) -> Column:
        keyed = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            # s is sorted: a window repeats if a neighbour has its hash
            return F.sort_array(F.transform(F.filter(s, lambda x, i: (
                (x["h"] == F.when(i > 0, F.get(s, i - 1))["h"])
                | (x["h"] == F.get(s, i + 1)["h"]))), lambda x: x["i"]))

        covered = F.aggregate(
            let(keyed, marked),
            F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
            lambda acc, p: F.struct(
                (acc["total"] + F.lit(k) - F.greatest(acc["end"] - p, F.lit(0))).alias("total"),
                (p + F.lit(k)).alias("end")),
            lambda acc: acc["total"])
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0)).otherwise(covered)

    def windows(hs: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hs) - k)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(k)]))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= k, let(let(hashes, windows), counted)).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, stop_words: dict[str, Sequence[str]] = STOP_WORDS) -> DataFrame:
    """doc_id with the measures of every whole text; a null text has none of anything."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    df = docs.select("doc_id", text.alias("text"), words.alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    stops = sorted({w for ws in stop_words.values() for w in ws})

    def line_counts(ls: Column) -> Column:
        return F.struct(F.size(ls).cast("long").alias("n"),
                        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))

    counts = let(F.col("words"), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n"),
        F.size(F.filter(ws, lambda w: F.regexp_replace(w, r"[.,]+$", "").isin(stops))).cast("long").alias("stop"),
        _repeat_words(ws).alias("repeat")))
    df = df.select("doc_id", "text", counts.alias("w"), let(lines, line_counts).alias("l"))
    return df.select(
        "doc_id",
        F.col("w.n").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.col("l.dup").alias("n_dup_lines"),
        F.col("w.repeat").alias("n_repeat_words"),
        F.greatest(F.col("w.n") - 20, F.lit(0)).cast("long").alias("n_late_words"),
        F.col("w.stop").alias("n_stop_words"),
        F.col("l.n").alias("n_lines"),
    )


def compile_rules(rules: Sequence[Rule]) -> dict[str, Column]:
    """One boolean column per rule: true if the row keeps within its bounds."""
    out = {}
    for r in rules:
        top = F.lit(100) * F.col(r.top)
        base = F.lit(1) if r.base == "one" else F.col(r.base)
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (top >= F.lit(r.low) * base)
        if r.high is not None:
            ok = ok & (top <= F.lit(r.high) * base)
        out[r.name] = ok
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: the measures, base_failed, failed_rules and kept.

    Empty or null texts have only zero measures and fail (fewer than 10 words).
    Repeated rows give repeated results; other columns of ``docs`` are ignored."""
    m = measures(docs)
    base_failed = (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))
    checks = compile_rules(rules)
    passed = F.lit(True)
    for ok in checks.values():
        passed = passed & ok
    failed = F.concat_ws(",", *[F.when(~ok, F.lit(name)) for name, ok in checks.items()])
    return m.select("*", base_failed.alias("base_failed"), (~base_failed & passed).alias("kept"),
                    failed.alias("failed_rules"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "documents"))


def _rule_sql(r: Rule) -> str:
    base = "1" if r.base == "one" else r.base
    parts = ([f"100 * {r.top} >= {r.low} * {base}"] if r.low is not None else []) + (
        [f"100 * {r.top} <= {r.high} * {base}"] if r.high is not None else [])
    return "(" + " AND ".join(parts or ["TRUE"]) + ")"


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n
      FROM (SELECT rid, regexp_extract_all(text, '{WORD}+') AS ws FROM d)),
win AS (
  SELECT rid, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
         || ' ' || lead(word, 4) OVER o AS win FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, win FROM win WHERE win IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
marked AS (SELECT DISTINCT rid, i + s.j AS i FROM win JOIN twice USING (rid, win), range(5) s(j)),
rep AS (SELECT rid, count(*) AS n FROM marked GROUP BY rid),
ws AS (SELECT rid, count(*) AS n, sum(length(word)) AS chars,
              count(*) FILTER (WHERE regexp_replace(word, '[.,]+$', '') IN ({_STOPS})) AS stop FROM w GROUP BY rid),
ln AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '{WORD}') GROUP BY rid),
m AS (
  SELECT doc_id, coalesce(ws.n, 0) AS n_words, CAST(coalesce(ws.chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(ln.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         greatest(coalesce(ws.n, 0) - 20, 0) AS n_late_words,
         coalesce(ws.stop, 0) AS n_stop_words, coalesce(ln.n, 0) AS n_lines
  FROM d LEFT JOIN ws USING (rid) LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed AND {" AND ".join(_rule_sql(r) for r in RULES)}) AS kept,
       concat_ws(',', {", ".join(f"CASE WHEN NOT {_rule_sql(r)} THEN '{r.name}' END" for r in RULES)}) AS failed_rules
FROM b
"""
