"""Personal data: fixed patterns plus a skip-chain conditional random field.

Base spans come from four patterns (e-mail, IP address, card, phone), leftmost
and non-overlapping per kind; a match that fails its test is dropped. The
patterns are applied so that long runs cost linear time.

The field labels the tokens (runs between white space) of a document that hold
a digit or ``@``; all other tokens are certainly outside. Its potentials:

* unary: token shape, numbers of digits and letters, shapes of the neighbours;
* chain: labels of two such tokens that follow each other directly;
* skip: labels of distant tokens that are equal or have the same long digits.
  Equal tokens are linked along their occurrences and to the first of them,
  never all with all.

Marginals come from loopy sum-product message passing over the document's
graph, so what one occurrence shows reaches all others. Weights are trained
piecewise (unary by multinomial regression, both edge tables by smoothed
association) with the base spans of at most ``MAX_TRAIN_DOCS`` documents as
labels, and with the values of assignments like ``token = "..."`` as labels of a
kind of its own, secrets. From each confident token that touches no base span a
run is followed over the neighbours that may have the same label; it becomes a
span if it is a whole number, address or secret by the test of its kind. So a
phone and a card that one pattern took for a single number, or a secret that is
repeated without its assignment, are found; pieces of numbers are not.

Every whole text is read once, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, load, text_chunks, text_column

# Kinds in the order in which spans of the same start are listed.
KINDS = ("email", "ip", "card", "phone")
ORDER = (*KINDS, "secret")  # secrets are only added by the field
LABELS = ("outside", *ORDER)
MAX_TRAIN_DOCS = 4000
MAX_PATTERNS = 5000
ROUNDS = 20
CONFIDENT, POSSIBLE = 0.9, 0.05

Span = tuple[int, int, str]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# from inside a run of digits a match fails just as from its first digit: only run starts are tried
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_ASSIGNED = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?[\x20\t]*[=:][\x20\t]*"
                       r"[\"']?([A-Za-z0-9_/+=.-]{16,})")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        # the next local part may begin inside what failed, but not before this sign
        done = match.end() if match else at + 1
        if match:
            yield start, match.end(), "email"
        at = text.find("@", done)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[Span]:
    """Valid matches by start, then kind as listed; offsets in code points, end exclusive."""
    if not text or not _SIGN.search(text):
        return []
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sort_spans(out)


def sort_spans(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], ORDER.index(s[2]), s[1]))


def whole(kind: str, value: str) -> bool:
    """Whether the value is a whole one of its kind, not a piece of it or more than it."""
    digits = _digits(value)
    if kind == "email":
        return any(True for _ in _emails(value))
    if kind == "ip":
        parts = value.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9\x20-]", value)
    if kind == "phone":
        return value[:1] == "+" and 9 <= len(digits) <= 15 and not re.search(r"[^0-9\x20().+-]", value)
    return len(value) >= 16 and bool(digits) and bool(re.search("[A-Za-z]", value)) and not _TOKEN_END.search(value)


_TOKEN_END = re.compile(r"[\x20\x09-\x0D]")


def assigned_secrets(text: str) -> list[Span]:
    """Values of assignments to a name that tells a secret: labels for training."""
    return [(m.start(1), m.end(1), "secret") for m in _ASSIGNED.finditer(text) if whole("secret", m.group(1))]


# ---------------------------------------------------------------- graph of a document
def shape(token: str) -> str:
    """Runs of digits as 9, runs of letters as a; a long shape keeps its beginning."""
    out = []
    for c in token:
        s = "9" if "0" <= c <= "9" else ("a" if c.isalpha() else c)
        if not out or s not in "9a" or out[-1] != s:
            out.append(s)
            if len(out) > 9:
                break
    return "".join(out[:9]) + ("~" if len(out) > 9 else "")


def _bucket(n: int) -> int:
    return n if n < 5 else (5 if n < 8 else (8 if n < 12 else (12 if n < 20 else 20)))


EDGE = ".,;:!?\"'[]{}<>"


@dataclass
class Graph:
    spans: list[tuple[int, int]]  # of the tokens, signs at the ends left out
    features: list[tuple[str, ...]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def graph(text: str) -> Graph:
    """Nodes are the tokens with a digit or ``@``."""
    spans, features, chain, keys, places = [], [], [], [], []
    last = None  # number of the token before, if it is a node
    before, waiting = "^", False
    for number, m in enumerate(_TOKEN.finditer(text)):
        token = m.group()
        sign = _SIGN.search(token)
        short = shape(token.strip(EDGE)) if sign else ("w" if token[:1].isalpha() else ".")
        if waiting:
            features[-1] = (*features[-1], "n=" + short)
            waiting = False
        if sign:
            core = token.strip(EDGE)
            start = m.start() + token.find(core) if core else m.start()
            digits = _digits(core)
            four = core.split(".")
            spans.append((start, start + len(core)))
            features.append((
                "s=" + short, f"d={_bucket(len(digits))}", f"c={_bucket(len(core))}", f"a={core.count('@')}",
                f"i={int(len(four) == 4 and all(p.isdigit() and len(p) < 4 for p in four))}",
                f"l={int(12 <= len(digits) <= 19 and luhn(digits))}", f"+={int(core[:1] == '+')}", "p=" + before))
            waiting = True
            if last == number - 1 and places:
                chain.append((len(spans) - 2, len(spans) - 1))
            last = number
            places.append(number)
            keys.append((core.lower(), digits if len(digits) >= 7 else None))
        before = short
    if waiting:
        features[-1] = (*features[-1], "n=$")
    skip: set[tuple[int, int]] = set()
    for part in (0, 1):
        first: dict[str, int] = {}
        previous: dict[str, int] = {}
        for i, key in enumerate(keys):
            k = key[part]
            if not k:
                continue
            if k in first:
                skip.add((first[k], i))
                skip.add((previous[k], i))
            else:
                first[k] = i
            previous[k] = i
    return Graph(spans, features, chain, sorted(skip))


def _labels(g: Graph, base: list[Span]) -> list[int]:
    """Label of the base span that a token overlaps (the first in order), else outside."""
    out, j = [], 0
    by_start = sorted(base)
    for start, end in g.spans:
        while j < len(by_start) and max(b[1] for b in by_start[j:j + 1]) <= start:
            j += 1
        found = 0
        for b in by_start[j:j + 4]:
            if b[0] < end and start < b[1]:
                found = LABELS.index(b[2])
                break
        out.append(found)
    return out


# ---------------------------------------------------------------- model
@dataclass
class Model:
    unary: dict[str, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Loopy sum-product in the log domain, all messages at once, half of the old message kept."""
        n, k = len(g.spans), len(LABELS)
        none = np.zeros(k)
        node = np.array([sum((self.unary.get(f, none) for f in fs), none) for fs in g.features]).reshape(n, k)
        edges = g.chain + g.skip
        if edges:
            a, b = np.array(edges).T
            source, target = np.concatenate((a, b)), np.concatenate((b, a))
            back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
            # one table for all messages of a direction along the chain or a skip
            cut = np.cumsum([0, len(g.chain), len(g.skip), len(g.chain), len(g.skip)])
            tables = [np.exp(t) for t in (self.chain, self.skip, self.chain.T, self.skip.T)]
            message = np.zeros((len(source), k))
            for _ in range(ROUNDS):
                belief = node.copy()
                np.add.at(belief, target, message)
                out = belief[source] - message[back]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                new = np.concatenate([out[x:y] @ t for x, y, t in zip(cut[:-1], cut[1:], tables, strict=True)])
                new = np.log(np.maximum(new, 1e-300))
                new -= new.max(axis=1, keepdims=True)
                if np.abs(new - message).max() < 1e-4:
                    break
                message = (message + new) / 2
            np.add.at(node, target, message)
        p = np.exp(node - node.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def fit(patterns: list[tuple[tuple[str, ...], int, int]], chain: np.ndarray, skip: np.ndarray,
        steps: int = 400, ridge: float = 0.05) -> Model:
    """Piecewise training from counted (features, label, count) patterns and edge label tables.
    Without patterns every token is outside."""
    k = len(LABELS)
    unary: dict[str, np.ndarray] = {}
    if patterns:
        names = sorted({f for fs, _, _ in patterns for f in fs})
        number = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(patterns), len(names) + 1))
        x[:, -1] = 1
        for i, (fs, _, _) in enumerate(patterns):
            x[i, [number[f] for f in fs]] = 1
        y = np.eye(k)[[label for _, label, _ in patterns]]
        weight = np.array([c for _, _, c in patterns], float)
        weight = np.minimum(weight, 200) / np.minimum(weight, 200).sum()
        w, speed = np.zeros((x.shape[1], k)), np.full((x.shape[1], k), 1e-8)
        for _ in range(steps):  # adaptive gradient steps on the weighted log loss
            z = x @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            grad = x.T @ ((p - y) * weight[:, None]) + ridge / len(patterns) * w
            speed += grad ** 2
            w -= 0.5 * grad / np.sqrt(speed)
        # the constant is spread over the shape feature that every token has
        unary = {f: w[i] + (w[-1] if f.startswith("s=") else 0) for f, i in number.items()}
    else:
        unary = {}

    def association(table: np.ndarray, prior: np.ndarray, limit: float = 3.0) -> np.ndarray:
        """Log of seen over expected counts; one added to both keeps pairs that were hardly seen near 0."""
        t = table + table.T + prior
        side = t.sum(axis=1)
        return np.clip(np.log((t + 1) / (np.outer(side, side) / max(t.sum(), 1e-9) + 1)), -limit, limit)

    # equal tokens are taken to share a label also where the training documents repeat none
    same = np.full((k, k), 1.0) + np.eye(k) * 20
    return Model(unary, association(chain, np.zeros((k, k))), association(skip, same))


def train(docs: DataFrame, limit: int = MAX_TRAIN_DOCS) -> Model:
    """Fitted on the base spans of at most ``limit`` documents that hold a digit or ``@``."""
    some = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]"))
    place = F.xxhash64("doc_id", F.lit("pii"))
    chosen = some.select("doc_id").orderBy(place, "doc_id").limit(limit).distinct()  # the first of each task, merged
    some = some.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                g = graph(text)
                base = base_spans(text)
                labels = _labels(g, base + [s for s in assigned_secrets(text) if not any(
                    b[0] < s[1] and s[0] < b[1] for b in base)])
                found.update((0, "\t".join(fs), y, 0) for fs, y in zip(g.features, labels, strict=True))
                found.update((1, "", labels[a], labels[b]) for a, b in g.chain)
                found.update((2, "", labels[a], labels[b]) for a, b in g.skip)
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([k[3] for k in keys], pa.int32()),
             pa.array([found[k] for k in keys], pa.int64())], ["kind", "features", "a", "b", "n"])

    counts = some.transform(arrow_map, counted, "kind int, features string, a int, b int, n long").groupBy(
        "kind", "features", "a", "b").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.col("kind").desc(), F.col("n").desc(), "features", "a").limit(MAX_PATTERNS).collect()
    tables = np.zeros((3, len(LABELS), len(LABELS)))
    patterns = []
    for r in rows:
        if r["kind"] == 0:
            patterns.append((tuple(r["features"].split("\t")), r["a"], r["n"]))
        else:
            tables[r["kind"], r["a"], r["b"]] = r["n"]
    return fit(patterns, tables[1], tables[2])


def method_spans(text: str | None, base: list[Span], model: Model) -> list[Span]:
    """Whole values around confident tokens, as runs of directly following tokens that overlap no base span.

    A run starts at a confident token and takes in neighbours for which its label is possible, the likelier side
    first, until it is whole; what does not become whole is no span."""
    if not text or not model.unary or not _SIGN.search(text):
        return []
    g = graph(text)
    p = model.marginals(g)
    covered = _labels(g, base)
    follows = {b for _, b in g.chain}
    n = len(g.spans)
    free = [not covered[i] and g.spans[i][1] > g.spans[i][0] for i in range(n)]
    out: list[Span] = []
    for i in np.flatnonzero(p[:, 1:].max(axis=1) >= CONFIDENT).tolist():
        y = int(p[i, 1:].argmax()) + 1
        if not free[i]:
            continue
        low = high = i
        while True:
            start, end = g.spans[low][0], g.spans[high][1]
            if whole(LABELS[y], text[start:end]):
                out.append((start, end, LABELS[y]))
                for j in range(low, high + 1):
                    free[j] = False
                break
            left = p[low - 1, y] if low in follows and free[low - 1] else 0.0
            right = p[high + 1, y] if high + 1 < n and high + 1 in follows and free[high + 1] else 0.0
            if max(left, right) < POSSIBLE or high - low >= 6:
                break
            if left >= right:
                low -= 1
            else:
                high += 1
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans.

    Null and empty texts have no spans (the digest is that of no bytes). Repeated rows give repeated
    results; other columns of ``docs`` are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            counts, digests, spans, added = [], [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                more = method_spans(text, base, shared.value)
                kinds = Counter(s[2] for s in base)
                counts.append([kinds[k] for k in KINDS])
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(sort_spans(base + more)))
                added.append(len(more))
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in columns], pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(added, pa.int64()),
                 pa.array(columns.sum(axis=0) + np.array(added, np.int64))],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_spans"])

    return docs.select("doc_id", "text").transform(
        arrow_map, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
             "n_added long, n_spans long")


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span, or group of overlapping spans, replaced by <KIND> of its first."""
    if not text or not spans:
        return text
    out, at = [], 0
    end = -1
    for start, stop, kind in sort_spans(spans):
        if start < end:
            end = max(end, stop)
            continue
        if end >= 0:
            at = end
        out.append(text[at:start])
        out.append(f"<{kind.upper()}>")
        end = stop
    out.append(text[end:])
    return "".join(out)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return find(docs, train(docs))


def redaction_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span is replaced in the text, n_chars follows; no document goes."""
    shared = spark.sparkContext.broadcast(train(docs))

    def redacted(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            base = base_spans(text)
            out.append(redact(text, base + method_spans(text, base, shared.value)))
        return pa.array(out, texts.type)

    out = docs.withColumn("text", text_column(spark, lambda: redacted, "string")("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
