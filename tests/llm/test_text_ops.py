"""Personal data, SentencePiece and decontamination against plain versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import decontamination, pii, sentencepiece_fst
from strata.llm.common import load, words_of

from .conftest import ODD_TEXTS, by_id

# ---------------------------------------------------------------- personal data
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            s = m.group()
            d = re.sub("[^0-9]", "", s)
            if (kind == "ip" and any(int(p) > 255 for p in s.split("."))
                    or kind == "card" and not (12 <= len(d) <= 19 and pii.luhn(d))
                    or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_base_spans_match_the_patterns(spark, sf_small):
    for r in load(spark, sf_small, "documents").select("text").collect():
        assert pii.base_spans(r[0]) == _plain_spans(r[0])
    rnd = random.Random(3)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab1209.@+-() %25é\n") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == _plain_spans(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    assert pii.base_spans("1" * 300_000 + "a" * 300_000 + "@" + "." * 1000) == []


K = len(pii.LABELS)


def _model():
    rows = [(("s=9", "l=1"), 3, 50), (("s=9", "l=0"), 0, 50), (("s=a", "l=0"), 0, 50)]
    return pii.fit(rows, np.zeros((K, K)), np.zeros((K, K)))


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(2)
    model = pii.Model({f"u{i}": rng.normal(size=K) for i in range(4)}, rng.normal(size=(K, K)), rng.normal(size=(K, K)))
    g = pii.Graph([(i, i + 1) for i in range(4)], [(f"u{i}",) for i in range(4)], [(0, 1), (1, 2)], [(0, 3)])
    joint = np.zeros((K,) * 4)
    for at in np.ndindex(joint.shape):
        joint[at] = sum(model.unary[f"u{i}"][at[i]] for i in range(4)) + model.chain[at[0], at[1]] \
            + model.chain[at[1], at[2]] + model.skip[at[0], at[3]]
    p = np.exp(joint) / np.exp(joint).sum()
    want = [p.sum(axis=tuple(j for j in range(4) if j != i)) for i in range(4)]
    assert np.allclose(model.marginals(g), want, atol=1e-3)


def test_repeated_tokens_share_their_label():
    model = _model()
    card, same = np.zeros(K), np.full((K, K), -1.0) + 3 * np.eye(K)
    card[3] = 4.0
    strong = pii.Model({"strong": card}, model.chain, same)
    g = pii.Graph([(0, 1), (5, 6), (9, 10)], [("strong",), ("none",), ("none",)], [], [(0, 1), (1, 2), (0, 2)])
    alone = pii.Graph(g.spans, g.features, [], [])
    assert strong.marginals(g)[1:, 3].min() > 0.8 > 0.3 > strong.marginals(alone)[1:, 3].max()


def test_equal_tokens_are_linked_along_their_occurrences():
    g = pii.graph(" x ".join(["id77"] * 6))
    assert len(g.skip) <= 2 * 5 and {(0, i) for i in range(1, 6)} <= set(g.skip) and (4, 5) in g.skip


def test_method_adds_spans_and_keeps_base(spark, sf_small):
    docs = load(spark, "/root/testdata/sf0.1", "documents")
    model = pii.train(docs)
    text = "Call +1 (583) 555-8469 4524132264652876 or mail aa.12@mail1.example.com now. Chapter 12 of 1984."
    base = pii.base_spans(text)
    more = pii.method_spans(text, base, model)
    assert [s[2] for s in base] == ["email"]  # the phone's run takes the card in, and both fail
    assert all(b[1] <= m[0] or m[1] <= b[0] for m in more for b in base)
    assert [(text[a:b], k) for a, b, k in more] == [("+1 (583) 555-8469", "phone"), ("4524132264652876", "card")]
    for r in pii.find(docs, model).collect()[:200]:
        assert len(r["base_sha256"]) == 64


def test_pii_on_odd_documents(odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in pii.find(odd_docs, _model()).collect()}
    assert (rows[11]["n_email"], rows[11]["n_ip"], rows[11]["n_card"], rows[11]["n_phone"]) == (1, 1, 1, 1)
    text = dict((i, t) for i, t in ODD_TEXTS)[11]
    want = pii.listed(_plain_spans(text))
    assert rows[11]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert rows[4]["base_sha256"] == rows[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find(odd_docs, _model()).count() == odd_docs.count()
    model = pii.train(no_docs)
    assert pii.find(no_docs, model).count() == 0 and pii.find(odd_docs, model).filter("n_added > 0").count() == 0


def test_redaction():
    text = "a x@y.zz b +1 (988) 555-2485"
    assert pii.redact(text, pii.base_spans(text)) == "a <EMAIL> b <PHONE>"
    assert pii.redact("abcdef", [(0, 3, "card"), (2, 5, "phone")]) == "<CARD>f"
    assert pii.redact(None, []) is None and pii.redact("", []) == ""


def test_redaction_stage(spark, odd_docs, no_docs):
    out = pii.redaction_stage(spark, odd_docs, "")
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    text, n = out.filter("doc_id = 11").select("text", "n_chars").first()
    assert "bob@" not in text and "4111" not in text and n == len(text)
    assert out.filter("doc_id = 4").first()["text"] is None
    assert pii.redaction_stage(spark, no_docs, "").count() == 0


# ---------------------------------------------------------------- SentencePiece
@pytest.fixture(scope="module")
def codec():
    return sentencepiece_fst.Codec(sentencepiece_fst.Vocabulary.read())


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)


def test_pieces_equal_the_library(spark, sf_small, codec, library):
    texts = [r[0] for r in load(spark, sf_small, "documents").select("text").collect()] + [t or "" for _, t in ODD_TEXTS]
    for t in texts:
        assert codec.encode(t) == library.encode(t)
        assert codec.decode(codec.encode(t)) == t


def test_random_texts_equal_the_library(codec, library):
    rnd = random.Random(9)
    signs = "abcdefghijklmnopqrstuvwxyz   THE\n\t.,'\"-=(){}[]0123456789éüñç▁日本語😀́​"
    for k in range(6000):
        if k % 2:
            t = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40)))
        else:
            t = rnd.choice("abe =-*0 .\n") * rnd.randint(0, 30) + "".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 20)))
        assert codec.encode(t) == library.encode(t), t
        assert codec.decode(codec.encode(t)) == library.decode(library.encode(t)), t


def test_shortest_path_is_the_only_finite_one(codec):
    """Brute force over all segmentations of short units."""
    machine = codec.machine

    def all_paths(unit):
        if not unit:
            yield []
        for i in range(1, len(unit) + 1):
            if unit[:i] in machine.score or i == 1:
                for rest in all_paths(unit[i:]):
                    yield [unit[:i], *rest]

    for unit in ("▁there", "▁nonsense", "▁ération", "aaaa", "▁▁▁x", "1984"):
        finite = [p for p in all_paths(unit) if all(machine.apart(a, b) for a, b in zip(p, p[1:], strict=False))]
        assert finite == [machine.shortest_path(unit)]


def test_caches_are_bounded(codec, monkeypatch):
    monkeypatch.setattr(sentencepiece_fst, "KEPT_UNITS", 5)
    monkeypatch.setattr(sentencepiece_fst, "KEPT_PAIRS", 5)
    small = sentencepiece_fst.Codec(sentencepiece_fst.Vocabulary.read())
    text = " ".join(f"word{i} other" for i in range(50))
    assert small.encode(text) == codec.encode(text) and len(small) <= 5 and len(small.machine.pairs) <= 5


def test_units_of_a_task_are_solved_once():
    """A task's texts have some 400,000 different units, which are met again and again."""
    small = sentencepiece_fst.Codec(sentencepiece_fst.Vocabulary.read())
    solved = []
    small.machine.ids = lambda unit: solved.append(1) or (7, 70_000)
    text = " ".join(map(str, range(420_000)))
    for _ in range(2):
        assert small.encode(text) == [7, 70_000] * 420_000
    assert len(solved) == 420_000


def test_frames_round_trip(spark, odd_docs, no_docs):
    vocabulary = sentencepiece_fst.Vocabulary.read()
    rows = sentencepiece_fst.encode(odd_docs, vocabulary)
    assert rows.columns == ["doc_id", "n_pieces", "pieces", "round_trip"]
    assert rows.filter("not round_trip").count() == 0 and rows.count() == odd_docs.count()
    assert rows.filter("size(pieces) <> n_pieces").count() == 0
    back = by_id(sentencepiece_fst.decode(rows, vocabulary), "doc_id", "text")
    want = sorted(((i, t or "") for i, t in ODD_TEXTS), key=lambda t: tuple((x is not None, str(type(x)), x) for x in t))
    assert back == want
    assert sentencepiece_fst.encode(no_docs, vocabulary).count() == 0


# ---------------------------------------------------------------- decontamination
def _naive_tiles(item, doc, least):
    """Greedy string tiling by its definition: all common runs of unmarked words, longest first."""
    used_i, used_d, out = set(), set(), []
    while True:
        best = []
        longest = least - 1
        for i in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while (i + n < len(item) and t + n < len(doc) and item[i + n] == doc[t + n]
                       and i + n not in used_i and t + n not in used_d):
                    n += 1
                if n > longest:
                    longest, best = n, [(i, t)]
                elif n == longest and n >= least:
                    best.append((i, t))
        if longest < least:
            return out
        for i, t in best:
            if not used_i & set(range(i, i + longest)) and not used_d & set(range(t, t + longest)):
                used_i |= set(range(i, i + longest))
                used_d |= set(range(t, t + longest))
                out.append((i, t, longest))


def test_tiles_match_the_definition():
    rnd = random.Random(4)
    for _ in range(150):
        item = np.array([rnd.randrange(6) for _ in range(rnd.randint(0, 25))], np.uint64)
        doc = np.array([rnd.randrange(6) for _ in range(rnd.randint(0, 40))], np.uint64)
        assert decontamination.tiles(item, doc, 3) == _naive_tiles(item.tolist(), doc.tolist(), 3)


ITEM = "the committee of seven decided that no further evidence would be heard before the autumn session begins in town"


def _leak_docs(spark):
    w = ITEM.split()
    rows = [(1, "before it " + ITEM.upper() + " and after"),
            (2, " ".join(w[10:]) + " -- " + " ".join(w[:10]) + "."),  # halves changed over
            (3, " ".join(w[:6]) + " nothing else of it"),
            (4, None), (5, ""), (6, "clean text " * 4000), (1, "before it " + ITEM.upper() + " and after"),
            (7, " filler ".join(w)), (8, "long " * 20_000 + ITEM)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, item string, seeds string")


def test_leaks_catch_copies_and_reordered_passages(spark):
    bench = spark.createDataFrame([(70, ITEM, 1), (71, "short item", 1), (72, None, 1), (73, "", 1)],
                                  "item_id long, text string, h int")
    got = by_id(decontamination.leaks(_leak_docs(spark), bench), "doc_id", "item_id", "n_tiles")
    assert got == [(1, 70, 1), (1, 70, 1), (2, 70, 2), (8, 70, 1)]
    empty = bench.limit(0)
    assert decontamination.leaks(_leak_docs(spark), empty).count() == 0
    assert decontamination.leaks(_leak_docs(spark).limit(0), bench).count() == 0


def test_leaks_match_brute_force(spark, sf_small):
    docs, bench = load(spark, sf_small, "documents"), load(spark, sf_small, "benchmark")

    def tokens(df, key):
        rows = df.select(key, "text").collect()
        h, at = decontamination.token_hashes(pa.array([r["text"] for r in rows]))
        return {r[key]: h[at[i]:at[i + 1]] for i, r in enumerate(rows)}

    want = []
    items = tokens(bench, "item_id")
    for d, doc in tokens(docs, "doc_id").items():
        for i, item in items.items():
            covered = sum(n for _, _, n in decontamination.tiles(item, doc))
            if covered >= decontamination.LEAST_COVERAGE * len(item) > 0:
                want.append((d, i, covered))
    got = by_id(decontamination.leaks(docs, bench), "doc_id", "item_id", "covered_words")
    assert got == sorted(want) and got


def test_stage_drops_leaks(spark, tmp_path):
    spark.createDataFrame([(70, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = decontamination.decontamination_stage(spark, _leak_docs(spark), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 7]


# ---------------------------------------------------------------- helpers
def test_words_of_slices():
    texts = ["a b", None, " Ä  Bc\x0bd ", "", "é" * 50 + " X", "tail"]
    whole = pa.array(texts)
    for a in range(len(texts)):
        for b in range(a, len(texts) + 1):
            flat, at = words_of(whole.slice(a, b - a), lower=True)
            got = [flat.to_pylist()[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
            low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            assert got == [re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(low)) for t in texts[a:b]]


def test_stage_judges_rows_without_or_with_a_repeated_id_one_by_one(spark, tmp_path):
    item = " ".join(f"item{i}" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, "before " + item), (None, "clean text without an id"), (None, None), (4, item + " after"),
            (4, "clean text of the same id"), (5, ""), (6, "another clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontamination.decontamination_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert by_id(kept, "doc_id", "text") == by_id(docs.filter("coalesce(text, '') not like '%item0%'"), "doc_id", "text")


def test_repeated_words_take_linear_time():
    import time

    begin = time.time()
    item, doc = np.full(300, 7, np.uint64), np.full(60_000, 7, np.uint64)
    assert decontamination.tiles(item, doc) == [(0, 0, 300)]
    half = np.concatenate([np.full(150, 7, np.uint64), np.arange(100, 250, dtype=np.uint64)])
    mixed = np.tile(np.concatenate([np.full(40, 7, np.uint64), [1]]), 1500).astype(np.uint64)
    assert sum(n for _, _, n in decontamination.tiles(half, mixed)) == 150
    assert time.time() - begin < 20


def test_most_coverage_bounds_the_tiles():
    rnd = random.Random(12)
    for _ in range(300):
        item = np.array([rnd.randint(0, 4) for _ in range(rnd.randint(0, 40))], np.uint64)
        doc = np.array([rnd.randint(0, 4) for _ in range(rnd.randint(0, 60))], np.uint64)
        assert decontamination.most_coverage(item, doc, 3) >= sum(n for _, _, n in decontamination.tiles(item, doc, 3))


def test_bit_table(spark):
    from pyspark.sql import functions as F

    from strata.llm.common import bit_table

    cells = spark.range(5000).select((F.col("id") * 7919 % (1 << 20)).cast("int").alias("cell"))
    bits = np.unpackbits(bit_table(cells, 20), bitorder="little")
    assert len(bits) == 1 << 20 and set(np.flatnonzero(bits).tolist()) == {r.cell for r in cells.collect()}
    assert not bit_table(cells.limit(0), 20).any()


def _planted(rnd):
    """(text, spans that the base patterns miss): numbers run together, secrets with and without an assignment."""
    words = lambda n: " ".join(rnd.choice(["the", "and", "erel", "tion", "12", "mente", "1984.", "v2"])
                               for _ in range(n))
    phone = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
    card = next(c for c in (f"4{rnd.randrange(10 ** 15):015d}" for _ in range(1000)) if pii.luhn(c))
    secret = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    parts = {"both": ([f"{phone} {card}"], [phone, card]), "assigned": ([f'token = "{secret}"'], [secret]),
             "repeated": ([f'token = "{secret}"', f"{secret}"], [secret, secret]), "none": ([], [])}
    pieces, wanted = parts[rnd.choice(sorted(parts))]
    text, spans = words(8) + " so", []
    for piece in pieces:
        text += " "
        at = len(text)
        text += piece + " so " + words(6)
        for w in dict.fromkeys(wanted):
            if w in piece:
                spans.append((at + piece.index(w), at + piece.index(w) + len(w)))
    return text, spans


def test_added_spans_on_planted_values(spark):
    model = pii.train(load(spark, "/root/testdata/sf0.1", "documents"))
    rnd = random.Random(21)
    hit = added = planted = 0
    for _ in range(400):
        text, spans = _planted(rnd)
        more = pii.method_spans(text, pii.base_spans(text), model)
        found = {(a, b) for a, b, _ in more}
        hit, added, planted = hit + len(found & set(spans)), added + len(found), planted + len(spans)
    assert planted > 300 and hit / planted >= 0.95 and hit / added >= 0.98, (hit, added, planted)


def test_pieces_of_numbers_are_no_spans():
    assert not pii.whole("phone", "+1 (826)") and pii.whole("phone", "+1 (826) 555-0101")
    assert not pii.whole("card", "4524132264652877") and pii.whole("card", "4524 1322 6465 2876")
    assert not pii.whole("ip", "10.1.2") and pii.whole("ip", "10.1.2.255") and not pii.whole("ip", "10.1.2.256")
    assert not pii.whole("secret", "0123456789abcde") and pii.whole("secret", "0123456789abcdef")
    assert pii.assigned_secrets('x token = "0123456789abcdef01" y') == [(11, 29, "secret")]
