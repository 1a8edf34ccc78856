"""Property test: the exact aggregates agree with Decimal half-up arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.functions.columns import avg_half_up, money_sum, pct_half_up

cents = st.integers(min_value=-10_000_000, max_value=10_000_000)
groups = st.lists(st.lists(cents, min_size=1, max_size=12), min_size=1, max_size=25)


def _q(d: Decimal, places: str) -> float:
    return float(d.quantize(Decimal(places), rounding=ROUND_HALF_UP))


@settings(max_examples=15, deadline=None)
@given(groups)
def test_avg_and_sum_match_decimal(spark, gs):
    rows = [(g, c / 100) for g, vals in enumerate(gs) for c in vals]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: (r.a, r.s) for r in df.groupBy("g").agg(avg_half_up("x", 2, 2).alias("a"),
                                                         money_sum("x").alias("s")).collect()}
    for g, vals in enumerate(gs):
        exact = sum(Decimal(c) for c in vals) / 100
        assert got[g] == (_q(exact / len(vals), "0.01"), _q(exact, "0.01")), (g, vals)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=30))
def test_pct_matches_decimal(spark, pairs):
    df = spark.createDataFrame([(i, min(p, t), t) for i, (p, t) in enumerate(pairs)], "i int, p long, t long")
    got = {r.i: r.pct for r in df.select("i", pct_half_up("p", "t", 1).alias("pct")).collect()}
    for i, (p, t) in enumerate(pairs):
        assert got[i] == _q(Decimal(min(p, t)) * 100 / Decimal(t), "0.1"), (p, t)


keys_st = st.sampled_from(["a", "b", "c", "d", None])
batch_st = st.lists(st.tuples(keys_st, st.integers(0, 9)), min_size=0, max_size=8)


@settings(max_examples=6, deadline=None)
@given(st.lists(batch_st, min_size=1, max_size=3))
def test_insert_new_matches_first_seen_model(spark, tmp_path_factory, batches):
    from strata.tables.versioned import VersionedTable

    t = VersionedTable(spark, str(tmp_path_factory.mktemp("ins")))
    model: dict = {}
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k string, v int")
        t.insert_new(df, ["k"], commit=f"b-{i}", order_by=["v"])
        for k in {r[0] for r in rows}:
            if k not in model:  # first batch that brings the key wins, smallest v inside it
                model[k] = min(v for kk, v in rows if kk == k)
    got = {r.k: r.v for r in t.read().collect()} if t.exists() else {}
    assert got == model
