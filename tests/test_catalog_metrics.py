import pytest

from strata.catalog import missing_schemas, register_table, table_properties
from strata.operators.quality import RuleCounts
from strata.streaming.flows import Flow, run_flow
from strata.tables.versioned import VersionedTable


def test_missing_schemas_and_table_properties(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS strata_bronze")
    missing = {r.schema_name for r in missing_schemas(spark, ["strata_bronze", "strata_nope"]).collect()}
    assert missing == {"strata_nope"}
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    register_table(spark, "strata_bronze.t", path, comment="raw rows", properties={"quality": "bronze"})
    props = {r.key: r.value for r in table_properties(spark, "strata_bronze.t").collect()}
    assert props.get("quality") == "bronze"
    assert spark.table("strata_bronze.t").count() == 3


def test_rule_counts_are_exact_after_a_crash(spark, tmp_path):
    """The flow dies after a batch's rows were committed and before its counts are there, then goes on."""
    src = VersionedTable(spark, str(tmp_path / "src"))
    for x in ([1, 0, None], [2, 3], [-1, -2], [4]):
        src.append(spark.createDataFrame([(i,) for i in x], "x int").coalesce(1))
    counts = RuleCounts(spark, str(tmp_path / "counts"))

    class Dies(RuleCounts):
        def record(self, commit, rows, rules):
            if len(counts.batches().select("commit").distinct().collect()) == 2:
                raise RuntimeError("gone")
            super().record(commit, rows, rules)

    def flow(where):
        return Flow("obs", lambda s: src.read_stream(1), lambda d: d.filter("x > 0"),
                    VersionedTable(spark, str(tmp_path / "out")), str(tmp_path / "ck"), batchwise=True,
                    rules={"pos": "x > 0"}, counts=where)

    with pytest.raises(Exception, match="gone"):
        run_flow(spark, flow(Dies(spark, counts.root)))
    assert counts.totals().first().total < 8
    for _ in range(2):  # and a rerun without input changes nothing
        run_flow(spark, flow(counts))
        assert [tuple(r) for r in counts.totals().select("rule", "total", "failed").collect()] == [("pos", 8, 4)]
    assert sorted(r.x for r in VersionedTable(spark, str(tmp_path / "out")).read().collect()) == [1, 2, 3, 4]


def test_scale_conf():
    from strata.session import scale_conf

    big = scale_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) > 700_000
    small = scale_conf(10**6, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_command_line(spark, sf_small, tmp_path, capsys):
    import json

    from strata.__main__ import main
    from strata.plans.batch import Medallion
    from strata.sources.files import write_landing

    m = Medallion(spark, sf_small)
    land, root = str(tmp_path / "land"), str(tmp_path / "root")
    write_landing(m.bronze_trips(), f"{land}/taxi")
    write_landing(m.bronze_drivers(), f"{land}/drivers", "json")
    write_landing(m.bronze_users(), f"{land}/users")
    assert main(["run", "--landing", land, "--root", root], spark=spark) == 0
    out = capsys.readouterr().out
    assert json.loads(out.strip().splitlines()[-1])["rule_failures"]["silver_taxi"]["rows"] > 0
    assert main(["audit", "--root", root, "--out", str(tmp_path / "report")], spark=spark) == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["pipeline_status"] == "SUCCESS" and summary["total_monitored_tables"] == 10
    assert main(["restore", "--root", root, "--table", "bronze.taxi", "--version", "0"], spark=spark) == 0
    assert "RESTORE" in capsys.readouterr().out
