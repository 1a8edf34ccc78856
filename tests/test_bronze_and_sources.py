import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import audit_columns
from strata.schemas import DRIVER, USER
from strata.sources.files import (RESCUED, FileSource, SchemaStore, apply_hints, common_type, is_json_object,
                                  list_files, parse_json_with_rescue, widen)
from strata.streaming.flows import Flow, run_flow
from strata.tables.versioned import VersionedTable


def test_audit_columns_from_metadata_struct(spark):
    df = spark.createDataFrame([("1", "dbfs:/landing/file1.json"), ("2", "dbfs:/landing/file2.json")],
                               "id string, fp string").select("id", F.struct(F.col("fp").alias("file_path")).alias("_metadata"))
    out = {r.id: r for r in audit_columns(df).collect()}
    assert out["1"]._source_file == "dbfs:/landing/file1.json"
    assert out["2"]._ingested_at is not None


def test_schemas():
    assert "phone" not in DRIVER.fieldNames()
    assert isinstance(USER["registration_date"].dataType, T.DateType)


def test_hints_and_widen():
    inferred = T.StructType([T.StructField("experience", T.LongType()), T.StructField("x", T.StringType())])
    hinted = apply_hints(inferred, "experience INT, phone STRING")
    assert hinted["experience"].dataType == T.IntegerType()
    assert hinted.fieldNames() == ["experience", "x", "phone"]
    wider = widen(hinted, T.StructType([T.StructField("y", T.DoubleType())]))
    assert wider.fieldNames() == ["experience", "x", "phone", "y"]


def test_rescued_data_unknown_key_and_bad_type(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([('{"id": 1, "v": 2.5, "extra": "x"}',), ('{"id": 2, "v": "abc"}',),
                                ('{"id": 3, "v": 1.0}',)], "value string")
    out = {r.id: r for r in df.select(parse_json_with_rescue(F.col("value"), schema).alias("r")).select("r.*").collect()}
    assert json.loads(out[1]._rescued_data) == {"extra": "x"} and out[1].v == 2.5
    assert json.loads(out[2]._rescued_data) == {"v": "abc"} and out[2].v is None
    assert out[3]._rescued_data is None


class Ingest:
    """A landing folder and a bronze table fed by it."""

    def __init__(self, spark, root, fmt, **source):
        self.spark, self.land = spark, f"{root}/land"
        self.source = FileSource(self.land, fmt, f"{root}/schema", **source)
        self.table = VersionedTable(spark, f"{root}/table")
        self.flow = Flow("t", self.source.files, audit_columns, self.table, f"{root}/ck", expand=self.source.read)

    def land_rows(self, rows, ddl):
        self.spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").format(self.source.fmt).save(self.land)
        return self

    def run(self):
        run_flow(self.spark, self.flow)
        return self

    def rows(self, *columns):
        return sorted((tuple(r[c] for c in columns) for r in self.table.read().collect()), key=str)

    def schema(self):
        return SchemaStore(self.spark, self.source.schema_location).load()


def test_file_source_schema_is_persisted_and_evolves(spark, tmp_path):
    t = Ingest(spark, tmp_path, "json").land_rows([(1, "a")], "id long, name string").run()
    assert t.schema()[1].fieldNames() == ["id", "name"]
    first = t.schema()
    assert t.land_rows([(3, "c")], "id long, name string").run().schema() == first  # nothing new: no new version
    t.land_rows([(2, "b", "555")], "id long, name string, phone string").run()
    assert t.schema()[0] == 1 and t.schema()[1].fieldNames() == ["id", "name", "phone"]
    assert t.rows("id", "phone") == [(1, None), (2, "555"), (3, None)]
    assert len(t.table.history().collect()) == 3 and len(t.run().table.history().collect()) == 3


def test_file_that_lands_while_the_stream_starts(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet").land_rows([(1,)], "a long")
    files = t.source.files

    def late(session):
        stream = files(session)
        t.land_rows([(2, "new")], "a long, b string")
        return stream

    t.flow.source = late
    t.run()
    assert t.rows("a", "b") == [(1, None), (2, "new")]


def test_parquet_types_that_change(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet", max_files_per_trigger=1).land_rows([(1, 5)], "id int, v int").run()
    t.land_rows([(2, 6), (3, 1 << 40), (4, None)], "id int, v long").run()
    t.land_rows([(5, "7"), (6, "x"), (7, "007")], "id int, v string").run()
    t.land_rows([(8, 9.0), (9, 9.5)], "id int, v double").run()
    t.land_rows([(10, [1, 2])], "id int, v array<int>").run()
    rescued = {3: '{"v":"%d"}' % (1 << 40), 6: '{"v":"x"}', 7: '{"v":"007"}', 9: '{"v":"9.5"}', 10: '{"v":"[1,2]"}'}
    values = {1: 5, 2: 6, 5: 7, 8: 9}
    assert dict((i, (v, r)) for i, v, r in t.rows("id", "v", RESCUED)) == {
        i: (values.get(i), rescued.get(i)) for i in range(1, 11)}
    assert t.table.schema()["v"].dataType == T.IntegerType()


def test_types_that_differ_in_the_first_batch(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet").land_rows([(1, 5, 2)], "id int, v int, w int")
    t.land_rows([(2, "x", 1 << 40)], "id int, v string, w long").land_rows([(3, 1.5, None)], "id int, v double, w long").run()
    assert t.rows("id", "v", "w") == [(1, "5", 2), (2, "x", 1 << 40), (3, "1.5", None)]
    assert RESCUED not in t.table.read().columns or t.table.read().filter(f"{RESCUED} is not null").isEmpty()
    assert common_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert common_type(T.DateType(), T.LongType()) == T.StringType()


def test_structs_gain_fields(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet").land_rows([(1, (5,))], "id int, s struct<a:int>").run()
    t.land_rows([(2, (6, "b")), (3, None)], "id int, s struct<a:int,b:string>").run()
    t.land_rows([(4, ("zzz", "c"))], "id int, s struct<a:string,b:string>").run()
    got = [(i, s and tuple(s), r) for i, s, r in t.rows("id", "s", RESCUED)]
    assert got == [(1, (5, None), None), (2, (6, "b"), None), (3, None, None),
                   (4, (None, "c"), json.dumps({"s": json.dumps({"a": "zzz", "b": "c"}, separators=(",", ":"))},
                                               separators=(",", ":")))]


def test_misfits_stop_a_flow_without_rescue(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet", rescue=False).land_rows([(1,)], "v int").run().land_rows([("x",)], "v string")
    with pytest.raises(Exception, match="do not fit"):
        t.run()
    assert t.table.refresh().read().count() == 1


def test_columns_unseen_by_a_fixed_schema_are_rescued(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet", schema=T.StructType.fromDDL("id int")).land_rows([(1, "k")], "id int, x string")
    assert t.run().rows("id", RESCUED) == [(1, '{"x":"k"}')]
    u = Ingest(spark, tmp_path / "u", "parquet", evolve=False).land_rows([(1,)], "id int").run()
    assert u.land_rows([(2, "k")], "id int, x string").run().rows("id", RESCUED) == [(1, None), (2, '{"x":"k"}')]


def test_paths_with_pattern_signs(spark, tmp_path):
    t = Ingest(spark, tmp_path / "run=1", "parquet")
    t.land_rows([(1,)], "id int")
    part = next((tmp_path / "run=1" / "land").glob("part-*"))
    part.rename(part.with_name("a[1]{x}*b.parquet"))
    assert t.run().rows("id") == [(1,)]


def test_failed_inference_stops_the_run(spark, tmp_path):
    t = Ingest(spark, tmp_path, "parquet").land_rows([(1, "a")], "id long, name string").run()
    (tmp_path / "land" / "part-broken.parquet").write_text("no parquet")
    for _ in range(2):  # and the file stays new
        with pytest.raises(Exception, match="(?i)parquet|footer"):
            t.run()
    assert t.table.refresh().read().count() == 1


def test_whole_lines_of_one_json_object(spark):
    good = ['{}', '{"a":1}', ' \t{"a":{"b":[1,2]}} ', '{"a":"]}"}', '{"A":1,"a":2}', '{"a":null}']
    bad = ['', '[1]', '1', 'x', '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}],[2', '{"a":1},null',
           '{"a":1,"a":2}', '{"a":{"b":1,"b":2}}', "{'a':1}", '{"a":1}]', '{"a":1},"x"]', None]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string").select("t", is_json_object(F.col("t")).alias("ok"))
    assert {r.t for r in df.collect() if r.ok} == set(good)


def test_lines_that_are_not_one_object_are_kept_whole(spark, tmp_path):
    (tmp_path / "land").mkdir()
    lines = ['{"id":"a","n":1} trailing', '{"id":"b","id":"c","n":2}', '{"id":"d","n":3}', '{"id":"e","n":"four"}']
    (tmp_path / "land" / "x.json").write_text("\n".join(lines) + "\n")
    t = Ingest(spark, tmp_path, "json", schema=T.StructType.fromDDL("id string, n long")).run()
    assert t.rows("id", "n", RESCUED) == sorted([(None, None, lines[0]), (None, None, lines[1]), ("d", 3, None),
                                                 ("e", None, '{"n":"four"}')], key=str)
    (tmp_path / "u" / "land").mkdir(parents=True)
    (tmp_path / "u" / "land" / "x.json").write_text("\n".join(lines[:3]) + "\n")
    u = Ingest(spark, tmp_path / "u", "json").run()  # inferred: such lines have no say
    assert u.rows("id", "n", RESCUED) == sorted([(None, None, lines[0]), (None, None, lines[1]), ("d", 3, None)], key=str)


def test_list_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    files = list_files(spark, str(tmp_path / "t")).collect()
    assert any(r.file.endswith(".parquet") and r.bytes > 0 for r in files)
