"""Incremental file ingestion on the open-source file stream source.

The stream of a ``FileSource`` carries the *names* of the files that arrived, not
their rows: every micro-batch is a list of files that the checkpoint has frozen
(a replayed batch gets the same list). ``read`` turns such a list into rows. The
schema is reconciled there, from exactly the files it will read, so no file can
arrive between the look at the schemas and the reading. It adds what a plain
``readStream`` lacks:

* a persisted schema per flow (the first batch infers it, later ones reuse it);
* schema hints (DDL) that override inferred types or add columns;
* schema evolution: unseen columns, and unseen fields of structs, are appended,
  nullable; old rows read back as NULL there. An inference that fails stops the
  run, and its batch is tried again;
* rescued data: what does not fit the schema is kept, as a JSON object of text
  values, in ``_rescued_data``. In JSON files these are values of unknown keys or
  of another type than the declared one; a line that is not exactly one JSON
  object (cut lines, text after the object, repeated keys) is kept there as it
  is. In Parquet and the other formats files are grouped by their own schemas,
  each group is cast to the flow's types, and a value that a cast would lose or
  change is kept there. The column appears with the first file that needs it.

A rerun without new files writes nothing. No file is too old: ``maxFileAge`` is
``NO_FILE_TOO_OLD``.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import create_text, path_exists
from ..schemas import SOURCE_FILE
from ..session import COMPRESSION

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"  # Spark's inference adds it when a line is no JSON
# by default the file source skips files a week older than the newest one
NO_FILE_TOO_OLD = "36500d"
FILES_PER_BATCH = 10_000  # names of one micro-batch that the driver holds
FOOTER_THREADS = 16
# JSON keeps full microsecond timestamps: written with micros (and the offset
# for zoned values), read back with the fraction and the offset optional.
JSON_TS_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
JSON_TS_READ_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
_LISTING = "path string, modificationTime timestamp, length long, content binary"
_STORE_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("schema", T.StringType()),
    T.StructField("inferred_until", T.StringType()),
])


class SchemaStore:
    """Versioned schema of one flow, kept as small JSON entries beside its checkpoint."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")

    def load(self) -> tuple[int, T.StructType, str] | None:
        if not path_exists(self.spark, self.location):
            return None
        rows = (self.spark.read.schema(_STORE_SCHEMA).json(self.location)
                .orderBy(F.col("version").desc()).limit(1).collect())
        if not rows:
            return None
        r = rows[0]
        return r["version"], T.StructType.fromJson(json.loads(r["schema"])), r["inferred_until"]

    def save(self, version: int, schema: T.StructType, inferred_until: str) -> None:
        entry = {"version": version, "schema": schema.json(), "inferred_until": inferred_until}
        if not create_text(self.spark, f"{self.location}/s{version:010d}.json", json.dumps(entry) + "\n"):
            raise RuntimeError(f"schema version {version} of {self.location} was written by another run")


# ------------------------------------------------------------------ schemas
def apply_hints(schema: T.StructType, hints: str | T.StructType | None) -> T.StructType:
    """Hinted fields take the hinted type; hinted fields not in ``schema`` are added."""
    if not hints:
        return schema
    hinted = T.StructType.fromDDL(hints) if isinstance(hints, str) else hints
    by_name = {f.name: f for f in hinted.fields}
    fields = [T.StructField(f.name, by_name[f.name].dataType, True) if f.name in by_name else f
              for f in schema.fields]
    present = {f.name for f in schema.fields}
    fields += [T.StructField(f.name, f.dataType, True) for f in hinted.fields if f.name not in present]
    return T.StructType(fields)


def widen(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Keep old fields and types; append fields seen only in ``new`` as nullable, inside structs too."""
    if old is None:
        return new
    seen = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        other = seen.get(f.name)
        if other is not None and isinstance(f.dataType, T.StructType) and isinstance(other.dataType, T.StructType):
            f = T.StructField(f.name, widen(f.dataType, other.dataType), f.nullable, f.metadata)
        fields.append(f)
    names = {f.name for f in old.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in names])


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type of a column whose first files disagree: the wider of two integer types, double for other numbers, text
    for anything else."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _agreed(a, b)
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _agreed(a: T.StructType, b: T.StructType) -> T.StructType:
    other = {f.name: f.dataType for f in b.fields}
    out = [T.StructField(f.name, common_type(f.dataType, other.get(f.name, f.dataType)), True) for f in a.fields]
    return widen(T.StructType(out), b)


def _shape(t: T.DataType) -> str:
    return t.simpleString()


def fit(value: Column, own: T.DataType, wanted: T.DataType) -> tuple[Column, Column]:
    """(the value as ``wanted``, whether something of it is lost by that). A cast must give the value back."""
    if _shape(own) == _shape(wanted):
        return value, F.lit(False)
    if isinstance(own, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name: f.dataType for f in own.fields}
        parts, lost = [], F.lit(False)
        for f in wanted.fields:
            if f.name in have:
                part, bad = fit(value.getField(f.name), have[f.name], f.dataType)
                lost = lost | bad
            else:
                part = F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        for name in have.keys() - set(wanted.fieldNames()):
            lost = lost | value.getField(name).isNotNull()
        return F.when(value.isNotNull(), F.struct(*parts)), F.coalesce(lost, F.lit(False))
    complex_types = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    if isinstance(own, complex_types) or isinstance(wanted, complex_types):
        if isinstance(wanted, T.StringType):
            return F.to_json(value), F.lit(False)
        if not (isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType)):
            return F.lit(None).cast(wanted), value.isNotNull()
    as_wanted = value.try_cast(wanted)
    back = as_wanted.try_cast(own)
    lost = value.isNotNull() & ~back.eqNullSafe(value)
    return F.when(~lost, as_wanted), lost


def _as_text(value: Column, own: T.DataType) -> Column:
    if isinstance(own, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return F.base64(value) if isinstance(own, T.BinaryType) else value.cast("string")


def aligned(rows: DataFrame, own: T.StructType, wanted: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (of schema ``own``) with the columns of ``wanted``, then ``extra`` columns, then ``_rescued_data`` if
    something of ``rows`` may not fit."""
    have = {f.name: f.dataType for f in own.fields}
    columns, rescued = [], []
    for f in wanted.fields:
        if f.name == RESCUED:
            continue
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, lost = fit(rows[f"`{f.name}`"], have[f.name], f.dataType)
        columns.append(value.alias(f.name))
        if _shape(have[f.name]) != _shape(f.dataType):
            rescued.append((f.name, lost))
    for name in have:
        if name not in wanted.fieldNames() and name != RESCUED:
            rescued.append((name, rows[f"`{name}`"].isNotNull()))
    columns += [F.col(c) for c in extra]
    if rescued:
        empty = F.create_map().cast("map<string,string>")
        found = F.map_concat(empty, *[
            F.when(lost, F.create_map(F.lit(n), _as_text(rows[f"`{n}`"], have[n]))).otherwise(empty)
            for n, lost in rescued])
        columns.append(F.when(F.size(found) > 0, F.to_json(found)).alias(RESCUED))
    elif RESCUED in wanted.fieldNames():
        columns.append(F.lit(None).cast("string").alias(RESCUED))
    return rows.select(*columns)


# ------------------------------------------------------------------ source
@dataclass
class FileSource:
    path: str
    fmt: str
    schema_location: str
    hints: str | T.StructType | None = None
    evolve: bool = True
    rescue: bool = True  # off: JSON misfits become NULL, misfits of other formats stop the run
    max_files_per_trigger: int | None = FILES_PER_BATCH
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None  # declared schema: no inference, no evolution
    infer_options: dict[str, str] = field(default_factory=dict)  # e.g. {"samplingRatio": "0.1"} for JSON

    def _reader(self, spark: SparkSession):
        options = {**(JSON_TS_READ_OPTIONS if self.fmt == "json" else {}), **self.options}
        return spark.read.format(self.fmt).options(**options)

    def files(self, spark: SparkSession) -> DataFrame:
        """Streaming DataFrame of the files that arrived (path and bytes; no content is read)."""
        return (spark.readStream.format("binaryFile").schema(_LISTING).option("maxFileAge", NO_FILE_TOO_OLD)
                .option("maxFilesPerTrigger", str(self.max_files_per_trigger or FILES_PER_BATCH))
                .load(self.path).select("path", "length"))

    def read(self, files: DataFrame) -> DataFrame:
        """Rows of the files of one micro-batch in the flow's schema, with ``_source_file``."""
        spark = files.sparkSession
        paths = sorted(r["path"] for r in files.select("path").collect())  # the batch's own files
        groups = self.groups(spark, paths)
        schema = self.resolve_schema(spark, [g for g, _ in groups])
        if self.fmt == "json":
            return self._json(spark, paths, schema)
        parts = []
        for own, members in groups:
            rows = self._reader(spark).schema(own).load(_literal(members)).select(
                "*", F.col("_metadata.file_path").alias(SOURCE_FILE))
            parts.append(aligned(rows, own, schema, (SOURCE_FILE,)))
        if not self.rescue and any(RESCUED in p.columns for p in parts):
            raise ValueError(f"files under {self.path} do not fit the schema {schema.simpleString()}")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def _json(self, spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
        source = F.col("_metadata.file_path").alias(SOURCE_FILE)
        if not self.rescue:
            return self._reader(spark).schema(schema).load(_literal(paths)).select("*", source)
        lines = spark.read.format("text").load(_literal(paths))
        # the hidden file metadata is gone after the parse, so resolve the path here
        return lines.select(parse_json_with_rescue(F.col("value"), schema).alias("_r"), source
                            ).select("_r.*", SOURCE_FILE)

    # -------------------------------------------------------------- schema
    def _infer(self, spark: SparkSession, paths: list[str]) -> T.StructType:
        reader = self._reader(spark).options(**self.infer_options)
        if self.fmt == "json" and self.rescue:  # lines that are rescued whole have no say
            lines = spark.read.text(_literal(paths)).filter(is_json_object(F.col("value")))
            strings = getattr(lines._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
            schema = T.StructType.fromJson(json.loads(reader._jreader.json(strings).schema().json()))
        else:
            if self.fmt == "parquet":
                reader = reader.option("mergeSchema", "true")
            schema = reader.load(_literal(paths)).schema
        return T.StructType([f for f in schema.fields if f.name != CORRUPT])

    def groups(self, spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
        """Files of one schema each. Mostly the files agree (one parallel job finds out); only where their types
        contradict each other, each file's own schema is looked at."""
        if not paths:
            return []
        if self.fmt == "json" and self.schema is not None:
            return [(self.schema, paths)]
        try:
            return [(self._infer(spark, paths), paths)]
        except Exception:  # noqa: BLE001 - contradicting types; an unreadable file fails again below
            if len(paths) == 1:
                raise
        with ThreadPoolExecutor(FOOTER_THREADS) as pool:
            schemas = list(pool.map(lambda p: self._infer(spark, [p]), paths))
        found: dict[str, tuple[T.StructType, list[str]]] = {}
        for schema, path in zip(schemas, paths):
            found.setdefault(schema.json(), (schema, []))[1].append(path)
        return list(found.values())

    def resolve_schema(self, spark: SparkSession, found: list[T.StructType]) -> T.StructType:
        """Stored schema, widened by the schemas of the files at hand, hints applied; saved if it changed."""
        if self.schema is not None:
            return self.schema
        store = SchemaStore(spark, self.schema_location)
        stored = store.load()
        if stored is not None and not self.evolve:
            return stored[1]
        if not found and stored is None:
            raise ValueError(f"no files to infer a schema from under {self.path}")
        schema = stored[1] if stored else None
        if schema is None:
            schema = found[0]
            for other in found[1:]:
                schema = _agreed(schema, other)
        for other in found:
            schema = widen(schema, other)
        schema = apply_hints(schema, self.hints)
        if stored is None or schema != stored[1]:
            now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")
            store.save(0 if stored is None else stored[0] + 1, schema, now)
        return schema


def _literal(paths: list[str]) -> list[str]:
    """The paths with the signs of file name patterns quoted."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


# ------------------------------------------------------------------ JSON lines
def is_json_object(text: Column) -> Column:
    """The whole text is one JSON object without repeated keys (NULL text: false).

    A parser stops after the first value, so the text is read as the first of two members of an array; the second
    one is made from the text's own hash, and must come next and last."""
    mark = F.hex(F.xxhash64(text))
    whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    ends = F.try_variant_get(whole, "$[1]", "string") == mark
    alone = F.try_variant_get(whole, "$[2]", "variant").isNull()
    return F.coalesce(F.ltrim(F.translate(text, "\t\r\n", "   ")).startswith("{") & ends & alone, F.lit(False))


def parse_json_with_rescue(text: Column, schema: T.StructType) -> Column:
    """Struct of ``schema`` fields plus ``_rescued_data``: a JSON object of the keys that are not in the schema or
    whose value could not be cast; the whole text, and no fields, where it is not one JSON object."""
    data_fields = [f for f in schema.fields if f.name != RESCUED]
    whole = F.when(is_json_object(text), text)
    typed = F.from_json(whole, T.StructType(data_fields), JSON_TS_READ_OPTIONS)
    raw = F.from_json(whole, T.MapType(T.StringType(), T.StringType()))
    known = F.array(*[F.lit(f.name) for f in data_fields])
    unknown = F.map_filter(raw, lambda k, v: ~F.array_contains(known, k))
    # a declared non-string field whose raw value is present but did not parse
    bad = [F.when(raw[f.name].isNotNull() & typed[f.name].isNull(),
                  F.create_map(F.lit(f.name), raw[f.name]))
           for f in data_fields if not isinstance(f.dataType, T.StringType)]
    empty = F.create_map().cast("map<string,string>")
    rescued = F.map_concat(unknown, *[F.coalesce(b, empty) for b in bad]) if bad else unknown
    cols = [typed[f.name].alias(f.name) for f in data_fields]
    cols.append(F.when(whole.isNull() & (F.trim(text) != ""), text)
                .when(F.size(rescued) > 0, F.to_json(rescued)).alias(RESCUED))
    return F.struct(*cols)


# ------------------------------------------------------------------ landing
def write_landing(df: DataFrame, path: str, fmt: str = "parquet", max_rows: int = 0) -> None:
    """Append files to a landing folder (no ``coalesce(1)``: parallel writers); ``max_rows`` of a file, if given."""
    df.write.mode("append").format(fmt).option("maxRecordsPerFile", max_rows).options(
        **{"json": JSON_TS_OPTIONS, "parquet": {"compression": COMPRESSION}}.get(fmt, {})).save(path)


def write_json_lines(df: DataFrame, path: str, merge_json_col: str | None = None) -> None:
    """Append JSON lines; ``merge_json_col`` (a JSON-object string column) is
    spliced into each record as top-level keys."""
    body = df.drop(merge_json_col) if merge_json_col else df
    line = F.to_json(F.struct(*[F.col(c) for c in body.columns]), JSON_TS_OPTIONS)
    if merge_json_col:
        extra = F.regexp_replace(F.trim(F.col(merge_json_col)), r"^\{\s*|\s*\}$", "")
        line = F.when(F.length(extra) > 0,
                      F.concat(F.expr("substring(_line, 1, length(_line) - 1)"), F.lit(","), extra, F.lit("}"))
                      ).otherwise(F.col("_line"))
        out = df.select(F.to_json(F.struct(*[F.col(c) for c in body.columns]), JSON_TS_OPTIONS).alias("_line"),
                        F.col(merge_json_col)).select(line.alias("value"))
    else:
        out = df.select(line.alias("value"))
    out.write.mode("append").text(path)


def list_files(spark: SparkSession, path: str, strip: str | None = None) -> DataFrame:
    """Recursive listing: file, size and modification time (content is not read)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_replace("path", strip, "") if strip else F.col("path")
    return df.select(name.alias("file"), F.col("length").alias("bytes"), "modificationTime")
