"""Helpers shared by the text operators: loading, fold rule, Arrow word batches, scratch tables."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Most bytes of text that a Python helper looks at in one go (a single longer text is a chunk of its own).
CHUNK_BYTES = 2 << 20
# Most bytes of an Arrow batch between Spark and a Python worker, where the session does not say otherwise: Spark
# bounds batches by rows only, and ten thousand long texts are hundreds of megabytes.
ARROW_BYTES = 2 << 20
ROW_GROUP_BYTES = 16 << 20  # of scratch tables
_ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % modulus


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage with files every executor can reach."""
    path = scratch_dir(spark, name)
    # a writer holds a whole row group in memory, outside Spark's accounts
    df.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library's modules to the executors, once per application, so that Python workers find them
    wherever they start."""
    context = spark.sparkContext
    if spark.conf.get(_ARROW_CONF, None) is None:
        spark.conf.set(_ARROW_CONF, str(ARROW_BYTES))
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="strata-modules-")) / "strata_modules.zip"  # read by the driver's file server
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with the library's modules at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def _libc():
    try:
        libc = ctypes.CDLL(None)
        # large arrays are returned to the system when they are freed, not kept in the heap of a reused worker
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        return libc if hasattr(libc, "malloc_trim") else None
    except (OSError, AttributeError):  # another C library
        return None


_LIBC = _libc()


def give_back() -> None:
    """A worker that is reused holds nothing of its last task."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def text_column(spark: SparkSession, make, schema) -> Callable[..., Column]:
    """A column function from texts: only texts go to Python and only answers come back, the other columns stay in
    Spark. ``make()`` is called once a task and returns a function from an Arrow array of texts to an Arrow array."""
    ship(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = make()
        try:
            for texts in batches:
                parts = text_chunks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))
                yield pa.concat_arrays([fn(part.column("text")) for part in parts]) if len(texts) else fn(texts)
        finally:
            del fn  # what the function kept for its task goes first
            give_back()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema)


def heavy_join(rows: DataFrame, table: DataFrame, keys: list[str], n: str, share: int = 1024) -> DataFrame:
    """``rows`` joined with a written table that has one row per key and in column ``n`` the key's number of rows.

    Keys with more than 1 / ``share`` of all rows are joined through a broadcast of fewer than ``share`` rows, so no
    task gets all rows of such a key; all other keys are joined by a shuffle."""
    total = table.agg(F.sum(n)).first()[0] or 0
    heavy = table.filter(F.col(n) * share > total)
    if heavy.isEmpty():
        return rows.join(table, keys)
    heavy = F.broadcast(heavy)
    light = table.filter(F.col(n) * share <= total)
    return rows.join(heavy, keys).unionByName(
        rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys))


def bit_table(cells: DataFrame, bits: int) -> np.ndarray:
    """Packed table (bit c & 7 of byte c >> 3) of the numbers of column ``cell``, all below 2**bits.

    Blocks of 65,536 bits are packed by tasks; the driver gets at most 2**bits / 8 bytes, in at most
    2**(bits - 16) rows."""
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << 16, np.uint8)
        marks[rows["cell"].to_numpy(np.int64) & 0xFFFF] = 1
        return pd.DataFrame({"block": [int(rows["cell"].iloc[0]) >> 16],
                             "packed": [np.packbits(marks, bitorder="little").tobytes()]})

    ship(cells.sparkSession)
    out = np.zeros(max(1 << bits, 1 << 16) >> 3, np.uint8)
    blocks = cells.select("cell").distinct().groupBy(F.shiftright("cell", 16)).applyInPandas(
        pack, "block int, packed binary")
    for r in blocks.collect():
        out[r["block"] << 13:(r["block"] + 1) << 13] = np.frombuffer(r["packed"], np.uint8)
    return out


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts add up to at most ``limit`` bytes."""
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            if int(sizes.sum()) <= limit:
                yield batch
                continue
            start, total = 0, 0
            for i, n in enumerate(sizes.tolist()):
                if total and total + n > limit:
                    yield batch.slice(start, i - start)
                    start, total = i, 0
                total += n
            yield batch.slice(start)
    finally:
        give_back()


def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in one flat array, and per
    text the start of its words in it (one more entry closes the last text).
    ``lower`` maps A-Z only."""
    if texts.offset:  # a copy that begins at 0: string kernels misread some slices
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.values
    offsets = lists.offsets.to_numpy().astype(np.int64)
    if offsets[0] or offsets[-1] != len(flat):
        raise ValueError("words outside the texts")
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        offsets = np.concatenate(([0], np.cumsum(full)))[offsets]
        flat = flat.filter(pa.array(full))
    return flat, offsets


def word_codes(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes into the distinct words of the batch, and those words."""
    enc = flat.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary


def hash_strings(words: pa.Array) -> np.ndarray:
    """64-bit keyed SipHash per word, the same in every process."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.asarray(words.to_pylist(), dtype=object), categorize=False)


def mix(h: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (wraps modulo 2**64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes; with fewer words the
    whole sequence as one; none without words."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.uint64)
    k_eff = min(k, n)
    out = np.full(n - k_eff + 1, np.uint64(k_eff), np.uint64)
    for j in range(k_eff):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j:n - k_eff + 1 + j])
    return out
