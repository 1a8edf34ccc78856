"""Session settings and the shared working folder.

The library never builds its own session inside a query: the caller passes one
in. ``local_session`` exists for tests and the benchmark only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

COMPRESSION = "zstd"  # of the library's Parquet files: about a quarter smaller than Spark's default
SORTED_BYTES = 24 << 20  # shuffled bytes of a task that sorts: five to six times that in memory
SHUFFLED_TO_STORED = 6  # bytes shuffled, at most about, of a byte of a Parquet table

# Settings every job of the library relies on. AQE re-plans joins from measured
# shuffle sizes (broadcast only when the measured side is under the threshold,
# split skewed partitions otherwise); RocksDB keeps streaming state off-heap.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(app: str = "strata", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 2 waves of tasks) so no shuffle partition outgrows
    executor memory; AQE then coalesces small ones to the advisory size and
    splits skewed ones. Example: 100 TB on 1000 executors x 8 cores gives
    about 780k partitions before coalescing, scans split at 128 MB."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_recommended_conf(spark: SparkSession) -> None:
    """Set the runtime-modifiable recommended settings that are still unset."""
    for k, v in RECOMMENDED_CONF.items():
        if k.endswith("providerClass"):
            continue  # only effective before the first stateful query; leave to the caller
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def session_with(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A second session of the application with the settings of ``spark`` and those of ``conf``: scans planned in it
    follow them, and neither ``spark`` nor its concurrent queries see a change."""
    other = spark.newSession()
    for k, v in {**spark.conf.getAll, **conf}.items():
        if other.conf.isModifiable(k):
            other.conf.set(k, v)
    return other


@contextmanager
def small_footprint(spark: SparkSession, input_bytes: int = 0) -> Iterator[None]:
    """Queries planned inside leave little on disk. They remove their shuffle files as they end (otherwise a run of
    many steps holds those of all its steps until the driver happens to collect its garbage). Tasks after a shuffle
    take about ``SORTED_BYTES``, so that they sort in memory (``input_bytes``: of the Parquet tables behind them, for as
    many partitions as that needs)."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    jvm, size = spark._jvm, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) > SORTED_BYTES:
        wanted[size] = f"{SORTED_BYTES}b"
    needed = -(-SHUFFLED_TO_STORED * input_bytes // SORTED_BYTES)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        wanted["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(needed)
    kept = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in kept.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the operator (a folder every executor can
    reach). Only when it is unset — local tests — a fresh temporary folder is
    created and registered as the checkpoint dir of the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared root for one run of a flow."""
    return f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
