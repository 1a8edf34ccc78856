"""Flows: source stream -> transform -> versioned table, drained and stopped.

A flow is ``extract -> transform -> load`` with its own checkpoint. It runs
with ``availableNow``: everything that arrived since the last run is processed
(bounded micro-batches if the source sets ``maxFilesPerTrigger``), then the
query stops. The sink is ``foreachBatch`` into a ``VersionedTable``; each
micro-batch becomes one commit keyed by its batch id, so a batch replayed
after a failure overwrites its own commit and nothing is written twice.

Append flows add commits; complete flows (streaming aggregates) replace the
table with the full aggregate of each batch — the aggregation state lives in
the checkpoint, so only the new input is read on each run.

A flow may restart with a wider source schema on the same checkpoint. Changing
a stateful part (the keys of a streaming dedup, the grouping or aggregates of
a streaming aggregate) needs a new checkpoint folder. Sink-side dedup keeps
no state, so its keys may change between runs.
"""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import RuleCounts
from ..session import small_footprint
from ..tables.buckets import BucketedAggregate
from ..tables.versioned import VersionedTable

log = logging.getLogger(__name__)


@dataclass
class Flow:
    name: str
    source: Callable[[SparkSession], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    target: VersionedTable | BucketedAggregate
    checkpoint: str
    mode: str = "append"  # "append" | "complete" | "update"
    after: Callable[[SparkSession], None] | None = None  # e.g. compaction / clustering
    depends_on: tuple[str, ...] = ()  # names of flows whose tables this flow reads
    merge_keys: tuple[str, ...] | None = None  # append only rows with unseen keys (see insert_new)
    merge_order: tuple[str, ...] | None = None  # reproducible winner within a micro-batch (merge_keys)
    merge_period: str | None = None  # a time among merge_keys: only stored keys of its periods are read
    # rows that passed the sink's de-duplication (and the whole micro-batch) -> rows to store (merge_keys)
    finish: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    expand: Callable[[DataFrame], DataFrame] | None = None  # rows of a micro-batch of file names (FileSource.read)
    batchwise: bool = False  # ``transform`` runs on each micro-batch as a plain DataFrame, not on the stream
    rules: Mapping[str, str] | None = None  # counted on the input of each micro-batch (batchwise flows)
    counts: RuleCounts | None = None  # where the counts go

    def tag(self) -> str:
        return "s" + hashlib.sha1(self.checkpoint.encode()).hexdigest()[:10]


def run_flow(spark: SparkSession, flow: Flow, once: bool = True) -> StreamingQuery:
    """Start the flow, wait until the available input is processed, run ``after``."""
    t0 = time.perf_counter()
    before = flow.target.version()
    write = flow.target.batch_writer(flow.mode, flow.tag(), flow.merge_keys, flow.merge_order, flow.merge_period,
                                     flow.finish)
    if flow.expand is None and not flow.batchwise:
        df, sink = flow.transform(flow.source(spark)), write
    else:
        df = flow.source(spark)

        def sink(batch: DataFrame, batch_id: int) -> None:
            rows = flow.expand(batch) if flow.expand else batch
            write(flow.transform(rows), batch_id)
            if flow.counts is not None:
                flow.counts.record(f"{flow.tag()}-{batch_id:012d}", rows, flow.rules or {})
    writer = (
        df.writeStream.queryName(f"{flow.name}_{flow.tag()}")
        .outputMode(flow.mode)
        .option("checkpointLocation", flow.checkpoint)
        .foreachBatch(sink)
    )
    writer = writer.trigger(availableNow=True) if once else writer
    query = writer.start()
    if once:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        t1 = time.perf_counter()
        # maintenance only after a run that committed something new
        if flow.after is not None and flow.target.version() != before:
            flow.after(spark)
        log.info("flow %s: run %.2fs, maintenance %.2fs, version %s -> %s", flow.name, t1 - t0,
                 time.perf_counter() - t1, before, flow.target.version())
    return query


def dependency_levels(flows: Sequence[Flow]) -> list[list[Flow]]:
    """Group flows into levels: every flow depends only on earlier levels."""
    names = {f.name for f in flows}
    done: set[str] = set()
    pending = list(flows)
    levels: list[list[Flow]] = []
    while pending:
        ready = [f for f in pending if all(d in done or d not in names for d in f.depends_on)]
        if not ready:
            raise ValueError(f"dependency cycle among {[f.name for f in pending]}")
        levels.append(ready)
        done |= {f.name for f in ready}
        pending = [f for f in pending if f.name not in done]
    return levels


def run_pipeline(spark: SparkSession, flows: Sequence[Flow], parallel: bool = True) -> list[StreamingQuery]:
    """Run flows in dependency order. Flows of one level are independent and,
    with ``parallel``, run as concurrent queries so small flows share the
    cluster instead of leaving it idle. A failure stops the pipeline before
    any dependent flow runs, so a downstream stream never reads an upstream
    commit folder that was written but not yet published; the next run
    replays the failed batch into the same folder first."""
    queries: list[StreamingQuery] = []
    with small_footprint(spark):
        for level in dependency_levels(flows):
            if not parallel or len(level) == 1:
                queries += [run_flow(spark, f) for f in level]
                continue
            with ThreadPoolExecutor(max_workers=len(level)) as pool:
                futures = [pool.submit(run_flow, spark, f) for f in level]
                queries += [fut.result() for fut in futures]
    return queries


def stop_all(spark: SparkSession) -> int:
    """Stop every active streaming query of the session; returns how many."""
    active = list(spark.streams.active)
    for q in active:
        q.stop()
    return len(active)
