"""The source schema that a flow was last started with, and what changed since.

A flow over a table starts with the table's latest schema. The log keeps one
small entry per schema the flow has seen, beside its checkpoint, with the
columns that were added, dropped or retyped:

* an added column is taken over;
* a dropped column stays in the flow's schema (older commits may still bring
  values), newer rows have NULL there;
* a retyped column stops the flow, because rows it has not read yet have the old
  type: the caller drains the old rows, then accepts the change.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import create_text, path_exists
from ..sources.files import widen

ADDED, DROPPED, RETYPED = "added", "dropped", "retyped"
_ENTRY = ("entry long, schema string, "
          "changes array<struct<change:string,column:string,old:string,new:string>>")


class SourceRetyped(RuntimeError):
    """A column of the source has another type than the flow was last started with."""


@dataclass(frozen=True)
class Change:
    change: str
    column: str
    old: str | None
    new: str | None


def compare(old: T.StructType, new: T.StructType) -> list[Change]:
    """Columns that differ, in the order of ``old``, then the added ones."""
    was, now = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (old, new))
    out = [Change(DROPPED if c not in now else RETYPED, c, t, now.get(c)) for c, t in was.items() if now.get(c) != t]
    return out + [Change(ADDED, c, None, t) for c, t in now.items() if c not in was]


class SchemaLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> DataFrame:
        """entry, schema (JSON), changes: one row per schema the flow has seen."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).json(self.root)

    def changes(self) -> DataFrame:
        """entry, change, column, old, new: one row per changed column."""
        return self.entries().select("entry", F.explode("changes").alias("c")).select("entry", "c.*")

    def track(self, current: T.StructType, accept_retyped: bool = False) -> T.StructType:
        """The schema to read the source with; a change is logged, a retyped column raises unless accepted."""
        last = self.entries().orderBy(F.desc("entry")).limit(1).collect()
        if not last:
            self._save(0, current, [])
            return current
        old = T.StructType.fromJson(json.loads(last[0]["schema"]))
        found = compare(old, current)
        retyped = [c for c in found if c.change == RETYPED]
        if retyped and not accept_retyped:
            raise SourceRetyped(", ".join(f"{c.column}: {c.old} -> {c.new}" for c in retyped))
        schema = widen(current, old)  # dropped columns stay
        news = [c for c in found if c.change != DROPPED or c.column not in self._dropped()]
        if news:
            self._save(last[0]["entry"] + 1, schema, news)
        return schema

    def _dropped(self) -> set[str]:
        """Columns that an entry already logs as dropped."""
        return {r["column"] for r in self.changes().filter(F.col("change") == DROPPED).select("column").collect()}

    def _save(self, entry: int, schema: T.StructType, changes: list[Change]) -> None:
        text = json.dumps({"entry": entry, "schema": schema.json(), "changes": [c.__dict__ for c in changes]})
        if not create_text(self.spark, f"{self.root}/e{entry:010d}.json", text + "\n"):
            raise RuntimeError(f"schema entry {entry} of {self.root} was written by another run")
