"""Token totals kept by signed deltas (operator 1).

Changes of documents (insert, delete, revised count) become signed additions to the totals
of their (source, language, tokenizer version). A batch is aggregated before its shuffle,
its few delta rows are written to a folder of their own, and one entry of the commit log
publishes it under the batch's id. A batch sent again finds its id in the log and changes
nothing; a writer that dies before the entry leaves only an unread folder. Totals are the
sum over published batches; ``compact`` folds them into one entry that covers them.

Null keys are a group of their own, null counts add nothing, an unknown kind of change is
refused, repeated rows count as often as they occur, an empty batch is published as such
(and totals stay as they are); extra columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commit_log import CommitLog
from .words import blocks, runs

KEYS = ("source", "lang", "tokenizer_version")
COMPACTION = "compaction "   # ids of compactions; batches may not take them


def count_words(docs: DataFrame, counters: dict[str, tuple], text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with one column per counter. A counter is (bytes of its
    words, bytes of which a word must hold one, or None)."""
    at = docs.columns.index(text_col)
    names = [c for c in docs.columns if c != text_col and c not in counters]
    schema = T.StructType([f for f in docs.schema.fields if f.name in names] + [T.StructField(c, T.LongType()) for c in counters])

    def count(block, inside, needed):
        starts, ends, bounds = runs(inside[block.data], block.offsets)
        if needed is None:
            return np.diff(bounds)
        at = np.flatnonzero(needed[block.data])
        full = np.searchsorted(at, ends) > np.searchsorted(at, starts)
        return np.diff(np.append(0, np.cumsum(full))[bounds])

    def run(batches):
        for batch in batches:
            counts = {c: [np.zeros(0, np.int64)] for c in counters}
            for block in blocks(batch.column(at)):
                for c, (inside, needed) in counters.items():
                    counts[c].append(count(block, inside, needed))
            yield pa.record_batch([batch.column(c) for c in names] + [pa.array(np.concatenate(n).astype(np.int64)) for n in counts.values()],
                                  names=[*names, *counters])

    return docs.mapInArrow(run, schema)


def changes(rows: DataFrame, kind: str, version: str, count_col: str, old_col: str | None = None) -> DataFrame:
    """Change rows of one kind (``insert``, ``delete`` or ``revise``) for one tokenizer version."""
    return rows.select("source", "lang", F.lit(version).alias("tokenizer_version"), F.lit(kind).alias("kind"),
                       F.col(count_col).cast("long").alias("n_tokens"),
                       (F.col(old_col).cast("long") if old_col else F.lit(None).cast("long")).alias("old_tokens"))


def deltas(changed: DataFrame) -> DataFrame:
    """Signed totals of a batch of changes, one row per key."""
    kind, new, old = F.col("kind"), F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    refused = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(refused.cast("int"))
    tokens = F.when(kind == "insert", new).when(kind == "delete", -new).otherwise(new - old)
    return changed.groupBy(*KEYS).agg(F.sum(docs).alias("docs"), F.sum(tokens).alias("tokens"))


class TokenRollup:
    """Totals under ``root`` (a shared folder)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")

    def commit(self, batch_id: str, changed: DataFrame) -> bool:
        """Add a batch; False (and no change) if a batch of that id was added before."""
        if batch_id.startswith(COMPACTION):
            raise ValueError(f"{batch_id!r}: this id is kept for compactions")
        if batch_id in self.log:
            return False
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        deltas(changed).coalesce(1).write.parquet(path)   # one row per key
        return self.log.publish(batch_id, {"path": path, "covers": []})

    def _live(self) -> tuple[dict[str, dict], int]:
        """The entries that no compaction covers, and the number of the next compaction."""
        ids = self.log.ids()
        entries = {i: self.log.read(i) for i in ids}
        covered = {c for e in entries.values() for c in e["covers"]}
        return {i: e for i, e in entries.items() if i not in covered}, 1 + sum(i.startswith(COMPACTION) for i in ids)

    def _rows(self, live: dict[str, dict]) -> DataFrame:
        paths = [e["path"] for e in live.values()]
        schema = "source string, lang string, tokenizer_version string, docs bigint, tokens bigint"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def totals(self) -> DataFrame:
        """Documents and tokens of every key over all published batches."""
        return self._rows(self._live()[0]).groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))

    def compact(self) -> bool:
        """Fold all published batches into one entry; their ids stay known. Compactions are
        numbered: of two that overlap, the one that publishes second is refused (False, and its
        folder stays unread), so no batch is ever covered twice."""
        live, number = self._live()
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        self._rows(live).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).coalesce(1).write.parquet(path)
        return self.log.publish(f"{COMPACTION}{number:08d}", {"path": path, "covers": sorted(live)})
