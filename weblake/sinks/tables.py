"""Gold tables on parquet: a run merges batches into any number of them and shows all at once.

Under a gold root every table has its folder, and every run writes the partitions it changes
into a folder of its own there (``<table>/run=<number>-<id>/<partitions>``). One small pointer file
(``_runs/<number>.json``) names, for every table, the folder in which each of its partitions lies
now. Writing the next pointer is the single step that makes a run visible: a reader sees all
tables as the old run left them or as the new one did, and a run that fails half way leaves only
folders that nothing names. The pointer has one entry per partition (months here: a few
hundred a table, whatever the size of the data). A run that finds its number taken has lost
to another one and is refused.

A merge rewrites only the partitions it touches: those of the batch's rows and those holding
target rows that the batch matches (a row whose partition value changes leaves its old
partition). Where the partition columns follow from the keys, the batch alone tells them.
A writer may name its run by an epoch: one that was published before changes nothing.

The pointer is created without overwriting. That excludes a second writer where creating a file
is exclusive (HDFS and its like); object stores without it need a single writer at a time. The
last run but one stays readable; what only older runs name is deleted.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.upsert import merge_condition, upsert
from ..session import stage, staging

RUN = "run"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"   # fixed value: Spark's folder name for a null partition value
EMPTY = {"run": 0, "tables": {}, "epochs": {}}


class _Pointers:
    """The pointer files of a gold root."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("_runs").getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def file(self, number: int):
        return self.path(f"_runs/{number:08d}.json")

    def read(self, number: int) -> dict | None:
        """The pointer of a run; None if there is none, or if it is still being written."""
        if not self.fs.exists(self.file(number)):
            return None
        stream = self.fs.open(self.file(number))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def latest(self) -> dict:
        folder = self.path("_runs")
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        for number in sorted((int(n[:-5]) for n in names if n.endswith(".json")), reverse=True):   # two or three files
            state = self.read(number)
            if state:
                return state
        return EMPTY

    def publish(self, state: dict) -> None:
        number = state["run"]
        try:
            out = self.fs.create(self.file(number), False)
        except Exception as exc:
            if self.fs.exists(self.file(number)):
                raise RuntimeError(f"another writer has published run {number}: read the tables and merge again") from exc
            raise
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        self._forget(number - 2, [state, self.read(number - 1)])

    def _forget(self, number: int, kept: list[dict | None]) -> None:
        """Delete an old pointer and the partition folders that no kept run names."""
        old = self.read(number)
        if old:
            used = {f for state in kept if state for f in folders(state)}
            for folder in folders(old) - used:
                self.fs.delete(self.path(folder), True)
            self.fs.delete(self.file(number), False)


def folders(state: dict) -> set[str]:
    """The partition folders of all tables, relative to the root."""
    return {f"{name}/{f}" for name, table in state["tables"].items() for _, f in table["live"]}


def current(spark: SparkSession, root: str) -> dict:
    """What the newest run left: its number, the live folder of every table's partitions, the writers' epochs."""
    return _Pointers(spark, root).latest()


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return name in current(spark, root)["tables"]


def storage_schema(schema: StructType, partition_cols: list[str]) -> StructType:
    """Declared columns plus any partition column not among them (as text)."""
    extra = [StructField(c, StringType(), True) for c in partition_cols if c not in schema.fieldNames()]
    return StructType(list(schema.fields) + extra)


def _scan(spark: SparkSession, base: str, paths: list[str], schema: StructType, names: list[str]) -> DataFrame:
    """Rows of partition folders below ``base`` (partition values as text; a filter on them prunes folders)."""
    full = storage_schema(schema, names)
    if not paths:
        return spark.createDataFrame([], full)
    stored = StructType([f for f in full.fields if f.name not in names] + [StructField(n, StringType()) for n in [RUN, *names]])
    data = spark.read.schema(stored).option("basePath", base).parquet(*paths)
    return data.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in full.fields])


def _same_partition(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names], F.lit(True))


def _literal(value, dtype: str) -> Column:
    """A literal of the column's type; date-times go through text so that no
    time zone (of Python or of the session) shifts them."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def _bounds(keys: list[Column], source: DataFrame, names: list[str]) -> Column:
    """Every key inside the [min, max] that its counterpart has in ``source``: as literal bounds
    these reach the scan, which skips row groups by their statistics."""
    lims = source.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(names)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(names)]).first()
    types = dict(source.dtypes)
    near = [F.lit(False) if lims[f"lo{i}"] is None else k.between(_literal(lims[f"lo{i}"], types[c]), _literal(lims[f"hi{i}"], types[c]))
            for i, (k, c) in enumerate(zip(keys, names))]
    return reduce(lambda a, b: a & b, near)


class Run:
    """The next run of a gold root. Its merges are visible to itself at once, to others when it is published."""

    def __init__(self, spark: SparkSession, root: str, epoch: tuple[str, int] | None = None):
        self.spark, self.root, self.epoch = spark, root.rstrip("/"), epoch
        self._pointers = _Pointers(spark, root)
        self.state = json.loads(json.dumps(self._pointers.latest()))
        self.number = self.state["run"] + 1
        self._folder = f"{RUN}={self.number}-{uuid.uuid4().hex}"

    @property
    def repeated(self) -> bool:
        """This writer's epoch has been published before."""
        return bool(self.epoch) and self.state["epochs"].get(self.epoch[0], -1) >= self.epoch[1]

    def define(self, name: str, schema: StructType, partition_cols: list[str] | None = None, replace: bool = False) -> None:
        """An empty table of ``schema`` if there is none of that name, or always with ``replace`` (drop and recreate)."""
        if replace or name not in self.state["tables"]:
            self.state["tables"][name] = {"schema": schema.jsonValue(), "partition_by": list(partition_cols or []), "live": []}

    def rows(self, name: str, schema: StructType | None = None, keep_partitions: bool = False) -> DataFrame:
        """The table as this run sees it, by its declared schema or a given one."""
        return table_rows(self.spark, self.root, self.state, name, schema, keep_partitions)

    def _write(self, name: str, df: DataFrame, partition_cols: list[str]) -> list:
        """Write rows to the run's folder and return its partitions: [[values, folder], ...]. Rows are first
        rebalanced on the partition columns: AQE then packs small partitions into few files
        and splits a large partition over several tasks (so a hot month never lands on one task)."""
        folder = f"{self._folder}-{uuid.uuid4().hex[:8]}"
        base = f"{self.root}/{name}"
        writer = (df.hint("rebalance", *partition_cols) if partition_cols else df).write
        (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(f"{base}/{folder}")
        if not partition_cols:
            return [[[], folder]]
        depth = len(partition_cols)
        files = self.spark.read.schema(df.schema).parquet(f"{base}/{folder}").inputFiles()
        found = {tuple(f.split("/")[-depth - 1:-1]) for f in files}   # one entry per partition
        return [[[_value(unquote(p)) for p in parts], "/".join([folder, *map(unquote, parts)])] for parts in sorted(found)]

    def replace(self, name: str, df: DataFrame, schema: StructType, partitions: dict[str, Column] | list[str] | None = None) -> None:
        """The table's whole content anew."""
        parts = _expressions(partitions)
        self.define(name, schema, list(parts), replace=True)
        self.state["tables"][name]["live"] = self._write(name, _stored(df, schema, parts), list(parts))

    def replace_partitions(self, name: str, df: DataFrame, schema: StructType, partitions: dict[str, Column] | list[str]) -> None:
        """The partitions that ``df`` has rows for, anew; the others stay."""
        parts = _expressions(partitions)
        self.define(name, schema, list(parts))
        table = self.state["tables"][name]
        if table["partition_by"] != list(parts):
            raise ValueError(f"table {name} is partitioned by {table['partition_by']}, not {list(parts)}")
        written = self._write(name, _stored(df, schema, parts), list(parts))
        new = [x[0] for x in written]
        table["live"] = [x for x in table["live"] if x[0] not in new] + written

    def merge(self, name: str, batch: DataFrame, on: list[str] | str | Column, schema: StructType,
              partitions: dict[str, Column] | list[str] | None = None) -> None:
        """MERGE ``batch`` into the table: update what matches, insert the rest.

        ``on`` is a list of key columns or a condition over ``target`` and ``source`` (see
        :mod:`weblake.operators.upsert`). ``partitions`` maps partition column -> expression over the
        declared columns, or lists declared columns."""
        parts = _expressions(partitions)
        names = list(parts)
        self.define(name, schema, names)
        table = self.state["tables"][name]
        if table["partition_by"] != names:
            if table["live"]:
                raise ValueError(f"table {name} is partitioned by {table['partition_by']}, not {names}")
            table["partition_by"] = names
        with staging(self.spark):
            # the batch is used several times: materialise it once in the shared folder,
            # which also cuts its lineage back to the sources
            src = stage(_stored(batch, schema, parts), "merge-batch")
            if not table["live"]:   # nothing to match
                table["live"] = self._write(name, src, names)
                return
            now = self.rows(name, schema, keep_partitions=True)
            touched = self._touched(now, src, on, parts)
            live = table["live"] if touched is None else [x for x in table["live"] if tuple(x[0]) in touched]
            kept = [x for x in table["live"] if x not in live]
            if not live:   # the batch only brings new partitions
                table["live"] = kept + self._write(name, src, names)
                return
            affected = _scan(self.spark, f"{self.root}/{name}", [f"{self.root}/{name}/{f}" for _, f in live], schema, names)
            table["live"] = kept + self._write(name, upsert(affected, src, on), names)

    def _touched(self, now: DataFrame, src: DataFrame, on, parts: dict[str, Column]) -> set[tuple] | None:
        """Values of the partitions that the batch changes (at most one per live partition and month of
        the batch); None for a table without partitions."""
        names = list(parts)
        if not names:
            return None
        touched = src.select(*names).distinct()
        if not (isinstance(on, (list, tuple)) and _references(src, list(parts.values())) <= set(on)):
            cond = merge_condition(now, src, on)
            source = cond.keyed(src, "source")
            target = now.alias("target").filter(_bounds(cond.target_keys, source, cond.names))
            hit = cond.keyed(target, "target").alias("target").join(source.alias("source"), cond.matches(), "left_semi")
            touched = touched.unionByName(hit.select(*names)).distinct()
        return {tuple(r) for r in touched.collect()}

    def publish(self) -> None:
        self.state["run"] = self.number
        if self.epoch:
            self.state["epochs"][self.epoch[0]] = self.epoch[1]
        self._pointers.publish(self.state)


def _expressions(partitions: dict[str, Column] | list[str] | None) -> dict[str, Column]:
    return dict(partitions) if isinstance(partitions, dict) else {c: F.col(c) for c in partitions or []}


def _value(segment: str) -> str | None:
    """The value in a partition folder's name ``column=value``."""
    text = unquote(segment.split("=", 1)[1])
    return None if text == NULL_FOLDER else text


def _references(df: DataFrame, columns: list[Column]) -> set[str]:
    """Names of the columns that expressions read."""
    plan = df.select(*columns)._jdf.queryExecution().analyzed()
    found, refs = set(), plan.references().iterator()
    while refs.hasNext():
        found.add(refs.next().name())
    return found


def _stored(df: DataFrame, schema: StructType, parts: dict[str, Column]) -> DataFrame:
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return rows.withColumns({n: e.cast("string") for n, e in parts.items()})


def table_rows(spark: SparkSession, root: str, state: dict, name: str, schema: StructType | None = None, keep_partitions: bool = False) -> DataFrame:
    """A table as the run whose pointer ``state`` is left it (see :func:`current`); without a
    ``schema`` by the declared one."""
    table = state["tables"].get(name)
    if table is None and schema is None:
        raise ValueError(f"no table {name} under {root}")
    schema = schema or StructType.fromJson(table["schema"])
    table = table or {"partition_by": [], "live": []}
    base = f"{root.rstrip('/')}/{name}"
    df = _scan(spark, base, [f"{base}/{f}" for _, f in table["live"]], schema, table["partition_by"])
    return df if keep_partitions else df.select(*schema.fieldNames())


@contextmanager
def gold_run(spark: SparkSession, root: str, epoch: tuple[str, int] | None = None):
    """A :class:`Run` that is published when the block ends without an error. Check ``repeated``
    first where an epoch is given; a repeated epoch is not published again."""
    run = Run(spark, root, epoch)
    yield run
    if not run.repeated:
        run.publish()


def define_table(spark: SparkSession, root: str, name: str, schema: StructType | str | dict, partition_cols: list[str] | None = None,
                 replace: bool = False) -> None:
    """A run that only defines a table, from a schema or a schema document (text, dict or path)."""
    from ..schemas import schema_from_json
    with gold_run(spark, root) as run:
        run.define(name, schema if isinstance(schema, StructType) else schema_from_json(schema), partition_cols, replace)


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | None = None, keep_partitions: bool = False) -> DataFrame:
    """Scan a table as the newest run left it, by its declared schema or a given one (partition values
    stay text). Partition columns that are not declared columns are dropped unless asked for."""
    return table_rows(spark, root, current(spark, root), name, schema, keep_partitions)


def merge_into(spark: SparkSession, root: str, name: str, batch: DataFrame, on: list[str] | str | Column, schema: StructType,
               partitions: dict[str, Column] | list[str] | None = None, epoch: tuple[str, int] | None = None) -> dict:
    """A run that merges one batch into one table (see :meth:`Run.merge`). Returns the newest run's
    number, and whether the batch was applied."""
    with gold_run(spark, root, epoch) as run:
        if run.repeated:
            return {"run": run.number - 1, "applied": False}
        run.merge(name, batch, on, schema, partitions)
    return {"run": run.number, "applied": True}


def append_text_lines(lines: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Append one-column text rows under ``path`` (optionally ``year=/month=`` folders). Rows are
    rebalanced on the folders: few files each, and a large folder is written by several tasks."""
    if partition_cols:
        lines = lines.hint("rebalance", *partition_cols)
    writer = lines.write.mode("append")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.text(path)


def write_table(df: DataFrame, path: str, partition_cols: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write plain parquet files. Overwriting replaces the whole table, not only the partitions
    that ``df`` has rows for, whatever the session's partition overwrite mode."""
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
