"""Tables as Parquet folders under one root, made visible by a commit manifest."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager, suppress

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.operators.keys import assign_surrogate_key
from clinloom.sources.manifest import CommitRefused, Manifest, State
from clinloom.sources.tables import TABLES, Table

# Each commit's rows of a table lie in a partition of their own.
_COMMIT = "_commit"
_LAST = "last key"
# A folder that no commit names and Spark's name of the partition without a value: an empty
# file there tells the columns to those who query the folder.
_DECLARED = "declared"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Warehouse:
    """Reads, appends to and recreates the tables of one folder.

    Rows count once their commit is in the manifest. An append is a commit of its own;
    within ``transaction`` all appends become visible together or not at all.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest = Manifest(spark, self.root)
        # Rows of the last append to each table that break a declared rule, by rule.
        self.broken: dict[str, dict[str, int]] = {}
        self._staged: list[str] = []
        self._open: State | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """Publish all that is written inside at the end; an error leaves nothing of it to see.

        Reads inside see the state at the beginning and what was written since. Where another
        writer has published in between, ``CommitRefused`` is raised. Inside another
        transaction this one is a part of it.
        """
        if self._open:
            yield
            return
        self._open = self.manifest.newest()
        try:
            before = self._open.copy()
            yield
            if self._open != before:
                self.manifest.publish(self._open)
        finally:
            self._open = None

    def _state(self) -> State:
        return self._open or self.manifest.newest()

    def read(self, name: str) -> DataFrame:
        """The committed rows of a table with its fixed schema; empty where nothing was written yet."""
        table = TABLES[name]
        schema = T.StructType(list(table.schema.fields))
        if not table.derived:
            commits = self._state().commits.get(name)
            if not commits:
                return self.spark.createDataFrame([], table.schema)
            schema.add(_COMMIT, T.StringType())
        try:
            rows = self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], table.schema)
        if not table.derived:
            rows = rows.where(F.col(_COMMIT).isin(commits))
        return rows.select(*table.schema.names)

    def last_key(self, name: str) -> int | None:
        """The largest surrogate key given in a table so far, as the manifest tells; no rows are read."""
        return self._state().last_keys.get(name)

    def recreate(self, name: str) -> None:
        """Drop the rows of a table and leave it empty."""
        with self.transaction():
            if TABLES[name].derived:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
                files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
                declared = self._declared(name) in self._folders(name)
                files.delete(folder, True)
                if declared:
                    self._declare(name)
            self._open.commits.pop(name, None)
            self._open.last_keys.pop(name, None)

    def recreate_all(self) -> None:
        with self.transaction():
            for name in TABLES:
                self.recreate(name)

    def append(self, name: str, rows: DataFrame, order: list[str] | None = None, stable: bool = False) -> None:
        """Append rows, filling the surrogate key and the time stamp.

        ``order`` gives the order the key follows; ``stable`` says the rows come
        straight from files (see ``assign_surrogate_key``).
        """
        table = TABLES[name]
        with self.transaction():
            rows = conform(self._with_key(name, table, rows, order, stable), table)
            commit, numbers = uuid.uuid4().hex, table.identity[0] if table.identity else table.numbers
            # The pass that writes the rows tells the key the next append goes on from and checks the rows.
            wanted = observed_rules(table)
            if numbers:
                wanted[_LAST] = F.max(numbers)
            seen = self._write(table, rows, f"{self.path(name)}/{_COMMIT}={commit}", observed=wanted)
            self._open.commits.setdefault(name, []).append(commit)
            if (last := seen.pop(_LAST, None)) is not None:
                self._open.last_keys[name] = max(last, self._open.last_keys.get(name, last))
            self.broken[name] = {rule: n for rule, n in seen.items() if n}

    def replace_partitions(self, name: str, rows: DataFrame) -> None:
        """Write rows of a derived table over the partitions they belong to, leaving the others."""
        self._write(TABLES[name], conform(rows, TABLES[name]), self.path(name), "overwrite")

    def declare(self) -> None:
        """Give every table a folder with an empty file and the warehouse a manifest, where they have none."""
        if not self.manifest.newest().version:
            with suppress(CommitRefused):  # then another writer has just made one
                self.manifest.publish(State())
        for name in TABLES:
            if self._declared(name) not in self._folders(name):
                self._declare(name)

    def _declared(self, name: str) -> str:
        table = TABLES[name]
        return f"{table.partition_by[0]}={_NO_VALUE}" if table.derived else f"{_COMMIT}={_DECLARED}"

    def _declare(self, name: str) -> None:
        table = TABLES[name]
        inner = table.partition_by[1:] if table.derived else table.partition_by
        folder = "/".join([self.path(name), self._declared(name), *[f"{c}={_NO_VALUE}" for c in inner]])
        stored = [f for f in table.schema if f.name not in table.partition_by]
        self.spark.createDataFrame([], T.StructType(stored)).coalesce(1).write.mode("overwrite").parquet(folder)

    def _folders(self, name: str) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []

    def remove_unpublished(self) -> None:
        """Delete the rows of commits that the manifest doesn't hold. No writer may be at work."""
        commits = self.manifest.newest().commits
        fs = self.spark._jvm.org.apache.hadoop.fs
        for name, table in TABLES.items():
            folder = fs.Path(self.path(name))
            files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if table.derived or not files.exists(folder):
                continue
            for status in files.listStatus(folder):
                if status.getPath().getName().removeprefix(f"{_COMMIT}=") not in [_DECLARED, *commits.get(name, [])]:
                    files.delete(status.getPath(), True)

    def stage(self, rows: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
        """Write rows once under the root, in folders of the columns ``by``, and read them back."""
        path = f"{self.root}/_staging/{label}-{uuid.uuid4().hex}"
        (rows.write.partitionBy(*by) if by else rows.write).parquet(path)
        self._staged.append(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def stage_counted(
        self, rows: DataFrame, label: str, counts: Mapping[str, Column], without: tuple[str, ...] = ()
    ) -> tuple[DataFrame, dict[str, int]]:
        """``stage``, and the ``counts`` over all rows, taken by the pass that writes them.

        The columns ``without`` are counted only and not written. What is counted is
        counted where a task writes, so a task that runs again counts once.
        """
        seen = Observation()
        observed = rows.observe(seen, *[c.alias(n) for n, c in counts.items()]).drop(*without)
        staged = self.stage(observed, label)
        return staged, {n: seen.get.get(n) or 0 for n in counts}

    def drop_staged(self) -> None:
        """Delete what this object has staged; nothing made of it may be read after."""
        files = self.spark._jvm.org.apache.hadoop.fs
        for folder in self._staged:
            path = files.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._staged.clear()

    def _with_key(self, name, table: Table, rows: DataFrame, order, stable) -> DataFrame:
        if table.identity is None or table.identity[0] in rows.columns:
            return rows
        key, seed = table.identity
        last = self.last_key(name)
        start = seed if last is None else last + 1
        return assign_surrogate_key(rows, order or rows.columns[:1], start, key, stable=stable)

    def _write(
        self, table: Table, rows: DataFrame, path: str, mode: str = "append",
        observed: Mapping[str, Column] | None = None,
    ) -> dict[str, int]:
        # Rebalancing lets Spark cut hot partitions and join small ones, so the
        # files have an even size whatever the keys look like. Rows that just
        # got a surrogate key are evenly partitioned already.
        if table.rebalance and not table.identity:
            rows = rows.hint("rebalance", *table.partition_by)
        seen = Observation()
        if observed:
            # Behind the shuffle: what is counted there counts once, also where a task runs again.
            rows = rows.observe(seen, *[c.alias(n) for n, c in observed.items()])
        writer = rows.write.mode(mode)
        if table.partition_by:
            writer = writer.partitionBy(*table.partition_by).option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
        return dict(seen.get) if observed else {}


def observed_rules(table: Table) -> dict[str, Column]:
    """Numbers of rows that break a declared rule, for the pass that writes them (``not null x``, ``length x``).

    Unique keys need a shuffle of their own; ``check_table`` has them, and the rows that break a rule.
    """
    nulls = {f"not null {c}": F.count_if(F.col(f"`{c}`").isNull()) for c in table.required}
    longs = {f"length {c}": F.count_if(F.length(f"`{c}`") > n) for c, n in table.lengths.items()}
    return {**nulls, **longs}


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """The table's columns in order and type; absent ones NULL or the load time."""
    present = {c.lower() for c in rows.columns}

    def value(field):
        if field.name.lower() in present:
            return F.col(f"`{field.name}`")
        return F.current_timestamp() if field.name == table.stamp else F.lit(None)

    return rows.select(
        *[value(f).cast(f.dataType).alias(f.name) for f in table.schema]
    )
