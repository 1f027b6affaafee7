"""Parquet tables below one root folder, replaced whole partitions at a time.

Layout: ``{root}/{schema}/{table}/{partition=value}/...``. Paths go through Hadoop's file system, so
any storage that Spark can write to will do.

Tables of the ``PUBLISHED`` schemas are written, audited and then published together. A write puts
whole partitions into a folder of its run, ``{table}/run=.../{partition=value}``, beside what is
there. A commit, one small file in ``{root}/_commits``, says of every published table which run's
folder each partition is in. Readers take the last commit; until a run's commit is there, and if its
checks fail, all tables are as they were.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable, Collection, Iterable, Iterator
from contextlib import contextmanager
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_SCHEMA_FILE = "_schema.json"
Partition = dict[str, str | None]
PUBLISHED = ("marts", "states")
# Commits that may still be read: older folders are removed.
KEPT_COMMITS = 3


class Tables:
    """Tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        # The commit under way: its number, its run, and the state it will publish.
        self._open: tuple[int, str, dict] | None = None

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"

    def exists(self, schema: str, table: str) -> bool:
        """True once a write has been completed, or published."""
        if schema in PUBLISHED:
            return f"{schema}.{table}" in self._state()
        return _exists(self.spark, f"{self.path(schema, table)}/{_SCHEMA_FILE}")

    def schema(self, schema: str, table: str) -> T.StructType:
        """As written; files of an empty table do not exist, and folder names have no types."""
        if not self.exists(schema, table):
            raise FileNotFoundError(f"no table {schema}.{table} in {self.root}")
        if schema in PUBLISHED:
            return T.StructType.fromJson(self._state()[f"{schema}.{table}"]["schema"])
        text = read_text(self.spark, f"{self.path(schema, table)}/{_SCHEMA_FILE}")
        return T.StructType.fromJson(json.loads(text))

    def read(self, schema: str, table: str) -> DataFrame:
        if schema in PUBLISHED:
            return self._read_published(schema, table)
        return self.spark.read.schema(self.schema(schema, table)).parquet(self.path(schema, table))

    def partitions(
        self, schema: str, table: str, first: Collection[str] | None = None
    ) -> list[Partition]:
        """Values of the partition folders, from a listing; reads no data.

        With ``first`` only folders of these values of the first partition column are listed.
        """
        if schema in PUBLISHED:
            found = [_values(p) for p in self._state().get(f"{schema}.{table}", {"parts": {}})["parts"] if p]
            return [p for p in found if first is None or next(iter(p.values())) in first]
        path = self.path(schema, table)
        if not _exists(self.spark, path):
            return []
        return [p for p, _ in _partitions(self.spark, path, first)]

    def first_values(self, schema: str, table: str) -> set[str | None]:
        """Values of the first partition column; folders below are not listed."""
        if schema in PUBLISHED:
            return {next(iter(p.values())) for p in self.partitions(schema, table)}
        path = self.path(schema, table)
        return {v for _, v, _ in _subfolders(self.spark, path)} if _exists(self.spark, path) else set()

    def dates(self, schema: str, table: str, column: str) -> set[date]:
        values = {p[column] for p in self.partitions(schema, table)}
        return {date.fromisoformat(v) for v in values if v is not None}

    def overwrite(
        self, df: DataFrame, schema: str, table: str, partition_by: Iterable[str] = (), rebalance: bool = True
    ) -> int:
        """Replace the table and return its number of rows. Without ``rebalance`` the tasks are those of ``df``."""
        if schema in PUBLISHED:
            return self._write_published(df, schema, table, list(partition_by), lambda _: True)
        rows, _ = _write(df, self.path(schema, table), list(partition_by), dynamic=False, rebalance=rebalance)
        return rows

    def replace_partitions(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        partition_by: Iterable[str],
        in_scope: Callable[[Partition], bool],
        first: Collection[str] | None = None,
        rebalance: bool = True,
    ) -> int:
        """Replace exactly the partitions ``in_scope`` by the rows of ``df``.

        ``df`` holds all rows these partitions shall have and must not read this table. Partitions
        for which it has no rows are removed. Running it again gives the same table. ``first`` says
        which values of the first partition column can be in scope, to list no other folders.
        """
        path, keys = self.path(schema, table), list(partition_by)
        if schema in PUBLISHED:
            return self._write_published(df, schema, table, keys, in_scope)
        if not self.exists(schema, table):
            return self.overwrite(df, schema, table, keys, rebalance)
        rows, written = _write(df, path, keys, dynamic=True, rebalance=rebalance)
        for values, folder in _partitions(self.spark, path, first):
            # A folder whose partitions are all gone has the first values only.
            key = tuple(values.get(k) for k in keys)
            if in_scope(values) and key not in written:
                _delete(self.spark, folder)
        return rows

    def register(self, schema: str, table: str, database: str | None = None) -> DataFrame:
        """Make the table known as ``database.table``, by default ``schema.table``, and return it.

        A table of that name with its data elsewhere is not ours and is left alone: an error.
        """
        database = database or schema
        name, path = f"`{database}`.`{table}`", self.path(schema, table)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{schema}'")
        if self.spark.catalog.tableExists(f"{database}.{table}"):
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
            location = _qualified(self.spark, described.filter("col_name = 'Location'").first()["data_type"])
            ours = _qualified(self.spark, path)
            if location != ours and not location.startswith(f"{ours}/run="):
                raise ValueError(f"{database}.{table} already exists at {location}")
        if schema in PUBLISHED:
            self._register_published(name, schema, table)
        else:
            partitioned = bool(self.partitions(schema, table))
            if not self.spark.catalog.tableExists(f"{database}.{table}"):
                known = {} if partitioned else {"schema": self.schema(schema, table)}
                self.spark.catalog.createTable(f"{database}.{table}", path=path, source="parquet", **known)
            if partitioned:
                self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(f"{database}.{table}")
        return self.spark.table(f"{database}.{table}")

    @contextmanager
    def publishing(self) -> Iterator[None]:
        """Publish what is written inside as one commit when it ends; nothing of it if it fails.

        Inside, reads see what has been written. Of two runs at a time the second to end fails.
        """
        if self._open:
            raise RuntimeError("a commit is under way")
        number, state = self._last_commit()
        self._open = (number + 1, uuid.uuid4().hex, copy.deepcopy(state))
        try:
            yield
            self._commit()
        except BaseException:
            self._discard()
            raise
        finally:
            self._open = None

    def number_under_way(self) -> int:
        """Number of the commit that is being prepared."""
        return self._open[0]

    def replaced(self, schema: str, table: str) -> tuple[DataFrame, DataFrame]:
        """Partitions of the last commit that the one under way replaces: as they were, and as they
        will be. A table that was not published before has none."""
        new = self._open[2][f"{schema}.{table}"]
        old = self._last_commit()[1].get(f"{schema}.{table}", {"schema": new["schema"], "parts": {}})
        changed = [p for p, run in old["parts"].items() if new["parts"].get(p) != run]
        still = [p for p in changed if p in new["parts"]]
        return self._read_version(schema, table, old, changed), self._read_version(schema, table, new, still)

    def commits(self) -> list[int]:
        """Numbers of the commits there are, oldest first."""
        return sorted(int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in list_files(self.spark, f"{self.root}/_commits/*.json"))

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/_commits/{number:010}.json"

    def _last_commit(self) -> tuple[int, dict]:
        numbers = self.commits()
        return (numbers[-1], json.loads(read_text(self.spark, self._commit_path(numbers[-1])))) if numbers else (0, {})

    def _state(self) -> dict:
        return self._open[2] if self._open else self._last_commit()[1]

    def _commit(self) -> None:
        number, _, state = self._open
        text = json.dumps(state)
        # created, not replaced: a number is given once
        write_text(self.spark, self._commit_path(number), text, overwrite=False)
        for old in self.commits()[:-KEPT_COMMITS]:
            _delete(self.spark, self._commit_path(old))
        self._remove_unused()

    def _discard(self) -> None:
        _, run, state = self._open
        for name in state:
            _delete(self.spark, f"{self.path(*name.split('.', 1))}/run={run}")

    def _remove_unused(self) -> None:
        """Delete partitions that no commit that is kept refers to."""
        kept = [json.loads(read_text(self.spark, self._commit_path(n))) for n in self.commits()]
        for name in kept[-1]:
            path = self.path(*name.split(".", 1))
            used = {f"run={run}/{part}".rstrip("/") for state in kept for part, run in state.get(name, {"parts": {}})["parts"].items()}
            runs = {u.split("/", 1)[0] for u in used}
            for folder in _folders(self.spark, path):
                run = folder.rsplit("/", 1)[1]
                if run not in runs:
                    _delete(self.spark, folder)
                elif run not in used:
                    for _, leaf in _partitions(self.spark, folder):
                        if f"{run}/{leaf.split(f'/{run}/', 1)[1]}" not in used:
                            _delete(self.spark, leaf)

    def _read_published(self, schema: str, table: str) -> DataFrame:
        entry = self._state()[f"{schema}.{table}"]
        return self._read_version(schema, table, entry, entry["parts"])

    def _read_version(self, schema: str, table: str, entry: dict, parts: Iterable[str]) -> DataFrame:
        """These partitions as one commit's entry has them."""
        written = T.StructType.fromJson(entry["schema"])
        path = self.path(schema, table)
        # one path per date: as many as the calendar has
        paths = [f"{path}/run={entry['parts'][part]}/{part}".rstrip("/") for part in parts]
        if not paths:
            return self.spark.createDataFrame([], written)
        run = T.StructField("run", T.StringType())
        rows = self.spark.read.schema(T.StructType([*written.fields, run])).option("basePath", path).parquet(*paths)
        return rows.select(*written.names)

    def _write_published(
        self, df: DataFrame, schema: str, table: str, keys: list[str], in_scope: Callable[[Partition], bool]
    ) -> int:
        if not self._open:
            with self.publishing():
                return self._write_published(df, schema, table, keys, in_scope)
        _, run, state = self._open
        folder = f"{self.path(schema, table)}/run={run}"
        if _exists(self.spark, folder):
            raise RuntimeError(f"{schema}.{table} is written twice in one commit")
        rows, _ = _write(df, folder, keys, dynamic=False)
        entry = state.setdefault(f"{schema}.{table}", {"schema": None, "keys": keys, "parts": {}})
        kept = {p: r for p, r in entry["parts"].items() if keys and not in_scope(_values(p))}
        new = [f.split(f"/run={run}/", 1)[1] for _, f in _partitions(self.spark, folder)] if keys else [""]
        entry |= {"schema": df.schema.jsonValue(), "parts": kept | dict.fromkeys(new, run)}
        return rows

    def _register_published(self, name: str, schema: str, table: str) -> None:
        """Declared anew, as its partitions are where the last commit says; no data is touched."""
        entry = self._state()[f"{schema}.{table}"]
        path, fields = self.path(schema, table), T.StructType.fromJson(entry["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parts = list(entry["parts"].items())
        location = path if entry["keys"] else f"{path}/run={parts[0][1]}"
        by = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in entry['keys'])})" if entry["keys"] else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{location}'")
        for at in range(0, len(parts) if entry["keys"] else 0, 500):
            added = " ".join(
                f"PARTITION ({', '.join(f'`{k}` = ' + _literal(v) for k, v in _values(p).items())}) LOCATION '{path}/run={r}/{p}'"
                for p, r in parts[at : at + 500]
            )
            self.spark.sql(f"ALTER TABLE {name} ADD {added}")


def _values(part: str) -> Partition:
    """Values of a partition's path, ``column=value/...``."""
    pairs = (x.split("=", 1) for x in part.split("/"))
    return {k: None if v == NULL_PARTITION else unquote(v) for k, v in pairs}


def _literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _write(
    df: DataFrame, path: str, keys: list[str], dynamic: bool, rebalance: bool = True
) -> tuple[int, set[tuple[str | None, ...]]]:
    """Write, and report the rows and the partitions written.

    The rebalance lets adaptive execution join small and cut large partitions, so a date holding
    much of the data is written by many tasks and a small one as few files.
    """
    if keys and rebalance:
        df = df.hint("rebalance", *keys)
    observed = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if keys:
        # One entry per partition folder, not per row.
        metrics.append(F.collect_set(F.struct(*[_as_text(k) for k in keys])).alias("folders"))
    df = df.observe(observed, *metrics)
    writer = df.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if dynamic else "static"
    )
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    write_text(df.sparkSession, f"{path}/{_SCHEMA_FILE}", df.schema.json())
    result = observed.get
    return result["rows"], {tuple(v or None for v in f) for f in result.get("folders") or ()}


def _as_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("")).alias(key)


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _qualified(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    return fs.makeQualified(at).toString()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, at = file_system(spark, path)
    out = fs.create(at, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of runs below a table."""
    fs, at = file_system(spark, path)
    found = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()] if fs.exists(at) else []
    return [p.toString() for p in found if p.getName().startswith("run=")]


def _partitions(
    spark: SparkSession, path: str, first: Collection[str] | None = None
) -> list[tuple[Partition, str]]:
    """Leaf partition folders, depth first; stops at folders that hold files only."""
    found = []
    for column, value, folder in _subfolders(spark, path):
        if first is not None and value not in first:
            continue
        below = _partitions(spark, folder)
        found += [({column: value, **v}, f) for v, f in below] or [({column: value}, folder)]
    return found


def _subfolders(spark: SparkSession, path: str) -> list[tuple[str, str | None, str]]:
    """Column, value and path of the partition folders directly below."""
    fs, at = file_system(spark, path)
    found = []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if not status.isDirectory() or "=" not in name or name.startswith((".", "_")):
            continue
        column, text = name.split("=", 1)
        value = None if text == NULL_PARTITION else unquote(text)
        found.append((column, value, status.getPath().toString()))
    return found


def list_files(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Size of each file matching a glob, by path."""
    fs, at = file_system(spark, pattern)
    found = {s.getPath().toString(): s.getLen() for s in fs.globStatus(at) or () if s.isFile()}
    return dict(sorted(found.items()))
