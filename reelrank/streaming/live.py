"""Tables that streams keep: Parquet parts under one commit pointer.

A batch writes its data first, into folders that nobody reads yet, and then one small pointer file that
names the parts of every table. So all tables of a batch become visible together or not at all, and
a reader that has a pointer has a consistent state. The pointer also holds the last batch of every run (a checkpoint), so
a batch that comes again is left out, and a run with a new checkpoint goes on with the
tables of the one before.

Appended parts are folded: FOLD parts of one level become one part of the next. A read so opens at most
FOLD - 1 parts of each level, about FOLD * log(batches) in all, and each row is rewritten once a level. Keyed tables
lie in buckets instead; an upsert rewrites the buckets it touches.
What no kept pointer names is deleted; a reader may be KEEP - 1 commits behind.

Pointers are created by a rename that fails if the name is taken, so of two writers one wins and the
other starts over from the winner's state. File systems without such a rename (object stores) need
a single writer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.session import concurrently, stage

#: Parts of a level that are folded into one, and pointers that are kept.
FOLD, KEEP = 8, 2

#: The column that says by which commit a row came, where a reader asks for it.
SEQ = "_commit"

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Append:
    """Rows that are added; ``merge`` folds rows of neighbouring parts without changing what
    readers make of them, and may use the column ``_commit``."""

    rows: DataFrame
    merge: Merge


@dataclass(frozen=True)
class Replace:
    """A bounded table that is rewritten: ``fold`` makes the new rows of the old ones (None at first)."""

    fold: Callable[[DataFrame | None], DataFrame]


@dataclass(frozen=True)
class Upsert:
    """Rows by key: ``merge`` of the stored rows and the new ones, which are unique on ``key``.

    The table lies in ``buckets`` by a hash of the key, as first given, and only the buckets of new keys are
    read and rewritten; the files of all others stay as they are.
    """

    rows: DataFrame
    key: str
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    buckets: int = 32


Change = Append | Replace | Upsert


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass
class Pointer:
    """Version, last batch by run, and of each table its schema and parts (level, seq, folder)."""

    version: int = 0
    runs: dict[str, int] = field(default_factory=dict)
    tables: dict[str, dict] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {f"{name}/{p[2]}" for name, t in self.tables.items() for p in t["parts"]}


class Folder:
    """A folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._rename_options = spark.sparkContext._gateway.new_array(
            getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0
        )
        self._root = root
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def names(self, pattern: str) -> list[str]:
        """Paths below the folder that match, from the folder on."""
        depth = pattern.count("/") + 1
        found = self._fs.globStatus(self._at(pattern)) or []
        return ["/".join(str(s.getPath()).split("/")[-depth:]) for s in found]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Writes a whole file under a name that is free, or says that it isn't."""
        waiting = self._at(f"waiting-{uuid.uuid4().hex}")
        out = self._fs.create(waiting, True)
        out.write(bytearray(text.encode()))
        out.close()
        start, end = (self._fs.makeQualified(p) for p in (waiting, self._at(name)))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            start.toUri(), self._conf
        )
        try:
            context.rename(start, end, self._rename_options)
        except Exception as refused:
            if "FileAlreadyExists" not in str(refused):
                raise
            self._fs.delete(waiting, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class LiveTables:
    """Named tables below ``root`` that change together."""

    def __init__(self, spark: SparkSession, root: str, fold: int = FOLD, keep: int = KEEP):
        self.spark, self.root, self.fold, self.keep = spark, root, fold, keep
        self.pointers = Folder(spark, f"{root}/pointers")
        self.data = Folder(spark, f"{root}/data")

    def pointer(self) -> Pointer:
        """The newest state; what is read through it stays as it is."""
        while True:
            names = self.pointers.names("[0-9]*")
            if not names:
                return Pointer()
            try:
                return Pointer(**json.loads(self.pointers.read(max(names))))
            except Exception as gone:
                # Newer pointers came while this one was read.
                if "FileNotFound" not in str(gone):
                    raise

    def read(
        self, name: str, pointer: Pointer | None = None, seq: bool = False
    ) -> DataFrame | None:
        """The rows of a table, None if no batch wrote it; with ``seq`` also the commit of each, ``_commit``."""
        table = (pointer or self.pointer()).tables.get(name)
        return None if table is None else self._rows(name, table, table["parts"], seq)

    def read_keys(
        self, name: str, keys: DataFrame, pointer: Pointer | None = None
    ) -> DataFrame | None:
        """The rows of a keyed table whose key is in the one column of ``keys``.

        Only the folders of the buckets that may hold them are opened.
        """
        table = (pointer or self.pointer()).tables.get(name)
        if table is None:
            return None
        key, buckets = table["key"], table["buckets"]
        wanted = keys.toDF(key).where(F.col(key).isNotNull()).distinct()
        # One row per bucket at most.
        asked = {r["b"] for r in wanted.select(bucket_of(key, buckets).alias("b")).distinct().collect()}
        rows = self._rows(name, table, [p for p in table["parts"] if p[0] in asked], False)
        return rows.join(wanted, key, "left_semi")

    def _rows(self, name: str, table: dict, parts: list, seq: bool) -> DataFrame:
        schema = T.StructType.fromJson(table["schema"])
        if not parts:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(SEQ, F.lit(0).cast("long")) if seq else empty
        base = f"{self.root}/data/{name}"
        folders = [T.StructField("part", T.StringType())]
        if "key" in table:
            folders.append(T.StructField("bucket", T.IntegerType()))
        found = (
            self.spark.read.schema(T.StructType([*schema.fields, *folders]))
            .option("basePath", base)
            .parquet(*(f"{base}/{folder}" for _, _, folder in parts))
        )
        if seq:
            found = found.withColumn(SEQ, F.split_part("part", F.lit("-"), F.lit(2)).cast("long"))
        return found.drop(*(f.name for f in folders))

    def _write(self, name: str, rows: DataFrame, level: int, seq: int, *by: str) -> list:
        folder = f"part={level}-{seq:012d}-{uuid.uuid4().hex}"
        writer = rows.write.partitionBy(*by) if by else rows.write
        writer.parquet(f"{self.root}/data/{name}/{folder}")
        return [level, seq, folder]

    def _upserted(self, name: str, change: Upsert, old: dict | None, seq: int) -> dict:
        buckets = old["buckets"] if old else change.buckets
        new = stage(change.rows, f"{name}-new")
        bucket = bucket_of(change.key, buckets)
        touched = {r["b"] for r in new.select(bucket.alias("b")).distinct().collect()}
        table = {"schema": new.schema.jsonValue(), "key": change.key, "buckets": buckets}
        parts = old["parts"] if old else []
        before = self._rows(name, old or table, [p for p in parts if p[0] in touched], False)
        merged = change.merge(before.select(*new.columns), new).select(*new.columns)
        merged = merged.withColumn("bucket", bucket).repartition("bucket")
        _, _, folder = self._write(name, merged, 0, seq, "bucket")
        rewritten = [[b, seq, f"{folder}/bucket={b}"] for b in sorted(touched)]
        return {**table, "parts": [p for p in parts if p[0] not in touched] + rewritten}

    def _changed(self, name: str, change: Change, now: Pointer, seq: int) -> dict:
        old = now.tables.get(name)
        if isinstance(change, Replace):
            rows = change.fold(None if old is None else self.read(name, now))
            return {"schema": rows.schema.jsonValue(), "parts": [self._write(name, rows, 0, seq)]}
        if isinstance(change, Upsert):
            return self._upserted(name, change, old, seq)
        table = {"schema": change.rows.schema.jsonValue()}
        parts = [*(old["parts"] if old else []), self._write(name, change.rows, 0, seq)]
        while len(parts) >= self.fold and len({p[0] for p in parts[-self.fold :]}) == 1:
            last = parts[-self.fold :]
            columns = change.rows.columns
            merged = change.merge(self._rows(name, table, last, True)).select(*columns)
            parts[-self.fold :] = [self._write(name, merged, last[0][0] + 1, last[-1][1])]
        return {**table, "parts": parts}

    def has(self, run: str, batch: int) -> bool:
        return self.pointer().runs.get(run, -1) >= batch

    def commit(self, run: str, batch: int, changes: dict[str, Change]) -> bool:
        """Applies the changes of a batch as one; False if the run committed that batch before."""
        while True:
            now = self.pointer()
            if now.runs.get(run, -1) >= batch:
                return False
            version = now.version + 1
            names = list(changes)
            work = [
                lambda n=name: self._changed(n, changes[n], now, version) for name in names
            ]
            try:
                written = concurrently(self.spark, *work) if work else []
            except PySparkException:
                # Another writer may have moved on and cleared what this one read.
                if self.pointer().version == now.version:
                    raise
                continue
            tables = {**now.tables, **dict(zip(names, written, strict=True))}
            then = Pointer(version, {**now.runs, run: batch}, tables)
            if self.pointers.write_new(f"{version:012d}", json.dumps(then.__dict__)):
                self._clear(then, now)
                return True

    def _clear(self, *newest: Pointer) -> None:
        """Deletes pointers that are too old and data that no kept one names."""
        versions = sorted(self.pointers.names("[0-9]*"))
        kept = versions[-self.keep :]
        known = {p.version: p for p in newest}
        named: set[str] = set()
        for name in kept:
            pointer = known.get(int(name)) or Pointer(**json.loads(self.pointers.read(name)))
            named |= pointer.folders()
        for name in versions[: -self.keep]:
            self.pointers.delete(name)
        parts = {"/".join(folder.split("/")[:2]) for folder in named}
        for folder in self.data.names("*/part=*"):
            # A part of a version to come may be a batch in the making.
            if folder not in parts and int(folder.split("-")[1]) < newest[0].version:
                self.data.delete(folder)
        for folder in self.data.names("*/part=*/bucket=*"):
            if "/".join(folder.split("/")[:2]) in parts and folder not in named:
                self.data.delete(folder)
