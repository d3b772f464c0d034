"""Keyed tables that a change does not rewrite: merged when read.

A table is a base, split by a hash of its key into one folder per bucket, and the
change sets since.  Applying a change set writes its rows and nothing else.  Readers
take the newest row of each key: change sets are reduced to one row per key, base
rows of those keys are left out by an anti join, and buckets without changes are read
as they are.  ``fold`` rewrites the buckets with enough changes and leaves the files
of all others alone.

What belongs to a table is stated in small numbered version files, one for all tables
of a layer; a version is written beside and renamed to its number, which fails if
the number is taken.  So several tables switch at once, readers see the old state or
the new one, and of two writers the second starts again from the first one's version.
The store must have a rename that does not overwrite (HDFS, local disks).

Rows without a whole key are added and never replaced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.conform import latest
from tidemark.operators.upsert import require_unique
from tidemark.session import file_system

BUCKET = "_bucket"
ATTEMPTS = 20


class ConcurrentChange(RuntimeError):
    """What a change was prepared for is no longer so."""


@dataclass(frozen=True)
class Table:
    """``base`` maps a bucket to its folder; ``changes`` are pairs of a folder and the
    buckets of it that the base has not taken, oldest first."""

    keys: tuple[str, ...]
    buckets: int
    schema: str
    base: dict[str, str] = field(default_factory=dict)
    changes: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def touched(self) -> list[str]:
        return sorted({b for _, buckets in self.changes for b in buckets}, key=int)


@dataclass(frozen=True)
class State:
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """A written change set that no version mentions yet."""

    name: str
    folder: str
    table: Table
    buckets: tuple[str, ...]


class KeyedLayer:
    """The keyed tables below ``root``, a folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", buckets: int = 64):
        self.spark, self.root, self.fmt, self.buckets = spark, root.rstrip("/"), fmt, buckets

    # --- versions ---------------------------------------------------------------

    def state(self) -> State:
        files, folder = file_system(self.spark, f"{self.root}/_versions")
        if not files.exists(folder):
            return State()
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        newest = max((n for n in names if n.endswith(".json") and n[0].isdigit()), default=None)
        if newest is None:
            return State()
        jvm = self.spark.sparkContext._jvm
        stream = files.open(jvm.org.apache.hadoop.fs.Path(folder, newest))
        raw = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        tables = {name: Table(tuple(t["keys"]), t["buckets"], t["schema"], t["base"],
                              tuple((folder, tuple(b)) for folder, b in t["changes"]))
                  for name, t in raw["tables"].items()}
        return State(raw["version"], tables, raw["streams"])

    def _write(self, state: State) -> bool:
        """Write a version; false if its number is taken."""
        jvm = self.spark.sparkContext._jvm
        fs = jvm.org.apache.hadoop.fs
        beside = fs.Path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        final = fs.Path(f"{self.root}/_versions/{state.version:012d}.json")
        files, _ = file_system(self.spark, self.root)
        out = files.create(beside, False)
        out.write(bytearray(json.dumps(asdict(state)), "utf-8"))
        out.close()
        context = fs.FileContext.getFileContext(beside.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(beside), context.makeQualified(final), none)
        except Py4JJavaError as error:
            files.delete(beside, False)
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _commit(self, change: Callable[[State], State | None]) -> State:
        """Write what ``change`` makes of the newest version; again if another writer was
        faster.  ``change`` returns None where nothing is to be done."""
        for _ in range(ATTEMPTS):
            now = self.state()
            then = change(now)
            if then is None:
                return now
            then = replace(then, version=now.version + 1)
            if self._write(then):
                return then
        raise ConcurrentChange(f"{ATTEMPTS} versions were written by others meanwhile")

    # --- reading ----------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return name in self.state().tables

    def read(self, name: str) -> DataFrame:
        return self._rows(self.state().tables[name])

    def _load(self, table: Table, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], table.struct)
        return self.spark.read.schema(table.struct).format(self.fmt).load(folders)

    def _newest(self, table: Table, buckets: Sequence[str]) -> DataFrame:
        """The last row of each key in the change sets."""
        sets = [self._load(table, own).withColumn("_order", F.lit(number))
                for number, (folder, has) in enumerate(table.changes)
                if (own := [f"{folder}/{BUCKET}={b}" for b in has if b in buckets])]
        if len(sets) == 1:
            return sets[0].drop("_order")
        rows = sets[0]
        for more in sets[1:]:
            rows = rows.unionByName(more)
        return latest(rows, table.keys, ["_order"]).drop("_order")

    def _merged(self, table: Table, buckets: Sequence[str]) -> DataFrame:
        newest = self._newest(table, buckets)
        old = self._load(table, [table.base[b] for b in buckets if b in table.base])
        kept = old.join(newest.select(*table.keys), list(table.keys), "left_anti").select(*old.columns)
        return kept.unionByName(newest)

    def _rows(self, table: Table) -> DataFrame:
        touched = table.touched()
        quiet = [folder for bucket, folder in table.base.items() if bucket not in touched]
        if not touched:
            return self._load(table, quiet)
        merged = self._merged(table, touched)
        return self._load(table, quiet).unionByName(merged) if quiet else merged

    # --- changing ---------------------------------------------------------------

    def stage(self, name: str, rows: DataFrame, keys: Sequence[str], check: bool = True) -> Staged:
        """Write a change set (or a first load) without making it part of the table.

        Several rows for one key are refused, by a look at the keys as written.
        """
        table = self.state().tables.get(name) or Table(tuple(keys), self.buckets, rows.schema.json())
        if table.keys != tuple(keys):
            raise ValueError(f"{name} is keyed by {table.keys}")
        if set(table.struct.names) != set(rows.columns):
            raise ValueError(f"the columns of {name} are {table.struct.names}")
        bucket = F.pmod(F.xxhash64(*keys), F.lit(table.buckets)).cast("int")
        folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.struct]
        (rows.select(*typed).withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET))
         .write.format(self.fmt).partitionBy(BUCKET).save(folder))
        files, path = file_system(self.spark, folder)
        written = [s.getPath().getName() for s in files.listStatus(path)]
        buckets = tuple(sorted((n.partition("=")[2] for n in written if n.startswith(BUCKET)), key=int))
        staged = Staged(name, folder, table, buckets)
        if check and buckets:
            try:
                keyed = self._load(table, [f"{folder}/{BUCKET}={b}" for b in buckets]).select(*keys)
                require_unique(keyed.na.drop(subset=list(keys)), keys)
            except Exception:
                self.discard([staged])
                raise
        return staged

    def discard(self, staged: Sequence[Staged]) -> None:
        for one in staged:
            files, path = file_system(self.spark, one.folder)
            files.delete(path, True)

    def commit(self, staged: Sequence[Staged], stream: tuple[str, int] | None = None) -> State:
        """Make staged change sets part of their tables, all of them in one switch.

        ``stream`` names a source and the number of its batch; a batch that is not newer
        than the last one taken of that source is dropped, so replays change nothing.
        """

        def change(now: State) -> State | None:
            if stream and now.streams.get(stream[0], -1) >= stream[1]:
                return None
            tables = dict(now.tables)
            for one in staged:
                table = tables.get(one.name)
                if table is None:
                    base = {b: f"{one.folder}/{BUCKET}={b}" for b in one.buckets}
                    tables[one.name] = replace(one.table, base=base, changes=())
                elif (table.keys, table.buckets, table.schema) != (one.table.keys, one.table.buckets, one.table.schema):
                    raise ConcurrentChange(f"{one.name} was created otherwise meanwhile")
                elif one.buckets:
                    tables[one.name] = replace(table, changes=(*table.changes, (one.folder, one.buckets)))
            streams = now.streams | {stream[0]: stream[1]} if stream else now.streams
            return State(now.version, tables, streams)

        state = self._commit(change)
        used = {folder for t in state.tables.values() for folder, _ in t.changes}
        used |= {folder.rpartition("/")[0] for t in state.tables.values() for folder in t.base.values()}
        self.discard([one for one in staged if one.folder not in used])
        return state

    def upsert(self, name: str, rows: DataFrame, keys: Sequence[str], check: bool = True,
               stream: tuple[str, int] | None = None) -> DataFrame:
        """Create the table, or replace and add rows by key; the last change set wins."""
        self.commit([self.stage(name, rows, keys, check)], stream)
        return self.read(name)

    def upsert_newest(self, name: str, rows: DataFrame, keys: Sequence[str], newest_first: Sequence[str],
                      stream: tuple[str, int] | None = None) -> DataFrame:
        """Upsert in which a row wins only if it is newer by ``newest_first``, then by its
        other columns; NULLs are oldest.  Of the table only the order of the keys that
        arrive is read."""
        rows = latest(rows, keys, newest_first)
        if not self.exists(name):
            return self.upsert(name, rows, keys, check=False, stream=stream)
        # What arrived is used twice below, so it is written first and read back.
        arrived = f"{self.root}/_arrived/{uuid.uuid4().hex}"
        rows.write.format(self.fmt).save(arrived)
        rows = self.spark.read.schema(rows.schema).format(self.fmt).load(arrived)
        others = [f.name for f in sorted(rows.schema, key=lambda f: f.name)
                  if f.name not in keys and f.name not in newest_first
                  and f.dataType.typeName() not in ("map", "variant")]
        rank = F.struct(*[F.col(c) for c in (*newest_first, *others)])
        now = self.read(name).join(rows.select(*keys), list(keys), "left_semi")
        now = now.select(*keys, rank.alias("_now"))
        ranked = rows.withColumn("_new", rank).join(now, list(keys), "left")
        newer = ranked.filter("_now IS NULL OR _new > _now").select(*rows.columns)
        try:
            return self.upsert(name, newer, keys, check=False, stream=stream)
        finally:
            files, path = file_system(self.spark, arrived)
            files.delete(path, True)

    def fold(self, name: str, least_share: float = 0.0) -> list[str]:
        """Rewrite the buckets whose changes have at least ``least_share`` of their base's
        bytes; returns them.  The files of the other buckets stay as they are."""
        table = self.state().tables[name]
        size = lambda folder: (lambda f, p: f.getContentSummary(p).getLength())(*file_system(self.spark, folder))
        changed = {b: sum(size(f"{folder}/{BUCKET}={b}") for folder, has in table.changes if b in has)
                   for b in table.touched()}
        chosen = [b for b, more in changed.items()
                  if b not in table.base or more >= least_share * size(table.base[b])]
        if not chosen:
            return []
        bucket = F.pmod(F.xxhash64(*table.keys), F.lit(table.buckets)).cast("int")
        folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
        (self._merged(table, chosen).withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET))
         .write.format(self.fmt).partitionBy(BUCKET).save(folder))

        def change(now: State) -> State:
            mine = now.tables.get(name)
            if mine is None or mine.changes[:len(table.changes)] != table.changes or mine.base != table.base:
                self.discard([Staged(name, folder, table, ())])
                raise ConcurrentChange(f"{name} was folded by another writer")
            base = mine.base | {b: f"{folder}/{BUCKET}={b}" for b in chosen}
            left = tuple((place, tuple(b for b in has if b not in chosen)) for place, has in table.changes)
            changes = tuple(c for c in left if c[1]) + mine.changes[len(table.changes):]
            return State(now.version, now.tables | {name: replace(mine, base=base, changes=changes)}, now.streams)

        self._commit(change)
        return chosen

    def remove_unused(self, name: str) -> int:
        """Delete the table's folders that the newest version does not mention; to be called
        when no reader of an older version and no writer is left."""
        table = self.state().tables[name]
        used = {folder for folder, _ in table.changes} | {f.rpartition("/")[0] for f in table.base.values()}
        files, path = file_system(self.spark, f"{self.root}/{name}")
        gone = [s.getPath() for s in files.listStatus(path) if f"{self.root}/{name}/{s.getPath().getName()}" not in used]
        for one in gone:
            files.delete(one, True)
        return len(gone)
