"""A keyed table with versions, kept as plain parquet folders.

``rows/_version=N``   the changes of commit N
``base/_base=N``      the whole table at version N (first load, replacement, or a later fold)
``log/_version=N``    one row describing commit N or the base at N; written last

A large base lies in hash buckets of its keys, so that joins with changes, feeds and other versions never
shuffle it, however many keys have changed: only the other side is dealt out, into the same buckets.

A commit is visible once its log row is written. What a lost job left behind belongs to no
listed version, is ignored by readers and replaced by the next commit. There is one writer
at a time; no isolation between writers is offered.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators import changelog as cl
from strandline.operators import layout
from strandline.operators.layout import TARGET_BYTES
from strandline.session import new_folder
from strandline.tables import PARTITION_BYTES, dataset_bytes, plan_bytes, sized_shuffles

LOG_SCHEMA = (
    "_version bigint, kind string, operation string, committed timestamp, columns string, keys string, "
    "whole boolean, floor boolean, source_path string, source_version bigint, stream string, batch bigint, buckets int"
)
# A base of more than this is kept in hash buckets of its keys, each of about as much.
BUCKET_BYTES = PARTITION_BYTES
MINIMUM_RETENTION = timedelta(days=7)


class SchemaMismatch(ValueError):
    """The rows do not fit the table's columns."""


class KeyViolation(ValueError):
    """A key is NULL, or one commit would change a key twice."""


class TableExists(ValueError):
    """There is a table at this path already."""


class VersionNotReadable(ValueError):
    """The version does not exist, or retention has passed it."""


def _moment(at: datetime) -> Column:
    """A point in time; without a zone of its own it is a wall time of the session's zone."""
    return F.lit(at) if at.tzinfo else F.lit(at.isoformat(sep=" ")).cast("timestamp")


@dataclass(frozen=True)
class Snapshot:
    """What is needed to read one version."""

    version: int
    head: int
    base: int
    schema: T.StructType
    keys: list[str]
    source_path: str | None
    source_version: int | None
    last_whole: int
    batch: int | None = None
    buckets: int | None = None


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- making tables ---------------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        rows: DataFrame,
        keys: Sequence[str],
        at: datetime | None = None,
        check_keys: bool = True,
    ) -> VersionedTable:
        """Version 0: the first load, possibly without rows."""
        table = cls(spark, path)
        table._refuse_existing()
        buckets = table._write_base(0, rows, keys, check_keys)
        table._log(0, "commit", "CREATE", at, rows.schema, keys, whole=True, floor=True, buckets=buckets)
        return table

    def _refuse_existing(self) -> None:
        try:
            self.snapshot()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        raise TableExists(self.path)

    def clone(self, path: str, version: int | None = None, at: datetime | None = None) -> VersionedTable:
        """A new table that starts from a version of this one without copying its rows."""
        snapshot = self.snapshot(version)
        copy = VersionedTable(self.spark, path)
        copy._refuse_existing()
        copy._log(
            0, "commit", "CLONE", at, snapshot.schema, snapshot.keys, whole=True, floor=True,
            source_path=self.path, source_version=snapshot.version,
        )
        return copy

    # -- reading ---------------------------------------------------------------------

    def _base_path(self, version: int) -> str:
        return f"{self.path}/base/_base={version}"

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")

    def snapshot(
        self, version: int | None = None, as_of: datetime | None = None, stream: str | None = None
    ) -> Snapshot:
        """Resolve a version number, a point in time, or (without either) the newest version.

        Aggregates over the log; a single row reaches the driver. What a write needs to know besides comes
        from the same pass: the last whole commit, and the last batch of a ``stream``.
        """
        log = self.log()
        is_commit = F.col("kind") == "commit"
        if as_of is not None:
            version = (
                log.where(is_commit & (F.col("committed") <= _moment(as_of))).agg(F.max("_version")).first()[0]
            )
            if version is None:
                raise VersionNotReadable(f"no version at {as_of}")
        upto = F.lit(True) if version is None else F.col("_version") <= version
        found = log.agg(
            F.max(F.when(is_commit, F.col("_version"))).alias("head"),
            F.max(F.when(F.col("floor"), F.col("_version"))).alias("floor"),
            F.max(F.when(F.col("whole") & upto, F.col("_version"))).alias("base"),
            F.max_by("columns", F.when(is_commit & upto, F.col("_version"))).alias("columns"),
            F.max("keys").alias("key_names"),
            F.max("source_path").alias("source_path"),
            F.max("source_version").alias("source_version"),
            F.max(F.when(is_commit & F.col("whole"), F.col("_version"))).alias("last_whole"),
            F.max(F.when(F.col("stream") == F.lit(stream), F.col("batch"))).alias("batch"),
            F.max_by("buckets", F.when(F.col("whole") & upto, F.col("_version"))).alias("buckets"),
        ).first()
        wanted = found.head if version is None else version
        if not 0 <= wanted <= found.head:
            raise VersionNotReadable(f"no version {wanted}, the newest is {found.head}")
        if wanted < found.floor:
            raise VersionNotReadable(f"version {wanted} is gone, the oldest kept is {found.floor}")
        return Snapshot(
            wanted,
            found.head,
            found.base,
            T.StructType.fromJson(json.loads(found.columns)),
            found.key_names.split(","),
            found.source_path,
            found.source_version,
            found.last_whole,
            found.batch,
            found.buckets,
        )

    def changes(self, after: int, upto: int, schema: T.StructType) -> DataFrame:
        """Changes of the versions after ``after`` up to and including ``upto``.

        The folders are named one by one, however many there are: the planner sees the size of these
        commits only, and a commit whose folder is missing is an error, never a gap. Folds keep
        the range that a read of the newest version needs short.
        """
        fields = T.StructType(
            [T.StructField(f.name, f.dataType) for f in schema.fields]
            + [T.StructField(cl.OP, T.StringType()), T.StructField(cl.VERSION, T.LongType())]
        )
        if upto <= after:
            return self.spark.createDataFrame([], fields)
        paths = [f"{self.path}/rows/_version={v}" for v in range(after + 1, upto + 1)]
        return self.spark.read.schema(fields).option("basePath", f"{self.path}/rows").parquet(*paths)

    def _base(self, snapshot: Snapshot, schema: T.StructType) -> DataFrame:
        if snapshot.base == 0 and snapshot.source_path is not None:
            rows = VersionedTable(self.spark, snapshot.source_path).read(snapshot.source_version)
            added = [f for f in schema.fields if f.name not in rows.columns]
            return rows.select(
                "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added]
            ).select(*schema.names)
        path = self._base_path(snapshot.base)
        if snapshot.buckets:
            return self.spark.table(self._bucketed(path, schema, snapshot.keys, snapshot.buckets))
        return self.spark.read.schema(schema).parquet(path)

    def _bucketed(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> str:
        """The name under which the session's catalog knows the files of a base as buckets.

        Files alone do not say that they are buckets, so each session enters them once, as an external table.
        """
        columns = self.spark.createDataFrame([], schema)._jdf.schema().toDDL()
        name = "buckets_" + hashlib.sha256(f"{path}|{columns}|{keys}|{buckets}".encode()).hexdigest()[:32]
        quoted, place = ", ".join(f"`{k}`" for k in keys), path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({quoted}) SORTED BY ({quoted}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return name

    def _state(self, snapshot: Snapshot, only: DataFrame | None = None) -> DataFrame:
        """The rows of a version; with ``only`` those whose key is among these, where that saves a shuffle of the base."""
        base = self._base(snapshot, snapshot.schema)
        if only is not None and snapshot.buckets:
            kinds = {k: snapshot.schema[k].dataType for k in snapshot.keys}  # another type would hash to another bucket
            only = only.select(*(F.col(k).cast(t).alias(k) for k, t in kinds.items())).repartition(snapshot.buckets, *kinds)
            base = base.join(only, list(snapshot.keys), "left_semi")
        if snapshot.version == snapshot.base:
            return base
        changes = self.changes(snapshot.base, snapshot.version, snapshot.schema)
        if only is not None and snapshot.buckets:
            changes = changes.join(only, list(snapshot.keys), "left_semi")
        return cl.as_of(base, changes, snapshot.keys, snapshot.version - snapshot.base, snapshot.buckets)

    def read(
        self, version: int | None = None, as_of: datetime | None = None, only: DataFrame | None = None
    ) -> DataFrame:
        """The rows of a version; with ``only`` those whose key is among the keys of that frame."""
        snapshot = self.snapshot(version, as_of)
        if only is None:
            return self._state(snapshot)
        return self._state(snapshot, only).join(only.select(*snapshot.keys).distinct(), list(snapshot.keys), "left_semi")

    def commit_rows(self, version: int) -> DataFrame:
        """The changes of one commit, as written."""
        snapshot = self.snapshot(version)
        if self._whole_commits().where(F.col(cl.VERSION) == version).first() is not None:
            return cl.inserted(self._state(snapshot))
        return self.changes(version - 1, version, snapshot.schema).drop(cl.VERSION)

    def _whole_commits(self) -> DataFrame:
        """Versions whose commit was the whole table rather than changes to it."""
        return self.log().where((F.col("kind") == "commit") & F.col("whole")).select(cl.VERSION)

    def history(self) -> DataFrame:
        """One row per commit: operation, time and changed rows. The rows of a clone's source count as none."""
        snapshot = self.snapshot()
        none = F.lit(0).cast("bigint")
        counts = []
        if snapshot.head > 0:
            counts.append(cl.change_counts(self.changes(0, snapshot.head, snapshot.schema)))
        own = F.col(cl.VERSION) > (-1 if snapshot.source_path is None else 0)  # version 0 of a clone has no rows here
        written = self._whole_commits().where(own)
        if not written.isEmpty():
            bases = self.spark.read.schema("_base bigint").parquet(f"{self.path}/base")
            sizes = bases.groupBy(F.col("_base").alias(cl.VERSION)).agg(F.count(F.lit(1)).alias("inserted"))
            counts.append(
                sizes.join(written, cl.VERSION, "left_semi").select("*", none.alias("updated"), none.alias("deleted"))
            )
        out = self.log().where(F.col("kind") == "commit").select(cl.VERSION, "operation", "committed")
        if not counts:
            return out.select("*", none.alias("inserted"), none.alias("updated"), none.alias("deleted"))
        both = counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1])
        return out.join(both, cl.VERSION, "left").na.fill(0, ["inserted", "updated", "deleted"])

    # -- writing ---------------------------------------------------------------------

    def _log(
        self,
        version: int,
        kind: str,
        operation: str,
        at: datetime | None,
        schema: T.StructType,
        keys: Sequence[str],
        whole: bool = False,
        floor: bool = False,
        source_path: str | None = None,
        source_version: int | None = None,
        stream: str | None = None,
        batch: int | None = None,
        buckets: int | None = None,
    ) -> None:
        when = F.current_timestamp() if at is None else _moment(at)
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(kind).alias("kind"),
            F.lit(operation).alias("operation"),
            when.alias("committed"),
            F.lit(schema.json()).alias("columns"),
            F.lit(",".join(keys)).alias("keys"),
            F.lit(whole).alias("whole"),
            F.lit(floor).alias("floor"),
            F.lit(source_path).cast("string").alias("source_path"),
            F.lit(source_version).cast("bigint").alias("source_version"),
            F.lit(stream).cast("string").alias("stream"),
            F.lit(batch).cast("bigint").alias("batch"),
            F.lit(buckets).cast("int").alias("buckets"),
        )
        row.write.mode("overwrite").parquet(f"{self.path}/log/_version={version}/entry={kind}")

    @staticmethod
    def _check_keys(rows: DataFrame, keys: Sequence[str]) -> None:
        """Refuse NULL keys and keys that occur twice. Reads the key columns only."""
        missing = F.lit(False)
        for k in keys:
            missing = missing | F.col(k).isNull()
        worst = (
            rows.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n").alias("n"), F.max(missing).alias("missing"))
            .first()
        )
        if worst.missing:
            raise KeyViolation(f"NULL in key {list(keys)}")
        if worst.n is not None and worst.n > 1:
            raise KeyViolation(f"one commit changes a key of {list(keys)} {worst.n} times")

    def _write_base(
        self, version: int, rows: DataFrame, keys: Sequence[str], check_keys: bool, dealt: int | None = None
    ) -> int | None:
        """Write a base and say in how many buckets, if any; ``dealt`` rows lie in so many already."""
        path, size = self._base_path(version), plan_bytes(rows)
        buckets = dealt or (math.ceil(size / BUCKET_BYTES) if size > BUCKET_BYTES else None)
        if buckets:
            # The write goes through the catalog, which is how Spark writes buckets; the entry is the one that reads use.
            name = self._bucketed(path, rows.schema, keys, buckets)
            rows = rows if dealt else rows.repartition(buckets, *keys)
            writer = rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
            writer.option("path", path).saveAsTable(name)
            written = self.spark.table(name)
        else:
            with sized_shuffles(rows):
                rows.write.mode("overwrite").parquet(path)
            written = self.spark.read.schema(rows.schema).parquet(path)
        if check_keys:
            self._check_keys(written, keys)
        return buckets

    def _commit(
        self,
        head: Snapshot,
        rows: DataFrame,
        operation: str,
        at: datetime | None,
        schema: T.StructType | None = None,
        check_keys: bool = False,
        stream: str | None = None,
        batch: int | None = None,
    ) -> int:
        version = head.head + 1
        folder = f"{self.path}/rows/_version={version}"
        with sized_shuffles(rows):
            rows.write.mode("overwrite").parquet(folder)
        if check_keys:
            self._check_keys(self.spark.read.schema(rows.schema).parquet(folder), head.keys)
        self._log(
            version, "commit", operation, at, schema or head.schema, head.keys, stream=stream, batch=batch
        )
        return version

    def _fitted(self, rows: DataFrame, head: Snapshot, evolve: bool) -> tuple[DataFrame, T.StructType]:
        """Rows with the table's columns and types, and the schema after the write."""
        known = {f.name: f for f in head.schema.fields}
        extra = [f for f in rows.schema.fields if f.name not in known]
        if extra and not evolve:
            raise SchemaMismatch(f"columns {[f.name for f in extra]} are not in the table")
        absent = [k for k in head.keys if k not in rows.columns]
        if absent:
            raise SchemaMismatch(f"key columns {absent} are missing")
        for field in rows.schema.fields:
            if field.name in known and not _fits(field.dataType, known[field.name].dataType):
                raise SchemaMismatch(
                    f"{field.name}: {field.dataType.simpleString()} does not fit "
                    f"{known[field.name].dataType.simpleString()}"
                )
        if extra:
            self._check_new_columns(extra)
        schema = T.StructType(head.schema.fields + [T.StructField(f.name, f.dataType) for f in extra])
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        return rows.select(*columns), schema

    def _check_new_columns(self, extra: list[T.StructField]) -> None:
        """A column that was there before a restore may only come back with its old type."""
        before = self.log().select("columns").distinct()
        past = before.select(
            F.explode(F.from_json(F.get_json_object("columns", "$.fields"), "array<struct<name:string,type:string>>"))
        ).select("col.*").distinct()
        for f in extra:
            kind = f.dataType.json().strip('"')
            clash = past.where((F.col("name") == f.name) & (F.col("type") != kind)).first()
            if clash is not None:
                raise SchemaMismatch(f"{f.name} was {clash.type} in an older version")

    def insert(
        self, rows: DataFrame, evolve: bool = False, at: datetime | None = None, check_keys: bool = True
    ) -> int:
        """Append rows. With ``evolve`` new columns are added; older rows get NULL in them.

        Keys that are in the table already are refused, as are keys that occur twice; ``check_keys=False``
        leaves both checks to the caller.
        """
        head = self.snapshot()
        fitted, schema = self._fitted(rows, head, evolve)
        if check_keys:
            known = self._state(head).select(*head.keys)
            again = known.join(fitted.select(*head.keys), list(head.keys), "left_semi").first()
            if again is not None:
                raise KeyViolation(f"{again.asDict()} is in the table already")
        return self._commit(head, cl.inserted(fitted), "INSERT", at, schema, check_keys)

    # A change may touch a few rows of every file of a large table. The rebalance hint gathers
    # what is written into files of the size Spark aims for, instead of one sliver per task.

    def update(
        self, predicate: Column | str, assignments: dict[str, Column | str], at: datetime | None = None
    ) -> int:
        head = self.snapshot()
        unknown = [c for c in assignments if c not in head.schema.names]
        if unknown or any(c in head.keys for c in assignments):
            raise SchemaMismatch(f"cannot assign {unknown or head.keys}")
        rows = cl.updated(self._state(head), predicate, assignments)
        return self._commit(head, rows.hint("rebalance"), "UPDATE", at)

    def delete(self, predicate: Column | str, at: datetime | None = None) -> int:
        head = self.snapshot()
        rows = cl.deleted(self._state(head), predicate, head.keys)
        return self._commit(head, rows.hint("rebalance"), "DELETE", at)

    def merge(
        self,
        source: DataFrame,
        clauses: Sequence[cl.Clause],
        at: datetime | None = None,
        stream: str | None = None,
        batch: int | None = None,
        evolve: bool = False,
        control: Sequence[str] = (),
        check_keys: bool = True,
    ) -> int:
        """All clauses in one commit. A micro-batch that was committed before changes nothing.

        ``check_keys=False`` says that the source has one row per key.

        With ``evolve`` source columns that the table lacks are added to it, but for the ``control``
        columns, which only conditions use; rows that the merge does not touch get NULL in them.
        """
        head = self.snapshot(stream=stream)
        if head.batch is not None and batch <= head.batch:
            return head.head
        state, schema = self._state(head, only=source), head.schema
        if evolve:
            schema = self._fitted(source.drop(*control), head, evolve)[1]
            added = schema.fields[len(head.schema.fields) :]
            state = state.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in added))
        rows = cl.merged(state, source, head.keys, clauses).hint("rebalance")
        return self._commit(head, rows, "MERGE", at, schema, check_keys=check_keys, stream=stream, batch=batch)

    def overtake(
        self, feed: DataFrame, order: Sequence[str], stream: str | None = None, batch: int | None = None
    ) -> int:
        """Commit a feed of one row per key (the caller's word), each of which replaces a row that is not newer.

        A micro-batch that was committed before changes nothing.
        """
        head = self.snapshot(stream=stream)
        if head.batch is not None and batch <= head.batch:
            return head.head
        rows = cl.overtaken(self._state(head, only=feed), feed, head.keys, order).hint("rebalance")
        return self._commit(head, rows, "MERGE", None, stream=stream, batch=batch)

    def restore(self, version: int, at: datetime | None = None) -> int:
        """Bring back a version as a new commit; the columns become that version's columns.

        Only keys changed since are looked at, unless the whole table was replaced since.
        """
        then = self.snapshot(version)
        head = self.snapshot()
        if head.last_whole > version:
            return self._commit_whole(head, self._state(then), "RESTORE", at, check_keys=False)
        changes = self.changes(version, head.head, then.schema)
        rows = cl.restored(changes, self._state(then, only=changes), head.keys, head.head - version)
        return self._commit(head, rows.hint("rebalance"), "RESTORE", at, then.schema)

    def replace(self, rows: DataFrame, at: datetime | None = None, check_keys: bool = True) -> int:
        """Put other rows, with columns of their own, in place of the whole table. Older versions stay."""
        head = self.snapshot()
        absent = [k for k in head.keys if k not in rows.columns]
        if absent:
            raise SchemaMismatch(f"key columns {absent} are missing")
        return self._commit_whole(head, rows, "REPLACE", at, check_keys)

    def _commit_whole(
        self, head: Snapshot, rows: DataFrame, operation: str, at: datetime | None, check_keys: bool
    ) -> int:
        version = head.head + 1
        buckets = self._write_base(version, rows, head.keys, check_keys)
        no_changes = cl.inserted(rows).where(F.lit(False))
        no_changes.write.mode("overwrite").parquet(f"{self.path}/rows/_version={version}")
        self._log(version, "commit", operation, at, rows.schema, head.keys, whole=True, buckets=buckets)
        return version

    def fold(self, version: int | None = None, floor: bool = False) -> int:
        """Write the whole table at a version as a new base, so that reads need not go further back."""
        snapshot = self.snapshot(version)
        if snapshot.version == 0:  # already a base, and already the floor
            return 0
        buckets = snapshot.buckets
        if snapshot.version != snapshot.base:
            state = self._state(snapshot)
            # While about as many buckets will do, what each holds stays together and the base is not shuffled.
            fits = buckets and buckets / 2 <= plan_bytes(state) / BUCKET_BYTES <= buckets * 2
            buckets = self._write_base(snapshot.version, state, snapshot.keys, False, buckets if fits else None)
        elif not floor:
            return snapshot.version
        self._log(
            snapshot.version, "fold", "FOLD", None, snapshot.schema, snapshot.keys, whole=True, floor=floor, buckets=buckets
        )
        return snapshot.version

    def fold_if_changed(self, share: float = 0.5) -> int | None:
        """Fold once the changes since the base take up this share of the base's bytes; the version, or None."""
        snapshot = self.snapshot()
        if snapshot.version == snapshot.base:
            return None
        base = 0
        if snapshot.base or snapshot.source_path is None:
            base = dataset_bytes(self.spark, self._base_path(snapshot.base))
        changed = [f"{self.path}/rows/_version={v}" for v in range(snapshot.base + 1, snapshot.version + 1)]
        return self.fold() if dataset_bytes(self.spark, *changed) >= share * base else None

    def compact(self, target_bytes: int = TARGET_BYTES, cluster_by: Sequence[str] = ()) -> int:
        """Fold the newest version into files of a wanted size, clustered by columns if any are named.

        Rows and versions stay as they are; reads that go on from the new base skip files by the
        clustered columns, and reads of older versions still use the older base.
        """
        snapshot = self.snapshot()
        target = self._base_path(snapshot.version)
        if snapshot.version == snapshot.base:
            # The base in use must not be overwritten while it is read: an empty commit makes room for a new one.
            self._commit(snapshot, cl.inserted(self._state(snapshot)).where(F.lit(False)), "OPTIMIZE", None)
            snapshot = self.snapshot()
            target = self._base_path(snapshot.version)
        work = new_folder(self.spark, "compact")
        state = self._state(snapshot)
        with sized_shuffles(state):
            state.write.parquet(work)
        if cluster_by:
            layout.cluster(self.spark, work, target, cluster_by, target_bytes)
        else:
            layout.compact(self.spark, work, target, target_bytes)
        self._log(snapshot.version, "fold", "FOLD", None, snapshot.schema, snapshot.keys, whole=True)
        return snapshot.version

    def details(self) -> DataFrame:
        """One row: columns, keys, version, and the files and bytes that a read of the newest version opens."""
        snapshot = self.snapshot()
        paths = [f"{self.path}/rows/_version={v}" for v in range(snapshot.base + 1, snapshot.version + 1)]
        if snapshot.base or snapshot.source_path is None:
            paths.append(self._base_path(snapshot.base))
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length")
        files = files.where(F.col("path").endswith(".parquet"))
        return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(
            F.lit(self.path).alias("location"),
            F.lit(snapshot.schema.simpleString()).alias("columns"),
            F.lit(",".join(snapshot.keys)).alias("keys"),
            F.lit(snapshot.version).cast("bigint").alias("version"),
            "files",
            "bytes",
        )

    def retain(
        self, keep: timedelta = MINIMUM_RETENTION, now: datetime | None = None, allow_short: bool = False
    ) -> int:
        """Make versions that were replaced longer ago than ``keep`` unreadable.

        Returns the oldest version still readable. Less than seven days must be asked for.
        """
        if keep < MINIMUM_RETENTION and not allow_short:
            raise ValueError(f"keeping less than {MINIMUM_RETENTION} needs allow_short=True")
        present = F.current_timestamp() if now is None else _moment(now)
        is_old = (F.col("kind") == "commit") & (F.col("committed") <= present - F.lit(keep))
        found = self.log().agg(
            F.max(F.when(is_old, F.col("_version"))).alias("horizon"),
            F.max(F.when(F.col("floor"), F.col("_version"))).alias("floor"),
        ).first()
        if found.horizon is None or found.horizon <= found.floor:
            return found.floor
        return self.fold(found.horizon, floor=True)


def _fits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a value can be stored without losing its kind: same type, NULL, or a wider number."""
    if given == wanted or isinstance(given, T.NullType):
        return True
    integers = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(given) in integers:
        if type(wanted) in integers:
            return integers.index(type(given)) <= integers.index(type(wanted))
        return isinstance(wanted, (T.DecimalType, T.FloatType, T.DoubleType))
    if isinstance(given, (T.DecimalType, T.FloatType)):
        return isinstance(wanted, T.DoubleType) or (
            isinstance(given, T.DecimalType) and isinstance(wanted, T.DecimalType)
            and given.scale <= wanted.scale
            and given.precision - given.scale <= wanted.precision - wanted.scale
        )
    return isinstance(given, T.DateType) and isinstance(wanted, T.TimestampType)
