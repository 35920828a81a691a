"""Changes of keyed tables: full and partial upserts, deletes, versioned replacement, and tables on disk with a pointer."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def last_by_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key in the given order; the rest of the row travels in one struct through a single aggregation."""
    others = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return best.select(key, *(F.col(f"_row.`{c}`").alias(c) for c in others)).select(*rows.columns)


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same key and are added otherwise. Keys of ``source`` are unique."""
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def upsert_columns(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Only the given columns are taken over, and only where ``source`` has a value; unknown keys are added with nulls elsewhere."""
    given = source.select(key, F.lit(True).alias("_there"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = target.join(given, key, "full")
    return joined.select(*((F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c)) if c in columns else F.col(c) for c in target.columns))


def delete(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).distinct(), key, "left_anti").select(*target.columns)


def replace_version(target: DataFrame, fresh: DataFrame, scope: str, value: str) -> DataFrame:
    """The rows of one scope replaced as a whole; other scopes stay."""
    return target.where(~F.col(scope).eqNullSafe(F.lit(value))).unionByName(fresh)


def replace_in_place(old: DataFrame, new: DataFrame, key: str, position: str) -> DataFrame:
    """Rows merged by key: a new record takes the place of the old one and keeps its position; others follow after the last.

    Keys are unique in ``old``; of several new records with one key the last by position counts. Rows without a key (null or '')
    are never merged: each stays or is appended."""
    some = F.coalesce(F.col(key), F.lit("")) != ""
    latest = last_by_key(new.where(some), key, position)
    place = old.where(some).select(key, F.col(position).alias("_place"))
    last = old.agg(F.coalesce(F.max(position), F.lit(0)).alias("_last"))
    moved = latest.join(place, key, "left").unionByName(new.where(~some).withColumn("_place", F.lit(None).cast(old.schema[position].dataType))).join(F.broadcast(last))
    moved = moved.withColumn(position, F.coalesce("_place", F.col("_last") + F.col(position))).drop("_place", "_last").select(*old.columns)
    return old.join(latest.select(key), key, "left_anti").select(*old.columns).unionByName(moved)


def fill_column(rows: DataFrame, column: str, value) -> DataFrame:
    """A column computed where it is null."""
    return rows.withColumn(column, F.coalesce(F.col(column), value))


def move_to_excluded(tables: list[DataFrame], excluded: DataFrame, keys: DataFrame, order: list[str | None] | None = None) -> tuple[list[DataFrame], DataFrame]:
    """(the tables without the listed keys, the excluded rows after).

    An excluded row gets DOI and title of the key's first row (by the table's ``order`` column, if it has one) in the first table
    that has the key, else of the known excluded row, else blanks; other excluded rows stay as they are. The excluded rows are to be
    written before the tables."""
    order = order or [None] * len(tables)
    wanted = keys.select(X.collapse(F.col("dblp_key")).alias("key")).where("key <> ''").distinct()
    one = lambda c: X.collapse(F.col(c)).alias(c)
    ranked = excluded.select("key", F.lit(len(tables)).alias("_rank"), F.lit(0).cast("bigint").alias("_at"), one("doi"), one("title"))
    for rank, (table, at) in enumerate(zip(tables, order)):
        place = F.col(at).cast("bigint") if at else F.lit(0).cast("bigint")
        ranked = ranked.unionAll(table.select(X.collapse(F.col("dblp_key")).alias("key"), F.lit(rank).alias("_rank"), place.alias("_at"), one("doi"), one("title")).where("key <> ''"))
    best = ranked.join(wanted, "key", "left_semi").groupBy("key").agg(F.min(F.struct("_rank", "_at", "doi", "title")).alias("e"))
    entry = wanted.join(best, "key", "left").select("key", F.col("key").alias("dblp_key"), F.coalesce("e.doi", F.lit("")).alias("doi"), F.coalesce("e.title", F.lit("")).alias("title"))
    kept = [t.withColumn("_key", X.collapse(F.col("dblp_key"))).join(wanted, F.col("_key") == F.col("key"), "left_anti").drop("_key") for t in tables]
    return kept, upsert(excluded.select("key", "dblp_key", "doi", "title"), entry, "key")


def first_found(keys: DataFrame, tables: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """Each key with the columns of the first table, in the given order, that holds it; nulls where none does.

    The tables are tagged with their rank and combined in one aggregation, so a key is shuffled once whatever their number."""
    ranked = None
    for rank, table in enumerate(tables):
        part = table.where(F.col(key).isNotNull()).select(key, F.lit(rank).alias("_rank"), F.struct(*columns).alias("_row"))
        ranked = part if ranked is None else ranked.unionAll(part)
    best = ranked.groupBy(key).agg(F.min_by("_row", F.struct("_rank", "_row")).alias("_row"))
    return keys.select(key).distinct().join(best, key, "left").select(key, *(F.col(f"_row.`{c}`").alias(c) for c in columns))


class VersionedTable:
    """A keyed table as Parquet parts beside numbered manifests; readers see the old version until the next manifest is there.

    A manifest lists the parts of a version and is never changed or deleted, so that there is always a last one. Appending writes the
    new rows only; after ``MOST_PARTS`` parts they are written together."""

    MOST_PARTS = 64

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        at = self._path(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _parts(self, version: int | None = None) -> list[str] | None:
        versions = self._versions()
        if not versions:
            return None
        stream = self._fs.open(self._path(f"{self.path}/manifest-{versions[-1] if version is None else version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["parts"]
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The last version, or an older one by its number."""
        parts = self._parts(version)
        if parts is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return self.spark.read.parquet(*(f"{self.path}/{p}" for p in parts))

    def exists(self) -> bool:
        return self._parts() is not None

    def _write(self, rows: DataFrame, partition_by: list[str] | None = None) -> str:
        part = f"part-{uuid.uuid4().hex}"
        writer = rows.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{part}")
        return part

    def _point(self, parts: list[str]) -> int:
        """Adds the next manifest; if another writer added it first, this one fails and nothing is lost."""
        number = (self._versions() or [0])[-1] + 1
        whole, temporary = (self._path(f"{self.path}/{n}") for n in (f"manifest-{number:012d}.json", f".{uuid.uuid4().hex}"))
        stream = self._fs.create(temporary, True)
        stream.write(bytearray(json.dumps({"parts": parts}).encode()))
        stream.close()
        if self._fs.exists(whole) or not self._fs.rename(temporary, whole):
            raise OSError(f"{self.path}: version {number} is there already")
        return number

    def commit(self, rows: DataFrame, partition_by: list[str] | None = None) -> int:
        """Writes a new version as a whole and returns its number. Parts in use are never overwritten."""
        return self._point([self._write(rows, partition_by)])

    def append(self, rows: DataFrame, key: str) -> None:
        """Adds rows whose key is not there yet; what is there is neither read whole nor written again."""
        parts = self._parts()
        if parts is None:
            self.commit(rows)
            return
        old = self.read()
        part = self._write(rows.join(old.select(key), key, "left_anti").select(*old.columns))
        self._point([*parts, part])
        if len(parts) >= self.MOST_PARTS:
            self.commit(self.read())

    def upsert(self, rows: DataFrame, key: str) -> None:
        self.commit(upsert(self.read(), rows, key) if self.exists() else rows)

    def upsert_columns(self, rows: DataFrame, key: str, columns: list[str]) -> None:
        self.commit(upsert_columns(self.read(), rows, key, columns))

    def delete(self, keys: DataFrame, key: str) -> None:
        self.commit(delete(self.read(), keys, key))

    def add_column(self, name: str, kind: str) -> None:
        self.commit(self.read().withColumn(name, F.lit(None).cast(kind)))

    def drop_column(self, name: str) -> None:
        self.commit(self.read().drop(name))
