"""Keyed tables that are changed in place: buckets of Parquet files and a manifest for each version.

A change reads and rewrites only the buckets of its keys, into a folder of its
own, and then names them in a new manifest. The manifest appears whole or not
at all, and only one writer can make a version's; so a reader sees a version
or the one before it, never half of one, and a job that dies leaves files that
no manifest names. Every change carries an id: a change whose id a manifest
has was made before and is not made again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"


class ConflictError(RuntimeError):
    """Another writer has made this version."""


class Manifest(NamedTuple):
    version: int
    schema: str  # JSON
    key: str
    buckets: dict[int, str]  # folder of each bucket that has rows
    many: int  # number of buckets
    changes: list[str]  # ids of all changes so far

    def text(self) -> str:
        return json.dumps(self._asdict() | {"buckets": {str(k): v for k, v in self.buckets.items()}})

    @classmethod
    def of(cls, text: str) -> Manifest:
        read = json.loads(text)
        return cls(**read | {"buckets": {int(k): v for k, v in read["buckets"].items()}})


class VersionedTable:
    """The table of a folder that all executors share, with a row for each key or more."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._fs_of = jvm.org.apache.hadoop.fs.Path
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs_of(self.path).toUri(), spark._jsc.hadoopConfiguration())

    def _place(self, version: int):
        return self._fs_of(f"{self.path}/manifests/{version:012d}.json")

    def manifest(self, version: int | None = None) -> Manifest | None:
        """That of a version, else of the last one; None if there is none."""
        if version is None:
            names, folder = [], self._fs_of(f"{self.path}/manifests")
            if self._context.util().exists(folder):
                found = self._context.listStatus(folder)
                while found.hasNext():
                    name = found.next().getPath().getName()
                    names += [int(name[:-5])] if name.endswith(".json") and name[:-5].isdigit() else []
            if not names:
                return None
            version = max(names)
        stream = self._context.open(self._place(version))
        try:
            return Manifest.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _committed(self, new: Manifest) -> Manifest:
        """The manifest written beside its place and moved there, which fails if there is one."""
        jvm, hidden = self.spark._jvm, self._fs_of(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$CreateOpts"), 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$CreateOpts").createParent()
        stream = self._context.create(hidden, flags, options)
        stream.write(bytearray(new.text().encode()))
        stream.close()
        try:
            self._context.rename(hidden, self._place(new.version), self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            self._context.delete(hidden, False)
            if "FileAlreadyExistsException" in str(e):
                raise ConflictError(f"version {new.version} of {self.path} exists") from e
            raise
        return new

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, else of the last one."""
        found = self.manifest(version)
        if found is None:
            raise FileNotFoundError(self.path)
        return self._rows(found, list(found.buckets))

    def _rows(self, of: Manifest, buckets: list[int]) -> DataFrame:
        schema, paths = StructType.fromJson(json.loads(of.schema)), [of.buckets[b] for b in buckets if b in of.buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, key: Column, many: int) -> Column:
        return F.pmod(F.xxhash64(F.lower(key)), F.lit(many)).cast("int")

    def _written(self, rows: DataFrame, key: str, many: int, change: str) -> dict[int, str]:
        """The rows as a folder for each bucket; folders by bucket."""
        folder = f"{self.path}/data/{change}-{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, self._bucket(F.col(key), many)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        place, out = self._fs_of(folder), {}
        found = self._context.listStatus(place)
        while found.hasNext():
            name = found.next().getPath().getName()
            if name.startswith(f"{BUCKET}="):
                out[int(name.split("=")[1])] = f"{folder}/{name}"
        return out

    def create(self, rows: DataFrame, key: str, many: int = 64, change: str = "create") -> Manifest:
        """Version 0; made before by the same change, it stays. A null key has a bucket as any other."""
        now = self.manifest()
        if now is not None:
            if change in now.changes:
                return now
            raise ConflictError(f"{self.path} has a version")
        return self._committed(Manifest(0, rows.schema.json(), key, self._written(rows, key, many, change), many, [change]))

    def changed(self, changes: DataFrame, change: str, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> Manifest:
        """A version in which the buckets of the changes' keys hold merged(their rows, changes); other buckets keep their files.

        ``change`` names it: made before, nothing is done. Without rows of
        changes the version has no new files. ``merged`` gives rows of the
        table's columns, whose keys stay in the buckets of those it got.
        """
        now = self.manifest()
        if now is None:
            raise FileNotFoundError(self.path)
        if change in now.changes:
            return now
        touched = sorted(r[0] for r in changes.select(self._bucket(F.col(now.key), now.many)).distinct().collect())
        rows = merged(self._rows(now, touched), changes).select(*[f.name for f in StructType.fromJson(json.loads(now.schema))])
        new = self._written(rows, now.key, now.many, change) if touched else {}
        kept = {b: p for b, p in now.buckets.items() if b not in touched}
        return self._committed(now._replace(version=now.version + 1, buckets=kept | new, changes=[*now.changes, change]))

    def upserted(self, new: DataFrame, change: str, pos: str | None = None) -> Manifest:
        """Rows of names that the table lacks, without regard to case, are added: of equal ones the first by ``pos``, a column that the table may lack."""
        from ..operators.tables import first_rows

        key = self._known().key

        def merged(old: DataFrame, fresh: DataFrame) -> DataFrame:
            low = lambda c: F.lower(F.col(c))
            lacking = fresh.where(F.col(key).isNotNull()).withColumn("_low", low(key)).join(old.select(low(key).alias("_low")).distinct(), "_low", "left_anti")
            order = [*([F.asc(pos)] if pos else []), F.to_json(F.struct(*[c for c in old.columns])).asc()]
            return old.unionByName(first_rows(lacking, ["_low"], *order).select(*old.columns))

        return self.changed(new, change, merged)

    def updated(self, updates: DataFrame, change: str, pos: str | None = None) -> Manifest:
        """Non-null values of updates take the place of those of rows of the same name; of updates of one name the last by ``pos`` counts, column by column; unknown names change nothing."""
        known = self._known()

        def merged(old: DataFrame, given: DataFrame) -> DataFrame:
            columns = [c for c in old.columns if c != known.key and c in given.columns]
            order = F.struct(*([F.col(pos)] if pos else []), F.to_json(F.struct(*columns)))
            last = given.where(F.col(known.key).isNotNull()).groupBy(F.col(known.key).alias("_key")).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_{c}") for c in columns])
            joined = old.join(last, old[known.key] == F.col("_key"), "left")
            return joined.select(*[F.coalesce(f"_{c}", c).cast(old.schema[c].dataType).alias(c) if c in columns else F.col(c) for c in old.columns])

        return self.changed(updates, change, merged)

    def appended(self, rows: DataFrame, change: str, defaults: dict[str, Column], required: Callable[[DataFrame], Column], pos: str | None = None) -> Manifest:
        """upserted() of the rows that are valid by ``required``, with defaults in place of columns that are missing or null; other missing columns are null."""
        schema = StructType.fromJson(json.loads(self._known().schema))
        full = rows
        for field in schema:
            given = F.col(field.name) if field.name in rows.columns else F.lit(None).cast(field.dataType)
            full = full.withColumn(field.name, F.coalesce(given, defaults[field.name]).cast(field.dataType) if field.name in defaults else given.cast(field.dataType))
        return self.upserted(full.where(required(full)), change, pos)

    def _known(self) -> Manifest:
        found = self.manifest()
        if found is None:
            raise FileNotFoundError(self.path)
        return found


#: What a property row has where nothing is given.
def property_defaults() -> dict[str, Column]:
    return {"pka_values": F.lit(""), "charge_states": F.lit("0"), "ion_charges": F.lit(""), "solubility_g_per_L": F.lit(100.0), "activity_coefficient": F.lit(1.0), "description": F.col("compound_name")}


def valid_property(rows: DataFrame) -> Column:
    """Whether a property row has a name, a weight above 0 and a solubility that is not negative."""
    return (F.coalesce(F.col("compound_name"), F.lit("")) != "") & (F.col("molecular_weight") > 0) & (F.col("solubility_g_per_L") >= 0)
