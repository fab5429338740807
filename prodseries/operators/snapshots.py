"""Published tables in versions: a load touches its own months and ends with one rename.

    <path>/data/<load>/_month=<month>/…   rows of a month as that load left them, in buckets of their key
    <path>/log/<version>.json             schema, keys, buckets, and the load that holds each month

A version is its record. A load writes new folders for the months of its batch, then renames one
record into place; readers see the version before or after, never a mixture, and a driver that
dies leaves the old one. Nothing is read but the newest record and the months it needs: the
schema is in the record, not gathered from the files' footers.

Rows are bucketed by a digest of their key. A load deals its batch into the same buckets and joins
bucket to bucket, so that the stored rows are neither shuffled nor sorted for the merge.

A stream passes the number of its batch; the record remembers the last one per stream, so a batch
that comes again changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.operators.publish import COUNTERS, _counters, as_timestamp

MONTH, KEY = "_month", "_key"
MANAGED = ["ingested_at", "updated_at"]


class LoadConflict(RuntimeError):
    """Another load took the version this one was to become; nothing was changed."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    keys: list[str]
    buckets: int
    months: dict[str, str]
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(
            {
                "version": self.number, "schema": self.schema.jsonValue(), "keys": self.keys, "buckets": self.buckets,
                "months": self.months, "batches": self.batches,
            }
        )

    @staticmethod
    def of(text: str) -> "Version":
        r = json.loads(text)
        return Version(r["version"], T.StructType.fromJson(r["schema"]), r["keys"], r["buckets"], r["months"], r["batches"])


class _Folder:
    """The files of a folder through Hadoop's file systems, as Spark sees them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(self.conf)

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path)] if self.fs.exists(self.path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.child(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """A new file with all of ``text``, by one rename; False if there is one of that name."""
        draft = self.child(f".{name}.{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.child(name)), options)
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
                return False
            raise
        return True


def key_digest(keys: list[str], nullable: list[str]) -> Column:
    """128 bits that equal keys share. NULL is a value in ``nullable`` and an error elsewhere."""
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        missing = F.lit("n") if c in nullable else F.raise_error(F.lit(f"key without a value: {c}")).cast("string")
        return F.when(F.col(c).isNull(), missing).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    return F.md5(F.concat(*[part(c) for c in keys]).cast("binary"))


def _all_nullable(schema: T.StructType) -> T.StructType:
    """What files give back: a value that a batch could not lack may be missing in another month."""
    return T.StructType.fromJson(json.loads(re.sub(r'("(?:nullable|containsNull|valueContainsNull)": )false', r"\1true", json.dumps(schema.jsonValue()))))


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], partition: str = "period_date",
                 nullable_keys: Iterable[str] = (), buckets: int | None = None) -> None:
        """``partition`` names a date column of the key whose month a row is stored under.
        ``buckets`` counts from the first load on; by default the session's shuffle width."""
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.partition, self.nullable = list(keys), partition, list(nullable_keys)
        self.buckets = buckets

    # ------------------------------------------------------------------------ versions

    def version(self, number: int | None = None) -> Version | None:
        """The newest version, or the one of that number."""
        log = _Folder(self.spark, f"{self.path}/log")
        numbers = sorted(int(n[:-5]) for n in log.names() if n.endswith(".json") and n[:-5].isdigit())
        if number is None:
            number = numbers[-1] if numbers else None
        if number is None:
            return None
        if number not in numbers:
            raise ValueError(f"no version {number} in {self.path}")
        return Version.of(log.read(f"{number:012}.json"))

    def _commit(self, new: Version) -> None:
        if not _Folder(self.spark, f"{self.path}/log").put(f"{new.number:012}.json", new.text()):
            raise LoadConflict(f"version {new.number} of {self.path} is taken")

    def _folder(self, load: str, month: str) -> str:
        return f"{self.path}/data/{load}/{MONTH}={month}"

    def rows(self, number: int | None = None, months: list[str] | None = None) -> DataFrame:
        """The rows of a version (the newest), of all months or of the named ones."""
        version = self.version(number)
        if version is None:
            raise ValueError(f"no load has reached {self.path}")
        held = {m: load for m, load in version.months.items() if months is None or m in months}
        if not held:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*[self._folder(load, m) for m, load in sorted(held.items())])

    # --------------------------------------------------------------------------- loads

    @contextmanager
    def _stored(self, version: Version, months: dict[str, str]):
        """The rows of some months as a bucketed table: only their folders are listed."""
        name = f"snapshot_{uuid.uuid4().hex}"
        schema = T.StructType([*version.schema.fields, T.StructField(KEY, T.StringType()), T.StructField(MONTH, T.StringType())])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({MONTH}) "
            f"CLUSTERED BY ({KEY}) INTO {version.buckets} BUCKETS LOCATION '{self.path}/data'"
        )
        try:
            for month, load in months.items():
                self.spark.sql(f"ALTER TABLE {name} ADD PARTITION ({MONTH}='{month}') LOCATION '{self._folder(load, month)}'")
            yield self.spark.table(name).filter(F.col(MONTH).isin(list(months)))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _dealt(self, batch: DataFrame, buckets: int) -> DataFrame:
        """The batch in the table's buckets; a key that comes twice is an error."""
        repeated = F.raise_error(F.lit(f"duplicate key in batch: {self.keys}")).cast("boolean")
        dealt = batch.withColumns({KEY: key_digest(self.keys, self.nullable), MONTH: self._month()}).repartition(buckets, KEY)
        once = F.count("*").over(Window.partitionBy(KEY)) == 1
        return dealt.withColumn("_in_batch", F.when(once, True).otherwise(repeated))

    def _month(self) -> Column:
        return F.date_format(F.col(self.partition), "yyyy-MM-01")

    def merged(self, stored: DataFrame | None, batch: DataFrame, schema: T.StructType, buckets: int, now: datetime | str | Column) -> DataFrame:
        """One row per key of ``stored`` and ``batch``, with ``write_status``, in the table's buckets.

        A batch row replaces the fields it carries and leaves the others; ``updated_at`` moves on
        every match, ``ingested_at`` is set once.
        """
        stamp, new = as_timestamp(now), self._dealt(batch, buckets)
        if stored is None:
            known = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in batch.columns}
            return new.select(
                *[known.get(f.name, F.col(f.name)).alias(f.name) for f in schema if f.name not in MANAGED],
                *[stamp.alias(c) for c in MANAGED], KEY, MONTH, F.when(F.col("_in_batch"), "inserted").alias("write_status"),
            )
        old = stored.select(*[F.col(c).alias(f"_o_{c}") for c in stored.columns], F.lit(True).alias("_in_old"))
        # The batch is what is held in memory, a bucket of it at a time.
        both = old.join(new.hint("shuffle_hash"), F.col(f"_o_{KEY}") == F.col(KEY), "full_outer")
        in_batch, in_old = F.col("_in_batch").isNotNull(), F.col("_in_old").isNotNull()

        def field_of(f: T.StructField) -> Column:
            prior = F.col(f"_o_{f.name}")
            mine = F.when(in_batch, F.col(f.name)).otherwise(prior) if f.name in batch.columns else prior
            return mine.cast(f.dataType).alias(f.name)

        return both.select(
            *[field_of(f) for f in schema if f.name not in MANAGED],
            F.coalesce("_o_ingested_at", stamp).alias("ingested_at"),
            F.when(in_batch, stamp).otherwise(F.col("_o_updated_at")).alias("updated_at"),
            *[F.coalesce(c, f"_o_{c}").alias(c) for c in (KEY, MONTH)],
            F.when(in_batch & in_old, "matched").when(in_batch, "inserted").otherwise("kept").alias("write_status"),
        )

    def load(self, batch: DataFrame, now: datetime | str | Column, stream: str | None = None, batch_id: int | None = None) -> dict[str, int]:
        """Merge a batch into its months and return the counters; nothing is ever deleted.

        A batch of a ``stream`` whose number has been loaded is left alone, with counters of 0.
        The batch is read twice (its months, then its rows): pass a stored table if it is dear.
        """
        old = self.version()
        if stream is not None and old is not None and old.batches.get(stream, -1) >= batch_id:
            return dict.fromkeys(COUNTERS, 0)
        touched = sorted(r[0] for r in batch.select(self._month().alias("m")).distinct().collect() if r[0] is not None)
        buckets = old.buckets if old else self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        schema = self._schema(old, batch)
        load = uuid.uuid4().hex
        held = {m: old.months[m] for m in touched if old and m in old.months}
        counters = dict.fromkeys(COUNTERS, 0)
        if touched:
            if held:
                with self._stored(Version(old.number, schema, old.keys, buckets, held), held) as stored:
                    counters = self._write(self.merged(stored, batch, schema, buckets, now), load, buckets)
            else:
                counters = self._write(self.merged(None, batch, schema, buckets, now), load, buckets)
        batches = dict(old.batches) if old else {}
        if stream is not None:
            batches[stream] = batch_id
        months = (old.months if old else {}) | dict.fromkeys(touched, load)
        self._commit(Version(old.number + 1 if old else 1, schema, self.keys, buckets, months, batches))
        return counters

    def _schema(self, old: Version | None, batch: DataFrame) -> T.StructType:
        """Fields of the table, those that only the batch has behind them, and the stamps last."""
        fields = [f for f in old.schema if f.name not in MANAGED] if old else []
        known = {f.name for f in fields}
        fields += [T.StructField(f.name, f.dataType) for f in batch.schema if f.name not in known and f.name not in MANAGED]
        return _all_nullable(T.StructType([*fields, *[T.StructField(c, T.TimestampNTZType()) for c in MANAGED]]))

    def _write(self, merged: DataFrame, load: str, buckets: int) -> dict[str, int]:
        observed, name = Observation("load"), f"load_{load}"
        try:
            (
                merged.observe(observed, *_counters())
                .drop("write_status")
                .write.bucketBy(buckets, KEY)
                .partitionBy(MONTH)
                .option("path", f"{self.path}/data/{load}")
                .saveAsTable(name, format="parquet")
            )
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return {k: int(v) for k, v in observed.get.items()}

    def loader(self, stream: str, now: Callable[[int], datetime | str]) -> Callable[[DataFrame, int], None]:
        """For ``writeStream.foreachBatch``: each batch is loaded once, however often it comes."""
        def take(batch: DataFrame, batch_id: int) -> None:
            self.load(batch, now(batch_id), stream, batch_id)

        return take

