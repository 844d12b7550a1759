"""Table writes, bucketed marts and keyed tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from doclake.constants import MART_BUCKETS

ROWS_PER_BUCKET = 5_000_000
REPLAYABLE = 64  # batches, the last ones, that can be run again without a trace of the first run
COMPACT_EVERY = 512  # batches in the log of a keyed table
MOST_BROADCAST = 1_000_000  # numbers of batches


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def write_table(df: DataFrame, table: str, path: str, database_path: str | None = None) -> int:
    """Overwrite an external Parquet table and return its number of rows.

    The rows are counted in the stored table, from the file footers alone, so
    nothing is computed twice.
    """
    spark = df.sparkSession
    if "." in table:
        ensure_database(spark, table.rsplit(".", 1)[0], database_path)
    df.write.format("parquet").option("path", path).mode("overwrite").saveAsTable(table)
    return spark.table(table).count()


def view_staging(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view and read it back."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for a mart of the given size, at least the fixed minimum."""
    return max(MART_BUCKETS, -(-rows // rows_per_bucket))


def table_mart(
    df: DataFrame,
    table: str,
    path: str,
    key: str = "file_name",
    buckets: int = MART_BUCKETS,
    database_path: str | None = None,
) -> DataFrame:
    """Overwrite a mart distributed by the hash of its key.

    Rows are shuffled to their bucket first, so that each bucket is one file
    and later joins on the key need no shuffle. Give ``bucket_count(rows)`` for
    large marts.
    """
    spark = df.sparkSession
    if "." in table:
        ensure_database(spark, table.rsplit(".", 1)[0], database_path)
    (
        df.repartition(buckets, key)
        .write.format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .mode("overwrite")
        .saveAsTable(table)
    )
    return spark.table(table)


def latest_by_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The row with the highest ``order`` columns for each key.

    ``row_number() = 1`` lets Spark keep one row per key in every task before
    the shuffle, so a key with very many rows does not fill one task. Rows that
    tie on ``order`` are settled by a hash of the row, the same on every run.
    """
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    window = Window.partitionBy(key).orderBy(
        *[F.desc(c) if isinstance(c, str) else c.desc() for c in order],
        F.desc(F.xxhash64(*plain)),
    )
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def upsert_by_key(
    current: DataFrame, changes: DataFrame, key: str, order: Sequence[str | Column]
) -> DataFrame:
    """``current`` with the latest change of each key put in place of its row.

    Changes without a key are left out; ``rejected_rows`` returns them.
    """
    keyed = changes.filter(F.col(key).isNotNull())
    latest = latest_by_key(keyed, key, order).select(*current.columns).withColumn("_new", F.lit(1))
    both = current.withColumn("_new", F.lit(0)).unionByName(latest)
    without_key = both.filter(F.col(key).isNull())
    return latest_by_key(both.filter(F.col(key).isNotNull()), key, ["_new"]).unionByName(without_key).drop("_new")


def rejected_rows(changes: DataFrame, key: str) -> DataFrame:
    return changes.filter(F.col(key).isNull())


class KeyedTable:
    """A table with one live row per key: a log of batches over runs bucketed by key.

    A batch has a name that no other run or source uses. Its first write gives
    it the next version; writing it again keeps its version and replaces its
    rows, whether they are still in the log or already in a run, so that neither
    a replay nor a source that counts from zero again can bring old rows back.
    The row with the highest version is the live one.

    ``compact`` folds the log into a new run and merges it with runs that are not
    larger, so that a row is written again about log(size) times in its life and
    few runs remain. Runs keep what a replay of the last ``replayable`` versions may
    bring back; older batches are settled: rows that such a replay withdraws have
    no older ones left to come back. Runs have the same buckets, so reading the
    live rows shuffles the log alone. One writer at a time is assumed.

    Below ``path``: ``log/generation=g/version=v`` holds the batches since the last
    compaction, ``run-…`` the runs, ``rejects`` rows without a key, ``batches`` what was
    written when (from each compaction on in one file), ``runs`` the runs of each
    generation, noted last, so that a compaction that fails changes nothing.
    """

    _BATCHES = "batch_id string, version long, generation int, again boolean"
    _RUNS = "generation int, run string, made int, rows long, buckets int"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        schema: str | StructType,
        replayable: int = REPLAYABLE,
        compact_every: int | None = COMPACT_EVERY,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.replayable = replayable
        self.compact_every = compact_every

    # what is there

    def _read(self, path: str, schema: str | StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField("_version", LongType())])

    def _notes(self, generation: int) -> DataFrame:
        return self._read(f"{self.path}/batches/since={generation}", self._BATCHES)

    def batches(self) -> DataFrame:
        """Names and versions of all batches so far."""
        return self._named_versions(self._runs()[0])

    def _named_versions(self, generation: int) -> DataFrame:
        return self._notes(generation).groupBy("batch_id").agg(F.min("version").alias("version"))

    def _runs(self) -> tuple[int, list]:
        """The generation and its runs; their number grows with the logarithm of the rows."""
        noted = self._read(f"{self.path}/runs", self._RUNS)
        generation = noted.agg(F.max("generation")).first()[0]
        if generation is None:
            return 0, []
        found = noted.filter(F.col("generation") == generation).orderBy("made").collect()
        return generation, [r for r in found if r["run"]]

    def _log(self, generation: int) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField("version", LongType())])
        log = self._read(f"{self.path}/log/generation={generation}", schema)
        return log.withColumnRenamed("version", "_version")

    def _without_replayed(self, rows: DataFrame, generation: int, made: Column) -> DataFrame:
        """``rows``, written in generation ``made``, without those of batches that came again since."""
        again = self._notes(generation).filter("again").groupBy("version").agg(F.max("generation").alias("_again"))
        again = again.withColumnRenamed("version", "_version")
        number = again.count()
        if not number:
            return rows
        joined = rows.join(F.broadcast(again) if number <= MOST_BROADCAST else again, "_version", "left")
        return joined.filter(F.col("_again").isNull() | (F.col("_again") < made)).select(*rows.columns)

    def _run_name(self, run: str) -> str:
        return f"keyed_{hashlib.sha256(f'{self.path}/{run}'.encode()).hexdigest()[:24]}"

    def _run_table(self, run: str, buckets: int) -> str:
        """The run as a table that knows its buckets, made known to this session if it isn't yet."""
        path = f"{self.path}/{run}"
        name = self._run_name(run)
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored_schema())
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{escaped}'"
        )
        return name

    def _run_rows(self, run, generation: int) -> DataFrame:
        rows = self.spark.table(self._run_table(run["run"], run["buckets"]))
        return self._without_replayed(
            rows.select(*self._stored_schema().names), generation, F.lit(run["made"])
        )

    # reading

    def latest(self) -> DataFrame:
        generation, runs = self._runs()
        log = self._log(generation).filter(F.col(self.key).isNotNull())
        rows = latest_by_key(log, self.key, ["_version"])
        if runs:
            # at most a row per key of the log is dealt to the buckets of the runs
            rows = rows.repartition(runs[0]["buckets"], self.key)
            rows = reduce(DataFrame.unionByName, [self._run_rows(r, generation) for r in runs], rows)
            rows = latest_by_key(rows, self.key, ["_version"])
        return rows.drop("_version")

    def log(self) -> DataFrame:
        """All rows kept, with ``_version`` and ``batch_id``."""
        generation, runs = self._runs()
        rows = self._log(generation).filter(F.col(self.key).isNotNull())
        rows = reduce(DataFrame.unionByName, [self._run_rows(r, generation) for r in runs], rows)
        return self._named(rows, generation)

    def rejects(self) -> DataFrame:
        """Rows without a key, with ``_version`` and ``batch_id``."""
        generation, _ = self._runs()
        rows = self._log(generation).filter(F.col(self.key).isNull())
        return self._named(rows.unionByName(self._folded_rejects(generation)), generation)

    def _folded_rejects(self, generation: int) -> DataFrame:
        schema = StructType([*self._stored_schema().fields, StructField("generation", IntegerType())])
        rows = self._read(f"{self.path}/rejects", schema)
        kept = self._without_replayed(
            rows.filter(F.col("generation") <= generation), generation, F.col("generation")
        )
        return kept.drop("generation")

    def _named(self, rows: DataFrame, generation: int) -> DataFrame:
        names = self._named_versions(generation).withColumnRenamed("version", "_version")
        return rows.join(names, "_version").select(*self.schema.names, "_version", "batch_id")

    def written(self, batch_id: int | str) -> int:
        """Rows with a key that the last write of a batch left in the log."""
        generation, _ = self._runs()
        mine = self._named_versions(generation).filter(F.col("batch_id") == str(batch_id)).first()
        if mine is None:
            return 0
        rows = self._log(generation).filter(F.col("_version") == mine["version"])
        return rows.filter(F.col(self.key).isNotNull()).count()

    # writing

    def upsert(
        self, batch: DataFrame, batch_id: int | str, order: Sequence[str | Column] = ()
    ) -> None:
        """Store the latest row per key of ``batch``, and its rows without a key as rejects.

        ``order`` may name columns that are not stored. Every ``compact_every``
        batches the log is compacted first.
        """
        generation, _ = self._runs()
        if self.compact_every and self._in_log(generation) >= self.compact_every:
            self.compact()
            generation += 1
        version = self._version(str(batch_id), generation)
        keyed = latest_by_key(batch.filter(F.col(self.key).isNotNull()), self.key, order)
        rows = keyed.select(*self.schema.names).unionByName(
            rejected_rows(batch, self.key).select(*self.schema.names)
        )
        rows.write.mode("overwrite").parquet(f"{self.path}/log/generation={generation}/version={version}")

    def _in_log(self, generation: int) -> int:
        noted = self._notes(generation).filter(F.col("generation") == generation)
        return noted.select("version").distinct().count()

    def _version(self, batch_id: str, generation: int) -> int:
        """The batch's version, noted before any of its rows is written."""
        notes = self._notes(generation)
        known, most = notes.agg(
            F.min(F.when(F.col("batch_id") == batch_id, F.col("version"))), F.max("version")
        ).first()
        version = (most or 0) + 1 if known is None else known
        noted = [(batch_id, version, generation, known is not None)]
        self._note(self.spark.createDataFrame(noted, self._BATCHES), f"{self.path}/batches/since={generation}")
        return version

    @staticmethod
    def _note(rows: DataFrame, path: str, mode: str = "append") -> None:
        rows.coalesce(1).write.mode(mode).parquet(path)

    def compact(self, path: str | None = None) -> "KeyedTable":
        """Fold the log into the runs, here or in a new folder that takes later batches in turn.

        A new folder gets all live rows in one run; the old one stays readable.
        Here the log and runs that were replaced stay until ``remove_old``.
        """
        generation, runs = self._runs()
        target = self if path is None else KeyedTable(
            self.spark, path, self.key, self.schema, self.replayable, self.compact_every
        )
        made = generation + 1 if path is None else 1
        log = self._log(generation)
        keyed = log.filter(F.col(self.key).isNotNull())
        rows = keyed.count()
        # runs that aren't larger than what they are merged with
        merged = []
        for run in reversed(runs):
            if path is None and run["rows"] > rows:
                break
            merged.append(run)
            rows += run["rows"]
        left = runs[: len(runs) - len(merged)]
        buckets = left[0]["buckets"] if left else bucket_count(rows)
        name = f"run-{made:06d}"
        table = target._run_name(name)
        self._folded(keyed, merged, generation, buckets).write.mode("overwrite").bucketBy(
            buckets, self.key
        ).option("path", f"{target.path}/{name}").saveAsTable(table)
        written = self.spark.table(table).count()
        rejects = log.filter(F.col(self.key).isNull())
        if path is not None:
            rejects = rejects.unionByName(self._folded_rejects(generation))
        rejects.select(*self._stored_schema().names).write.mode("overwrite").parquet(
            f"{target.path}/rejects/generation={made}"
        )
        # a new folder has nothing that a replay so far would have to replace
        replayed = F.lit(path is None) & F.max("again")
        notes = self._notes(generation).groupBy("batch_id").agg(
            F.min("version").alias("version"), F.max(F.when(F.col("again"), F.col("generation"))).alias("generation"),
            replayed.alias("again"),
        )
        notes = notes.withColumn("generation", F.coalesce("generation", F.lit(-1)))
        self._note(notes, f"{target.path}/batches/since={made}", "overwrite")
        noted = [(made, r["run"], r["made"], r["rows"], r["buckets"]) for r in left]
        noted.append((made, name, made, written, buckets))
        self._note(self.spark.createDataFrame(noted, self._RUNS), f"{target.path}/runs")
        return target

    def remove_old(self) -> None:
        """Remove the logs, notes and runs that the current generation doesn't need.

        Frames read before the last compaction can't be computed any more.
        """
        generation, runs = self._runs()
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        needed = {r["run"] for r in runs} | {f"generation={generation}", f"since={generation}"}
        for folder, prefix in (("", "run-"), ("/log", "generation="), ("/batches", "since=")):
            place = jvm.org.apache.hadoop.fs.Path(f"{self.path}{folder}")
            for status in system.listStatus(place) if system.exists(place) else []:
                name = status.getPath().getName()
                if name.startswith(prefix) and name not in needed:
                    if prefix == "run-":
                        self.spark.sql(f"DROP TABLE IF EXISTS {self._run_name(name)}")
                    system.delete(status.getPath(), True)

    def _folded(self, log: DataFrame, runs: list, generation: int, buckets: int) -> DataFrame:
        """The live rows of settled batches and all rows of those that may come again."""
        newest = self._notes(generation).agg(F.max("version")).first()[0] or 0
        rows = reduce(DataFrame.unionByName, [self._run_rows(r, generation) for r in runs], log)
        settled = F.col("_version") <= newest - self.replayable
        names = self._stored_schema().names
        old = latest_by_key(rows.filter(settled), self.key, ["_version"]).select(*names)
        return old.unionByName(rows.filter(~settled).select(*names)).repartition(buckets, self.key)
