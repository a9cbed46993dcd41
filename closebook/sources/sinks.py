"""Sinks: view, table (full refresh), clustered table, versioned snapshot.

A stored table is a folder of versions, ``<path>/v-000001``, ``v-000002``...
A write adds the next version; the version counts from the moment it has a
``_SUCCESS`` file, which is written last. Readers take the highest
version that has one, so a refresh that fails leaves the table as it was, and
one that runs beside a reader takes nothing from under it: the version before
the new one is kept, older ones are removed. Outputs live in the shared folder
the caller names, never in machine-local temp space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: register the lazy plan under a name, store nothing."""
    df.createOrReplaceTempView(name)
    return df


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _found(spark: SparkSession, pattern: str) -> list:
    fs, p = _hadoop(spark, pattern)
    return [s.getPath() for s in fs.globStatus(p) or ()]


def _number(name: str) -> int:
    return int(name.removeprefix("v-"))


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete version of a stored table, if there is one."""
    done = [p.getParent() for p in _found(spark, f"{path.rstrip('/')}/v-*/_SUCCESS")]
    return max(done, key=lambda p: _number(p.getName())).toString() if done else None


def _next(spark: SparkSession, path: str) -> str:
    """A folder for the next version; failed attempts keep their numbers."""
    taken = [_number(p.getName()) for p in _found(spark, f"{path.rstrip('/')}/v-*")]
    return f"{path.rstrip('/')}/v-{max(taken, default=0) + 1:06d}"


def _retire(spark: SparkSession, path: str) -> list[str]:
    """Remove what is older than the version before the current one."""
    removed = []
    done = sorted(_number(p.getParent().getName())
                  for p in _found(spark, f"{path.rstrip('/')}/v-*/_SUCCESS"))
    for p in _found(spark, f"{path.rstrip('/')}/v-*"):
        if len(done) > 1 and _number(p.getName()) < done[-2]:
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            removed.append(f"{path.rstrip('/')}/{p.getName()}")
    return removed


#: Spark's own removal of an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files. Else they stay until the driver's
    garbage collection, and a run of several tables holds those of all at once."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                compression: str | None = None) -> str:
    """Full refresh of a stored table; returns the folder of the new version."""
    version = _next(df.sparkSession, path)
    w = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    with shuffles_dropped(df.sparkSession):
        w.save(version)
    _retire(df.sparkSession, path)
    return version


def stored(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """``df`` written as the next version of a table, and read back."""
    return df.sparkSession.read.schema(df.schema).parquet(
        write_table(df, path, compression=compression))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Bucketed table: the next version of ``path``, hashed by ``key`` into
    ``buckets`` files and sorted within, and read back as such. Tables bucketed
    alike join on the key without a shuffle. Rows are dealt by the same hash
    before they are written, so each task writes one file.

    Spark keeps buckets in the catalog; the table's name is made of its path.
    """
    def name(version: str) -> str:
        return "closebook_" + hashlib.md5(version.encode()).hexdigest()

    spark, version = df.sparkSession, _next(df.sparkSession, path)
    (df.repartition(buckets, key).write.mode("errorifexists").format("parquet")
     .option("path", version).bucketBy(buckets, key).sortBy(key).saveAsTable(name(version)))
    for old in _retire(spark, path):
        spark.sql(f"DROP TABLE IF EXISTS {name(old)}")
    return spark.table(name(version))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stored table."""
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no complete version of a table in {path}")
    return spark.read.parquet(version)


#: A staged table is divided by this number, one folder each.
_PART = "_part"


def part_of(value, cuts: Sequence) -> int:
    """The part of a staged table that a value belongs to; null belongs to the first."""
    return 0 if value is None else sum(value >= c for c in cuts)


def stage(pieces: Iterable[DataFrame], folder: str, column: str, cuts: Sequence = ()) -> None:
    """Add ``pieces`` to a staged table, one after the other, so that only one's shuffle
    files are held at a time. ``cuts`` divide the values of ``column`` into the parts
    that are clustered one after the other."""
    number = F.lit(0)
    for c in cuts:
        number = number + F.when(F.col(column) >= F.lit(c), 1).otherwise(0)
    for piece in pieces:
        with shuffles_dropped(piece.sparkSession):
            w = (piece.withColumn(_PART, number) if cuts else piece).write.mode("append")
            if cuts:
                w = w.partitionBy(_PART)
            w.option("compression", "zstd").parquet(folder if cuts else f"{folder}/{_PART}=0")


def staged_parts(spark: SparkSession, folder: str, schema, parts: int) -> Iterator[DataFrame]:
    """The parts of a staged table in order, also those without rows. A part is deleted
    as soon as the next one is asked for."""
    for k in range(parts):
        fs, p = _hadoop(spark, f"{folder}/{_PART}={k}")
        if fs.exists(p):
            yield spark.read.schema(schema).parquet(p.toString())
            fs.delete(p, True)
        else:
            yield spark.createDataFrame([], schema)


def _arranged(rows: DataFrame, keys: Sequence[str], file_bytes: int) -> DataFrame:
    """Rows of a stored table, range-ordered by ``keys``; the number of partitions
    follows from the table's size in bytes."""
    folders = {f.rpartition("/")[0] for f in rows.inputFiles()}
    size = sum(fs.getContentSummary(p).getLength() for fs, p in (
        _hadoop(rows.sparkSession, f) for f in folders))
    return rows.repartitionByRange(max(1, -(-size // file_bytes)), *[F.col(k) for k in keys]) \
        .sortWithinPartitions(*keys)


def write_clustered(df: DataFrame, path: str, partition_col: str, cluster_by: Sequence[str],
                    unique_by: str, file_bytes: int = 128 << 20) -> str:
    """Clustered table: folders by ``partition_col`` (pruned by filters on it)
    and rows range-ordered by ``cluster_by``, so that parquet's min/max
    statistics skip row groups for filters on those columns.

    ``unique_by`` is the last range key: rows that agree in all others can
    still be divided, so files stay balanced when one date and channel holds a
    large share. ``df`` is stored first and range-partitioned from there: the
    sampling of keys then reads a table instead of running the plan again, and
    the number of files follows from its size in bytes.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_staged"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    version = write_parts([rows], path, partition_col, cluster_by, unique_by, file_bytes)
    fs, p = _hadoop(spark, staged)
    fs.delete(p, True)
    return version


def write_parts(parts: Iterable[DataFrame], path: str, partition_col: str,
                cluster_by: Sequence[str], unique_by: str, file_bytes: int = 128 << 20,
                made: Callable[[DataFrame], DataFrame] | None = None,
                compression: str | None = None) -> str:
    """Clustered table from stored tables, one after the other: each holds other values
    of ``partition_col``. ``made`` adds the columns that need not be shuffled. The
    version counts when all are written."""
    keys = [partition_col, *cluster_by, unique_by]
    version = None
    for rows in parts:
        spark = rows.sparkSession
        version = version or _next(spark, path)
        df = _arranged(rows, keys, file_bytes)
        w = (made(df) if made else df).write.mode("append").partitionBy(partition_col).option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if compression:
            w = w.option("compression", compression)
        with shuffles_dropped(spark):
            w.parquet(version)
    fs, p = _hadoop(spark, f"{version}/_SUCCESS")
    fs.create(p, True).close()
    _retire(spark, path)
    return version


def overwrite_partitions(rows: DataFrame, folder: str, partition_col: str, values: Sequence,
                         cluster_by: Sequence[str], unique_by: str,
                         file_bytes: int = 128 << 20,
                         made: Callable[[DataFrame], DataFrame] | None = None,
                         compression: str | None = None) -> None:
    """Replace the partitions ``values`` of a clustered table by ``rows`` (a stored
    table, which does not read ``folder``); the others are not touched. A partition
    without rows is removed. Spark swaps the partitions in when all are written.
    ``made`` adds the columns that need not be shuffled."""
    spark = rows.sparkSession
    df = _arranged(rows, [partition_col, *cluster_by, unique_by], file_bytes)
    w = (made(df) if made else df).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    if compression:
        w = w.option("compression", compression)
    with shuffles_dropped(spark):
        w.parquet(folder)
    left = {r[0] for r in rows.select(partition_col).distinct().collect()}
    for value in set(values) - left:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        fs, p = _hadoop(spark, f"{folder}/{partition_col}={name}")
        fs.delete(p, True)


def write_versioned(df: DataFrame, base_path: str, version: str) -> str:
    """Write a snapshot version to ``base_path/version=<version>``. A complete
    version is never overwritten; what a failed attempt left is replaced."""
    path = f"{base_path.rstrip('/')}/version={version}"
    if _found(df.sparkSession, f"{path}/_SUCCESS"):
        raise FileExistsError(f"{path} is a complete version")
    df.write.mode("overwrite").format("parquet").save(path)
    return path
