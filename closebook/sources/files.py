"""Readers for the raw feeds: CSV seeds, parquet/table sources, staged feeds.

``SourceCatalog`` maps a logical source (``orders``, ``gl_entries``...) to a
physical location per environment, the way a warehouse source definition maps
``source('raw_sales', 'orders')`` to ``RAW.SALES.raw_orders``. ``StoredFeeds``
reads feeds staged as parquet by ``write_feeds``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.operators.skew import sketch
from closebook.sources import sinks
from closebook.sources.schemas import RAW_SCHEMAS, SOURCE_IDENTIFIERS


CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession):
    return (spark.read.option("header", True).option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .option("dateFormat", "yyyy-MM-dd"))


def seed_schema(spark: SparkSession, name: str, path: str) -> T.StructType:
    """Types of a seed's columns in the order of its header: the declared ones
    by name, text for further columns. A seed that lacks a declared column, or
    names one twice, is refused."""
    header = _csv(spark).option("inferSchema", False).csv(path).columns  # reads one line
    found = [c.strip() for c in header]
    declared_types = {f.name: f.dataType for f in RAW_SCHEMAS[name].fields}
    missing = [c for c in declared_types if c not in found]
    twice = sorted({c for c in found if found.count(c) > 1})
    if missing or twice:
        raise ValueError(f"seed {path}: header {found} lacks {missing}, repeats {twice}")
    return T.StructType([T.StructField(c, declared_types.get(c.strip(), T.StringType()))
                         for c in header])


def read_csv_seed(spark: SparkSession, name: str, path: str,
                  rejects: str | None = None) -> DataFrame:
    """Read a header-first CSV; columns are bound by name, whatever their order,
    and typed as declared; further columns are left out.

    Blank fields load as null; quoted fields may hold commas and doubled
    quotes (RFC 4180); a bare quote inside an unquoted field is kept. The
    header of every file of the seed must be the same.

    A bad row fails the read, by any of its columns, also those that a query
    does not need. With ``rejects``, a path, bad rows are written to the table
    there instead (the line, its file, and what could be read of it), one
    version per read, and the good ones are returned.
    """
    schema = seed_schema(spark, name, path)
    own = [F.col(f"`{c}`").alias(c.strip()) for c in schema.names]
    wanted = [f.name for f in RAW_SCHEMAS[name].fields]
    # Always true, but it needs every column, so none is left unparsed.
    all_read = F.xxhash64(*own).bitwiseOR(F.lit(1)) != 0
    reader = _csv(spark).option("enforceSchema", False)
    if rejects is None:
        rows = reader.option("mode", "FAILFAST").schema(schema).csv(path).where(all_read)
        return rows.select(*own).select(*wanted)
    rows = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
            .csv(path))
    bad = F.col(CORRUPT).isNotNull()
    sinks.write_table(rows.where(bad).select(
        F.lit(name).alias("seed"), F.input_file_name().alias("file"),
        F.col(CORRUPT).alias("line"), F.struct(*own).alias("parsed")), rejects)
    return rows.where(~bad & all_read).select(*own).select(*wanted)


def read_parquet_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read a parquet feed and project it to the declared column order/types."""
    return declared(spark.read.parquet(path), name)


def declared(df: DataFrame, name: str) -> DataFrame:
    schema = RAW_SCHEMAS[name]
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


V1_SOURCES = "spark.sql.sources.useV1SourceList"


def footer_max(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row, newest: the maximum of a TIMESTAMP_NTZ column of Parquet files,
    by the aggregate push-down of the v2 reader. It answers for long columns, not
    for timestamps, so the column is read as the microseconds it is stored in.
    All files have the same columns in the same order, by which the reader finds
    the statistics, as files of one write have. A file whose column is null
    throughout has none; the read then fails and says so."""
    before = spark.conf.get(V1_SOURCES)
    # Read from one footer.
    schema = T.StructType([T.StructField(f.name, T.LongType()) if f.name == column else f
                           for f in spark.read.parquet(path).schema])
    # The list is read where the relation is made; spark.sql.parquet.aggregatePushdown
    # (session.py), without which the column is read after all, when the query runs.
    spark.conf.set(V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        rows = spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, before)
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    micro = F.expr("INTERVAL '0.000001' SECOND")
    return rows.agg(F.max(column).alias("_us")).select((epoch + F.col("_us") * micro).alias("newest"))


@dataclass(frozen=True)
class SourceCatalog:
    """Logical name -> physical path or table, per environment.

    ``locations`` maps a source group (``raw_sales``, ``raw_finance``) to a base
    directory or a ``catalog.schema`` prefix; ``fmt`` is ``parquet``, ``csv`` or
    ``table``. With ``rejects``, bad rows of a CSV seed go to a table of the
    seed's name under that path instead of failing the read.
    """

    locations: dict[str, str] = field(default_factory=dict)
    fmt: str = "parquet"
    rejects: str | None = None

    def location(self, name: str) -> str:
        group, identifier = SOURCE_IDENTIFIERS[name]
        base = self.locations[group]
        if self.fmt == "table":
            return f"{base}.{identifier}"
        suffix = ".csv" if self.fmt == "csv" else ""
        return f"{base.rstrip('/')}/{identifier}{suffix}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        where = self.location(name)
        if self.fmt == "csv":
            bad = f"{self.rejects.rstrip('/')}/{SOURCE_IDENTIFIERS[name][1]}" if self.rejects else None
            return read_csv_seed(spark, name, where, bad)
        if self.fmt == "table":
            return declared(spark.table(where), name)
        return read_parquet_source(spark, name, where)


class StoredFeeds:
    """Raw feeds stored as parquet under one directory, by their physical
    names (``raw_orders``, ``raw_order_items``...), read with declared schemas.
    Exposes the same attributes as ``RawFeeds``, so the model graph runs on
    either."""

    EXTRA = ("customer_extracts", "customer_loads")
    #: Made from the stored feed itself, for the jobs that read it.
    DERIVED = ("order_line_sketch",)

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        extra = (*self.EXTRA, *self.DERIVED)
        if name.startswith("_") or (name not in SOURCE_IDENTIFIERS and name not in extra):
            raise AttributeError(name)
        if name in extra and not self._stored(name):
            raise AttributeError(f"{name} is not stored in {self.base_dir}")
        if name not in self._cache:
            if name in SOURCE_IDENTIFIERS:
                ident = SOURCE_IDENTIFIERS[name][1]
                self._cache[name] = read_parquet_source(self.spark, name, f"{self.base_dir}/{ident}")
            else:
                self._cache[name] = self.spark.read.parquet(f"{self.base_dir}/{name}")
        return self._cache[name]

    def newest(self, name: str, loaded_at: str = "_loaded_at") -> DataFrame:
        """One row, max_loaded_at: the newest load time of a stored feed, from the
        statistics in the footers of its files; no column is read."""
        path = f"{self.base_dir}/{SOURCE_IDENTIFIERS[name][1]}"
        return footer_max(self.spark, path, loaded_at).withColumnRenamed("newest", "max_loaded_at")

    def _stored(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base_dir}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)


def write_feeds(raw, base_dir: str, names: tuple[str, ...] | None = None,
                files: int | None = None) -> str:
    """Write raw feeds (any object exposing them) to ``base_dir`` as parquet,
    under their physical names; returns ``base_dir``.

    ``files`` spreads each feed over that many files (round-robin), like a
    loaded raw table, so later scans are split across tasks."""
    base = base_dir.rstrip("/")
    for name in names or (*SOURCE_IDENTIFIERS, *StoredFeeds.EXTRA):
        ident = SOURCE_IDENTIFIERS[name][1] if name in SOURCE_IDENTIFIERS else name
        df = getattr(raw, name)
        if files:
            df = df.repartition(files)
        df.write.mode("overwrite").parquet(f"{base}/{ident}")
        if name == "order_items":  # one scan now, none in every refresh that joins the lines
            lines = df.sparkSession.read.schema(df.schema).parquet(f"{base}/{ident}")
            sketch(lines, "order_id").write.mode("overwrite").parquet(f"{base}/order_line_sketch")
    return base
