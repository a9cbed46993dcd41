"""Session settings for running the marts (tests, bench, local jobs).

On a cluster the session comes from the platform; only the settings below
matter to the plans, and ``spark.checkpoint.dir`` is read from the session
(a shared folder), never invented here unless it is unset, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions (also when that costs an extra shuffle downstream), and turn a
# shuffle join into a broadcast join when a side proves small at runtime.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Size-checked broadcast: the planner broadcasts a join side only when its
    # estimated (and, under AQE, its measured) size is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # max() of a stored feed's load time from Parquet footers (sources/files.py).
    "spark.sql.parquet.aggregatePushdown": "true",
    # Spark's own bloom filter of a join's filtered side, applied to a large scan
    # before its shuffle; beyond this size of the filtered side there is none.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.session.timeZone": "UTC",
    # Remove checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def plan_session(app: str) -> SparkSession:
    """The platform's session with the plan settings in force."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    for k, v in PLAN_SETTINGS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[*]", app: str = "closebook",
                  shuffle_partitions: int = 8, extra: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**PLAN_SETTINGS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    ``spark.checkpoint.dir`` from the session wins. Only when it is unset is
    a folder chosen: the one named by CLOSEBOOK_SCRATCH, else a scratch folder
    for local sessions (tests), or ``<warehouse>/_checkpoints`` on a cluster. A
    cluster whose warehouse is on a local disk has no folder that all executors
    share; that is an error, not a place to write to.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if os.environ.get("CLOSEBOOK_SCRATCH"):
            path = os.environ["CLOSEBOOK_SCRATCH"]
        elif spark.sparkContext.master.startswith("local") \
                and not spark.sparkContext.master.startswith("local-cluster"):
            path = tempfile.mkdtemp(prefix="closebook-ckpt-",
                                    dir=os.environ.get("TMPDIR", "/tmp"))
        else:
            path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
            if file_system(spark, path)[0].getScheme() == "file" \
                    and not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is unset and the warehouse is on a local "
                                   "disk: name a folder that the whole cluster shares")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a folder or file, whatever its scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_bytes(spark: SparkSession, folder: str) -> int:
    fs, path = file_system(spark, folder)
    return fs.getContentSummary(path).getLength()


def broadcast_bytes(spark: SparkSession) -> int:
    """The size below which the planner broadcasts a join side."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def drop_folder(spark: SparkSession, folder: str) -> None:
    fs, path = file_system(spark, folder)
    fs.delete(path, True)


_open_scopes: list[list[str]] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder of the session. Within a
    ``scratch_scope`` it is deleted when the scope ends; else it stays, as what
    reads it may run at any later time."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/closebook-{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes all scratch folders made within, when it ends: run the actions on
    what was built from them inside."""
    folders: list[str] = []
    _open_scopes.append(folders)
    try:
        yield folders
    finally:
        _open_scopes.remove(folders)
        for folder in folders:
            drop_folder(spark, folder)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back: it is computed once,
    its lineage is cut, and it survives the loss of any executor."""
    from closebook.sources.sinks import shuffles_dropped
    path = scratch_folder(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
