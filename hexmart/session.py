"""Session settings and the shared folder for tables that must outlive an executor."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, name: str = "hexmart", **conf: str) -> SparkSession:
    """A one-machine session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="hexmart-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def wide_rows(spark: SparkSession) -> None:
    """For rows that hold whole groups and may be megabytes long: what this session writes as Parquet is measured row by row, and not first when a
    hundred rows are held.  Where rows are small the writer soon reckons how many make a page."""
    spark.conf.set("parquet.page.size.row.check.min", "1")


# Row groups of such rows: readers hold up to one as plain values.
WIDE = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(8 << 20)}


def materialize(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written table.

    This cuts the lineage at a place that survives the loss of executors, keeps a table that is used
    several times from being computed several times, and leaves column pruning to the Parquet reader.  ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace_stored(old: DataFrame | None, df: DataFrame, tag: str) -> DataFrame:
    """:func:`materialize` ``df``, a step made of the stored table ``old``, which nothing else reads any more: its files go.

    Spark deletes the files of a shuffle once the driver has collected its last reference, so the driver is asked to collect.
    """
    made = materialize(df, tag)
    spark = df.sparkSession
    if old is not None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for folder in {name.rsplit("/", 1)[0] for name in old.inputFiles()}:
            path = hadoop.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return made


# Work that multiplies rows is dealt out so that a task makes about this many.
ROWS_MADE = 1_000_000


def ways(spark: SparkSession, rows: int = 0) -> int:
    """Into how many tasks to deal out work that makes ``rows`` rows, a number that adaptive execution does not lower."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_MADE))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Deal rows out to all cores before work that multiplies them.

    Adaptive execution merges small shuffle partitions by their bytes; a fixed number keeps it from putting rows that
    stand for very many results into one task.
    """
    return df.repartition(ways(df.sparkSession), F.xxhash64(*columns))
