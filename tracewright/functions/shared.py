"""Small helpers every operator uses: reading tables, the shared checkpoint folder, session defaults."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(app: str = "tracewright", cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, last map key wins)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TRACEWRIGHT_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; only where that is unset (tests on one
    machine) a temporary folder is chosen and set."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    if spark.sparkContext.master.startswith("local["):
        own = tempfile.mkdtemp(prefix="tracewright-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


#: The tables this process wrote to the shared folder.
_WRITTEN: list[str] = []


def release(spark: SparkSession) -> int:
    """Deletes the tables that ``materialise`` wrote, once no DataFrame that reads them is needed any more; how many."""
    context, n = spark.sparkContext, 0
    while _WRITTEN:
        path = context._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True))
    return n


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage with a table written in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Has Spark delete the shuffle files of what is run inside as soon as it is over. What is run must end in something
    durable, as a written table: nothing else may read these shuffles."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file of any file system Spark knows; None where there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(conf)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside and renamed over the old one, so readers see the old text or the new."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = place.getFileSystem(conf).create(beside)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(beside, place, over)


def spread(df: DataFrame) -> DataFrame:
    """For stages that compute long on each row: more partitions where the input has fewer than there are cores (one
    small file, say). Inputs of many splits, as any large table has, stay as they are and aren't shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once an application, so that Python workers anywhere can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="tracewright-ship-")  # the driver's own; addPyFile serves it to the executors
    try:
        archive = shutil.make_archive(f"{folder}/tracewright", "zip", root, "tracewright")
        context.addPyFile(archive)
    finally:
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _SHIPPED.add(context.applicationId)
