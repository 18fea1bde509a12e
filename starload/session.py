"""Session settings and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CLAIMING = threading.Lock()


def local_session(
    app: str, shared: str, cores: int | str = 8, memory: str = "8g"
) -> SparkSession:
    """A single-machine session for tests and the benchmark, with `shared` as scratch folder.

    On a cluster the session comes from the cluster; the library sets nothing on it.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one: `spark.checkpoint.dir`, or where a session names
    none, below the warehouse folder, which all executors share as well."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/starload/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *partitions: str) -> DataFrame:
    """`df` written to the scratch folder, by the partitions if any are named, and read back.

    Cuts the lineage for good: a lost executor re-reads files instead of recomputing,
    and the planner knows the real size, so it can decide by itself what to broadcast.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, into: Observation | None) -> DataFrame:
    """`df`, whose `rows` are counted into the observation, if there is one, while it is written.

    To be used right below a write, where each task counts once however often it is tried.
    Below a shuffle the counts would include tasks that ran again, and those that sample ranges.
    """
    return df if into is None else df.observe(into, F.count(F.lit(1)).alias("rows"))


def stamp() -> str:
    """A name for a run: later ones sort behind earlier ones, and no two are the same."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, wherever it lies, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of one of that name."""
    system, place = _hadoop(spark, path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _hadoop(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, uri: str, longest: int = 1 << 20) -> str | None:
    """The first line of a text file, compressed or not, or nothing if it is empty. Of a longer
    line only the start."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    settings = spark._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(place)
    stream = place.getFileSystem(settings).open(place)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(plain, longest)
        reader = jvm.java.io.InputStreamReader(bounded, "UTF-8")
        return jvm.java.io.BufferedReader(reader).readLine()
    finally:
        stream.close()


def file_sizes(spark: SparkSession, path: str) -> list[int] | None:
    """The sizes of all files below a folder that are not hidden; nothing if there is none."""
    system, place = _hadoop(spark, path)
    if not system.exists(place):
        return None
    sizes, files = [], system.listFiles(place, True)
    while files.hasNext():
        file = files.next()
        if not file.getPath().getName().startswith(("_", ".")):
            sizes.append(file.getLen())
    return sizes


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file of that name, unless there is one: whether this was the one to do so.

    As safe as the file system's create; that of a local disk looks first and then creates, so
    threads of one driver take turns here.
    """
    system, place = _hadoop(spark, path)
    with _CLAIMING:
        try:
            system.create(place, False).close()
        except Py4JJavaError as error:
            if system.exists(place):
                return False
            raise error
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    system, place = _hadoop(spark, path)
    system.delete(place, True)


def folder_ages(spark: SparkSession, path: str) -> list[tuple[str, dt.timedelta]]:
    """What a folder holds, and how long ago each was changed; nothing if it does not exist."""
    system, place = _hadoop(spark, path)
    if not system.exists(place):
        return []
    now = dt.datetime.now(dt.UTC).timestamp()
    return [
        (entry.getPath().getName(), dt.timedelta(seconds=now - entry.getModificationTime() / 1000))
        for entry in system.listStatus(place)
    ]
