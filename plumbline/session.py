"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Settings that hold for every job of this package and may be changed at run
# time. Adaptive execution sizes broadcasts, merges small shuffle partitions
# and splits skewed ones; the forced variant also splits a hot key when two
# joins in a row use the same key.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A write that keeps rejected lines beside the good ones has two files open and sorts nothing.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def tuned(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        # Recording the Python call site of every expression costs more than
        # planning it. The setting is static, so it goes in at launch.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = tuned(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_row(spark: SparkSession, schema: T.StructType, values: Sequence) -> DataFrame:
    """A frame of one row in one partition, made of literals: no Python data goes through a job."""
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(schema, values)]
    )


def side_by_side(spark: SparkSession, work: Callable[[str], object], names: Iterable[str]) -> list:
    """``work`` for each name, in threads: where the tasks of one job run out, those of the next begin."""
    names = list(names)
    if not names:
        return []
    with ThreadPoolExecutor(len(names)) as pool:
        # Each thread has the job group and other properties of the caller.
        jobs = [pool.submit(inheritable_thread_target(spark)(work), name) for name in names]
        return [job.result() for job in jobs]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that every executor can reach.

    A cluster names that folder in ``spark.checkpoint.dir``. Where it is unset
    and the session is local, a temporary folder of this machine serves.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="plumbline-")
    return f"{shared.rstrip('/')}/plumbline/{purpose}-{uuid.uuid4().hex}"
