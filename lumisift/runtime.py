"""Session-level helpers shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders written by :func:`stored`, by application.
_STORED: dict[str, list[str]] = {}
#: Folders of :func:`stored_once`, by application, name and files read.
_ONCE: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a local one is set if it runs in one process (tests, a
    laptop); on a cluster that is an error, as executors don't see each other's disks.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lumisift-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Computes ``df`` once and continues from a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Computes ``df`` once into Parquet files in the shared folder and reads them back; :func:`clear_stored` removes them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_once(df: DataFrame, name: str, source: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """As :func:`stored`, but a folder of that name that was made in this session from the same files of ``source`` is read again, if it is still there."""
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, name, tuple(sorted(source.inputFiles())))
    if key in _ONCE and key[2]:
        try:
            return spark.read.parquet(_ONCE[key])
        except AnalysisException:  # removed since
            pass
    held = stored(df, name, partition_by)
    _ONCE[key] = _STORED[key[0]][-1]
    return held


def clear_stored(spark: SparkSession) -> int:
    """Removes all folders that :func:`stored` wrote in this session, whose DataFrames can't be used any more; gives their number."""
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def bounded_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """At most ``size`` rows, those whose keys hash lowest; the same rows in every run.

    Rows are first thinned by the hash to about one and a half times ``size``, so that
    tasks don't each send ``size`` rows, however many tasks there are.
    """
    fine = 1 << 40
    share = min(1.0, 1.5 * size / max(1, df.count()))
    h = F.xxhash64(key, F.lit(seed))
    return df.where(F.pmod(h, F.lit(fine)) <= int(share * fine)).orderBy(h, key).limit(size)


def _bytes_of(text: str) -> int:
    """A size as the session states it: a number, or one with b, k, m or g behind it."""
    low = text.lower().removesuffix("b") or "0"
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(low[-1], 1)
    return int(low if unit == 1 else low[:-1]) * unit


def spread(df: DataFrame) -> DataFrame:
    """Redistributes the projection of a table whose files make fewer than half as many tasks as there are cores; others stay as they are.

    Only the sizes of a few files are read for that: a table of many files is never listed anew.
    """
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not files or 2 * len(files) > cores:
        return df
    task = _bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    total = spark.read.format("binaryFile").load(files).agg(F.sum("length").alias("n")).first()["n"] or 0
    return df if 2 * total > cores * task else df.repartition(cores)
