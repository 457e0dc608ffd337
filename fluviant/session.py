"""Session helpers: the session's shared folder, written tables, and shipping of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's checkpoint
    folder. A session on one machine that names none gets one of its own; on a cluster
    that is an error, for there a local folder would be another on each executor."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not given.isDefined():
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(f"{tempfile.gettempdir()}/fluviant-checkpoints-{uuid.uuid4().hex[:8]}")
            given = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = given.get()
    return named.rstrip("/")


#: The setting that bounds a batch of rows on its way to Python.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Tasks a core that write a settled table.
TASKS_PER_CORE = 4


#: Written tables that still exist, in the order of writing, by application.
_tables: dict[str, list[str]] = {}


def scratch(df: DataFrame, name: str, settle: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    The written files cut the lineage: a lost executor costs a re-read, not a
    recomputation, and two readers see the same rows. They go when ``discard`` or
    ``release`` says so, at the latest when the driver ends.
    ``settle`` is for light results of a shuffle: a task then works through several
    shuffle partitions, one after the other, and writes one file for all of them.
    Tables read off a scan keep a task for each split.
    """
    spark = df.sparkSession
    if settle:
        df = df.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    path = f"{shared_folder(spark)}/fluviant/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._fluviant_path = path
    return written


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _tables[spark.sparkContext.applicationId].remove(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``scratch`` returned and that nothing reads any more."""
    _delete(table.sparkSession, table._fluviant_path)


def written_tables(spark: SparkSession) -> list[str]:
    """The tables that exist, in the order of writing."""
    return list(_tables.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, before: list[str], *keep: DataFrame) -> None:
    """Delete all tables written since ``before`` (``written_tables`` of then) but ``keep``,
    themselves written tables, whose rows need none of the others."""
    for path in set(written_tables(spark)).difference(before, (k._fluviant_path for k in keep)):
        _delete(spark, path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if its scan has fewer splits than there are cores.

    For small inputs in one file; a large table is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context.

    Executors need not have it installed, nor share the driver's folders. One setting
    of the session changes by it: Arrow batches, 64 MB by default in each task outside
    the heap, are made 4 MB, unless the session has set their size itself."""
    if spark.conf.get(BATCH_BYTES, "67108864b") in ("67108864b", "67108864"):
        spark.conf.set(BATCH_BYTES, "4m")
    context = spark.sparkContext
    if getattr(context, "_fluviant_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="fluviant-"), "fluviant.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, str(f.relative_to(here.parent)))
    context.addPyFile(target)
    context._fluviant_shipped = True
