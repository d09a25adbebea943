"""Session settings the engine is written for, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache, wraps

from pyspark import InheritableThread, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings that change how plans run, never what they return.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole documents travel to the Python workers: bound a batch by bytes, not by rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}


def build_session(
    app: str = "quireworks", master: str | None = None, scratch: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above. ``scratch`` names the folder for staged rows and
    checkpoints, which all executors must reach (``spark.checkpoint.dir``)."""
    builder = SparkSession.builder.appName(app)
    if scratch:
        conf = {"spark.checkpoint.dir": scratch, **conf}
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def made_once(make: Callable) -> Callable:
    """Keep the columns or functions that ``make`` returns, for the same arguments in the same
    application: to make a column takes some calls of the JVM for each of its parts, which a
    micro-batch would make anew. The arguments must be hashable and no columns."""
    kept = lru_cache(maxsize=64)(lambda application, *args: make(*args))

    @wraps(make)
    def get(*args):
        return kept(SparkContext.getOrCreate().applicationId, *args)

    return get


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder of ``spark.checkpoint.dir``.

    Every executor must be able to reach the folder, so there is no default.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root.rstrip('/')}/quireworks/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoint below the scratch folder where the session has no checkpoint folder yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))


def materialize(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Write rows that several steps read to the scratch folder; returns them and the path.

    Cuts the lineage (a lost executor does not repeat the work before), and gives the
    optimizer true sizes and counts.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def bucketed(df: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Write rows to the scratch folder in buckets by keys, one for each shuffle partition, so
    that several joins on these keys need not shuffle them again. Only the files are kept."""
    spark = df.sparkSession
    path, name = scratch_dir(spark, purpose), f"quireworks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def spread_over_cores(df: DataFrame) -> DataFrame:
    """Give every core a share of a small input before heavy work on its rows.

    A file is split no finer than its row groups, so a small table may sit in one task.
    Only an input of less than one full split per core is redistributed: the shuffle is
    bounded by the size of the cluster and a large table is left as it is read. So is a
    stream, whose size nobody knows.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(2 * cores) if size < cores * split else df


def _class(spark: SparkSession, name: str):
    """A class of the JVM by its whole name: one call, where attributes are one for each part."""
    return getattr(spark._jvm, name)


def _located(spark: SparkSession, path: str):
    """A path and its file system."""
    jpath = _class(spark, "org.apache.hadoop.fs.Path")(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _located(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    jpath, fs = _located(spark, path)
    fs.delete(jpath, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    jpath, fs = _located(spark, path)
    return fs.getContentSummary(jpath).getLength()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, hidden ones left out; none where there is no folder."""
    jpath, fs = _located(spark, path)
    if not fs.exists(jpath):
        return []
    paths = _class(spark, "org.apache.hadoop.fs.FileUtil").stat2Paths(fs.listStatus(jpath))
    joined = _class(spark, "scala.collection.immutable.ArraySeq").unsafeWrapArray(paths).mkString("\n")
    names = (line.rsplit("/", 1)[-1] for line in joined.split("\n"))
    return sorted(n for n in names if n and n[0] not in "._")


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder to a name that is free; false where there is no such folder or the name is taken."""
    jsource, fs = _located(spark, source)
    jtarget = _class(spark, "org.apache.hadoop.fs.Path")(target)
    if not fs.exists(jsource) or fs.exists(jtarget):
        return False
    fs.mkdirs(jtarget.getParent())
    return fs.rename(jsource, jtarget)


@contextmanager
def beside(task: Callable[[], object] | None) -> Iterator[None]:
    """Run a task in a thread of its own while the context lasts; what it raises is raised at the end."""
    if task is None:
        yield
        return
    raised: list[BaseException] = []

    def run() -> None:
        try:
            task()
        except BaseException as exc:
            raised.append(exc)

    thread = InheritableThread(target=run)
    thread.start()
    try:
        yield
    finally:
        thread.join()
    if raised:
        raise raised[0]
