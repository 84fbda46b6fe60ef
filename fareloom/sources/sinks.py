"""Writers: table output, and staging of an intermediate result that is read many times."""

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.names import quoted

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save_to_parquet(
    df: DataFrame,
    output_path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
    rebalance: bool = True,
) -> None:
    """Write ``df`` as Parquet with the parallelism it has.

    ``partition_by`` lays rows out in one folder per key. Rows are rebalanced on those
    keys first, so a key gets a few well-sized files instead of one per task, and
    adaptive execution splits a key that holds a large share of the rows. For a handful
    of keys ``rebalance=False`` saves that shuffle.
    ``files`` deals the rows out evenly to that many tasks, each of which writes a file. With
    ``partition_by`` a task takes a range of the keys, and a key with a large share of the
    rows several tasks, so there are about as many files as tasks and keys together.
    """
    if files is not None and partition_by:
        df = df.repartitionByRange(files, *partition_by, F.xxhash64(*(quoted(c) for c in df.columns)))
    elif files is not None:
        df = df.repartition(files)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(output_path)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset, the session's
    warehouse folder is taken. A warehouse on the local disk of one machine is refused
    unless the session runs on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if folder.startswith(("file:", "/")) and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors share; {folder} is local to each")
    return folder.rstrip("/")


# The folder of the innermost open scope.
_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A scope that owns the tables staged while it is the innermost: one folder, deleted at its end.

    That also holds after an error. What still reads a staged table has to be stored or collected
    before the scope ends; ``refine`` and ``drop_duplicates``, which return such DataFrames, are
    called within one.
    """
    folder = f"{shared_folder(spark)}/fareloom-{uuid.uuid4().hex}"
    outer = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(outer)
        drop_folder(spark, folder)


def new_folder(spark: SparkSession, name: str, owned: bool = True) -> str:
    """A path in the shared folder that no earlier run has used, below that of the open scope if ``owned``."""
    scope = _scope.get() if owned else None
    return f"{scope or shared_folder(spark)}/fareloom-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str = "stage", infer: bool = True) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written.

    Without ``infer`` the scan takes the columns of ``df``, which spares the job that reads a footer.

    Later passes read only the columns they need, filters reach the files, and losing
    an executor loses no intermediate data. The shuffle files of the write are deleted
    as soon as it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        save_to_parquet(df, path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path) if infer else spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, on whatever filesystem holds it. A missing path is no error."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def drop_staged(staged: DataFrame) -> None:
    """Delete the table a DataFrame returned by ``stage`` scans."""
    files = staged.inputFiles()
    if files:
        drop_folder(staged.sparkSession, files[0].rsplit("/", 1)[0])
