"""Session helpers: shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

# Size up to which a table is sent to every executor; wider rows count for more.
BROADCAST_BYTES = 100_000_000

# Inputs below this size may sit in fewer row groups than there are cores; larger
# ones must not be shuffled for it.
SMALL_INPUT_BYTES = 256 * 1024 * 1024

_local_dirs: dict[str, str] = {}
_app_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="quillsieve-")
    return _local_dirs[app]


def filesystem_of(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder.

    That part is removed when the application ends (see also drop_stages).
    """
    app = spark.sparkContext.applicationId
    if app not in _app_dirs:
        root = f"{shared_dir(spark)}/quillsieve-{app}-{uuid.uuid4().hex}"
        filesystem, target = filesystem_of(spark, root)
        filesystem.mkdirs(target)
        filesystem.deleteOnExit(target)
        _app_dirs[app] = root
    return f"{_app_dirs[app]}/{label}-{uuid.uuid4().hex}"


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step; False if ``target`` exists by now."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(old.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # Without an option to overwrite, the rename fails if the target is there.
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(old, new, options)
        return True
    except Py4JJavaError:
        if not filesystem_of(spark, target)[0].exists(new):
            raise
        return False


def drop_stages(spark: SparkSession) -> None:
    """Remove the stored intermediate tables early; results built on them must be written by now."""
    root = _app_dirs.pop(spark.sparkContext.applicationId, None)
    if root:
        filesystem, target = filesystem_of(spark, root)
        filesystem.delete(target, True)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result is columnar, so later passes read only the columns they use, and
    a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_within(df: DataFrame, max_rows: int, row_bytes: int = 100) -> DataFrame:
    """Broadcast ``df`` if its proven bound of rows is small enough; otherwise it is merged, whatever Spark estimates."""
    return F.broadcast(df) if max_rows * row_bytes <= BROADCAST_BYTES else df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input in few files over the cores before CPU-heavy work."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= SMALL_INPUT_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df
