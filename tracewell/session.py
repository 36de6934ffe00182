"""What operators need of a session: folders that all executors see, and their own code on the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a kept result that are worth a task of their own, and the fewest tasks that read one.
_TASK_BYTES = 2 << 20
_FEWEST_TASKS = 12


def _base(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where none is set, a folder of our own will do only if all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (folder or tempfile.mkdtemp()).rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    return f"{_base(spark)}/tracewell-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """df, computed once and kept where a lost executor costs nothing.

    Only its rows are kept: a checkpoint hands on what its plan was thought to weigh, and rounds of joins would multiply
    that until the numbers have millions of digits.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_base(df.sparkSession))
    kept = df.checkpoint(eager=True)
    file = kept._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        _files(df.sparkSession).append(file.get())
    made = df.sparkSession._jsparkSession.internalCreateDataFrame(kept._jdf.queryExecution().toRdd(), kept._jdf.schema(), False)
    return DataFrame(made, df.sparkSession)


def compact(df: DataFrame) -> DataFrame:
    """durable(df), read by as many tasks as its bytes are worth, if its partitions are more.

    Each task of a later shuffle leaves files and what Spark writes down about it, however few rows it has.  Not for
    results whose partitions mean something.
    """
    spark = df.sparkSession
    before = kept_so_far(spark)
    kept = durable(df)
    if kept_so_far(spark) == before:
        return kept
    path = spark._jvm.org.apache.hadoop.fs.Path(_files(spark)[-1])
    held = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    tasks = max(_FEWEST_TASKS, -(-held // _TASK_BYTES))
    return kept.coalesce(tasks) if tasks_of(kept) > tasks else kept


def tasks_of(kept: DataFrame) -> int:
    """How many tasks read a kept result, 1 at least."""
    return max(1, kept._jdf.queryExecution().toRdd().getNumPartitions())


def _files(spark: SparkSession) -> list[str]:
    """Where this context's results are kept, in the order they were made."""
    context = spark.sparkContext
    if not hasattr(context, "_tracewell_kept"):
        context._tracewell_kept = []
    return context._tracewell_kept


def kept_so_far(spark: SparkSession) -> int:
    """How many results have been kept."""
    return len(_files(spark))


def drop_kept(spark: SparkSession, first: int, last: int) -> None:
    """Delete the results from the first to before the last, by the order they were made; nothing may need them any more."""
    files = _files(spark)
    for i in range(first, last):
        if files[i]:
            path = spark._jvm.org.apache.hadoop.fs.Path(files[i])
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            files[i] = ""


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a context; they need not have it installed."""
    context, root = spark.sparkContext, Path(__file__).parent
    if not root.is_dir() or getattr(context, "_tracewell_core_shipped", False):
        return
    made = Path(tempfile.mkdtemp()) / "tracewell_core.zip"  # the driver serves it
    with zipfile.ZipFile(made, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(made))
    context._tracewell_core_shipped = True
