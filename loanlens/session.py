"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from loanlens.functions.values import col

# Rows that are worth a task of their own, and the most that one gets.
FEWEST_ROWS, MOST_ROWS = 2048, 65536


def local_session(cores: int | str = "*", name: str = "loanlens") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # The JVM never compiles methods above 8000 bytes; smaller ones are generated then.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Python call sites are only of use for error messages; recording them is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure that reliable checkpoints have a folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session without one gets a folder of its own.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loanlens-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def checkpoint_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and go on from there.

    For what is read several times: a lost executor then costs a re-read, not a run
    of everything before. As a columnar table it also lets every later pass read
    just the columns it needs.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a small table over all cores, for steps whose work lies in the rows themselves.

    A table of few bytes is read by one or two tasks, however long each row takes. Rows are
    dealt and ordered by their values, so a task always meets the same ones in the same order.
    """
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(cores, rows // FEWEST_ROWS)
    if rows > MOST_ROWS * cores:
        # A reader packs several files into a task; as many files per core leave no core behind.
        tasks = cores * math.ceil(rows / (MOST_ROWS * cores))
    if tasks <= 1:
        return df
    columns = [col(c) for c in df.columns]
    return df.repartition(tasks, *columns).sortWithinPartitions(*columns)
