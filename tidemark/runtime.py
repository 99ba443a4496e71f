"""Session-level helpers: where checkpoints go, and how long lineages are cut."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 50_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure the session has a reliable checkpoint folder and return it.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    used when present.  Only a local session without the setting gets a
    temporary folder: on a cluster a machine-local folder would be lost with
    the executor that wrote it, so there the missing setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def right_sized(df: DataFrame) -> DataFrame:
    """Persist a training set in as many partitions as its rows deserve.

    Iterative fits run one job over all partitions per step, so a small set in
    many partitions costs more in scheduling than in work.  Large sets keep
    their partitions.
    """
    cached = df.persist()
    wanted = -(-cached.count() // ROWS_PER_TASK) or 1
    if wanted >= cached.rdd.getNumPartitions():
        return cached
    packed = cached.coalesce(wanted).persist()
    packed.count()
    cached.unpersist()
    return packed


def run_parallel(spark: SparkSession, tasks: Sequence[Callable[[], object]], threads: int = 8) -> list:
    """Run independent fits side by side, as MLlib's own searches do."""
    ensure_checkpoint_dir(spark)
    if threads <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPool(min(threads, len(tasks))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: task()), tasks)
