"""SparkSession construction and lineage-cutting helpers."""

from __future__ import annotations

import contextlib
import contextvars
import itertools
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants; a cluster launcher may
# override any of them with --conf.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Checkpoints of a run (its staged tables) go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "staffline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage, and an error is raised
    if it does not; only a local master (tests) gets a scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    current = sc.getCheckpointDir() if sc is not None and hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="staffline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
    return configured


#: Folder of the run's staging tables, and how many it holds.
_STAGE: contextvars.ContextVar[tuple[str, Iterator[int]] | None] = contextvars.ContextVar("stage", default=None)


@contextlib.contextmanager
def staged(folder: str):
    """Within the block ``cut_lineage`` writes to ``folder`` (shared storage), which the caller takes away
    when the run is over: what a run stages does not outlive it, whatever still refers to it."""
    token = _STAGE.set((folder, itertools.count()))
    try:
        yield
    finally:
        _STAGE.reset(token)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame written out and read back: a reliable checkpoint into the shared
    checkpoint folder, or within a run a table of its staging folder.

    Used between chained reconciliation passes so a lost executor
    recomputes from the last written state, not from the raw snapshot.
    """
    stage = _STAGE.get()
    if stage is not None:
        path = f"{stage[0]}/{next(stage[1])}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
