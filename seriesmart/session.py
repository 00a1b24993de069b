"""Session construction and the shared scratch folder.

Everything in the package works on any SparkSession; ``build_session`` only
collects the settings we want for local runs and tests.  Scratch output
(round-trip fixtures, staged loads, checkpoints) goes under the folder named by
``spark.checkpoint.dir`` - on a cluster that is a shared file system path.  A
local temporary folder is created only on a local master that names none;
elsewhere a missing setting is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn joins into broadcasts when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Timestamps in the data model are wall-clock values.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "seriesmart", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only on a local master."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: only its conf is visible
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="seriesmart-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "seriesmart", *parts, uuid.uuid4().hex])


def stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again: later steps
    neither recompute them nor depend on an executor that holds them."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
