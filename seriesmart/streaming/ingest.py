"""Incremental file ingest with Structured Streaming.

New files that land in a folder are parsed with the same positional parser as
the batch path and appended to a Parquet table.  The checkpoint records which
files were taken, so running the ingest again over the same folder adds no
rows; ``trigger(availableNow=True)`` processes what is there and stops, which
suits a scheduled job.  Revised history (a changed file under the same name)
is not picked up by a file source - reload it with a full refresh.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.text import HEADER_PREFIX, parse_lines


def freeze_static(*frames: DataFrame) -> list[DataFrame]:
    """Checkpoint the static side of a stream-static join (series, code lists)
    to the shared checkpoint folder: every micro-batch then joins the same
    rows, lineage is cut, and expressions that streaming plans reject (the
    file-order ids of the code-list reader) are already evaluated."""
    if frames:
        ensure_checkpoint_dir(frames[0].sparkSession)
    return [f.checkpoint(eager=True) for f in frames]


def stream_ingest(spark: SparkSession, landing_dir: str, columns: Sequence[str], out_dir: str,
                  checkpoint: str, min_fields: int | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  on_batch: Callable[[DataFrame, int], None] | None = None,
                  max_files_per_trigger: int | None = None) -> int:
    """Parse every new file under ``landing_dir`` and append it to ``out_dir``.

    ``transform`` shapes the parsed rows (casts, labels).  ``on_batch`` replaces
    the Parquet sink with a per-micro-batch function ``(batch_df, batch_id)``;
    make it idempotent per ``batch_id``.  Returns the number of micro-batches run.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a stream has no first lines: a header is a line whose first field is the column's name
    lines = reader.load(landing_dir).select(F.make_valid_utf8("value").alias("value"))
    parsed = parse_lines(lines, columns, min_fields, header_field=HEADER_PREFIX)
    if transform is not None:
        parsed = transform(parsed)
    before = _last_batch(spark, checkpoint)
    w = parsed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if on_batch is not None:
        q = w.foreachBatch(on_batch).start()
    else:
        q = w.format("parquet").option("path", out_dir).outputMode("append").start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _last_batch(spark, checkpoint) - before


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last micro-batch that the checkpoint has as done, -1 before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)
