"""Rows of vectors as integer components, what the vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .graph import stored

#: A component becomes floor(SCALE * x).
SCALE = 256


def common_length(vectors: DataFrame, multiple: int = 1) -> int:
    """The most frequent length that ``multiple`` divides (of several, the largest); 0 if there is none."""
    n = F.size("vector").alias("n")
    top = (vectors.filter("vector IS NOT NULL").groupBy(n).count().filter(f"n > 0 AND n % {multiple} = 0")
           .orderBy(F.desc("count"), F.desc("n")).limit(1).collect())
    return top[0]["n"] if top else 0


def largest_component(length: int) -> int:
    """The bound of a component below which sums of ``length`` squared differences fit a long."""
    return int((2 ** 60 / length) ** 0.5)


def integer_rows(vectors: DataFrame, spark: SparkSession, length: int) -> DataFrame:
    """The kept rows of ``(.., vector)``, the vector as ``code``: its integer components, 8 bytes each.

    Dropped are rows whose vector is null, has another length, holds null or
    non-finite components or components whose squares would not fit a long.
    """
    rest = [f for f in vectors.schema.fields if f.name != "vector"]
    most = largest_component(length) if length else 0
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("vector"))
            right = np.array(column.value_lengths().fill_null(-1)) == length
            batch = batch.filter(pa.array(right & (length > 0)))
            values = batch.column(batch.schema.get_field_index("vector")).flatten()
            x = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, max(length, 1))
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(x * SCALE)
                good = (np.abs(x) <= most).all(axis=1)  # false for NaN too
            x = np.ascontiguousarray(x[good].astype("<i8"))
            kept = batch.filter(pa.array(good))
            code = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([kept.column(kept.schema.get_field_index(n)) for n in names] + [code], names + ["code"])

    from pyspark.sql.types import BinaryType, StructField, StructType
    return stored(vectors.mapInArrow(run, StructType(rest + [StructField("code", BinaryType())])), spark, "vectors")


def matrix(codes: pa.Array, length: int) -> np.ndarray:
    """The integer components of some rows' ``code``, a row each."""
    return np.frombuffer(b"".join(codes.to_pylist()), "<i8").reshape(-1, length)
