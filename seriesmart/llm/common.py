"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+`` (what bytes.split() splits at).
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (null: empty); any further columns are left out."""
    return docs.select(named(id_col).cast("long").alias("doc_id"),
                       F.coalesce(named(text_col), F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where body uses it in lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Rows of an Arrow batch that are worked on at once.
SLICE = 256


#: Rows of whole texts that Spark sends to a worker at once.
TEXT_ROWS = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows go to the workers in batches of at most ``TEXT_ROWS``: the session's limit is lowered,
    as rows of whole texts make Spark's 10,000 too large for an executor's memory beside its heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key, "10000")) <= TEXT_ROWS:
        df.sparkSession.conf.set(key, str(TEXT_ROWS))
    return df


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of some batches, few at a time, as their texts become Python's."""
    return (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE))


def map_column(df: DataFrame, col: str, out: str, fn: Callable[[list], dict[str, Iterable[Any]]], keep: bool = False) -> DataFrame:
    """Replace column ``col``, and those of their names, by the columns that ``fn`` makes of its values.
    With ``keep`` the column itself stays (rather than being sent twice).

    ``fn`` gets some of the values and returns one sequence per name of the DDL
    ``out``; all other columns pass through as they are.  A worker holds the
    results of ``SLICE`` rows, not those of a whole Arrow batch.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = StructType.fromDDL(out)
    # by place, as names may repeat; a column that is made replaces one of its name
    at_col = df.columns.index(col)
    replaced = {n.lower() for n in made.names}
    rest = [i for i, n in enumerate(df.columns) if (keep or i != at_col) and n.lower() not in replaced]
    schema = StructType([df.schema.fields[i] for i in rest] + made.fields)
    types = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = fn(batch.column(at_col).to_pylist())
            arrays = [batch.column(i) for i in rest]
            arrays += [pa.array(got[t.name], type=t.type) for t in types]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return text_batches(df).toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)  # names may hold dots


#: Rows of a list of ids and keys that are broadcast at most (about 50 MB); a longer one is joined by a shuffle.
BROADCAST_ROWS = 500_000


def bounded(few: DataFrame) -> DataFrame:
    """A stored list, to be broadcast where its counted rows are within the bound, so the texts it meets stay in place."""
    return F.broadcast(few) if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else few


def unused(name: str, columns: Iterable[str]) -> str:
    """A name made of ``name`` that none of the columns has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(column: str) -> Column:
    """The column of exactly this name, also one with dots or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)
