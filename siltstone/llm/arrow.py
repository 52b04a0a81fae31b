"""Row-by-row text work in Arrow batches, for operators that built-in functions cannot express."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows handled together; texts may be long, so batches are cut small.
SLICE_ROWS = 256

Columns = list[Sequence]
Step = Callable[[list[bytes | None]], Columns]


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package also where only the driver's path names it."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))


def texts(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    return column.cast(pa.large_binary()).to_pylist()


def with_texts(
    df: DataFrame, keep: Sequence[str], text: str, fields: Sequence[T.StructField], make: Callable[[], Step]
) -> DataFrame:
    """Columns ``keep`` and new ``fields``, made from ``text`` by the function that ``make()`` gives once a task.

    One row comes out for each row that goes in; other columns of ``df`` are not read.
    """
    importable(df.sparkSession)
    source = df.select(*(df[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)), df[f"`{text}`"].cast("string").alias("_t"))
    kept = [T.StructField(c, df.schema[c].dataType) for c in keep]
    schema = T.StructType([*kept, *fields])
    names = schema.names
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                made = step(texts(piece.column(width)))
                columns = [piece.column(i) for i in range(width)]
                columns += [pa.array(values, kind) for values, kind in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)
