"""Vector columns in tasks: whole-number components, Arrow batches as matrices, rows numbered without gaps."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from overspend.llm.common import written

#: Sums of products stay exact below this size in double precision.
EXACT = float(1 << 53)


def is_finite(vector: str) -> Column:
    """True for vectors that are not null and hold neither nulls nor NaN nor infinities; an empty vector is finite."""
    bad = F.exists(F.col(vector).cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def whole(vector: str, factor: int, shift: int = 0) -> Column:
    """``floor(factor * x) + shift`` of every component, as whole numbers."""
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * factor) + F.lit(shift).cast("long"))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``function`` to the Arrow batches of each task; it gives dictionaries of columns."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(batches):
            columns = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, kind)


def matrix(column: pa.Array, width: int, fill: int = 0) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix; shorter lists are filled up."""
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), np.int64)
    if len(flat) == len(column) * width and (sizes == width).all():
        return flat.reshape(len(column), width)
    rows = np.full((len(column), width), fill, np.int64)
    rows[np.arange(width) < sizes[:, None]] = flat
    return rows


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, max(1, rows)):
        yield batch.slice(start, max(1, rows))


def numbered(df: DataFrame, order: list[str], purpose: str, name: str = "position") -> DataFrame:
    """The rows, written, with their place from 0 without gaps in the order of the columns.

    Rows are dealt by ranges of the order and sorted in their tasks; a column of row numbers, added last, lets even
    equal rows go to several tasks. The offsets are one row per task.
    """
    keys = [*order, "_row"]
    placed = (df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
              .drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    stored = written(placed, purpose)
    parted = stored.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parted.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return parted.join(F.broadcast(offsets), "_part").withColumn(name, place).drop("_part", "_at", "_before")
