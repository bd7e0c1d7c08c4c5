"""Helpers shared by the operators: Arrow batches in tasks, written tables, hashing of byte strings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from overspend.session import remove_path, shared_dir

#: Words are runs of anything but these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

Batch = dict[str, list]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder: cuts lineage and outlives executors."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def release(*tables: DataFrame) -> None:
    """Remove the folders of written tables that nothing reads any more."""
    for table in tables:
        remove_path(table.sparkSession, table.written_to)


def map_batches(df: DataFrame, function: Callable[[Iterator[Batch]], Iterator[Batch]], schema: str) -> DataFrame:
    """Apply ``function`` to the rows of each task, as dictionaries of column lists. One batch is in memory at a time."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
                  for batch in batches for part in _split(batch))
        for out in function(pieces):
            yield pa.RecordBatch.from_arrays([_column(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def _split(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` bytes, one row at least."""
    rows = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _column(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, kind)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


class RollingHash:
    """Hashes of any substring of a byte string, from prefix sums modulo 2^64.

    Bytes stand for random odd numbers and the base is a random odd number, whose inverse makes a hash
    independent of the position. Results are scrambled, since the low bits of such sums are weak.
    """

    def __init__(self) -> None:
        self.letters = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, 1 << 16)
            base = 0x9E3779B97F4A7C15
            self.powers = _geometric(base, size)
            self.inverses = _geometric(pow(base, -1, 1 << 64), size)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[:len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverses[starts])

    def grams(self, data: np.ndarray, size: int) -> np.ndarray:
        sums = self.prefix(data)
        return mix((sums[size:] - sums[:-size]) * self.inverses[:len(data) - size + 1])


def _geometric(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)
