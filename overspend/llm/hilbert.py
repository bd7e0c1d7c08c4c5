"""Sharding along a Hilbert curve through several metadata dimensions. DataFrame operations only.

Each dimension is quantised into cells of about equally many rows; the cells' coordinates give a place on the Hilbert curve, whose neighbours differ in one
coordinate by one. Rows are sorted by their place and cut into runs, so a shard covers a small box in every dimension and a reader
with a condition on any of them can skip most shards by their least and greatest values.

Only metadata is sorted, never the texts. Rows are dealt by ranges of (curve, content, id, row), so a cell of any size is spread over
tasks; places come from the sizes of the sorted tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from overspend.llm.common import written
from overspend.llm.vectors import numbered

BITS = 4
#: Accuracy of the quantiles that bound the cells.
ACCURACY = 10_000
#: Bytes of a text, after what all values have in common, that order it as a number.
TEXT_BYTES = 6


def curve_index(coordinates: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve through whole-number coordinates of ``bits`` bits, as a long.

    The coordinates are transposed as Skilling describes: excess rotations are undone from the highest bit down, then the Gray code is taken; the
    bits are interleaved last. ``len(coordinates) * bits`` must be at most 62.
    """
    if len(coordinates) * bits > 62:
        raise ValueError("a curve index has 62 bits at most")
    size = len(coordinates)

    def at(x: Column, i: int) -> Column:
        return F.get(x, F.lit(i))

    # Each step makes a new array inside a one-element transform, so no expression is repeated by the next step.
    def step(x: Column, body: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(x), body), F.lit(0))

    def turn(i: int, q: int) -> Callable[[Column], Column]:
        def body(a: Column) -> Column:
            p, first, own = F.lit(q - 1), at(a, 0), at(a, i)
            high, swapped = own.bitwiseAND(F.lit(q)) != 0, first.bitwiseXOR(own).bitwiseAND(F.lit(q - 1))
            new_first = first.bitwiseXOR(F.when(high, p).otherwise(swapped))
            new_own = F.when(high, own).otherwise(own.bitwiseXOR(swapped))
            return F.array(*[new_first if k == 0 else new_own if k == i else at(a, k) for k in range(size)])

        return body

    def gray(i: int) -> Callable[[Column], Column]:
        return lambda a: F.array(*[at(a, k).bitwiseXOR(at(a, i - 1)) if k == i else at(a, k) for k in range(size)])

    x = F.array(*[c.cast("int") for c in coordinates])
    for bit in range(bits - 1, 0, -1):
        for i in range(size):
            x = step(x, turn(i, 1 << bit))
    for i in range(1, size):
        x = step(x, gray(i))

    def untwist(a: Column) -> Column:
        last, twist = at(a, size - 1), F.lit(0)
        for bit in range(bits - 1, 0, -1):
            twist = twist.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
        index = F.lit(0).cast("long")
        for bit in range(bits - 1, -1, -1):
            for k in range(size):
                one = F.shiftright(at(a, k).bitwiseXOR(twist), bit).bitwiseAND(F.lit(1)).cast("long")
                index = index.bitwiseOR(F.shiftleft(one, bit * size + size - 1 - k))
        return index

    return step(x, untwist)


def _as_number(name: str, kind: T.DataType, common: int) -> Column:
    """A number that orders values as their type does; of a text, the bytes after those that all texts have in common."""
    if isinstance(kind, T.StringType):
        head = F.hex(F.substring(F.col(name).cast("binary"), common + 1, TEXT_BYTES))
        return F.conv(F.rpad(head, 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def quantised(df: DataFrame, dimensions: Sequence[str], bits: int = BITS, prefix: str = "_cell_") -> DataFrame:
    """Adds each dimension's cell: the number of cell bounds that its value reaches; nulls and NaN are in cell 0.

    The bounds are quantiles from sketches of bounded size, taken in one pass (two where a dimension is text, whose common start
    is found first). Equal values always share a cell.
    """
    kinds = {d: df.schema[d].dataType for d in dimensions}
    common = {d: 0 for d in dimensions}
    if texts := [d for d in dimensions if isinstance(kinds[d], T.StringType)]:
        ends = df.agg(*[f(d).alias(f"{d}{i}") for d in texts for i, f in enumerate((F.min, F.max))]).first()
        for d in texts:
            low, high = ((ends[f"{d}{i}"] or "").encode() for i in (0, 1))
            common[d] = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    cells = 1 << bits
    numbers = {d: _as_number(d, kinds[d], common[d]) for d in dimensions}
    numbers = {d: F.when(~F.isnan(n), n) for d, n in numbers.items()}
    shares = [i / cells for i in range(1, cells)]
    bounds = df.agg(*[F.percentile_approx(n, shares, ACCURACY).alias(d) for d, n in numbers.items()]).first()

    def cell(d: str) -> Column:
        limits = sorted(set(bounds[d] or []))
        # Few values leave cells unused; those in use are spread over all coordinates.
        reached = F.size(F.filter(F.array(*[F.lit(b) for b in limits]), lambda b: b <= numbers[d])) if limits else F.lit(0)
        scale = (cells - 1) / max(len(limits), 1)
        return F.when(numbers[d].isNull(), F.lit(0)).otherwise(F.floor(reached * scale).cast("int"))

    return df.withColumns({f"{prefix}{i}": cell(d) for i, d in enumerate(dimensions)})


def assign(metadata: DataFrame, dimensions: Sequence[str], shards: int, law: str = "rows", size: str = "size", tie: Sequence[str] = (),
           bits: int = BITS) -> DataFrame:
    """The rows with ``curve``, ``shard`` from 0 and ``slot``, gapless from 0 in each shard, along the curve.

    law ``rows``: shards hold equally many rows, at most one more or less. law ``bytes``: a row goes to the shard that holds the middle of
    its bytes on the curve, so a shard departs from an equal share by half of its first and last row at most.
    ``tie`` orders rows of one place; rows equal in it come in any order. Nulls sort first. Repeated rows each have a slot of
    their own; other columns stay, but ``curve``, ``position``, ``shard`` and ``slot`` are replaced and names that start with ``_`` are reserved.
    An empty table gives no rows; with fewer rows than shards, some shards stay empty.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"no law {law!r}")
    taken = [c for c in metadata.columns if c not in ("curve", "position", "shard", "slot")]
    celled = quantised(metadata.select(*taken), dimensions, bits)
    cells = [f"_cell_{i}" for i in range(len(dimensions))]
    placed = numbered(celled.withColumn("curve", curve_index([F.col(c) for c in cells], bits)).drop(*cells), ["curve", *tie], "hilbert")
    if law == "rows":
        total = max(placed.count(), 1)
        starts = F.array(*[F.lit(-(-s * total // shards)).cast("long") for s in range(shards)])
        cut = placed.withColumn("shard", F.expr(f"cast((position * {shards}L) div {total}L as int)"))
        return cut.withColumn("slot", F.col("position") - F.get(starts, F.col("shard")))
    return _cut_by_bytes(placed, shards, size)


def _cut_by_bytes(placed: DataFrame, shards: int, size: str) -> DataFrame:
    """Shards of equal bytes. Running sums are taken inside blocks of places and shifted by the totals of earlier blocks."""
    blocked = placed.withColumn("_block", F.shiftright("position", 16))
    before = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy("_block").agg(F.sum(size).alias("_sum")).select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    total = max(blocked.agg(F.sum(size)).first()[0] or 0, 1)
    inside = Window.partitionBy("_block").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    run = blocked.withColumn("_sum", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(sums, "_block")
    middle = f"((2 * (_start + _sum) + {size}) * {shards}L) div {2 * total}L"
    cut = run.withColumn("shard", F.expr(f"cast(least({middle}, {shards - 1}L) as int)"))
    firsts = cut.groupBy("shard").agg(F.min("position").alias("_first"))
    return cut.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("position") - F.col("_first")).drop("_block", "_sum", "_start", "_first")


def with_sizes(documents: DataFrame) -> DataFrame:
    """Adds ``size``, the text's bytes plus 8, and ``text_crc32``. A null text counts as empty; columns of these names are replaced."""
    text = F.coalesce("text", F.lit(""))
    return documents.withColumns({"size": (F.octet_length(text) + 8).cast("long"), "text_crc32": F.crc32(text.cast("binary"))})


DIMENSIONS = ("source", "lang", "size")


TIE = ("text_crc32", "size", "doc_id")


def shard_documents(documents: DataFrame, shards: int = 24, law: str = "rows", dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Documents' metadata with shard and slot; equal texts of one place on the curve are neighbours.

    Texts are read once, for their size and checksum; the passes for quantiles, ranges and places read the written metadata.
    """
    metadata = with_sizes(documents).select(*dict.fromkeys(["doc_id", *dimensions, "size", "text_crc32"]))
    return assign(written(metadata, "hilbert-metadata"), dimensions, shards, law, tie=TIE)


def manifest(sharded: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per shard: rows, bytes, and the least and greatest value of each dimension, by which a reader skips shards."""
    ends = [f(d).alias(f"{name}_{d}") for d in dimensions for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends)


def write_shards(documents: DataFrame, path: str, shards: int = 24, law: str = "rows", dimensions: Sequence[str] = DIMENSIONS) -> None:
    """All columns of the documents as one folder per shard. The texts are shuffled once; a shard is written by all tasks that hold
    a piece of its run, one file each, sorted by slot."""
    sharded = assign(with_sizes(documents), dimensions, shards, law, tie=TIE)
    sharded.drop("position").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
