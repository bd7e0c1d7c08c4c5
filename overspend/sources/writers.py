"""Table writes: replace, append, monthly partitions, registration and keyed upsert."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overspend.session import folder_names, path_exists, remove_path, size_of

#: Buckets of a table whose creator names no number; a large table wants about one per million rows.
BUCKETS = 8

#: Runs of one size that become a longer one.
JOINED = 8


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table and its schema."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def write_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write one folder per value, replacing only the folders that ``df`` has rows for.

    Running it again for a month gives the same table. The rebalance hint joins small pieces and splits
    large values, so one busy month is still written by several tasks.
    """
    (df.hint("rebalance", F.col(column)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))


def register(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make a stored table known by name."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key. Partial aggregation leaves one row per key and task before the shuffle."""
    columns = [F.col(c) for c in df.columns]
    last = df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("row"))
    return last.select("row.*")


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _note(spark: SparkSession, path: str, text: str) -> None:
    spark.range(1).coalesce(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)


def _noted(spark: SparkSession, path: str) -> str | None:
    """The text of a complete note; a half-written one counts as missing."""
    return spark.read.text(path).first().value if path_exists(spark, f"{path}/_SUCCESS") else None


def _layout(spark: SparkSession, root: str, key: str, buckets: int | None) -> int:
    """The bucket count stored with the table; fixed when the table is created."""
    place, wanted = f"{root}_log/layout", buckets or BUCKETS
    stored = _noted(spark, place)
    if stored is None:
        if path_exists(spark, root):
            raise ValueError(f"{root} holds a table that upsert did not create")
        _note(spark, place, json.dumps({"key": key, "buckets": wanted}))
        return wanted
    layout = json.loads(stored)
    if layout["key"] != key or buckets not in (None, layout["buckets"]):
        raise ValueError(f"{root} was created with key {layout['key']} and {layout['buckets']} buckets")
    return layout["buckets"]


def _finish(spark: SparkSession, root: str) -> None:
    """Put staged buckets in place if their swap was begun and not completed; the runs they hold go with it."""
    name = _noted(spark, f"{root}_log/swap")
    if name is None or path_exists(spark, f"{root}_log/{name}/done/_SUCCESS"):
        return
    write_partitions(spark.read.parquet(f"{root}_log/{name}/rows"), root, "bucket")
    remove_path(spark, f"{root}_log/runs")
    _note(spark, f"{root}_log/{name}/done", name)
    remove_path(spark, f"{root}_log/{name}/rows")


@dataclass
class _Run:
    """Rows of deliveries ``first`` to ``last`` that are not in the buckets yet, in a folder of that name."""

    first: int
    last: int
    level: int
    batch: str
    path: str


def _runs(spark: SparkSession, root: str) -> tuple[list[_Run], int]:
    """The complete runs in the order of their deliveries, and the first number that no folder bears.

    A run is complete once its folder is; one that lies within a longer run was joined into it.
    """
    found, fresh = [], 0
    for folder in folder_names(spark, f"{root}_log/runs"):
        first, last, level, batch = folder.split("_", 3)
        fresh = max(fresh, int(last) + 1)
        if path_exists(spark, f"{root}_log/runs/{folder}/_SUCCESS"):
            found.append(_Run(int(first), int(last), int(level), batch, f"{root}_log/runs/{folder}"))
    longest = sorted(found, key=lambda r: (r.first, -r.last))
    return [r for i, r in enumerate(longest) if not any(o.first <= r.first and r.last <= o.last for o in longest[:i])], fresh


def _join_runs(spark: SparkSession, runs: list[_Run], key: str) -> DataFrame:
    """The last row of each key over some runs; rows without a key are nobody's successors and all stay."""
    tagged = [spark.read.parquet(run.path).withColumn("_run", F.lit(run.first)) for run in runs]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if len(runs) == 1:
        return rows.drop("_run")
    columns = [F.col(c) for c in rows.columns if c != "_run"]
    last = rows.groupBy(key, F.when(F.col(key).isNull(), F.col("_run")).alias("_apart")).agg(F.max_by(F.struct(*columns), "_run").alias("row"))
    return last.select("row.*")


def _merged(current: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    return current.join(latest, key, "left_anti").unionByName(latest, allowMissingColumns=True)


def upsert(source: DataFrame, path: str, key: str, order: list[str], buckets: int | None = None, batch: str | None = None) -> None:
    """Insert new keys and replace known ones in a Parquet table laid out by key bucket.

    A batch is written once, as a run beside the buckets. ``JOINED`` runs of one size become a longer one, and when the runs hold half as many
    bytes as the buckets, the buckets that they touch are rewritten with them. So a row is rewritten a number of times that follows the logarithm of the table,
    however many batches come; ``read_upserted`` puts buckets and runs together. The bucket count is stored when the table is
    created. New content is written in full to a side folder before the swap begins, and the next call completes a swap that died
    halfway. ``batch`` names a delivery that may come again, by its stream and its number: once applied it changes nothing.
    Without a name every call is applied. One writer at a time; readers that need a stable snapshot
    during a write should use a table format and ``merge_statement``.
    """
    spark, root = source.sparkSession, path.rstrip("/")
    buckets = _layout(spark, root, key, buckets)
    _finish(spark, root)
    name = batch or uuid.uuid4().hex
    runs, fresh = _runs(spark, root)
    if runs and runs[-1].batch and not path_exists(spark, f"{root}_log/{runs[-1].batch}/done/_SUCCESS"):
        _note(spark, f"{root}_log/{runs[-1].batch}/done", runs[-1].batch)
    if path_exists(spark, f"{root}_log/{name}/done/_SUCCESS"):
        return
    latest = latest_per_key(source, key, order).withColumn("bucket", _bucket(key, buckets))
    own = f"{root}_log/runs/{fresh:08d}_{fresh:08d}_0_{name}"
    latest.write.parquet(own)
    runs.append(_Run(fresh, fresh, 0, name, own))
    held = size_of(spark, root) if path_exists(spark, root) else 0
    if 2 * sum(size_of(spark, run.path) for run in runs) >= held:
        _settle(spark, root, name, key, runs)
    else:
        _note(spark, f"{root}_log/{name}/done", name)
        _shorten(spark, root, key, runs)


def _settle(spark: SparkSession, root: str, name: str, key: str, runs: list[_Run]) -> None:
    """Rewrite the buckets that the runs touch."""
    merged = latest = _join_runs(spark, runs, key)
    touched = [row.bucket for row in spark.read.parquet(*[run.path for run in runs]).select("bucket").distinct().collect()]
    if not touched:
        _note(spark, f"{root}_log/{name}/done", name)
        remove_path(spark, f"{root}_log/runs")
        return
    if path_exists(spark, root):
        merged = _merged(spark.read.parquet(root).where(F.col("bucket").isin(touched)), latest, key)
    merged.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}_log/{name}/rows")
    _note(spark, f"{root}_log/swap", name)
    _finish(spark, root)


def _shorten(spark: SparkSession, root: str, key: str, runs: list[_Run]) -> None:
    """Join the newest runs while ``JOINED`` of them are of one level; a folder within a longer one that is complete counts no more."""
    while len(runs) >= JOINED and len({run.level for run in runs[-JOINED:]}) == 1:
        parts = runs[-JOINED:]
        path = f"{root}_log/runs/{parts[0].first:08d}_{parts[-1].last:08d}_{parts[0].level + 1}_"
        _join_runs(spark, parts, key).write.mode("overwrite").parquet(path)
        runs[-JOINED:] = [_Run(parts[0].first, parts[-1].last, parts[0].level + 1, "", path)]
        for part in parts:
            remove_path(spark, part.path)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table as its batches left it: the buckets, with the runs that are not in them yet put over their rows."""
    root = path.rstrip("/")
    runs, _ = _runs(spark, root)
    if not runs:
        return spark.read.parquet(root).drop("bucket")
    key = json.loads(_noted(spark, f"{root}_log/layout"))["key"]
    latest = _join_runs(spark, runs, key)
    return (_merged(spark.read.parquet(root), latest, key) if path_exists(spark, root) else latest).drop("bucket")


def merge_statement(target: str, source: str, key: str) -> str:
    """The same upsert for a target in a table format that knows MERGE."""
    return (f"MERGE INTO {target} AS t USING {source} AS s ON t.{key} = s.{key} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
