"""Table writes, keyed upserts and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from overspend import schemas
from overspend.operators.clean import parse_records
from overspend.session import folder_names, path_exists, shared_dir
from overspend.sources import readers, writers
from overspend.streaming import jobs


@pytest.fixture
def folder(spark):
    return shared_dir(spark, "test")


def batch(spark, *data):
    return spark.createDataFrame(list(data), "id string, v int, at int")


def stored(spark, folder):
    return {r.id: r.v for r in writers.read_upserted(spark, folder).collect()}


def test_shared_dir_follows_the_session(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first != second and first.startswith(named)


def test_upsert_updates_inserts_and_keeps(spark, folder):
    writers.upsert(batch(spark, ("a", 1, 0), ("b", 2, 0), ("b", 3, 1)), folder, "id", ["at"], 4, "s-0")
    assert stored(spark, folder) == {"a": 1, "b": 3}
    writers.upsert(batch(spark, ("b", 5, 9), ("b", 4, 8), ("c", 6, 0)), folder, "id", ["at"], 4, "s-1")
    assert stored(spark, folder) == {"a": 1, "b": 5, "c": 6}
    assert writers.read_upserted(spark, folder).count() == 3


def test_upsert_repeated_after_a_crash(spark, folder, monkeypatch):
    writers.upsert(batch(spark, ("a", 1, 0), ("b", 2, 0)), folder, "id", ["at"], 4, "s-0")
    second = batch(spark, ("b", 9, 1), ("c", 3, 1))
    real = writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        writers.upsert(second, folder, "id", ["at"], 4, "s-1")
    assert path_exists(spark, f"{folder}_log/s-1/rows")
    monkeypatch.setattr(writers, "write_partitions", real)
    for _ in range(2):
        writers.upsert(second, folder, "id", ["at"], 4, "s-1")
        assert stored(spark, folder) == {"a": 1, "b": 9, "c": 3}


def test_upsert_keeps_the_batches_of_all_streams(spark, folder):
    """A new stream counts from 0 again, and a batch that died is completed before another one is applied."""
    writers.upsert(batch(spark, ("a", 1, 0)), folder, "id", ["at"], 4, "first-0")
    writers.upsert(batch(spark, ("b", 2, 0)), folder, "id", ["at"], 4, "second-0")
    for _ in range(2):
        writers.upsert(batch(spark, ("c", 3, 0)), folder, "id", ["at"])
    assert stored(spark, folder) == {"a": 1, "b": 2, "c": 3}
    writers.upsert(batch(spark, ("a", 9, 0)), folder, "id", ["at"], 4, "first-0")
    assert stored(spark, folder)["a"] == 1


def test_upsert_completes_a_swap_that_died(spark, folder, monkeypatch):
    writers.upsert(batch(spark, ("a", 1, 0), ("b", 2, 0)), folder, "id", ["at"], 1, "s-0")
    real = writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        writers.upsert(batch(spark, ("b", 5, 1)), folder, "id", ["at"], 1, "s-1")
    monkeypatch.setattr(writers, "write_partitions", real)
    writers.upsert(batch(spark, ("a", 7, 1)), folder, "id", ["at"], 1, "other-0")
    writers.upsert(batch(spark, ("b", 5, 1)), folder, "id", ["at"], 1, "s-1")
    assert stored(spark, folder) == {"a": 7, "b": 5}


def test_upsert_refuses_another_layout(spark, folder):
    writers.upsert(batch(spark, *((str(i), i, 0) for i in range(60))), folder, "id", ["at"], 4)
    for key, buckets in (("id", 8), ("v", 4)):
        with pytest.raises(ValueError):
            writers.upsert(batch(spark, ("1", 0, 1)), folder, key, ["at"], buckets)
    writers.upsert(batch(spark, *((str(i), -i, 1) for i in range(4))), folder, "id", ["at"])
    assert writers.read_upserted(spark, folder).count() == 60 and stored(spark, folder)["3"] == -3


def test_upsert_takes_new_columns_and_empty_batches(spark, folder):
    writers.upsert(batch(spark, ("a", 1, 0)), folder, "id", ["at"], 1, "s-0")
    writers.upsert(batch(spark).where("false"), folder, "id", ["at"], 1, "s-1")
    writers.upsert(batch(spark, ("b", 2, 0)).withColumn("extra", F.lit("x")), folder, "id", ["at"], 1, "s-2")
    assert stored(spark, folder) == {"a": 1, "b": 2}
    assert {r.id: r.extra for r in writers.read_upserted(spark, folder).collect()} == {"a": None, "b": "x"}


def test_upsert_rewrites_follow_the_logarithm_of_the_batches(spark, folder, monkeypatch):
    """24 batches of new keys, one old key and one row without a key; the buckets are rewritten a few times, not 24 times."""
    rewrites, real = [], writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda *a: (rewrites.append(1), real(*a)))
    wanted = {}
    for number in range(24):
        rows = {f"k{number * 50 + i}": i for i in range(50)} | {"k7": 1000 + number}
        wanted |= rows
        writers.upsert(batch(spark, *((k, v, 0) for k, v in rows.items()), (None, number, 0)).coalesce(1), folder, "id", ["at"], 2, f"s-{number}")
    got = [(r.id, r.v) for r in writers.read_upserted(spark, folder).collect()]
    assert len(rewrites) <= 14 and len(folder_names(spark, f"{folder}_log/runs")) <= 2 * writers.JOINED
    assert sorted(v for k, v in got if k is None) == list(range(24))
    assert {k: v for k, v in got if k is not None} == wanted and len(got) == len(wanted) + 24
    writers.upsert(batch(spark, ("k7", -1, 0)), folder, "id", ["at"], 2, "s-22")
    assert stored(spark, folder)["k7"] == 1023


def test_upsert_joins_runs_of_one_size(spark, folder):
    """Small batches on a large table stay beside it; eight of them become one run, and a run within a longer one counts no more."""
    big = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(0).alias("v"), F.lit(0).alias("at"))
    writers.upsert(big, folder, "id", ["at"], 1, "s-0")
    for number in range(1, writers.JOINED + 2):
        writers.upsert(batch(spark, ("k1", number, 0)).coalesce(1), folder, "id", ["at"], 1, f"s-{number}")
    names = folder_names(spark, f"{folder}_log/runs")
    assert len(names) == 2 and names[0].split("_")[2] == "1"
    spark.read.parquet(f"{folder}_log/runs/{names[0]}").withColumn("v", F.lit(-5)).write.parquet(f"{folder}_log/runs/00000002_00000002_0_s-3")
    assert stored(spark, folder)["k1"] == writers.JOINED + 1 and writers.read_upserted(spark, folder).count() == 20_000


def test_upsert_knows_a_run_whose_note_is_missing(spark, folder, monkeypatch):
    """A batch that was written before its note died is applied once, also if another stream comes between."""
    big = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(0).alias("v"), F.lit(0).alias("at"))
    writers.upsert(big, folder, "id", ["at"], 1, "s-0")
    real = writers._note
    monkeypatch.setattr(writers, "_note", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        writers.upsert(batch(spark, ("k1", 5, 0)), folder, "id", ["at"], 1, "s-1")
    monkeypatch.setattr(writers, "_note", real)
    writers.upsert(batch(spark, ("k1", 7, 0)), folder, "id", ["at"], 1, "other-0")
    writers.upsert(batch(spark, ("k1", 5, 0)), folder, "id", ["at"], 1, "s-1")
    assert stored(spark, folder)["k1"] == 7


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
    plan = writers.latest_per_key(rows, "k", ["at"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in text and "Window" not in text
    assert plan.where("k = -1").first().at == 4998


def test_merge_statement_is_valid_sql(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    assert "MergeInto" in parser.parsePlan(writers.merge_statement("silver", "batch", "id_contrato")).toString()


def test_monthly_write_is_repeatable(spark, folder):
    df = spark.sql("SELECT id, (id % 12 + 1)::int AS mes FROM range(120)")
    writers.write_partitions(df, folder, "mes")
    writers.write_partitions(df.where("mes = 3").withColumn("id", F.col("id") + 1000), folder, "mes")
    got = readers.scan(spark, folder)
    assert got.count() == 120 and got.where("mes = 3").agg(F.min("id")).first()[0] >= 1000
    assert "PartitionFilters: [isnotnull(mes" in got.where("mes = 3")._jdf.queryExecution().executedPlan().toString()


def test_overwrite_changes_the_schema(spark, folder):
    writers.overwrite(spark.range(3), folder)
    writers.overwrite(spark.range(2).withColumn("x", F.lit("a")), folder)
    assert readers.read_table(spark, folder).columns == ["id", "x"]
    writers.append(spark.range(1).withColumn("x", F.lit("b")), folder)
    assert readers.read_table(spark, folder).count() == 3


def records(spark, *messages):
    data = [(json.dumps(m).encode(), 0, m["_at"]) for m in messages]
    return spark.createDataFrame(data, "value binary, partition int, offset long").withColumn(
        "timestamp", F.timestamp_seconds(F.col("offset")))


def message(key, value, at):
    return {"id_contrato": key, "objeto_contrato": "obra vial", "valor_contrato": value, "fecha_firma": "2024-01-04", "_at": at}


def test_silver_stream_over_several_batches(spark, folder):
    def run():
        source = readers.stream_files(spark, f"{folder}/in", schemas.TOPIC_RECORD)
        jobs.run(jobs.silver_stream(source, f"{folder}/silver", f"{folder}/checkpoint", buckets=2))

    writers.append(records(spark, message("a", 1.0, 1), message("a", 2.0, 2), message("b", 0.0, 3)), f"{folder}/in")
    run()
    assert {r.id_contrato: r.valor_contrato for r in writers.read_upserted(spark, f"{folder}/silver").collect()} == {"a": 2.0}
    writers.append(records(spark, message("a", 7.0, 4), message("c", 5.0, 5)), f"{folder}/in")
    run()
    run()
    assert {r.id_contrato: r.valor_contrato for r in writers.read_upserted(spark, f"{folder}/silver").collect()} == {
        "a": 7.0, "c": 5.0}


def test_topic_files_share_a_micro_batch(spark, folder):
    """Ten files of a topic are read side by side, in one micro-batch."""
    from overspend.plans import streams

    key = F.col("id")
    spark.range(0, 1000, 1, 1).select(
        key.alias("o_orderkey"), key.alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(5.0).alias("o_totalprice"),
        F.lit("2024-01-04").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    sizes = []
    jobs.run(jobs.batch_stream(streams.record_stream(spark, folder, rows_per_file=100), lambda rows, number: sizes.append(rows.count()), f"{folder}/checkpoint"))
    assert sizes == [1000]


def test_update_stream_keeps_open_windows(spark, folder):
    """Windows that no watermark has passed are in the table, with their last count; closed ones leave the state."""
    def deliver(*minutes):
        writers.append(spark.createDataFrame([(m,) for m in minutes], "m int").select(
            F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz").alias("ts"), F.lit("k").alias("k")), f"{folder}/in")
        source = readers.stream_files(spark, f"{folder}/in", "ts timestamp_ntz, k string")
        query = jobs.update_stream(jobs.window_counts(source, "ts", "k"), f"{folder}/out", f"{folder}/checkpoint")
        query.awaitTermination()
        return query.lastProgress.stateOperators[0].numRowsTotal

    held = [deliver(7, 8), deliver(8, 9), deliver(300), deliver(301, 600)]
    table = jobs.newest(readers.read_table(spark, f"{folder}/out"), ["window_start", "window_end", "k"])
    got = {(int(r.s) // 60, r.n) for r in table.select(F.unix_seconds("window_start").alias("s"), "n").collect()}
    assert got == {(0, 4), (5, 4), (295, 2), (300, 2), (595, 1), (600, 1)}
    assert max(held) <= 4


def test_window_query_gives_every_window(spark, folder):
    """Also the windows within ten minutes of the last event."""
    from overspend.plans import streams

    rows = [(i, 60 * i, "a" if i % 3 else "b") for i in range(25)]
    spark.createDataFrame(rows, "event_id long, s long, event_type string").select(
        "event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"), "event_type",
        F.lit(1.0).alias("value"), F.lit("{}").alias("props")).coalesce(1).write.parquet(f"{folder}/parts")
    source = [n for n in folder_names(spark, f"{folder}/parts") if n.endswith(".parquet")][0]
    move = spark._jvm.org.apache.hadoop.fs.Path
    system = move(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    assert system.rename(move(f"{folder}/parts/{source}"), move(f"{folder}/events.parquet"))
    got = sorted(streams.stream_window_count(spark, folder).collect())
    assert got == sorted(streams.window_count_batch(spark, folder).collect()) and len(got) == 12


def test_append_windows_close_and_drop_late_rows(spark, folder):
    def deliver(*minutes):
        writers.append(spark.createDataFrame([(m,) for m in minutes], "m int").select(
            F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz").alias("ts"), F.lit("k").alias("k")), f"{folder}/in")
        schema = "ts timestamp_ntz, k string"
        source = readers.stream_files(spark, f"{folder}/in", schema)
        jobs.run(jobs.append_stream(jobs.window_counts(source, "ts", "k"), f"{folder}/out", f"{folder}/checkpoint"))

    deliver(2, 3, 100)
    deliver(2, 101)
    deliver(200)
    got = {(r.window_start.minute + 60 * r.window_start.hour, r.n) for r in spark.read.parquet(f"{folder}/out")
           .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).where("window_start >= '1970-01-01'").collect()}
    assert got == {(0, 2), (95, 2), (100, 2)}


def test_window_state_is_bounded_over_many_days(spark, folder):
    """State follows the open windows: after 20 days it holds no more than after one."""
    rows = []
    for day in range(20):
        spark.range(288).select(F.timestamp_seconds(F.lit(day * 86_400) + F.col("id") * 300).alias("ts"), (F.col("id") % 3).cast("string").alias("k")).coalesce(
            1).write.mode("append").parquet(f"{folder}/in")
        source = readers.stream_files(spark, f"{folder}/in", "ts timestamp, k string")
        counted = jobs.window_counts(source, "ts", "k").withColumn("day", F.to_date("window_start"))
        query = jobs.append_stream(counted, f"{folder}/out", f"{folder}/checkpoint", by="day")
        query.awaitTermination()
        rows.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert max(rows) <= rows[0] <= 12
    out = spark.read.parquet(f"{folder}/out")
    assert out.select("day").distinct().count() >= 20 and out.agg(F.sum("n")).first()[0] > 2 * 20 * 288 - 30


def rows_read(df):
    """Rows and files that the scans of an executed query gave."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    while hasattr(plan, "executedPlan") and plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numOutputRows").value() for m in metrics), sum(m.apply("numFiles").value() for m in metrics)


def test_incremental_rows_skip_old_files(spark, folder):
    """40 ordered files of 100 rows: only those after the last processed time are read; old day folders are not even listed."""
    from overspend.operators import clean

    days = spark.range(0, 4_000, 1, 1).select("id", F.timestamp_seconds(F.col("id") * 864).alias("t"), F.to_date(F.timestamp_seconds(F.col("id") * 864)).alias("day"))
    days.write.option("maxRecordsPerFile", 100).parquet(f"{folder}/files")
    days.write.partitionBy("day").parquet(f"{folder}/days")
    default = F.lit("1970-01-01").cast("timestamp")
    done = days.where("id < 3850")
    since = clean.high_watermark(done, "t", default)
    plain = clean.newer_than(spark.read.parquet(f"{folder}/files"), "t", since)
    assert plain.count() == 150 and rows_read(plain.select("id", "t"))[0] <= 200
    foldered = clean.newer_than(spark.read.parquet(f"{folder}/days"), "t", since, folder=("day", F.to_date))
    read, files = rows_read(foldered.select("id", "t"))
    assert foldered.count() == 150 and read <= 200 and files == 2
    assert clean.newer_than(days, "t", clean.high_watermark(days.limit(0), "t", default)).count() == 3_999


def test_stream_and_batch_share_the_function(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-3.0, 1.0), (0.0, 0.0)], "fare_amount double, tip_amount double")
    assert [r.total_cost for r in jobs.total_cost(df).collect()] == [3.0]


def test_message_without_a_field(spark):
    row = parse_records(records(spark, message("a", 1.0, 1))).first()
    assert row.municipio is None and row.offset == 1 and row.partition == 0
