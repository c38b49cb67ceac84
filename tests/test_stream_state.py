"""Keyed inserts read the batch's partitions only; bounded state of spikes, shadow counters and event-time velocity."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators.windows import trailing_count, velocity_features
from riskspark.session import scratch_path
from riskspark.sources import sinks as SK
from riskspark.streaming import pipelines as ST

T0 = datetime(2024, 1, 1)
NAMES = "event_id string, event_ts timestamp_ntz, n int"


def _files(spark, df, name, col, values):
    path = scratch_path(spark, name)
    for v in values:
        df.where(F.col(col) == v).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_insert_reads_the_batch_partitions_only(spark):
    path = scratch_path(spark, "test-keyed")
    days = [spark.createDataFrame([(f"{d}-{i}", T0 + timedelta(days=d), i) for i in range(50)], NAMES) for d in range(5)]
    for d in days:
        assert SK.append_ignore(spark, path, d, "event_id", ["n"], day="event_ts", buckets=4) == 50
        assert SK.append_ignore(spark, path, d, "event_id", ["n"], day="event_ts", buckets=4) == 0
    assert spark.read.parquet(path).count() == 250
    batch = SK.keyed_parts(days[2].where("event_id = '2-7'"), "event_id", "event_ts", 4)
    keys = SK.keys_beside(spark, path, batch, "event_id", ["part_bucket_4", "part_day"])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part_day" in plan.split("PartitionFilters")[1]
    seen = {r.event_id.split("-")[0] for r in keys.collect()}
    assert seen == {"2"} and keys.select(F.input_file_name()).distinct().count() == 1


def test_insert_without_day_conflicts_on_the_key_alone(spark):
    path = scratch_path(spark, "test-key-only")
    rows = [("a", T0, 1), ("b", None, 2), ("a", T0 + timedelta(days=3), 0)]
    df = spark.createDataFrame(rows, NAMES)
    assert SK.append_ignore(spark, path, df, "event_id", ["n"]) == 2
    assert SK.append_ignore(spark, path, spark.createDataFrame([("a", T0 + timedelta(days=9), 7), ("c", T0, 1)], NAMES)) == 1
    assert sorted((r.event_id, r.n) for r in spark.read.parquet(path).collect()) == [("a", 0), ("b", 2), ("c", 1)]
    with pytest.raises(ValueError):
        SK.append_ignore(spark, path, df, buckets=8)
    assert SK.append_ignore(spark, path, df.limit(0)) == 0


def test_ring_equals_one_window_over_all_batches(spark):
    rows = [(str(i), T0 + timedelta(milliseconds=370 * i + (i % 7) * 20), i // 40) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id string, arrived_at timestamp_ntz, n int")
    root, got = scratch_path(spark, "test-ring"), {}
    for b in range(10):
        for _ in range(2):                              # every batch is replayed once
            r = SK.flag_spikes(spark, df.where(f"n = {b}"), root, b, 50, seconds=20).collect()
        got.update({x.event_id: x.volume_spike for x in r})
    want = {r.event_id: r.trailing_count > 50 for r in trailing_count(df, "arrived_at", 20).collect()}
    differ = [k for k in want if want[k] != got[k]]
    # arrivals of a later batch may precede the last ones of a batch; only windows at those edges can differ
    assert len(got) == 400 and all(int(k) % 40 > 37 or int(k) % 40 < 2 for k in differ)
    ring = spark.read.parquet(f"{root}/volume_ring/slot=1")
    assert ring.agg(F.max("t") - F.min("t")).first()[0] <= 20_000_000


def test_ring_of_an_earlier_run_is_not_read(spark):
    df = spark.createDataFrame([(str(i), T0 + timedelta(seconds=i)) for i in range(10)], "event_id string, arrived_at timestamp_ntz")
    root = scratch_path(spark, "test-ring-rerun")
    for b in (0, 1, 2, 3):
        SK.flag_spikes(spark, df, root, b, 12).collect()
    again = SK.flag_spikes(spark, df, root, 0, 12)      # a new run on the same root starts at batch 0
    assert again.where("volume_spike").count() == 0


def test_broken_lines_and_missing_times_are_in_no_spike(spark):
    rows = [("a", T0, True), ("b", T0, False), ("c", None, False), ("d", T0 + timedelta(seconds=1), False)]
    df = spark.createDataFrame(rows, "event_id string, arrived_at timestamp_ntz, is_dead boolean")
    got = {r.event_id: r.volume_spike for r in SK.flag_spikes(spark, df, scratch_path(spark, "t"), 0, 1).collect()}
    assert got == {"a": False, "b": False, "c": False, "d": True}
    assert SK.flag_spikes(spark, df.limit(0), scratch_path(spark, "t"), 0, 1).count() == 0


def test_shadow_totals_merge_over_batches_and_replays(spark):
    rows = [(str(i), T0 + timedelta(seconds=i), (i % 10) / 10 if i % 9 else None, "block" if i % 4 else None, i // 10) for i in range(60)]
    v1 = spark.createDataFrame(rows, "event_id string, created_at timestamp_ntz, final_score double, decision string, n int")
    v2 = v1.withColumn("final_score", F.col("final_score") + F.col("n") / 20).withColumn(
        "decision", F.when(F.col("n") == 3, F.lit("approve")).otherwise(F.col("decision")))
    root = scratch_path(spark, "test-shadow")
    ST.shadow_totals_stream(_files(spark, v1, "test-v1", "n", range(6)), _files(spark, v2, "test-v2", "n", range(6)), root,
                            scratch_path(spark, "test-shadow-ck")).awaitTermination()
    pairs = v1.selectExpr("event_id", "final_score v1_score", "decision v1_decision").join(
        v2.selectExpr("event_id", "final_score v2_score", "decision v2_decision"), "event_id")
    want = ST.delta_totals(pairs).first().asDict()
    got = ST.shadow_totals(spark, root).first().asDict()
    assert got == want and got["pairs"] == 60 and got["decision_diff"] == 10
    h = [(r.le, r.n) for r in ST.delta_histogram(ST.shadow_totals(spark, root)).orderBy("le").collect()]
    assert h[-1] == (float("inf"), 60) and [n for _, n in h] == sorted(n for _, n in h)
    # two stored states at most, whatever the number of batches
    assert spark.read.parquet(f"{root}/slot=*").count() == 2


@pytest.mark.parametrize("bucket", ["1 hour", "20 minutes"])
def test_event_time_velocity_equals_batch_with_late_rows(spark, bucket):
    """Late rows, one instant in several micro-batches, repeated ids, null amounts and a user with most of the rows."""
    rows = []
    for i in range(300):
        when = T0 + timedelta(seconds=(i // 4) * 97)
        late = timedelta(minutes=(i % 5) * 2)           # up to 8 minutes
        rows.append((str(i // 2 if i % 50 == 0 else i), 1 if i % 3 else i % 7, when, None if i % 11 == 0 else float(i), when + late))
    df = spark.createDataFrame(rows, "event_id string, user_id long, event_ts timestamp_ntz, amount double, arrives timestamp_ntz")
    edges = [T0 + timedelta(minutes=25 * i) for i in range(1, 6)]
    df = df.withColumn("n", sum((F.col("arrives") > F.lit(e)).cast("int") for e in edges))
    marker = spark.createDataFrame([(None, None, T0 + timedelta(days=1), None, None, 9)], df.schema)
    s = _files(spark, df.union(marker), "test-late", "n", [0, 1, 2, 3, 4, 5, 9])
    got = ST.run_to_table(ST.velocity_final_stream(s, bucket=bucket), f"test-late-{bucket[:2].strip()}")
    cols = ["event_id", "user_txn_count_5m", "user_txn_count_1h", "user_amount_sum_1h"]
    want = velocity_features(df.withColumn("amount", F.coalesce("amount", F.lit(0.0))), method="window").select(*cols)
    assert got.count() == 300
    assert got.select(*cols).exceptAll(want).count() == 0 and want.exceptAll(got.select(*cols)).count() == 0


def test_state_of_event_time_velocity_does_not_grow_with_the_keys(spark):
    """500 users and rows without a user in 4 hash parts: one state per part and time bucket, features per user as in the batch form."""
    rows = [(str(i), i % 500 if i % 97 else None, T0 + timedelta(seconds=i), float(i % 13), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id string, user_id long, event_ts timestamp_ntz, amount double, n int")
    marker = spark.createDataFrame([(None, None, T0 + timedelta(days=1), None, 1)], df.schema)
    s = _files(spark, df.union(marker), "test-parts", "n", [0, 1])
    path = scratch_path(spark, "test-parts-out")
    q = (ST.velocity_final_stream(s, parts=4).writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", scratch_path(spark, "test-parts-ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    states = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert 0 < max(states) <= 4 * 2 + 2
    cols = ["event_id", "user_id", "user_txn_count_5m", "user_txn_count_1h", "user_amount_sum_1h"]
    got = spark.read.parquet(path).select(*cols)
    want = velocity_features(df, method="window").select(*cols)
    assert got.count() == 3000 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_spiking_batch_is_parsed_once(spark):
    """The ring, its oldest instant and the three sinks read one parsed batch."""
    from pyspark.sql.types import StringType

    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return x

    df = spark.createDataFrame([(str(i), T0 + timedelta(seconds=i), "x") for i in range(50)], "event_id string, arrived_at timestamp_ntz, raw string")
    v = df.withColumn("raw", F.udf(touch, StringType()).asNondeterministic()("raw"))
    v = v.select("*", (F.col("raw") == "x").alias("is_dead"), F.lit(False).alias("is_valid"), F.array().cast("array<string>").alias("failed"),
                 *[F.lit(None).cast(t).alias(c) for c, t in (("event_type", "string"), ("event_ts", "string"), ("user_id", "double"),
                   ("merchant_id", "double"), ("device_id", "double"), ("ip_id", "double"), ("amount", "double"), ("currency", "string"),
                   ("country", "string"), ("channel", "string"), ("drift_phase", "double"))])
    assert SK.route_sinks(spark, v, scratch_path(spark, "test-parsed-once"), 0, 10)["dead_letter"] == 50
    assert seen.value == 50
