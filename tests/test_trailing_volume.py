"""Trailing volume against a plain count, and its plan."""

import random

from pyspark.sql import functions as F

from riskspark.operators.windows import flag_volume_spike, trailing_count


def test_counts_by_brute_force(spark):
    rng = random.Random(2)
    for seconds in (1, 7, 60):
        t = [rng.choice([rng.randrange(0, 400_000_000), rng.randrange(0, 300) * 1_000_000]) - 50_000_000 for _ in range(400)]
        t += [t[0]] * 30 + [x + seconds * 1_000_000 for x in t[:20]] + [x + seconds * 1_000_000 + 1 for x in t[:20]]
        rows = [(i, x, rng.choice([1, 2, 5])) for i, x in enumerate(t)] + [(10_000 + i, None, 3) for i in range(4)]
        df = spark.createDataFrame(rows, "event_id long, us long, w long").withColumn("event_ts", F.timestamp_micros("us")).repartition(4)
        for weight in (None, "w"):
            got = {r.event_id: r.trailing_count for r in trailing_count(df, seconds=seconds, weight=weight).collect()}
            for i, x, _ in rows:
                mine = [(w if weight else 1) for _, y, w in rows if (x is None and y is None) or (
                    x is not None and y is not None and x - seconds * 1_000_000 <= y <= x)]
                assert got[i] == sum(mine), (seconds, x)


def test_one_scan_one_shuffle(spark, tmpdir_fresh):
    spark.range(1000).select(F.timestamp_seconds("id").alias("event_ts"), F.col("id").alias("bucket"), F.lit(1).alias("t")).write.parquet(f"{tmpdir_fresh}/e")
    d = flag_volume_spike(spark.read.parquet(f"{tmpdir_fresh}/e"), limit=40)
    assert d.columns == ["event_ts", "bucket", "t", "trailing_count", "volume_spike"]
    assert d.where("volume_spike").count() == 1000 - 40 and d.agg(F.max("trailing_count")).first()[0] == 61
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
