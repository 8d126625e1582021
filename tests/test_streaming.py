"""Streaming jobs fed file by file."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.sources import files
from ledgerlens.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, ts timestamp, value double"


def folder(spark, batches):
    """One file per batch, in order of arrival."""
    import os
    import time

    path = files.scratch(spark, "stream")
    for rows in batches:
        data = [(i, T0 + dt.timedelta(hours=h), float(v)) for i, h, v in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        now = time.time()
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if os.path.getmtime(full) > now - 0.0:
                os.utime(full, (now, now))
        time.sleep(1.1)
    return path


def stream(spark, path):
    schema = spark.read.parquet(path).schema
    return jobs.source(spark, path, schema, files_per_batch=1)


def test_late_rows_count_and_open_days_are_marked(spark):
    batches = [
        [(1, 1, 10), (2, 30, 20)],  # day 1 and day 2
        [(3, 2, 100), (4, 50, 5)],
        [(5, 3, 1000), (6, 80, 1)],  # day 1 again, two days late
    ]
    want = {"2024-01-01": (3, 1110.0, False), "2024-01-02": (1, 20.0, False), "2024-01-03": (1, 5.0, False), "2024-01-04": (1, 1.0, True)}
    for cut in (batches, [sum(batches, [])]):
        days = jobs.drain(jobs.daily_totals(stream(spark, folder(spark, cut)), "ts", "value"), "t", "complete")
        assert {r.day: (r.n, r.total, r.open) for r in jobs.mark_open(days).collect()} == want


def test_duplicates_across_batches(spark):
    # 4 and 5 first come days later than rows of earlier batches
    path = folder(spark, [[(1, 0, 1), (1, 1, 1), (2, 1, 1)], [(2, 200, 1), (3, 203, 1)], [(4, 1, 1), (3, 2, 1)], [(5, 0, 1), (4, 300, 1)]])
    got = jobs.drain(jobs.unique_rows(stream(spark, path), ["id"]), "u")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4, 5]


def test_scores_on_a_stream_keep_rows_without_a_feature(spark):
    from ledgerlens.operators import modeling

    rows = [(i, float(i % 7), float(i % 5), float(i), float(i % 2), "train", 1.0) for i in range(40)]
    table = spark.createDataFrame(rows, "CustomerId long, recency_days double, transaction_frequency double, total_monetary_value double, is_high_risk double, split string, weight double")
    model = modeling.fit(table, "decision_tree", modeling.RFM)
    arriving = table.select("CustomerId", F.when(F.col("CustomerId") % 4 > 0, F.col("recency_days")).alias("recency_days"), "transaction_frequency", "total_monetary_value")
    path = files.write(arriving, files.scratch(spark, "gaps"))
    got = jobs.drain(jobs.scored(jobs.source(spark, path, arriving.schema), model), "g").collect()
    assert len(got) == 40 and {r.CustomerId for r in got if r.risk_score is None} == {i for i in range(40) if i % 4 == 0}
    assert all((r.risk_level is None) == (r.risk_score is None) for r in got)


def test_naive_times_become_timestamps(spark):
    df = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    path = files.write(df, files.scratch(spark, "ntz"))
    assert dict(jobs.source(spark, path, df.schema).dtypes)["ts"] == "timestamp"
