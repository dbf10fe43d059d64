"""Transmission versions against a brute-force count."""

from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators.versions import (
    _keyed,
    arrival_version,
    inherit_version,
    latest_versions,
    recalculate_versions,
    version_corrections,
)

SCHEMA = "source_id long, company string, customer_po string, downloaded_at timestamp"


def headers(spark):
    """A dominant order number spread over hours, ties, other case and NULL numbers."""
    start = datetime(2024, 1, 1)
    data = [(i, "BELK" if i % 2 else "Belk", "PO1", start + timedelta(minutes=17 * (i % 90))) for i in range(200)]
    data += [(1000 + i, "BELK", "PO2", start) for i in range(3)]
    data += [(2000 + i, "ARULA", None, start + timedelta(days=i)) for i in range(3)]
    return data, spark.createDataFrame(data, SCHEMA)


def test_versions_match_brute_force(spark):
    data, frame = headers(spark)

    def key(row):
        return (row[1].upper(), row[2])

    arrival = {r[0]: 1 + sum(key(o) == key(r) and o[3] < r[3] for o in data) for r in data}
    exact = {
        r[0]: 1 + sum(key(o) == key(r) and (o[3], o[0]) < (r[3], r[0]) for o in data) for r in data
    }
    assert dict(rows(arrival_version(frame), "source_id", "version")) == arrival
    assert dict(rows(recalculate_versions(frame), "source_id", "version")) == exact
    wrong = version_corrections(arrival_version(frame))
    found = {r.source_id: r.correct_version for r in wrong.collect()}
    assert found == {k: v for k, v in exact.items() if arrival[k] != v}
    assert version_corrections(recalculate_versions(frame)).isEmpty()


def test_latest_is_the_highest_of_each_order_number(spark):
    _, frame = headers(spark)
    latest = latest_versions(recalculate_versions(frame))
    assert latest.columns == [*frame.columns, "version"]
    assert sorted(v for (v,) in rows(latest, "version")) == [3, 3, 200]


def test_versions_follow_the_source_id(spark):
    frame = spark.createDataFrame([(1,), (2,)], "source_id long")
    versions = spark.createDataFrame([(1, 7)], "source_id long, version int")
    assert rows(inherit_version(frame, versions)) == [(1, 7), (2, None)]


def test_rows_are_ranked_by_time_and_block_alone(spark):
    _, frame = headers(spark)
    plan = recalculate_versions(frame)._jdf.queryExecution().optimizedPlan().toString()
    ranked = [text for text in plan.splitlines() if "row_number" in text and "Window" in text]
    assert ranked and all("t_micro" in text and "t_block" in text for text in ranked)
    assert "Window" not in "".join(
        text for text in arrival_version(frame)._jdf.queryExecution().optimizedPlan().toString()
        .splitlines() if "row_number" in text or "rank" in text
    )


def test_one_order_sent_100000_times_in_a_second(spark):
    """Half of them at one time; no task reads more than its share of rows."""
    frame = spark.range(100_000, numPartitions=8).selectExpr(
        "id * 7 % 100000 AS source_id", "if(id < 0, '', 'BELK') AS company",
        "if(id < 0, '', 'PO1') AS customer_po",
        "timestamp_micros(1700000000000000 + if(id * 7 % 100000 % 2 = 0, 0, id * 7 % 100000)) AS downloaded_at",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        keyed = _keyed(frame)
        sizes = keyed.groupBy("po_number", "t_second", "t_micro", "t_block").count().agg({"count": "max"})
        assert sizes.first()[0] <= 512
        for numbered, name in ((recalculate_versions(frame), "exact"), (arrival_version(frame), "shared")):
            share = numbered.groupBy(F.spark_partition_id()).count().agg({"count": "max"}).first()[0]
            assert share < 100_000 / 8 * 3, name
            assert "ReusedExchange" in numbered._jdf.queryExecution().executedPlan().toString()
            got = numbered.agg(F.min("version"), F.max("version"), F.count_distinct("version")).first()
            assert tuple(got) == ((1, 100_000, 100_000) if name == "exact" else (1, 100_000, 50_001))
        order = [r[0] for r in recalculate_versions(frame).orderBy("version").select("source_id").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert order == [*range(0, 100_000, 2), *range(1, 100_000, 2)]


def test_rows_without_time_or_company_come_first(spark):
    rows_ = [(1, None, "PO1", None), (2, None, "PO1", datetime(2024, 1, 1)), (3, None, "PO1", None)]
    frame = spark.createDataFrame(rows_, SCHEMA)
    assert dict(rows(recalculate_versions(frame), "source_id", "version")) == {1: 1, 3: 2, 2: 3}
    assert dict(rows(arrival_version(frame), "source_id", "version")) == {1: 1, 3: 1, 2: 3}
