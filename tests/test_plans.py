"""What the physical plans have to look like to hold at scale."""

from __future__ import annotations

import re

import pytest

from txnlens.operators.bursts import fraud_alerts, large_withdrawals
from txnlens.operators.sliding import sliding_alerts
from txnlens.plans import reports
from txnlens.sinks.alerts import alert_versions


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("saved") / "transactions")
    spark.range(20000).selectExpr(
        "id AS transaction_id",
        "IF(id % 3 = 0, 0, id % 500) AS customer_id",
        "timestamp_seconds(1709287200 + id) AS txn_timestamp",
        "CAST(id % 1000 AS DOUBLE) AS amount",
        "IF(id % 2 = 0, 'withdrawal', 'deposit') AS transaction_type",
        "element_at(array('atm', 'online', 'branch'), CAST(id % 3 + 1 AS INT)) AS channel",
        "IF(id % 10 = 0, 'failed', 'success') AS status",
        "1 AS txn_day",
        "CAST(id % 24 AS INT) AS txn_hour",
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_filters_and_columns_reach_the_scan(saved):
    text = plan(reports.high_value_per_day(saved))
    assert "GreaterThan(amount,500.0)" in text
    assert set(re.search(r"ReadSchema: struct<(.*?)>", text)[1].replace(":", " ").split()) & {"channel", "status"} == set()
    text = plan(reports.top_withdrawal_customer(saved))
    assert "EqualTo(transaction_type,withdrawal)" in text
    assert "TakeOrderedAndProject" in text


@pytest.mark.parametrize(
    "report", [reports.top_customers, reports.monthly_volume, reports.avg_amount_by_channel, reports.hourly_trend]
)
def test_one_shuffle_after_partial_aggregation(saved, report):
    text = plan(report(saved))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text


@pytest.mark.parametrize("find", [fraud_alerts, sliding_alerts])
def test_no_cross_join_and_no_python(saved, find):
    text = plan(find(large_withdrawals(saved)))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_rows_are_not_shuffled_if_flagged_groups_are_few(saved):
    text = executed(fraud_alerts(large_withdrawals(saved)))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text
    # Without hot groups their branch is gone: one scan is left outside the reused exchange.
    assert text.count("Union") == 0
    assert "ReusedExchange" in text


def test_rows_are_shuffled_on_the_key_if_groups_are_many(spark, saved):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = executed(fraud_alerts(large_withdrawals(saved)))
        assert "SortMergeJoin" in text
        assert "hashpartitioning(window_start" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_source_is_aggregated_once(spark, saved):
    """The flagged groups have four uses but are computed once."""
    spark.sparkContext.setJobGroup("flags", "flags")
    fraud_alerts(large_withdrawals(saved)).collect()
    tracker = spark.sparkContext.statusTracker()
    store = spark._jsc.sc().statusStore()
    scans = 0
    for job in tracker.getJobIdsForGroup("flags"):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            if info and info.numCompletedTasks and store.lastStageAttempt(stage).inputRecords() > 0:
                scans += 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert scans == 2


def test_versions_are_limited_before_the_shuffle(saved):
    stored = saved.selectExpr("CAST(customer_id AS STRING) AS row_key", "transaction_id AS batch_id", "1L AS transaction_count", "txn_timestamp", "amount")
    text = plan(alert_versions(stored))
    assert "WindowGroupLimit" in text.split("Exchange")[1]
