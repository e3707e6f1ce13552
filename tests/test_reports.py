from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, txn
from txnlens.functions.cells import amount_text
from txnlens.functions.money import exact_sum, rounded
from txnlens.operators.cleaning import clean_transactions, derive, normalize
from txnlens.plans import reports, suite


@pytest.fixture
def mixed(frame):
    return frame(
        [
            txn(1, 1, "2024-01-05 10:00:00", 500.0, "Withdrawal", "ATM"),
            txn(2, 1, "2024-02-05 11:59:59", 500.01, "DEPOSIT", "Online"),
            txn(3, 2, "2024-01-05 10:30:00", 10.0, "deposit", "Branch", "failed"),
            txn(4, 2, "2023-01-31 23:00:00", 20.0, "withdrawal", "branch", None),
            txn(5, 2, "2023-01-31 23:00:00", 20.5, "withdrawal", "branch", "FAILED"),
            txn(6, 3, "2024-01-31 00:00:00", None, "withdrawal", "branch"),
        ]
    )


def test_clean_lowers_text_but_not_status_and_drops_unknown_status(mixed):
    got = clean_transactions(mixed)
    assert rows(got, "transaction_id", "transaction_type", "channel", "status") == [
        (1, "withdrawal", "atm", "success"),
        (2, "deposit", "online", "success"),
        (5, "withdrawal", "branch", "FAILED"),
        (6, "withdrawal", "branch", "success"),
    ]


def test_derived_columns_are_recomputed_and_thresholds_are_strict(mixed):
    stale = mixed.withColumn("high_value_flag", F.lit(7))
    got = derive(stale).where("transaction_id <> 4")
    assert rows(got, "transaction_id", "txn_day", "txn_hour", "high_value_flag") == [
        (1, 5, 10, 0),
        (2, 5, 11, 1),
        (3, 5, 10, 0),
        (5, 31, 23, 0),
        (6, 31, 0, 0),
    ]


def test_ties_are_broken_by_customer(frame):
    df = clean_transactions(frame([txn(i, customer=c) for i, c in enumerate([9, 9, 7, 7, 5, 4, 3, 2])]))
    got = [tuple(r) for r in reports.top_customers(df, 4).collect()]
    assert got == [(7, 2), (9, 2), (2, 1), (3, 1)]


def test_months_merge_years_unless_calendar(mixed):
    df = clean_transactions(mixed).where("customer_id = 1 OR transaction_id = 5").withColumn("customer_id", F.lit(1))
    assert len(rows(reports.monthly_volume(df))) == 2
    assert len(rows(reports.monthly_volume(df, calendar=True))) == 3


def test_success_rate_counts_unknown_status_as_not_successful(mixed):
    got = rows(reports.success_rate_by_channel(normalize(mixed)))
    assert got == [("atm", 100.0), ("branch", 25.0), ("online", 100.0)]


def test_failed_over_limit_has_a_row_per_day(frame):
    failed = [txn(i, 1, f"2024-03-0{1 + i // 4} 10:00:00", status="failed") for i in range(8)]
    failed += [txn(20 + i, 2, status="failed") for i in range(3)]
    assert rows(reports.failed_over_limit(frame(failed))) == [(1,), (1,)]
    assert rows(reports.failed_over_limit(frame(failed), limit=2)) == [(1,), (1,), (2,)]


def test_days_merge_months_unless_calendar(frame):
    failed = [txn(i, 1, f"2024-0{1 + i // 2}-05 10:00:00", status="failed") for i in range(4)]
    assert rows(reports.failed_over_limit(frame(failed))) == [(1,)]
    assert rows(reports.failed_over_limit(frame(failed), calendar=True)) == []


def test_busiest_hours(frame):
    df = clean_transactions(frame([txn(i, ts=f"2024-03-01 0{h}:00:00") for i, h in enumerate([1, 1, 1, 2, 3, 3])]))
    assert [r[0] for r in reports.hourly_trend(df, 2).collect()] == [3, 2]
    assert [r[0] for r in reports.hourly_trend(df, 2, by="volume").collect()] == [1, 3]
    with pytest.raises(ValueError):
        reports.hourly_trend(df, by="amount")


def test_weeks_start_on_thursday(frame):
    # 2024-01-04 is a Thursday: the first customer's channels fall into two weeks.
    spread = ["2024-01-02 10:00:00", "2024-01-03 10:00:00", "2024-01-04 10:00:00"]
    within = ["2024-01-04 00:00:00", "2024-01-05 10:00:00", "2024-01-10 23:59:59"]
    records = [txn(i, 1, ts, channel=c) for i, (ts, c) in enumerate(zip(spread, ["atm", "online", "branch"]))]
    records += [txn(10 + i, 2, ts, channel=c) for i, (ts, c) in enumerate(zip(within, ["atm", "online", "branch"]))]
    df = frame(records)
    assert rows(reports.all_channels_in_week(df)) == [(2,)]
    trailing = reports.all_channels_in_week(df, as_of=F.lit("2024-01-08 00:00:00").cast("timestamp"))
    assert rows(trailing) == [(1,)]


def test_exact_sum_does_not_depend_on_partitioning(spark):
    rng = random.Random(7)
    values = [(round(rng.uniform(-1e6, 1e6), 2),) for _ in range(20000)] + [(1.005,), (None,)]
    expected = None
    for parts in (1, 3, 16):
        df = spark.createDataFrame(values, "amount double").repartition(parts)
        got = df.agg(exact_sum("amount")).first()[0]
        expected = expected or got
        assert got == expected
    paise = sum(round(v[0] * 100) for v in values[:-2])
    assert float(expected) == pytest.approx(paise / 100 + 1.005, abs=1e-6)


def test_sums_of_odd_amounts(spark):
    values = [(1, 5.0), (1, float("nan")), (2, 5.0), (2, float("inf")), (3, 1e17), (3, 0.25), (4, None), (5, 5.0), (5, None)]
    df = spark.createDataFrame(values, "k int, amount double")
    got = {r.k: r.total for r in df.groupBy("k").agg(exact_sum("amount").cast("double").alias("total")).collect()}
    assert got == {1: None, 2: None, 3: 1e17, 4: None, 5: 5.0}


def test_sums_round_half_up(spark):
    df = spark.createDataFrame([(1.005,), (0.0,)], "amount double")
    assert df.agg(rounded(exact_sum("amount"))).first()[0] == 1.01


def test_empty_input_gives_empty_reports(frame):
    df = clean_transactions(frame([]))
    assert reports.avg_amount_by_channel(df).count() == 0
    assert reports.all_channels_in_week(df).count() == 0


def test_reports_from_rollups_equal_single_reports(spark, frame):
    rng = random.Random(3)
    records = [
        txn(
            i,
            rng.choice([1, 1, 1, rng.randint(2, 30)]),
            f"2024-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:00:00",
            round(rng.uniform(0, 1000), 2),
            rng.choice(["withdrawal", "deposit"]),
            rng.choice(["atm", "online", "branch"]),
            rng.choice(["success", "success", "failed"]),
        )
        for i in range(2000)
    ]
    raw = frame(records)
    df = clean_transactions(raw)
    built = suite.build_reports(raw, df, suite.customer_rollup(df), suite.time_rollup(df))
    for name, report in built.items():
        source = raw if name in ("success_rate_by_channel", "failed_over_limit") else df
        assert rows(report) == rows(getattr(reports, name)(source)), name
    total = sum(r[3] for r in rows(built["monthly_volume"]))
    assert total == pytest.approx(sum(r[2] for r in rows(built["daily_volume"])))


def test_amounts_of_any_size_can_be_summed(spark):
    def total(*amounts, parts=1):
        df = spark.createDataFrame([(float(a),) for a in amounts], "amount double").repartition(parts)
        return df.agg(exact_sum("amount")).first()[0]

    assert total(9e16, 9e16) == 18 * 10**16
    assert total(1e30, 1) == 10**30 + 1
    assert total(1e35) is None
    assert total(float("nan"), 1) is None
    assert total(*[0.0000004] * 10) == 0
    fine = [1.23456789, 0.0000016, 99999.999999, -3.3333339]
    assert {str(total(*fine, parts=n)) for n in (1, 3, 16)} == {"99997.901235"}


def test_last_week_counts_all_channels_of_the_table(frame):
    rows_ = [txn(1, ts="2024-01-01 10:00:00", channel="branch")]
    rows_ += [txn(2, ts="2024-03-01 10:00:00", channel="atm"), txn(3, ts="2024-03-01 11:00:00", channel="online")]
    df = frame(rows_)
    as_of = F.lit("2024-03-01 12:00:00").cast("timestamp")
    assert reports.all_channels_in_week(df, as_of=as_of).count() == 0
    two = df.where("channel <> 'branch'").select("channel")
    assert reports.all_channels_in_week(df, as_of=as_of, channels=two).count() == 1


def test_amount_texts_have_no_exponent(spark):
    df = spark.createDataFrame([(x,) for x in (1e7, 12345678.5, 0.0001, 450.0, 0.25, -1e7)], "amount double")
    got = [r[0] for r in df.select(amount_text(F.col("amount"))).collect()]
    assert got == ["10000000.0", "12345678.5", "0.0001", "450.0", "0.25", "-10000000.0"]
