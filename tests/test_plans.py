"""What the plans must look like at any scale."""

import re

import pytest

import __spark_entry__ as entry
from ledgerweave.plans import finance_queries
from ledgerweave.periods import in_period, resolve
from ledgerweave.sources import shared, star, tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("name", list(finance_queries.QUERIES))
def test_no_cross_join_and_no_single_task_window(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SinglePartition" not in text
    assert "Python" not in text


@pytest.mark.parametrize("name", ["spend_total", "top_categories", "cash_flow", "half_split",
                                  "account_activity", "finance_summary", "monthly_trend"])
def test_dates_reach_the_scan(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    scans = re.findall(r"PushedFilters: \[([^\]]*)\].*?ReadSchema: (\S+)", text)
    assert any("GreaterThanOrEqual(l_shipdate" in f for f, _ in scans)


def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["spend_total"](spark, SF_DIR))
    lineitem = next(s for s in re.findall(r"ReadSchema: struct<([^\n]*)>", text) if "l_orderkey" in s)
    names = {c.split(":")[0] for c in lineitem.split(",")}
    assert names == {"l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_shipdate"}


def test_top_k_is_limited_before_the_shuffle(spark):
    text = plan(entry.queries()["top_transactions"](spark, SF_DIR))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_trend_needs_one_shuffle_beside_its_joins(spark):
    df = finance_queries.QUERIES["monthly_trend"][0](spark, SF_DIR)
    text = plan(df)
    assert text.count("Exchange hashpartitioning(user_id") == 1


def test_owner_join_keeps_line_items_to_one_shuffle(spark):
    """Even without broadcasts line items are exchanged once per join key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.transactions(spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    assert text.count("Exchange hashpartitioning(l_partkey") == 1


def test_local_folders_are_refused_on_a_cluster():
    for folder in ("spark-warehouse", "/tmp/x", "file:/tmp/x", "file:///tmp/x"):
        shared.check_shared(folder, "local[8]")
        for master in ("yarn", "spark://host:7077", "k8s://host"):
            with pytest.raises(ValueError):
                shared.check_shared(folder, master)
    shared.check_shared("hdfs://host/warehouse", "yarn")
    shared.check_shared("s3a://bucket/warehouse", "k8s://host")


def test_months_outside_the_period_are_not_read(spark, tmp_path):
    tables.write_transactions(star.transactions(spark, SF_DIR), str(tmp_path))
    months = sorted(p.name for p in (tmp_path / "transactions").iterdir() if "=" in p.name)
    some = tables.load_transactions(spark, str(tmp_path), "last_month", finance_queries.AS_OF)
    scan = plan(some)
    assert "PartitionFilters: [isnotnull(tx_month" in scan and "tx_month" not in some.columns
    whole = tables.load_transactions(spark, str(tmp_path))
    assert whole.count() == star.transactions(spark, SF_DIR).count()
    start = resolve("last_month", finance_queries.AS_OF).start
    for month in months:                  # the other months' files cannot be read any more
        if month != f"tx_month={start}":
            for file in (tmp_path / "transactions" / month).glob("*.parquet"):
                file.write_bytes(b"x" * file.stat().st_size)
    want = star.transactions(spark, SF_DIR).where(
        in_period("tx_date", "last_month", finance_queries.AS_OF))
    assert some.exceptAll(want).isEmpty() and some.count() == want.count() > 0
