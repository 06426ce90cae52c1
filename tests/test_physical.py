"""Physical plans: pruned scans, pushed filters, no single-task row windows."""

import re

import pytest

from voltide.operators import clean, windows
from voltide.plans.queries import QUERIES
from voltide.sources.tables import trades_from_events, trades_from_orders


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fences_reach_the_scan(spark, sf):
    text = plan(clean.iqr_filter(trades_from_events(spark, sf).select("op_id", "amount")))
    assert "GreaterThanOrEqual(value" in text and "LessThanOrEqual(value" in text
    assert re.search(r"ReadSchema: struct<event_id:bigint,value:double>", text)


def test_unused_joins_are_left_out(spark, sf):
    assert "Join" not in plan(trades_from_orders(spark, sf, ["op_id", "amount"]))


def test_rolling_columns_share_one_sort(spark, sf):
    t = trades_from_orders(spark, sf, ["op_id", "client_id", "close_ts", "amount"])
    text = plan(windows.rolling(t, windows.client_amount_stats()))
    assert text.count("Window ") == 1 and text.count("Exchange") == 1


@pytest.mark.parametrize("name", ["rolling_global_rate", "positional_split", "error_acf",
                                  "ffill_bfill", "rolling_means", "features_g2"])
def test_no_row_window_in_one_task(spark, sf, name):
    # a window over everything sits on an exchange into one partition
    text = plan(QUERIES[name](spark, sf))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = "".join(lines[i + 1: i + 4])
            if "Exchange SinglePartition" in below:
                assert "_chunk" in line, line


def test_client_columns_share_one_shuffle(spark, sf):
    from voltide.plans.cleaning import load_trades
    from voltide.session import materialize

    t = materialize(trades_from_orders(spark, sf), "trades")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(load_trades(t))
        raw = plan(load_trades(trades_from_orders(spark, sf)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert text.count("Exchange") == 1 and "Join" not in text
    assert text.count("FileScan") == 1
    # orders, customers and summed lines are joined by their keys, then one shuffle by client
    assert raw.count("Exchange") <= 6 and raw.count("FileScan") == 3


def test_no_cross_joins(spark, sf):
    for name in ("iqr_filter", "winsorize", "standard_scale", "error_by_quintile", "drift_report"):
        text = plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_folds_are_stored(spark):
    """Fits read the fold many times; its digest is made once."""
    from voltide.operators.models import with_folds

    df = spark.range(50).selectExpr("id AS op_id", "id * 1.0D AS amount")
    rows = with_folds(df, ["amount"], 5, "folds")
    assert "md5" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.where("fold BETWEEN 0 AND 4").count() == 50


def test_scaler_takes_few_columns_a_pass(spark, monkeypatch):
    from voltide.operators import scale

    seen, plain = [], scale.collect_stats

    def counted(df, columns, wanted):
        seen.append(len(df.columns))
        return plain(df, columns, wanted)

    monkeypatch.setattr(scale, "collect_stats", counted)
    names = [f"c{i}" for i in range(2 * scale.AT_ONCE + 1)]
    df = spark.range(10).selectExpr(*[f"CAST(id * {i} AS DOUBLE) AS {c}" for i, c in enumerate(names)])
    fitted = scale.StandardScale.fit(df, names)
    assert max(seen) <= scale.AT_ONCE and sum(seen) == len(names)
    assert [fitted.parameters[c][0] for c in names] == [4.5 * i for i in range(len(names))]
