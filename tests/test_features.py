"""Edge semantics on hand-made rows, and the shape of the plans."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daybook.functions.classes import argmax_class, spend_class
from daybook.functions.scaling import scale
from daybook.operators import daily as D
from daybook.operators import encode as E
from daybook.operators.evaluate import leaderboard, majority_class
from daybook.sources import parse_timestamp, read_statement_csv, statement_from_events, write_statement_csv
from daybook.sources.statement import STATEMENT_SCHEMA, coerce_amount
from registry.spark_queries import events


def statement(spark, rows):
    made = [(a, dt.datetime.fromisoformat(t), Decimal(str(v))) for a, t, v in rows]
    return spark.createDataFrame(made, STATEMENT_SCHEMA)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_class_bins_are_right_closed(spark):
    amounts = [(v,) for v in (0.0, 0.01, 200.0, 200.01, 600.0, 600.01)]
    got = spark.createDataFrame(amounts, "a double").select(spend_class(F.col("a"))).collect()
    assert [r[0] for r in got] == [None, 0, 0, 1, 1, 2]


def test_row_and_calendar_lags(spark):
    rows = [(1, f"2024-01-{d:02d} 10:00:00", -v) for d, v in ((1, 10), (2, 20), (5, 50), (6, 60))]
    daily = D.daily_spend(statement(spark, rows))
    by_row = {r["day"].day: (r["prev1"], r["prev2"]) for r in D.lag_features(daily).collect()}
    assert by_row == {5: (20.0, 10.0), 6: (50.0, 20.0)}
    by_day = {r["day"].day: (r["prev1"], r["prev2"]) for r in D.calendar_lag_features(daily).collect()}
    assert by_day == {5: (0.0, 0.0), 6: (50.0, 0.0)}


def test_income_and_zero_are_no_spending(spark):
    rows = [(1, "2024-01-01 10:00:00", 5), (1, "2024-01-01 11:00:00", 0), (1, "2024-01-02 10:00:00", -7.25)]
    got = D.daily_spend(statement(spark, rows)).collect()
    assert [(r["day"].day, r["amount"], r["n"]) for r in got] == [(2, 7.25, 1)]


def test_weekend_and_weekday(spark):
    rows = [(1, f"2024-01-{d:02d} 23:59:59", -1) for d in range(1, 8)]  # Monday to Sunday
    got = D.daily_spend(statement(spark, rows)).orderBy("day").collect()
    assert [r["dow"] for r in got] == list(range(7))
    assert [r["weekend"] for r in got] == [0, 0, 0, 0, 0, 1, 1]


def test_day_does_not_depend_on_the_session_zone(spark):
    rows = statement(spark, [(1, "2024-01-01 23:30:00", -1)])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert D.daily_spend(rows).first()["day"] == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_split_is_chronological(spark):
    rows = [(1, f"2024-01-{d:02d} 10:00:00", -1) for d in range(1, 13)]
    table = D.feature_table(statement(spark, rows))
    parts = [r["part"] for r in table.orderBy("day").collect()]
    assert parts == ["train"] * 8 + ["test"] * 2


def test_scaling_bounds_come_from_train(spark):
    rows = [(1, d, "train" if d < 3 else "test", float(v), 4.0) for d, v in enumerate((10, 20, 30, 50))]
    table = spark.createDataFrame(rows, "account_id long, day int, part string, v double, same double")
    for per_account in (True, False):
        got = D.minmax_scale(table, ["v", "same"], per_account).orderBy("day").collect()
        assert [r["v"] for r in got] == [0.0, 0.5, 1.0, 2.0]
        assert [r["same"] for r in got] == [0.0] * 4


def test_constant_column_with_other_test_value(spark):
    got = spark.range(1).select(scale(F.lit(9.0), F.lit(4.0), F.lit(4.0))).first()[0]
    assert got == 0.0


def test_default_count_rounds_half_to_even(spark):
    table = spark.createDataFrame([(2,), (3,)], "n long")
    assert D.default_count(table).first()[0] == 2


def test_majority_and_argmax_ties_take_the_lowest(spark):
    table = spark.createDataFrame([(1, 2), (1, 0), (1, 2), (1, 0)], "k int, cls int")
    assert majority_class(table, ["k"]).first()["majority"] == 0
    scores = spark.createDataFrame([(0.1, 0.7, 0.7)], "a double, b double, c double")
    assert scores.select(F.expr(argmax_class(["a", "b", "c"]))).first()[0] == 1


def test_leaderboard_marks_winners(spark):
    rows = [("class", "a", "accuracy", 0.5), ("class", "b", "accuracy", 0.7), ("amount", "a", "rmse", 3.0), ("amount", "b", "rmse", 2.0)]
    board = leaderboard(spark.createDataFrame(rows, "task string, model string, metric string, value double"))
    assert {(r["task"], r["model"]) for r in board.filter("winner").collect()} == {("class", "b"), ("amount", "b")}


def test_encoding_ignores_later_labels(spark):
    def encoded(labels):
        rows = [(1, dt.date(2024, 1, 1 + i), i % 2, 1, v) for i, v in enumerate(labels)]
        train = spark.createDataFrame(rows, "account_id long, day date, dow int, month int, cls int")
        return [r["dow_enc"] for r in E.ordered_target_encode(train, ["dow"], "cls").orderBy("day").collect()]

    # Same label sum, so the same mean: only rows after a change may differ.
    first, second = encoded([0, 1, 2, 1, 0]), encoded([0, 1, 2, 0, 1])
    assert first[:4] == second[:4]


def test_pooled_encoding_is_one_series(spark, folder):
    train = events(spark, folder).filter("part = 'train'")
    got = E.ordered_target_encode_pooled(train, ["dow"], "cls").toPandas()
    got["slot"] = train.select("account_id", "day", E.day_slot(F.col("account_id")).alias("slot")).toPandas().set_index(
        ["account_id", "day"]).loc[list(zip(got.account_id, got.day)), "slot"].to_numpy()
    got = got.sort_values(["day", "slot", "account_id"])
    mean, sums, counts = got["cls"].mean(), {}, {}
    for r in got.itertuples():
        want = (sums.get(r.dow, 0) + 0.5 * mean) / (counts.get(r.dow, 0) + 0.5)
        assert abs(r.dow_enc - want) < 1e-9
        sums[r.dow] = sums.get(r.dow, 0) + r.cls
        counts[r.dow] = counts.get(r.dow, 0) + 1


@pytest.mark.parametrize("few", [0, 200_000])
def test_pooled_encoding_does_not_depend_on_ranges(spark, monkeypatch, few):
    """Any number of ranges, a category that holds all rows, null categories and labels; totals broadcast or joined."""
    monkeypatch.setattr(E, "_FEW", few)
    rows = [(i % 40, dt.date(2024, 1, 1 + i // 40), None if i % 5 == 0 else i % 3, "all", None if i % 11 == 0 else i % 7) for i in range(800)]
    train = spark.createDataFrame(rows, "account_id long, day date, dow int, kind string, cls int").repartition(5)
    local = train.withColumn("slot", E.day_slot(F.col("account_id"))).toPandas().sort_values(["day", "slot", "account_id"])
    mean, want = local["cls"].mean(), {}
    for c in ("dow", "kind"):
        seen = {}
        for r in local.itertuples():
            key = None if c == "dow" and r.dow != r.dow else getattr(r, c)
            s, k = seen.get(key, (0.0, 0))
            want.setdefault((r.account_id, r.day), []).append((s + 0.5 * mean) / (k + 0.5))
            seen[key] = (s + (0.0 if r.cls != r.cls else r.cls), k + 1)
    for pieces in (1, 3, 16):
        got = E.ordered_target_encode_pooled(train, ["dow", "kind"], "cls", pieces=pieces)
        assert got.columns == [*train.columns, "dow_enc", "kind_enc"]
        for r in got.collect():
            assert [r.dow_enc, r.kind_enc] == pytest.approx(want[r.account_id, r.day])
    assert E.ordered_target_encode_pooled(train.limit(0), ["dow"], "cls").count() == 0


def test_unseen_category_gets_the_mean(spark):
    train = spark.createDataFrame([(0, 2), (0, 1), (1, 0)], "dow int, cls int")
    got = E.target_encode(spark.createDataFrame([(5,)], "dow int"), train, ["dow"], "cls").first()
    assert got["dow_enc"] == pytest.approx(1.0)


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    from daybook.sources.statement import AMOUNT_HEADER, TIME_HEADER

    path = tmp_path / "swapped.csv"
    path.write_text(f"{AMOUNT_HEADER},{TIME_HEADER}\n-5.00,01.02.2024 10:00:00\n-6.00\n", encoding="utf-8")
    rows = read_statement_csv(spark, str(path), lenient=True, keep_corrupt=True).collect()
    assert [(r.amount is not None, r.ts is not None, r._corrupt_record) for r in rows] == [(True, True, None), (True, False, "-6.00")]
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_statement_csv(spark, str(path), lenient=True, header_names=[TIME_HEADER, AMOUNT_HEADER]).collect()


def test_stream_goes_on(spark, tmp_path):
    from daybook.streaming.daily import run_to_folder

    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for n in (3, 4):
        spark.range(n).write.mode("append").parquet(source)
        run_to_folder(spark.readStream.schema("id long").parquet(source), "x", target, progress)
    assert spark.read.parquet(target).count() == 7


def test_csv_round_trip_and_bad_rows(spark, tmp_path):
    rows = [(1, "2024-02-03 04:05:06", -12.5), (2, "2024-11-30 23:59:59", 7)]
    path = str(tmp_path / "csv")
    write_statement_csv(statement(spark, rows), path)
    back = read_statement_csv(spark, path, account="account_id")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, statement(spark, rows).collect()))
    bad = tmp_path / "bad.csv"
    bad.write_text(
        "Дата i час операції,Опис,Сума в валюті картки (UAH)\n"
        "1.2.2025 3:04:05,x,-1.50\nsoon,y,-2\n01.02.2025 03:04:05,z,many\n", encoding="utf-8"
    )
    got = read_statement_csv(spark, str(bad), lenient=True).collect()
    assert got[0]["ts"] == dt.datetime(2025, 2, 1, 3, 4, 5) and got[0]["amount"] == Decimal("-1.50")
    assert got[1]["ts"] is None and got[2]["amount"] is None
    with pytest.raises(PySparkException):
        read_statement_csv(spark, str(bad)).collect()


def test_strict_parsers_raise(spark):
    text = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(PySparkException):
        text.select(parse_timestamp(F.col("t"))).collect()
    with pytest.raises(PySparkException):
        text.select(coerce_amount(F.col("t"))).collect()


def test_feature_plan(spark, folder):
    plan = plan_of(events(spark, folder))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "SinglePartition" not in plan
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), Not(EqualTo(event_type,signup)), GreaterThan(value,0.0)]" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    scan = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "props" not in scan and "event_id" not in scan


def test_raw_amount_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "statement")
    statement(spark, [(1, "2024-01-01 10:00:00", -1)]).write.parquet(path)
    plan = plan_of(D.keep_spending(spark.read.schema(STATEMENT_SCHEMA).parquet(path)))
    assert "LessThan(amount,0" in plan


def test_prefilter_keeps_the_exact_filter(spark, folder):
    full = D.keep_spending(statement_from_events(spark, folder)).count()
    assert D.keep_spending(statement_from_events(spark, folder, spending_only=True)).count() == full


def test_account_models_never_shuffle_after_the_feature_table(spark, folder):
    from registry.spark_queries import QUERIES

    for query in ("tree_by_account", "newton_classify_by_account", "knn_classify", "target_encode_test", "minmax_scale"):
        plan = plan_of(QUERIES[query](spark, folder))
        assert plan.count("Exchange hashpartitioning") == 2, query
        assert "Python" not in plan and "InPandas" not in plan


def test_copies_are_limited_before_the_shuffle(spark):
    from daybook.operators.knn import _merge_copies

    rows = spark.createDataFrame([(1, [0.5], 2)], "id long, __x array<double>, label int")
    assert plan_of(_merge_copies(rows, "id", "label", 3)).count("WindowGroupLimit") >= 1
