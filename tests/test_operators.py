"""Sampling, neighbours, nets, streams and lineage on small data."""

import hashlib
import math
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators.dense import DenseNet, fit_dense, gradient_sums
from daybook.operators.knn import knn_by_account, knn_pooled
from daybook.operators import sampling
from daybook.operators.sampling import Goss, Order, bag_samples, by_hash, first_rows, goss_sample, goss_weights
from daybook.session import cut_lineage, shared_folder
from daybook.streaming.daily import CLOSED_DAY_SCHEMA, LAGGED_DAY_SCHEMA, run_to_folder, stream_lag_features, stream_lags, stream_lags_in_order
from registry.spark_queries import daily_events


def test_bag_sizes_and_members(spark):
    rows = spark.range(1003).withColumnRenamed("id", "k")
    picks = bag_samples(rows, 3, ["k"], 0.8, "s")
    for t, pick in enumerate(picks):
        got = {r["k"] for r in rows.filter(pick).collect()}
        ranked = sorted(range(1003), key=lambda k: hashlib.md5(f"s-{t}-{k}".encode()).hexdigest())
        assert got == set(ranked[: int(1003 * 0.8)])


def test_first_rows_with_heavy_ties(spark):
    """A third of all rows share one value; ties are resolved by the next column."""
    data = [(i, 5.0 if i % 3 == 0 else float(i), float((i * 7919) % 1000)) for i in range(900)]
    rows = spark.createDataFrame(data, "k long, v double, t double")
    for want in (1, 5, 6, 150, 300, 304, 305, 899, 900, 2000):
        pick = first_rows(rows, {"a": Order(("v", "t", "double(k)"), want)})["a"]
        expected = {r[0] for r in sorted(data, key=lambda r: (r[1], r[2], r[0]))[:want]}
        assert {r["k"] for r in rows.filter(pick).collect()} == expected


def test_first_rows_several_orders_and_filter(spark):
    rows = spark.range(100).select("id", F.col("id").cast("double").alias("v"))
    picks = first_rows(rows, {"low": Order(("v",), 3), "high": Order(("-v",), 4, "v < 50"), "none": Order(("v",), 0)})
    assert sorted(r["id"] for r in rows.filter(picks["low"]).collect()) == [0, 1, 2]
    assert sorted(r["id"] for r in rows.filter(picks["high"]).collect()) == [46, 47, 48, 49]
    assert rows.filter(picks["none"]).count() == 0


@pytest.mark.parametrize("values,accuracy", [(100_000, 10_000), (40, 10_000), (40, 10)])
def test_first_rows_in_buckets_and_from_narrow_bands(spark, monkeypatch, values, accuracy):
    """Bands of many values are cut into buckets; bands that miss the row are widened; unknown numbers of rows; nulls."""
    monkeypatch.setattr(sampling, "_VALUES", values)
    monkeypatch.setattr(sampling, "_ACCURACY", accuracy)
    data = [(i, None if i % 50 == 7 else math.exp((i * 7919) % 5000 / 200)) for i in range(5000)]
    rows = spark.createDataFrame(data, "k long, v double").repartition(5)
    known = sorted((r for r in data if r[1] is not None), key=lambda r: r[1])
    for want in (1, 2, 2500, 4899, 4900, 4901):
        found = first_rows(rows, {"a": Order(("v",), want), "b": Order(("-v",), want, rows=5000), "c": by_hash("s", ["k"], want, "k < 3000")})
        got = {key: {r["k"] for r in rows.filter(f).filter("v IS NOT NULL").select("k").collect()} for key, f in found.items()}
        assert got["a"] == {r[0] for r in known[:want]}
        assert got["b"] == {r[0] for r in known[::-1][:want]}
        ranked = sorted(range(3000), key=lambda k: hashlib.md5(f"s-{k}".encode()).hexdigest())
        assert got["c"] == {k for k in ranked[:want] if k % 50 != 7}


def test_samples_take_few_passes(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(sampling, "_counted", lambda df, waiting, f=sampling._counted: passes.append("count") or f(df, waiting))
    monkeypatch.setattr(sampling, "_place_bands", lambda df, waiting, f=sampling._place_bands: passes.append("place") or f(df, waiting))
    rows = spark.range(20_000).selectExpr("id", "sin(id) AS g")
    bag_samples(rows, 5, ["id"], count=20_000)
    assert passes == ["place", "count"]  # placing hash bands reads nothing
    passes.clear()
    goss_weights(rows, {"a": "g", "b": "cos(id)"}, ["id"], Goss(), {"a": "1", "b": "2"}, count=20_000)
    assert passes == ["place", "count"] * 2


@pytest.mark.parametrize("n", [3, 10, 500])
def test_goss_sizes(spark, n):
    rows = spark.range(n).selectExpr("id", "sin(id) AS g")
    got = goss_sample(rows, "g", ["id"], Goss())
    large, small = max(1, int(n * 0.2)), max(1, int(n * 0.1))
    assert got.filter("weight = 1").count() == large
    assert got.filter("weight = 8").count() == small
    lowest = got.filter("weight = 1").agg(F.min(F.abs("g"))).first()[0]
    assert rows.filter(F.abs("g") > lowest + 1e-8).count() < large


def test_goss_when_all_gradients_are_equal(spark):
    got = goss_sample(spark.range(200).selectExpr("id", "1D AS g"), "g", ["id"], Goss())
    assert got.groupBy("weight").count().orderBy("weight").collect() == [(1.0, 40), (8.0, 20)]


def brute_neighbours(train, test, k, metric):
    out = {}
    for i, q in test:
        ranked = sorted(
            (round(float(np.abs(x - q).sum() if metric == "manhattan" else np.sqrt(((x - q) ** 2).sum())), 9), label, j)
            for j, x, label in train
        )[:k]
        labels = [r[1] for r in ranked]
        out[i] = min(set(labels), key=lambda c: (-labels.count(c), c))
    return out


@pytest.mark.parametrize("metric", ["manhattan", "euclidean"])
def test_pooled_neighbours_with_copies_and_small_blocks(spark, metric):
    """A third of the train rows and of the queries are copies of one vector; blocks are tiny."""
    draw = np.random.default_rng(3)
    vectors = [np.round(draw.normal(size=4) * (1 + i % 5), 2) for i in range(240)]
    for i in range(0, 240, 3):
        vectors[i] = np.array([1.0, 1.0, 0.0, 0.5])
    labels = [int(draw.integers(0, 4)) for _ in vectors]
    rows = [(i, [float(v) for v in x], labels[i]) for i, x in enumerate(vectors)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int")
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    for k in (1, 3, 7):
        got = knn_pooled(train, test, "x", "id", "label", k, metric, train_block=10, query_block=7)
        want = brute_neighbours(
            [(i, np.array(x), c) for i, x, c in rows if i % 4], [(i, np.array(x)) for i, x, _ in rows if i % 4 == 0], k, metric
        )
        assert {r["id"]: r["pred"] for r in got.collect()} == want


def test_pooled_neighbours_when_train_is_smaller_than_k(spark):
    train = spark.createDataFrame([(1, [0.0], 2), (2, [5.0], 1)], "id long, x array<double>, label int")
    test = spark.createDataFrame([(9, [1.0], 0)], "id long, x array<double>, label int")
    assert knn_pooled(train, test, "x", "id", k=5).first()["pred"] == 1


def test_pooled_neighbours_send_a_query_once_to_a_block(spark, tmp_path):
    """Vectors without any structure reach every cell; a query goes to blocks, not to each of its cells."""
    from daybook.operators.knn import _blocks, _plan_cells, _visit_udf

    draw = np.random.default_rng(5)
    rows = [(i, [float(v) for v in draw.normal(size=16)], i % 4, [(i % 4, i)]) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, __x array<double>, label int, members array<struct<label int, id long>>")
    _, cells = _plan_cells(df.select("__x", "members"), "manhattan", 3)
    assert len(cells.sizes) == 30
    blocks = _blocks(cells.sizes, 450)
    visits = df.limit(50).select(_visit_udf(cells, blocks, "manhattan", 3)("__x").alias("v")).collect()
    assert {len(r["v"]["blocks"]) for r in visits} <= {1, 2, 3}
    assert sum(len(r["v"]["blocks"]) for r in visits) > 50


@pytest.mark.parametrize("metric", ["manhattan", "euclidean"])
def test_pooled_neighbours_at_equal_and_large_distances(spark, metric):
    """One-hot vectors are all equally far; numbers beyond 32 bits, and far from zero, are compared exactly."""
    draw = np.random.default_rng(6)
    hot = [list(np.eye(8)[i % 8] * (1 + i // 8)) for i in range(80)]
    far = [list(1e6 + np.round(draw.normal(size=8), 3)) for _ in range(80)]
    huge = [list(draw.normal(size=8) * 1e30) for _ in range(40)]
    rows = [(i, [float(v) for v in x], int(draw.integers(0, 5))) for i, x in enumerate(hot + far + huge)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int")
    got = knn_pooled(df.filter("id % 3 <> 0"), df.filter("id % 3 = 0"), "x", "id", "label", 3, metric)
    want = brute_neighbours(
        [(i, np.array(x), c) for i, x, c in rows if i % 3], [(i, np.array(x)) for i, x, _ in rows if i % 3 == 0], 3, metric
    )
    assert {r["id"]: r["pred"] for r in got.collect()} == want


def test_account_neighbours_tie_order(spark):
    """Equal distances: the lower label comes first; equal votes: the lower label wins."""
    rows = [(1, 1, "train", 0.0, 2), (1, 2, "train", 2.0, 1), (1, 3, "train", 2.0, 0), (1, 4, "test", 1.0, 0)]
    df = spark.createDataFrame(rows, "account_id long, day int, part string, x double, cls int")
    assert knn_by_account(df, ["x"], k=1).first()["pred"] == 0
    assert knn_by_account(df, ["x"], k=2).first()["pred"] == 0


def test_gradient_matches_differences(spark):
    draw = np.random.default_rng(1)
    data = [(*map(float, draw.normal(size=2)), int(draw.integers(0, 3))) for _ in range(40)]
    df = spark.createDataFrame(data, "a double, b double, cls int").repartition(3)
    net = DenseNet.seeded((2, 4, 3), "class", seed=5, spread=0.7)
    sums = {r["at"]: r["total"] for r in gradient_sums(df, net, ["a", "b"], "cls").collect()}

    def loss():
        x, y = np.array([r[:2] for r in data]), np.array([r[2] for r in data])
        h = np.maximum(x @ net.weights[0] + net.biases[0], 0)
        z = h @ net.weights[1] + net.biases[1]
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        return -np.log(p[np.arange(len(y)), y]).sum()

    step = 1e-6
    for at, (layer, i, j) in {0: (0, 0, 0), 5: (0, 1, 1), 12: (1, 0, 0), 17: (1, 1, 2)}.items():
        net.weights[layer][i, j] += step
        up = loss()
        net.weights[layer][i, j] -= 2 * step
        down = loss()
        net.weights[layer][i, j] += step
        assert sums[at] == pytest.approx((up - down) / (2 * step), abs=1e-3)


def test_patience_stops_training(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "x double, y double")
    net = DenseNet([np.zeros((1, 1))], [np.ones(1)], "amount")  # already perfect
    assert len(fit_dense(df, ["x"], (1, 1), "amount", "y", epochs=50, patience=3, net=net).losses) == 4


def test_stream_state_carries_over_batches(spark, folder, tmp_path):
    """Closed days that arrive in two batches give the same lags as the batch operator."""
    days = daily_events(spark, folder).select("account_id", "day", "amount", "n")
    source = str(tmp_path / "closed")
    middle = days.filter("day < DATE'2024-01-15'")
    middle.write.mode("append").parquet(source)
    stream = spark.readStream.schema(CLOSED_DAY_SCHEMA).parquet(source)
    query_dir, out = str(tmp_path / "progress"), str(tmp_path / "out")

    def run():
        stream_lags(stream).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", query_dir
        ).trigger(availableNow=True).start().awaitTermination()

    run()
    days.filter("day >= DATE'2024-01-15'").write.mode("append").parquet(source)
    run()
    got = spark.read.parquet(out).dropna().select("account_id", "day", "prev1", "prev2")
    from daybook.operators.daily import lag_features

    want = lag_features(days).select("account_id", "day", "prev1", "prev2")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_late_days_get_their_place(spark, folder, tmp_path):
    """Days shuffled over files that come one at a time, in two runs, give the lags of the batch operator."""
    from daybook.operators.daily import lag_features

    days = daily_events(spark, folder).select("account_id", "day", "amount", "n")
    source, target, progress = (str(tmp_path / name) for name in ("closed", "out", "progress"))
    number = F.datediff("day", F.lit("2024-01-01").cast("date")) + F.pmod(F.xxhash64("account_id", "day"), F.lit(5))
    part = F.floor(number / 3)  # a file holds days up to four days late
    rows = days.withColumn("part", part).cache()
    parts = sorted(r[0] for r in rows.select("part").distinct().collect())
    assert len(parts) > 8

    def arrive(some):
        for p in some:
            rows.filter(F.col("part") == p).drop("part").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(CLOSED_DAY_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        run_to_folder(stream_lags_in_order(stream, 7), "lags", target, progress)

    arrive(parts[:5])
    run()
    first = spark.read.schema(LAGGED_DAY_SCHEMA).parquet(target).count()
    arrive(parts[5:])
    run()
    got = spark.read.schema(LAGGED_DAY_SCHEMA).parquet(target)
    rows.unpersist()
    bound = days.agg(F.max("day")).first()[0] - timedelta(days=7)
    want = lag_features(days).filter(F.col("day") < F.lit(bound)).select("account_id", "day", "prev1", "prev2")
    complete = got.dropna().select("account_id", "day", "prev1", "prev2")
    assert 0 < first < got.count() and got.filter(F.col("day") >= F.lit(bound)).isEmpty()
    assert complete.count() == want.count() and complete.exceptAll(want).isEmpty()
    # a day that is older than what has left already is not taken in
    days.limit(1).withColumn("day", F.lit("2023-01-01").cast("date")).coalesce(1).write.mode("append").parquet(source)
    run()
    assert spark.read.schema(LAGGED_DAY_SCHEMA).parquet(target).count() == got.count()


def test_lag_stream_goes_on(spark, folder, tmp_path):
    places = tuple(str(tmp_path / name) for name in ("d", "dp", "l", "lp"))
    once = stream_lag_features(spark, folder, places=places).count()
    assert once > 0 and stream_lag_features(spark, folder, places=places).count() == once


def test_written_frames(spark):
    written = cut_lineage(spark.range(10))
    assert written.path.startswith(shared_folder(spark)) and written.rows.count() == 10
    written.drop()


def test_account_without_train_rows(spark):
    """Three spending days leave one row, a test row: no model, so no prediction, and no error for the others."""
    from datetime import date

    from daybook.operators.account_models import boost_by_account, tree_by_account
    from daybook.operators.boosting import BoostParams

    rows = [(1, date(2024, 1, d), "train" if d < 9 else "test", float(d), float(d), d % 3) for d in range(1, 11)]
    rows.append((2, date(2024, 1, 3), "test", None, None, 1))
    frame = spark.createDataFrame(rows, "account_id long, day date, part string, x double, y double, cls int")
    for scored in (
        tree_by_account(frame, ["x"]),
        tree_by_account(frame, ["x"], task="amount"),
        boost_by_account(frame, ["x"], BoostParams("amount", rounds=2)),
        boost_by_account(frame, ["x"], BoostParams("class", rounds=2)),
        knn_by_account(frame, ["x"]),
    ):
        found = {(r.account_id, r.day.day): r.pred for r in scored.collect()}
        assert found[2, 3] is None
        assert all(v is not None for k, v in found.items() if k[0] == 1)
