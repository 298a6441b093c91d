"""Every registered query: a function of the session and a folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import losses
from daybook.functions.calendar import WEEKDAY_NAMES, with_calendar
from daybook.functions.classes import DEFAULT_EDGES, DEFAULT_LABELS, argmax_class, name_of, softmax, spend_class
from daybook.operators import account_models as A
from daybook.operators import daily as D
from daybook.operators import dense as N
from daybook.operators import encode as E
from daybook.operators import evaluate as V
from daybook.operators import knn as K
from daybook.operators import linear as L
from daybook.operators import sampling as S
from daybook.operators import score as Z
from daybook.operators import single_tree as T
from daybook.operators import splits as P
from daybook.operators.binned import fit_binned
from daybook.operators.boosting import BoostParams, fit_boosted
from daybook.operators.ensemble import predict_from_table
from daybook.operators.sampling import Goss
from daybook.operators.trees import Node, Tree
from daybook.plans import compare as C
from daybook.plans import presets
from daybook.plans.model_frame import KEYS, ModelFrame, encode_requests, encoded_frame, model_frame
from daybook.session import cut_lineage, new_folder
from daybook.sources import statement as src
from daybook.streaming import daily as stream

INF = float("inf")
EVENT_EDGES = (0.0, 50.0, 120.0, INF)
ORDER_EDGES = (0.0, 760000.0, 1230000.0, INF)
X = D.FEATURES


def r6(*columns: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]


def r9(*columns: str) -> list:
    """For thresholds and gains; gains are already rounded to 9 digits."""
    return [F.round(F.col(c), 9).alias(c) for c in columns]


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Feature table of the events statement."""
    return D.feature_table(src.statement_from_events(spark, folder, spending_only=True), EVENT_EDGES)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Feature table of the orders statement (one account, several years)."""
    return D.feature_table(src.statement_from_orders(spark, folder, spending_only=True), ORDER_EDGES)


def daily_events(spark: SparkSession, folder: str) -> DataFrame:
    return D.daily_spend(src.statement_from_events(spark, folder, spending_only=True))


# --- sources ---------------------------------------------------------------------------------------------


def scan_statement(spark, folder):
    return src.statement_from_events(spark, folder)


def scan_statement_csv(spark, folder):
    path = new_folder(spark, "statement")
    src.write_statement_csv(src.statement_from_events(spark, folder), path)
    header = ["account_id", src.TIME_HEADER, src.AMOUNT_HEADER]
    return src.read_statement_csv(spark, path, account="account_id", header_names=header)


def coerce_amount(spark, folder):
    raw = spark.read.parquet(f"{folder}/events.parquet")
    text = F.col("value").cast("string")
    maybe = F.when(F.col("event_type") == "signup", F.lit("n/a")).otherwise(text)
    return raw.select(
        "event_id", src.coerce_amount(text).alias("amount"), src.coerce_amount(maybe, lenient=True).alias("lenient")
    )


def parse_timestamp(spark, folder):
    raw = spark.read.parquet(f"{folder}/events.parquet")
    padded = src.format_timestamp(F.col("ts"))
    short = F.concat(
        F.concat_ws(".", F.dayofmonth("ts"), F.month("ts"), F.year("ts")), F.lit(" "),
        F.concat_ws(":", F.hour("ts"), F.minute("ts"), F.second("ts")),
    )
    broken = F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(padded)
    return raw.select(
        "event_id",
        src.parse_timestamp(padded).alias("ts"),
        src.parse_timestamp(short).alias("ts_short"),
        src.parse_timestamp(broken, lenient=True).alias("ts_lenient"),
    )


# --- features --------------------------------------------------------------------------------------------


def expense_filter(spark, folder):
    return D.keep_spending(src.statement_from_events(spark, folder, spending_only=True))


def daily_spend(spark, folder):
    return daily_events(spark, folder).select("account_id", "day", "amount", "n")


def calendar_features(spark, folder):
    days = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.to_date("l_shipdate").alias("day")).distinct()
    return with_calendar(days)


def lag_features(spark, folder):
    return D.lag_features(daily_events(spark, folder)).select("account_id", "day", "amount", "prev1", "prev2")


def lag_calendar(spark, folder):
    return D.calendar_lag_features(daily_events(spark, folder)).select("account_id", "day", "amount", "prev1", "prev2")


def spend_class_query(spark, folder):
    """Per account and day: how much was spent, and which class is it?"""
    days = daily_events(spark, folder)
    return days.select(
        "account_id", "day", "amount",
        spend_class(F.col("amount"), EVENT_EDGES).alias("cls"),
        spend_class(F.col("amount"), DEFAULT_EDGES).alias("cls_default"),
    )


def label_names(spark, folder):
    days = daily_events(spark, folder)
    return days.select(
        "account_id", "day",
        name_of(F.col("dow"), WEEKDAY_NAMES).alias("weekday_name"),
        name_of(spend_class(F.col("amount")), DEFAULT_LABELS).alias("class_name"),
    )


def feature_table(spark, folder):
    return events(spark, folder)


def feature_table_orders(spark, folder):
    return orders(spark, folder)


def chrono_split(spark, folder):
    return events(spark, folder).groupBy("account_id", "part").agg(
        F.count(F.lit(1)).alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


def truncate_features(spark, folder):
    return D.truncate_features(events(spark, folder)).select("account_id", "day", *X)


def class_distribution(spark, folder):
    return D.class_distribution(events(spark, folder))


def minmax_bounds(spark, folder):
    return D.minmax_bounds(events(spark, folder), (*X, "amount"), ["account_id"])


def minmax_scale(spark, folder):
    scaled = D.minmax_scale(events(spark, folder), (*X, "amount"))
    return scaled.select("account_id", "day", "part", *r6(*X, "amount"))


def minmax_scale_pooled(spark, folder):
    scaled = D.minmax_scale(orders(spark, folder), (*X, "amount"), per_account=False)
    return scaled.select("account_id", "day", "part", *r6(*X, "amount"))


def minmax_inverse(spark, folder):
    table = events(spark, folder)
    bounds = D.minmax_bounds(table, ["amount"], ["account_id"])
    back = D.minmax_inverse(D.minmax_scale(table, ["amount"]), ["amount"], bounds, ["account_id"])
    return back.select("account_id", "day", *r6("amount"))


def default_count(spark, folder):
    return D.default_count(events(spark, folder), ["account_id"])


def default_count_all(spark, folder):
    return D.default_count(orders(spark, folder))


def spend_summary(spark, folder):
    return D.spend_summary(events(spark, folder), ["part"]).select("part", "days", *r6("mean_amount", "std_amount"))


# --- groups and encoders ---------------------------------------------------------------------------------


def target_stats(spark, folder):
    train = events(spark, folder).filter("part = 'train'")
    return E.target_stats(train, "dow", "cls")


def gini_by_group(spark, folder):
    return P.gini_by_group(events(spark, folder), ["account_id", "part"]).select("account_id", "part", "n", *r6("gini"))


def mse_by_group(spark, folder):
    return P.mse_by_group(events(spark, folder), ["dow", "part"], "amount").select("dow", "part", "n", *r6("mse"))


def majority_class(spark, folder):
    return V.majority_class(events(spark, folder), ["account_id", "part"])


def ordered_target_encode(spark, folder):
    train = orders(spark, folder).filter("part = 'train'")
    encoded = E.ordered_target_encode(train, ["dow", "month"], "cls")
    return encoded.select("account_id", "day", *r6("dow_enc", "month_enc"))


def ordered_target_encode_pooled(spark, folder):
    train = events(spark, folder).filter("part = 'train'")
    encoded = E.ordered_target_encode_pooled(train, ["dow", "month"], "cls")
    return encoded.select("account_id", "day", *r6("dow_enc", "month_enc"))


def target_encode_test(spark, folder):
    table = events(spark, folder)
    encoded = E.target_encode_by_account(table, ["dow", "month"], "cls").filter("part = 'test'")
    return encoded.select("account_id", "day", *r6("dow_enc", "month_enc"))


def target_encode_pooled(spark, folder):
    """Test rows encoded by the train rows of all accounts."""
    table = events(spark, folder)
    train, test = table.filter("part = 'train'"), table.filter("part = 'test'")
    return E.target_encode(test, train, ["dow", "month"], "cls").select("account_id", "day", *r6("dow_enc", "month_enc"))


def bag_sample(spark, folder):
    train = cut_lineage(events(spark, folder).filter("part = 'train'").select(*KEYS)).rows
    return S.bag_sample(train, 6, KEYS).select("tree", "account_id", "day")


def goss_sample(spark, folder):
    train = model_frame(events(spark, folder))
    mean = float(train.train.agg(F.avg("y")).first()[0])
    sample = S.goss_sample(train.train, f"({mean!r}D - y)", KEYS, seed="42-1-0")
    return _released(train, sample.select("account_id", "day", "weight"))


# --- scores and losses -----------------------------------------------------------------------------------


def _scores(spark, folder):
    """Three linear scores per day, as stand-ins for raw class scores."""
    frame = events(spark, folder)
    return frame.selectExpr(
        "account_id", "day", "cls", "amount", "prev1 / 100 - 1 AS f0", "prev2 / 120 - n / 4D AS f1", "dow / 6D AS f2"
    )


def softmax_scores(spark, folder):
    probabilities = [f"{p} AS p{k}" for k, p in enumerate(softmax(["f0", "f1", "f2"]))]
    return _scores(spark, folder).selectExpr("account_id", "day", *probabilities).select(
        "account_id", "day", *r6("p0", "p1", "p2")
    )


def argmax_class_query(spark, folder):
    return _scores(spark, folder).selectExpr("account_id", "day", f"{argmax_class(['f0', 'f1', 'f2'])} AS pred")


def log_loss(spark, folder):
    p = softmax(["f0", "f1", "f2"])
    scored = _scores(spark, folder).selectExpr("cls", *[f"{e} AS p{k}" for k, e in enumerate(p)])
    true = "CASE cls WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END"
    return V.total_log_loss(scored, true, by=["cls"]).select("cls", *r6("total_loss", "mean_loss"))


def gradients_squared(spark, folder):
    g, h = losses.squared_gradient("f0", "amount")
    return _scores(spark, folder).selectExpr("account_id", "day", f"round({g}, 6) AS g", f"{h} AS h")


def gradients_softmax(spark, folder):
    columns = []
    for k, p in enumerate(softmax(["f0", "f1", "f2"])):
        g, h = losses.softmax_gradient(p, "cls", k)
        columns += [f"round({g}, 6) AS g{k}", f"round({h}, 6) AS h{k}"]
    return _scores(spark, folder).selectExpr("account_id", "day", *columns)


# --- splits ----------------------------------------------------------------------------------------------


_HELD: list[ModelFrame] = []


def _released(frame: ModelFrame, result: DataFrame) -> DataFrame:
    """The result is lazy, so its kept table stays until another query has one of its own."""
    while _HELD:
        held = _HELD.pop()
        if held.rows.sparkSession is frame.rows.sparkSession:
            held.release()
    _HELD.append(frame)
    return result


def _first_gradients(frame: ModelFrame) -> DataFrame:
    """Train rows with squared-loss gradients at the start score."""
    mean = float(frame.train.agg(F.avg("y")).first()[0])
    return frame.train.withColumns({"g": F.lit(mean) - F.col("y"), "h": F.lit(1.0)})


def gini_best_split(spark, folder):
    train = events(spark, folder).filter("part = 'train'")
    return P.gini_best_split(train, ["account_id"], X, ranges=P.BOUNDED).select(
        "account_id", "feature", *r9("threshold", "gain"), "n_left", "n_right"
    )


def mse_best_split(spark, folder):
    frame = model_frame(events(spark, folder))
    best = P.mse_best_split(frame.train, ["dow"], X[1:])
    return _released(frame, best.select(F.round("dow", 6).alias("dow"), "feature", *r9("threshold", "gain"), "n_left", "n_right"))


def mse_best_split_ranges(spark, folder):
    """The same search in value ranges, as for features of very many distinct values."""
    frame = model_frame(events(spark, folder))
    ranges = P.plan_ranges(frame.train, X[1:], wide=20, pieces=16)
    best = P.mse_best_split(frame.train, ["dow"], X[1:], ranges=ranges)
    return _released(frame, best.select(F.round("dow", 6).alias("dow"), "feature", *r9("threshold", "gain"), "n_left", "n_right"))


def newton_best_split(spark, folder):
    frame = model_frame(events(spark, folder))
    best = P.newton_best_split(_first_gradients(frame), ["account_id"], X, lam=1.0, gamma=0.0, ranges=P.BOUNDED)
    return _released(frame, best.select("account_id", "feature", *r9("threshold", "gain"), "n_left", "n_right"))


def newton_leaf_values(spark, folder):
    frame = model_frame(events(spark, folder))
    leaves = P.newton_leaf_values(_first_gradients(frame), ["account_id"], lam=2.0)
    return _released(frame, leaves.select("account_id", "n", *r6("leaf_value")))


def _oblivious_level(spark, folder, level_gain, wide=None):
    frame = model_frame(events(spark, folder))
    rows = _first_gradients(frame).withColumn("node", F.when(F.col("n") > 0.2, 1).otherwise(0))
    ranges = P.BOUNDED if wide is None else P.plan_ranges(rows, X, wide=wide, pieces=16)
    best = P.oblivious_best_split(rows, ["account_id"], "node", X, lam=3.0, level_gain=level_gain, ranges=ranges)
    return _released(frame, best.select("account_id", "feature", *r9("threshold", "gain")))


def oblivious_best_split_sum_ranges(spark, folder):
    return _oblivious_level(spark, folder, "sum", wide=20)


def oblivious_best_split(spark, folder):
    return _oblivious_level(spark, folder, "owner")


def oblivious_best_split_sum(spark, folder):
    return _oblivious_level(spark, folder, "sum")


def assign_nodes(spark, folder):
    rows = events(spark, folder).withColumn("node", F.lit(1).cast("long"))
    rows = P.assign_nodes(rows, "node", "prev1", 75.5)
    rows = P.assign_nodes(rows, "node", "n", 2.0)
    return P.assign_nodes(rows, "node", "prev2", 100.0).select("account_id", "day", "node")


# --- trees -----------------------------------------------------------------------------------------------


def _tree_rows(table: DataFrame) -> DataFrame:
    return table.select("round", "class", "node_id", "is_leaf", "feature", *r9("threshold"), *r6("value"))


def tree_classify(spark, folder):
    frame = model_frame(orders(spark, folder))
    return _released(frame, _tree_rows(T.tree_classify(frame.train, X, max_depth=3).table(spark)))


def tree_regress(spark, folder):
    frame = model_frame(orders(spark, folder))
    return _released(frame, _tree_rows(T.tree_regress(frame.train, X, max_depth=3).table(spark)))


def predict_tree(spark, folder):
    frame = model_frame(events(spark, folder))
    model = T.tree_classify(frame.train, X, max_depth=3)
    return _released(frame, model.predict(frame.rows).select("account_id", "day", "part", "pred"))


def forest_classify(spark, folder):
    frame = model_frame(events(spark, folder))
    model = T.forest_classify(frame.train, X, KEYS, n_trees=6, max_depth=5)
    return _released(frame, model.predict(frame.rows).select("account_id", "day", "part", "pred"))


def forest_regress(spark, folder):
    frame = model_frame(events(spark, folder))
    model = L.forest_regress(frame.train, X)
    return _released(frame, model.predict(frame.rows).select("account_id", "day", "part", "pred"))


# --- boosting --------------------------------------------------------------------------------------------


def _boost(spark, folder, params: BoostParams, table=events) -> tuple[ModelFrame, DataFrame]:
    frame = model_frame(table(spark, folder))
    models, _ = fit_boosted(frame.train, X, {"m": params}, KEYS)
    return frame, models["m"].predict(frame.rows)


def _amounts(spark, folder, params, table=events):
    frame, scored = _boost(spark, folder, params, table)
    return _released(frame, scored.select("account_id", "day", "part", *r6("pred")))


def _classes(spark, folder, params, table=events):
    frame, scored = _boost(spark, folder, params, table)
    return _released(frame, scored.select("account_id", "day", "part", *r6("p0", "p1", "p2"), "pred"))


def _short(params: BoostParams, **changes) -> BoostParams:
    return BoostParams(**{**params.__dict__, **changes})


OWN_C, OWN_R = presets.OWN_CLASSIFIERS, presets.OWN_REGRESSORS


def gb_regress(spark, folder):
    return _amounts(spark, folder, _short(OWN_R["boosted"], rounds=3))


def gb_classify(spark, folder):
    return _classes(spark, folder, _short(OWN_C["boosted"], rounds=2))


def newton_regress(spark, folder):
    return _amounts(spark, folder, _short(OWN_R["newton"], rounds=3))


def newton_classify(spark, folder):
    return _classes(spark, folder, _short(OWN_C["newton"], rounds=3))


def ensemble_scores(spark, folder):
    return _amounts(spark, folder, _short(OWN_R["newton"], rounds=5, gamma=0.0), orders)


def leafwise_tree(spark, folder):
    frame = model_frame(events(spark, folder))
    params = BoostParams("amount", growth="leaf", rounds=1, num_leaves=15, min_rows=5, lam=0.1)
    models, _ = fit_boosted(frame.train, X, {"m": params}, KEYS)
    return _released(frame, _tree_rows(models["m"].table(spark)))


def leafwise_regress(spark, folder):
    return _amounts(spark, folder, _short(OWN_R["leafwise"], rounds=2))


def leafwise_classify(spark, folder):
    return _classes(spark, folder, _short(OWN_C["leafwise"], rounds=2))


def oblivious_tree(spark, folder):
    frame = model_frame(orders(spark, folder))
    params = _short(OWN_R["oblivious"], rounds=1)
    models, _ = fit_boosted(frame.train, X, {"m": params}, KEYS)
    return _released(frame, _tree_rows(models["m"].table(spark)))


def oblivious_regress(spark, folder):
    return _amounts(spark, folder, _short(OWN_R["oblivious"], rounds=3))


def oblivious_classify(spark, folder):
    return _classes(spark, folder, _short(OWN_C["oblivious"], rounds=2))


def _encoded(spark, folder, params, label):
    frame = encoded_frame(events(spark, folder), label)
    rows = cut_lineage(frame.rows).rows  # encoded once, read by every pass
    models, _ = fit_boosted(rows.filter("part = 'train'"), X, {"m": params}, KEYS)
    return frame, models["m"].predict(rows)


def oblivious_encoded_regress(spark, folder):
    """Categories encoded by the scaled amount, other features unscaled."""
    frame, scored = _encoded(spark, folder, _short(OWN_R["oblivious"], rounds=2), "y")
    return _released(frame, scored.select("account_id", "day", "part", *r6("pred")))


def oblivious_encoded_classify(spark, folder):
    frame, scored = _encoded(spark, folder, _short(OWN_C["oblivious"], rounds=2), "cls")
    return _released(frame, scored.select("account_id", "day", "part", *r6("p0", "p1", "p2"), "pred"))


def score_new_days_fitted(spark, folder):
    """New days scored by fitted models, each on its own encoding: by class, and by scaled amount."""
    table = events(spark, folder)
    plain = model_frame(table, scale_features=False)

    def fitted(label, params):
        rows = cut_lineage(encoded_frame(table, label).train).rows
        return fit_boosted(rows, X, {"m": params}, KEYS)[0]["m"].predict

    fits = {"cls": OWN_C["oblivious"], "y": OWN_R["oblivious"]}
    models = dict(zip(fits, C.side_by_side(spark, [lambda label=label, params=params: fitted(label, params) for label, params in fits.items()])))
    usual = D.default_count(plain.rows).first()[0]
    scored = Z.score_new_days(
        Z.next_day_requests(daily_events(spark, folder)), usual, plain.bounds, models["cls"], models["y"],
        encode=encode_requests(plain, "cls"), encode_amount=encode_requests(plain, "y"),
    )
    return _released(plain, scored.select("account_id", "day", "weekday_name", "month", "cls", "cls_name", *r6("p0", "p1", "p2", "amount")))


def oblivious_regress_sum(spark, folder):
    return _amounts(spark, folder, _short(OWN_R["oblivious"], rounds=2, level_gain="sum"))


def training_curve(spark, folder):
    frame = model_frame(events(spark, folder))
    runs = {"m": _short(OWN_R["newton"], rounds=3)}
    _, curve = fit_boosted(frame.train, X, runs, KEYS, curve_every=1)
    frame.release()
    table = spark.createDataFrame(curve, "model string, round int, metric string, value double")
    return table.select("round", "metric", *r6("value"))


def sweep_regularisation(spark, folder):
    frame = model_frame(events(spark, folder))
    result = C.sweep(spark, frame, presets.regularisation_runs(rounds=2))
    return _released(frame, result.select("task", "model", "metric", *r6("value")))


def sweep_leaves(spark, folder):
    frame = model_frame(events(spark, folder))
    result = C.sweep(spark, frame, presets.leaves_runs(rounds=1))
    return _released(frame, result.select("task", "model", "metric", *r6("value")))


# --- long fits on binned features ------------------------------------------------------------------------

#: A bin per distinct value as far as that goes; beyond it bins of equal numbers of rows.
BINS = 4096


def _binned(spark, folder, params, table=events):
    """Fitted on bins, written as a model table, read back and applied."""
    frame = model_frame(table(spark, folder))
    model = fit_binned(frame.train, X, {"m": params}, max_bins=BINS)[0]["m"]
    kept = cut_lineage(model.sums_table(spark)).rows
    scored = predict_from_table(frame.rows, kept, X, params.task)
    values = ["pred"] if params.task == "amount" else ["p0", "p1", "p2"]
    label = [] if params.task == "amount" else ["pred"]
    return _released(frame, scored.select("account_id", "day", "part", *r6(*values), *label))


def gb_regress_binned(spark, folder):
    return _binned(spark, folder, _short(OWN_R["boosted"], rounds=20))


def gb_classify_binned(spark, folder):
    return _binned(spark, folder, _short(OWN_C["boosted"], rounds=10))


def newton_regress_binned(spark, folder):
    return _binned(spark, folder, _short(OWN_R["newton"], rounds=20, gamma=0.0))


def newton_classify_binned(spark, folder):
    return _binned(spark, folder, _short(OWN_C["newton"], rounds=20))


def oblivious_regress_binned(spark, folder):
    return _binned(spark, folder, _short(OWN_R["oblivious"], rounds=20))


def oblivious_classify_binned(spark, folder):
    return _binned(spark, folder, _short(OWN_C["oblivious"], rounds=10))


def leafwise_regress_binned(spark, folder):
    """The library run's settings, which sample no rows."""
    return _binned(spark, folder, _short(presets.LIBRARY_REGRESSORS["leafwise"], rounds=4))


def predict_from_table_query(spark, folder):
    return _binned(spark, folder, _short(OWN_R["newton"], rounds=40, gamma=0.0), orders)


# --- one model per account -------------------------------------------------------------------------------


def _by_account(spark, folder):
    """Features and amount scaled by each account's own train bounds."""
    table = events(spark, folder).withColumn("y", F.col("amount"))
    return D.minmax_scale(table, (*X, "y"))


def tree_by_account(spark, folder):
    return A.tree_by_account(_by_account(spark, folder), X)


def tree_regress_by_account(spark, folder):
    return A.tree_by_account(_by_account(spark, folder), X, task="amount").select("account_id", "day", "part", *r6("pred"))


def newton_regress_by_account(spark, folder):
    params = _short(OWN_R["newton"], rounds=4, gamma=0.0)
    return A.boost_by_account(_by_account(spark, folder), X, params).select("account_id", "day", "part", *r6("pred"))


def newton_classify_by_account(spark, folder):
    params = _short(OWN_C["newton"], rounds=2, gamma=0.0, learning_rate=0.1)
    scored = A.boost_by_account(_by_account(spark, folder), X, params)
    return scored.select("account_id", "day", "part", *r6("p0", "p1", "p2"), "pred")


# --- neighbours, linear, dense ---------------------------------------------------------------------------


def knn_classify(spark, folder):
    scaled = D.minmax_scale(events(spark, folder), X)
    return K.knn_by_account(scaled, X, k=3).select("account_id", "day", "cls", "pred")


def _knn_vectors(spark, folder, metric):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    train, test = rows.filter("vec_id % 5 <> 0"), rows.filter("vec_id % 5 = 0")
    return K.knn_pooled(train, test, "embedding", "vec_id", k=3, metric=metric).select("vec_id", "label", "pred")


def knn_vectors(spark, folder):
    return _knn_vectors(spark, folder, "manhattan")


def knn_euclidean(spark, folder):
    return _knn_vectors(spark, folder, "euclidean")


def linear_fit_1d(spark, folder):
    train = orders(spark, folder).filter("part = 'train'").select(
        "dow", (F.col("prev1") / 1e6).alias("x"), (F.col("amount") / 1e6).alias("y")
    )
    return L.linear_fit_1d(train, "x", "y", ["dow"]).select("dow", *r6("slope", "intercept"))


def _library(spark, folder, fit, columns=("pred",)):
    frame = model_frame(events(spark, folder))
    return _released(frame, fit(frame.train, X).predict(frame.rows).select("account_id", "day", "part", *columns))


def linear_regress(spark, folder):
    return _library(spark, folder, L.linear_regress, r6("pred"))


def logistic_classify(spark, folder):
    return _library(spark, folder, L.logistic_classify)


def logistic_gradient(spark, folder):
    """The penalised gradient at the fitted weights, summed by columns: zero."""
    frame = model_frame(events(spark, folder))
    model = L.logistic_classify(frame.train, X)
    sums = L.logistic_gradient(frame.train, model)
    return _released(frame, sums.select("class", "feature", (F.round("total", 6) + 0.0).alias("total")))


def perceptron_classify(spark, folder):
    return _library(spark, folder, L.perceptron_classify)


def perceptron_regress(spark, folder):
    """The net for amounts by quasi-Newton steps with a hold-out stop, at most 25 steps."""
    frame = model_frame(events(spark, folder))
    net = N.perceptron_regress(frame.train, X, KEYS, iterations=25)
    return _released(frame, net.predict(frame.rows, X).select("account_id", "day", "part", *r6("pred")))


def _net(layers, task):
    """A small net with fixed weights."""
    import numpy as np

    weights = [
        np.array([[((3 * i + 2 * j + depth) % 7 - 3) / 4 for j in range(b)] for i in range(a)], dtype=float)
        for depth, (a, b) in enumerate(zip(layers, layers[1:]))
    ]
    biases = [np.array([(j % 3 - 1) / 8 for j in range(b)], dtype=float) for b in layers[1:]]
    return N.DenseNet(weights, biases, task)


def dense_forward(spark, folder):
    frame = model_frame(events(spark, folder))
    out = _net((6, 4, 3), "class").forward(frame.rows, X).select("account_id", "day", *r6("o0", "o1", "o2"))
    return _released(frame, out)


def dense_gradient_step(spark, folder):
    frame = model_frame(events(spark, folder))
    step = N.dense_gradient_step(frame.train, _net((6, 2, 3), "class"), X, "cls")
    return _released(frame, step.select("layer", "kind", "row", "col", *r6("total")))


def dense_net_classify(spark, folder):
    frame = model_frame(events(spark, folder))
    net = N.dense_net_classify(frame.train, X, epochs=8)
    return _released(frame, net.predict(frame.rows, X).select("account_id", "day", "part", "pred"))


def dense_net_regress(spark, folder):
    frame = model_frame(events(spark, folder))
    net = N.dense_net_regress(frame.train, X, epochs=8)
    return _released(frame, net.predict(frame.rows, X).select("account_id", "day", "part", *r6("pred")))


def linear_by_gradient(spark, folder):
    """The linear model by gradient from zero weights, two epochs."""
    import numpy as np

    frame = model_frame(events(spark, folder))
    net = N.DenseNet([np.zeros((6, 1))], [np.zeros(1)], "amount")
    net = N.linear_by_gradient(frame.train, X, epochs=2, net=net)
    return _released(frame, net.predict(frame.rows, X).select("account_id", "day", "part", *r6("pred")))


def loss_curve(spark, folder):
    """Total train loss per epoch of the linear model by gradient from zero weights."""
    import numpy as np

    frame = model_frame(events(spark, folder))
    net = N.DenseNet([np.zeros((6, 1))], [np.zeros(1)], "amount")
    net = N.linear_by_gradient(frame.train, X, epochs=4, net=net)
    return _released(frame, net.loss_table(spark).select("epoch", *r6("loss")))


# --- evaluation ------------------------------------------------------------------------------------------


def _tree_predictions(spark, folder):
    frame = model_frame(events(spark, folder))
    model = T.tree_classify(frame.train, X, max_depth=2)
    return frame, model.predict(frame.rows)


def accuracy(spark, folder):
    frame, scored = _tree_predictions(spark, folder)
    return _released(frame, V.accuracy(scored).select("part", *r6("accuracy"), "days"))


def rmse_units(spark, folder):
    frame = model_frame(events(spark, folder))
    scored = T.tree_regress(frame.train, X, max_depth=2).predict(frame.rows)
    return _released(frame, V.rmse_units(scored, *frame.bounds["amount"]).select("part", *r6("mse", "rmse")))


def baseline_metrics(spark, folder):
    return V.baseline_metrics(events(spark, folder)).select(*r6("random_accuracy", "majority_accuracy"))


def _metric_rows(spark, folder):
    """Test metrics of cheap models on both tasks."""
    frame = model_frame(events(spark, folder))
    tree = T.tree_classify(frame.train, X, max_depth=2).predict(frame.test)
    near = K.knn_by_account(D.minmax_scale(events(spark, folder), X), X)
    base = V.baseline_metrics(frame.rows)
    amounts = T.tree_regress(frame.train, X, max_depth=2).predict(frame.test)
    low, high = frame.bounds["amount"]
    hit = F.expr("avg(double(pred = cls))")
    rows = V.add_metric_rows("class", "tree", "accuracy", hit, tree)
    rows = rows.unionByName(V.add_metric_rows("class", "neighbours", "accuracy", hit, near))
    rows = rows.unionByName(V.add_metric_rows("class", "majority", "accuracy", F.max("majority_accuracy"), base))
    error = F.expr("sqrt(avg(pow(pred - y, 2)))") * (high - low)
    rows = rows.unionByName(V.add_metric_rows("amount", "tree", "rmse", error, amounts))
    mean = float(frame.train.agg(F.avg("y")).first()[0])
    constant = frame.test.withColumn("pred", F.lit(mean))
    rows = rows.unionByName(V.add_metric_rows("amount", "mean", "rmse", error, constant))
    return _released(frame, rows)


def leaderboard(spark, folder):
    board = V.leaderboard(_metric_rows(spark, folder).select("task", "model", "metric", *r6("value")))
    return board.select("task", "model", "metric", "value", "place", "winner")


def run_comparison(spark, folder):
    """Accuracy of own tree depths 1 and 2, side by side per part."""
    frame = model_frame(events(spark, folder))
    rows = None
    for depth in (1, 2):
        scored = T.tree_classify(frame.train, X, max_depth=depth).predict(frame.rows)
        metrics = V.accuracy(scored).select(
            F.col("part").alias("task"), F.lit("tree").alias("model"), F.lit("accuracy").alias("metric"),
            F.lit(f"depth{depth}").alias("run"), F.round("accuracy", 6).alias("value"),
        )
        rows = metrics if rows is None else rows.unionByName(metrics)
    return _released(frame, V.run_comparison(rows, ["depth1", "depth2"]))


def own_against_library(spark, folder):
    """Own and library runs of all eight models, few rounds and epochs."""
    frame = model_frame(events(spark, folder))
    table = C.own_against_library(spark, frame, rounds=1, epochs=2)
    return _released(frame, table)


def tree_library(spark, folder):
    return _library(spark, folder, L.library_tree)


def compare_models(spark, folder):
    frame = model_frame(events(spark, folder))
    metrics = C.compare_models(spark, frame, rounds=1, epochs=2)
    return _released(frame, V.leaderboard(metrics).select("task", "model", "metric", "value", "place", "winner"))


def prediction_sample(spark, folder):
    frame, scored = _tree_predictions(spark, folder)
    return _released(frame, V.prediction_sample(scored, DEFAULT_LABELS))


def probability_sample(spark, folder):
    """The first test days with the class probabilities of a boosted model."""
    frame, scored = _boost(spark, folder, _short(OWN_C["newton"], rounds=3))
    return _released(frame, V.prediction_sample(scored, DEFAULT_LABELS, r6("p0", "p1", "p2")))


def amount_sample(spark, folder):
    frame = model_frame(events(spark, folder))
    scored = T.tree_regress(frame.train, X, max_depth=2).predict(frame.rows)
    sample = V.amount_sample(scored, *frame.bounds["amount"])
    return _released(frame, sample.select("account_id", "day", *r6("predicted", "actual")))


def _fixed_tree(leaves: list[float]) -> Tree:
    """n at most 0.2 looks at prev1, above at dow; the four leaves from left to right."""
    tree = Tree({1: Node(feature=3, threshold=0.2, left=2, right=3), 2: Node(feature=4, threshold=0.15, left=4, right=5),
                 3: Node(feature=0, threshold=0.5, left=6, right=7)})
    tree.nodes.update({4 + i: Node(value=v) for i, v in enumerate(leaves)})
    return tree


def score_new_days(spark, folder):
    table = events(spark, folder)
    bounds = D.driver_bounds(table, (*X, "amount"))
    usual = D.default_count(table).first()[0]
    classes = T.TreeModel("fixed", X, [_fixed_tree([0, 1, 1, 2])], "class")
    amounts = T.TreeModel("fixed", X, [_fixed_tree([0.05, 0.15, 0.25, 0.4])], "amount")
    requests = Z.next_day_requests(daily_events(spark, folder))
    scored = Z.score_new_days(requests, usual, bounds, classes.predict, amounts.predict)
    return scored.select("account_id", "day", "weekday_name", "month", "cls", "cls_name", *r6("amount"))


def score_new_days_encoded(spark, folder):
    """Categories encoded by train statistics, for models that were trained on encoded, unscaled features."""
    table = events(spark, folder)
    train = table.filter("part = 'train'")
    bounds = D.driver_bounds(table, ("amount",))
    usual = D.default_count(table).first()[0]

    def encode(requests):
        encoded = E.target_encode(requests, train, ["dow", "month"], "cls")
        return encoded.withColumns({"dow": F.col("dow_enc"), "month": F.col("month_enc")}).drop("dow_enc", "month_enc")

    tree = Tree({1: Node(feature=0, threshold=0.8, left=2, right=3), 2: Node(value=0.0), 3: Node(value=2.0)})
    amount = Tree({1: Node(feature=4, threshold=60.0, left=2, right=3), 2: Node(value=0.1), 3: Node(value=0.3)})
    scored = Z.score_new_days(
        Z.next_day_requests(daily_events(spark, folder)), usual, bounds,
        T.TreeModel("fixed", X, [tree], "class").predict, T.TreeModel("fixed", X, [amount], "amount").predict,
        encode=encode,
    )
    return scored.select("account_id", "day", "weekday_name", "month", "cls", "cls_name", *r6("amount"))


# --- streams ---------------------------------------------------------------------------------------------


def stream_daily_spend(spark, folder):
    return stream.stream_daily_spend(spark, folder).select("account_id", "day", "amount", "n", "dow", "month", "weekend")


def stream_lag_features(spark, folder):
    return stream.stream_lag_features(spark, folder).select("account_id", "day", "amount", "n", "prev1", "prev2")


def stream_lags_in_order(spark, folder):
    """Days wait until seven younger ones have been seen, so that late ones get their place."""
    lagged = stream.stream_lag_features(spark, folder, late_days=7)
    return lagged.select("account_id", "day", "amount", "n", "prev1", "prev2")


QUERIES = {
    "scan_statement": scan_statement,
    "scan_statement_csv": scan_statement_csv,
    "coerce_amount": coerce_amount,
    "parse_timestamp": parse_timestamp,
    "expense_filter": expense_filter,
    "daily_spend": daily_spend,
    "calendar_features": calendar_features,
    "lag_features": lag_features,
    "lag_calendar": lag_calendar,
    "spend_class": spend_class_query,
    "label_names": label_names,
    "feature_table": feature_table,
    "feature_table_orders": feature_table_orders,
    "chrono_split": chrono_split,
    "truncate_features": truncate_features,
    "class_distribution": class_distribution,
    "minmax_bounds": minmax_bounds,
    "minmax_scale": minmax_scale,
    "minmax_scale_pooled": minmax_scale_pooled,
    "minmax_inverse": minmax_inverse,
    "default_count": default_count,
    "default_count_all": default_count_all,
    "spend_summary": spend_summary,
    "target_stats": target_stats,
    "gini_by_group": gini_by_group,
    "mse_by_group": mse_by_group,
    "majority_class": majority_class,
    "ordered_target_encode": ordered_target_encode,
    "ordered_target_encode_pooled": ordered_target_encode_pooled,
    "target_encode_test": target_encode_test,
    "target_encode_pooled": target_encode_pooled,
    "bag_sample": bag_sample,
    "goss_sample": goss_sample,
    "softmax_scores": softmax_scores,
    "argmax_class": argmax_class_query,
    "log_loss": log_loss,
    "gradients_squared": gradients_squared,
    "gradients_softmax": gradients_softmax,
    "gini_best_split": gini_best_split,
    "mse_best_split": mse_best_split,
    "mse_best_split_ranges": mse_best_split_ranges,
    "newton_best_split": newton_best_split,
    "newton_leaf_values": newton_leaf_values,
    "oblivious_best_split": oblivious_best_split,
    "oblivious_best_split_sum_ranges": oblivious_best_split_sum_ranges,
    "oblivious_best_split_sum": oblivious_best_split_sum,
    "assign_nodes": assign_nodes,
    "tree_classify": tree_classify,
    "tree_regress": tree_regress,
    "predict_tree": predict_tree,
    "forest_classify": forest_classify,
    "forest_regress": forest_regress,
    "gb_regress": gb_regress,
    "gb_classify": gb_classify,
    "newton_regress": newton_regress,
    "newton_classify": newton_classify,
    "ensemble_scores": ensemble_scores,
    "predict_from_table": predict_from_table_query,
    "gb_regress_binned": gb_regress_binned,
    "gb_classify_binned": gb_classify_binned,
    "newton_regress_binned": newton_regress_binned,
    "newton_classify_binned": newton_classify_binned,
    "oblivious_regress_binned": oblivious_regress_binned,
    "oblivious_classify_binned": oblivious_classify_binned,
    "leafwise_regress_binned": leafwise_regress_binned,
    "leafwise_tree": leafwise_tree,
    "leafwise_regress": leafwise_regress,
    "leafwise_classify": leafwise_classify,
    "oblivious_tree": oblivious_tree,
    "oblivious_regress": oblivious_regress,
    "oblivious_classify": oblivious_classify,
    "oblivious_regress_sum": oblivious_regress_sum,
    "oblivious_encoded_regress": oblivious_encoded_regress,
    "oblivious_encoded_classify": oblivious_encoded_classify,
    "score_new_days_fitted": score_new_days_fitted,
    "training_curve": training_curve,
    "sweep_regularisation": sweep_regularisation,
    "sweep_leaves": sweep_leaves,
    "tree_by_account": tree_by_account,
    "tree_regress_by_account": tree_regress_by_account,
    "newton_regress_by_account": newton_regress_by_account,
    "newton_classify_by_account": newton_classify_by_account,
    "knn_classify": knn_classify,
    "knn_vectors": knn_vectors,
    "knn_euclidean": knn_euclidean,
    "linear_fit_1d": linear_fit_1d,
    "linear_regress": linear_regress,
    "logistic_classify": logistic_classify,
    "perceptron_classify": perceptron_classify,
    "dense_forward": dense_forward,
    "dense_gradient_step": dense_gradient_step,
    "dense_net_classify": dense_net_classify,
    "dense_net_regress": dense_net_regress,
    "linear_by_gradient": linear_by_gradient,
    "loss_curve": loss_curve,
    "logistic_gradient": logistic_gradient,
    "perceptron_regress": perceptron_regress,
    "accuracy": accuracy,
    "rmse_units": rmse_units,
    "baseline_metrics": baseline_metrics,
    "leaderboard": leaderboard,
    "run_comparison": run_comparison,
    "own_against_library": own_against_library,
    "tree_library": tree_library,
    "compare_models": compare_models,
    "prediction_sample": prediction_sample,
    "probability_sample": probability_sample,
    "amount_sample": amount_sample,
    "score_new_days": score_new_days,
    "score_new_days_encoded": score_new_days_encoded,
    "stream_daily_spend": stream_daily_spend,
    "stream_lag_features": stream_lag_features,
    "stream_lags_in_order": stream_lags_in_order,
}
