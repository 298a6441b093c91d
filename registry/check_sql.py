"""Check SQL per registered query, for DuckDB over the given tables."""

from __future__ import annotations

from registry.sql_base import (
    DAILY,
    EVENT_EDGES,
    FEATURES,
    LAGGED,
    STATEMENT,
    account_frame_ctes,
    amount_scores,
    boost_ctes,
    class_scores,
    class_sql,
    cuts_sql,
    frame_ctes,
    grow_depth,
    level_gain_sql,
    query,
    scaled,
    table_ctes,
)

EVENTS = table_ctes("events")
ORDERS = table_ctes("orders")
FRAME = frame_ctes("events")
FRAME_ORDERS = frame_ctes("orders")
ID = "account_id, day"
NAMES = [f"'{f}'" for f in FEATURES]
FEATURE_NAME = "CASE f " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(NAMES)) + " END"
XS = ", ".join(f"x{i}" for i in range(6))
DEFAULT = (0, 200, 600)
LABELS = ("0-200 UAH", "200-600 UAH", "600+ UAH")
WEEKDAYS = ("Понеділок", "Вівторок", "Середа", "Четвер", "Пятниця", "Субота", "Неділя")


def named(column: str, names) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


O: dict[str, str] = {}

# --- sources ---------------------------------------------------------------------------------------------

O["scan_statement"] = query([STATEMENT["events"]], "SELECT account_id, ts, amount FROM statement")
O["scan_statement_csv"] = query(
    [STATEMENT["events"]], "SELECT account_id, date_trunc('second', ts) AS ts, amount FROM statement"
)
O["coerce_amount"] = """SELECT event_id, CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) AS amount,
  CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) END AS lenient
FROM events"""
O["parse_timestamp"] = """SELECT event_id,
  strptime(strftime(ts, '%d.%m.%Y %H:%M:%S'), '%d.%m.%Y %H:%M:%S') AS ts, date_trunc('second', ts) AS ts_short,
  CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS ts_lenient
FROM events"""

# --- features --------------------------------------------------------------------------------------------

O["expense_filter"] = query([STATEMENT["events"]], "SELECT account_id, ts, amount FROM statement WHERE amount < 0")
O["daily_spend"] = query([STATEMENT["events"], DAILY], "SELECT account_id, day, amount, n FROM daily")
O["calendar_features"] = """SELECT day, CAST(isodow(day) - 1 AS INTEGER) AS dow, CAST(month(day) AS INTEGER) AS month,
  CASE WHEN isodow(day) IN (6, 7) THEN 1 ELSE 0 END AS weekend
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)"""
O["lag_features"] = query(
    [STATEMENT["events"], DAILY, LAGGED], "SELECT account_id, day, amount, prev1, prev2 FROM lagged"
)
O["lag_calendar"] = query(
    [STATEMENT["events"], DAILY],
    """SELECT d.account_id, d.day, d.amount, coalesce(a.amount, 0) AS prev1, coalesce(b.amount, 0) AS prev2
FROM daily d
LEFT JOIN daily a ON a.account_id = d.account_id AND a.day = d.day - 1
LEFT JOIN daily b ON b.account_id = d.account_id AND b.day = d.day - 2
JOIN (SELECT account_id, min(day) AS first_day FROM daily GROUP BY account_id) f ON f.account_id = d.account_id
WHERE d.day >= f.first_day + 2""",
)
O["spend_class"] = query(
    [STATEMENT["events"], DAILY],
    f"SELECT account_id, day, amount, {class_sql(EVENT_EDGES)} AS cls, {class_sql(DEFAULT)} AS cls_default FROM daily",
)
O["label_names"] = query(
    [STATEMENT["events"], DAILY],
    f"SELECT account_id, day, {named('dow', WEEKDAYS)} AS weekday_name, "
    f"{named('(' + class_sql(DEFAULT) + ')', LABELS)} AS class_name FROM daily",
)
FT = f"SELECT account_id, day, amount, {', '.join(FEATURES)}, cls, part FROM ft"
O["feature_table"] = query(EVENTS, FT)
O["feature_table_orders"] = query(ORDERS, FT)
O["chrono_split"] = query(
    EVENTS,
    "SELECT account_id, part, count(*) AS days, min(day) AS first_day, max(day) AS last_day FROM ft GROUP BY account_id, part",
)
O["truncate_features"] = query(
    EVENTS, f"SELECT account_id, day, {', '.join(f'CAST(trunc({f}) AS INTEGER) AS {f}' for f in FEATURES)} FROM ft"
)
O["class_distribution"] = query(EVENTS, "SELECT part, cls, count(*) AS days FROM ft GROUP BY part, cls")
BOUNDED = (*FEATURES, "amount")
O["minmax_bounds"] = query(
    EVENTS,
    "SELECT account_id, " + ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in BOUNDED)
    + " FROM ft WHERE part = 'train' GROUP BY account_id",
)


def _scale_all(keys: str) -> str:
    join = "LEFT JOIN b USING (account_id)" if keys else "CROSS JOIN b"
    columns = ", ".join(f"round({scaled('ft.' + c, 'b.' + c + '_lo', 'b.' + c + '_hi')}, 6) AS {c}" for c in BOUNDED)
    return f"SELECT ft.account_id, ft.day, ft.part, {columns} FROM ft {join}"


def _bounds(keys: str) -> str:
    columns = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in BOUNDED)
    return f"b AS (SELECT {keys + ', ' if keys else ''}{columns} FROM ft WHERE part = 'train'{' GROUP BY ' + keys if keys else ''})"


O["minmax_scale"] = query([*EVENTS, _bounds("account_id")], _scale_all("account_id"))
O["minmax_scale_pooled"] = query([*ORDERS, _bounds("")], _scale_all(""))
O["minmax_inverse"] = query(
    [*EVENTS, _bounds("account_id")],
    f"SELECT ft.account_id, ft.day, round({scaled('ft.amount', 'b.amount_lo', 'b.amount_hi')} "
    f"* (b.amount_hi - b.amount_lo) + b.amount_lo, 6) AS amount FROM ft LEFT JOIN b USING (account_id)",
)
O["default_count"] = query(
    EVENTS, "SELECT account_id, CAST(round_even(avg(n), 0) AS BIGINT) AS default_n FROM ft GROUP BY account_id"
)
O["default_count_all"] = query(ORDERS, "SELECT CAST(round_even(avg(n), 0) AS BIGINT) AS default_n FROM ft")
O["spend_summary"] = query(
    EVENTS,
    "SELECT part, count(*) AS days, round(avg(amount), 6) AS mean_amount, round(stddev_samp(amount), 6) AS std_amount "
    "FROM ft GROUP BY part",
)

# --- groups and encoders ---------------------------------------------------------------------------------

O["target_stats"] = query(
    EVENTS,
    "SELECT dow, CAST(sum(cls) AS DOUBLE) AS label_sum, count(*) AS label_count FROM ft WHERE part = 'train' GROUP BY dow",
)
O["gini_by_group"] = query(
    EVENTS,
    """SELECT account_id, part, count(*) AS n, round(1 - (pow(count(*) FILTER (cls = 0), 2) + pow(count(*) FILTER (cls = 1), 2)
  + pow(count(*) FILTER (cls = 2), 2)) / pow(count(*), 2), 6) AS gini FROM ft GROUP BY account_id, part""",
)
O["mse_by_group"] = query(
    EVENTS, "SELECT dow, part, count(*) AS n, round(var_pop(amount), 6) AS mse FROM ft GROUP BY dow, part"
)
O["majority_class"] = query(
    EVENTS,
    """SELECT account_id, part, cls AS majority, votes FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id, part ORDER BY votes DESC, cls) AS rn
  FROM (SELECT account_id, part, cls, count(*) AS votes FROM ft GROUP BY account_id, part, cls)) WHERE rn = 1""",
)


def _encode(keys: str, order: str, mean: str) -> str:
    def one(c):
        over = f"OVER (PARTITION BY {keys}{c} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return f"round((coalesce(sum(cls) {over}, 0) + 0.5 * {mean}) / (count(cls) {over} + 0.5), 6) AS {c}_enc"

    return f"SELECT account_id, day, {one('dow')}, {one('month')} FROM ft WHERE part = 'train'"


O["ordered_target_encode"] = query(
    ORDERS, _encode("account_id, ", "day", "(SELECT avg(cls) FROM ft WHERE part = 'train')")
)
O["ordered_target_encode_pooled"] = query(
    EVENTS,
    _encode("", "day, substr(md5(CAST(account_id AS VARCHAR)), 1, 3), account_id",
            "(SELECT avg(cls) FROM ft WHERE part = 'train')"),
)
O["target_encode_test"] = query(
    [
        *EVENTS,
        "m AS (SELECT account_id, avg(cls) AS m FROM ft WHERE part = 'train' GROUP BY account_id)",
        *[
            f"s_{c} AS (SELECT account_id, {c}, sum(cls) AS s, count(*) AS k FROM ft WHERE part = 'train' GROUP BY account_id, {c})"
            for c in ("dow", "month")
        ],
    ],
    """SELECT t.account_id, t.day, round((coalesce(d.s, 0) + 0.5 * m.m) / (coalesce(d.k, 0) + 0.5), 6) AS dow_enc,
  round((coalesce(o.s, 0) + 0.5 * m.m) / (coalesce(o.k, 0) + 0.5), 6) AS month_enc
FROM ft t LEFT JOIN m ON m.account_id = t.account_id
LEFT JOIN s_dow d ON d.account_id = t.account_id AND d.dow = t.dow
LEFT JOIN s_month o ON o.account_id = t.account_id AND o.month = t.month WHERE t.part = 'test'""",
)


O["target_encode_pooled"] = query(
    [
        *EVENTS,
        *[
            f"s_{c} AS (SELECT {c}, sum(cls) AS s, count(*) AS k FROM ft WHERE part = 'train' GROUP BY {c})"
            for c in ("dow", "month")
        ],
        "m AS (SELECT avg(cls) AS m FROM ft WHERE part = 'train')",
    ],
    """SELECT t.account_id, t.day, round((coalesce(d.s, 0) + 0.5 * m.m) / (coalesce(d.k, 0) + 0.5), 6) AS dow_enc,
  round((coalesce(o.s, 0) + 0.5 * m.m) / (coalesce(o.k, 0) + 0.5), 6) AS month_enc
FROM ft t CROSS JOIN m LEFT JOIN s_dow d ON d.dow = t.dow LEFT JOIN s_month o ON o.month = t.month WHERE t.part = 'test'""",
)


def bagged(trees: int) -> str:
    """Membership of train days in the sample of every tree."""
    return (
        f"bag AS MATERIALIZED (SELECT tree, account_id, day FROM (SELECT t.tree, ft.account_id, ft.day, row_number() OVER "
        f"(PARTITION BY t.tree ORDER BY md5('13-' || t.tree || '-' || ft.account_id || '-' || ft.day)) AS rn, "
        f"count(*) OVER (PARTITION BY t.tree) AS total FROM ft CROSS JOIN (SELECT CAST(unnest(range({trees})) AS INTEGER) "
        f"AS tree) t WHERE ft.part = 'train') WHERE rn <= floor(total * CAST(0.8 AS DOUBLE)))"
    )


O["bag_sample"] = query([*EVENTS, bagged(6)], "SELECT tree, account_id, day FROM bag")
O["goss_sample"] = query(
    [
        *FRAME,
        """g AS MATERIALIZED (SELECT account_id, day, (SELECT avg(y) FROM frame WHERE part = 'train') - y AS g
  FROM frame WHERE part = 'train')""",
        """r AS MATERIALIZED (SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY round(abs(g), 9) DESC,
  md5('42-1-0-top-' || account_id || '-' || day)) AS place FROM g)""",
    ],
    """SELECT account_id, day, CAST(1 AS DOUBLE) AS weight FROM r WHERE place <= floor(total * CAST(0.2 AS DOUBLE))
UNION ALL
SELECT account_id, day, (1 - CAST(0.2 AS DOUBLE)) / CAST(0.1 AS DOUBLE) FROM (
  SELECT *, row_number() OVER (ORDER BY md5('42-1-0-rest-' || account_id || '-' || day)) AS o
  FROM r WHERE place > floor(total * CAST(0.2 AS DOUBLE))) WHERE o <= floor(total * CAST(0.1 AS DOUBLE))""",
)

# --- scores and losses -----------------------------------------------------------------------------------

SCORES = [
    *EVENTS,
    """sc AS (SELECT account_id, day, cls, amount, prev1 / 100 - 1 AS f0,
  prev2 / 120 - n / CAST(4 AS DOUBLE) AS f1, dow / CAST(6 AS DOUBLE) AS f2 FROM ft)""",
    """pr AS (SELECT *, exp(f0) / (exp(f0) + exp(f1) + exp(f2)) AS p0, exp(f1) / (exp(f0) + exp(f1) + exp(f2)) AS p1,
  exp(f2) / (exp(f0) + exp(f1) + exp(f2)) AS p2 FROM sc)""",
]
O["softmax_scores"] = query(SCORES, f"SELECT {ID}, {rounded('p0', 'p1', 'p2')} FROM pr")
O["argmax_class"] = query(
    SCORES, f"SELECT {ID}, CASE WHEN f0 >= f1 AND f0 >= f2 THEN 0 WHEN f1 >= f2 THEN 1 ELSE 2 END AS pred FROM sc"
)
TRUE_LOSS = "-ln(CASE cls WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END + 1e-9)"
O["log_loss"] = query(
    SCORES,
    f"SELECT cls, round(sum({TRUE_LOSS}), 6) AS total_loss, round(avg({TRUE_LOSS}), 6) AS mean_loss FROM pr GROUP BY cls",
)
O["gradients_squared"] = query(SCORES, f"SELECT {ID}, round(f0 - amount, 6) AS g, CAST(1 AS DOUBLE) AS h FROM sc")
O["gradients_softmax"] = query(
    SCORES,
    f"SELECT {ID}, "
    + ", ".join(
        f"round(p{k} - CASE WHEN cls = {k} THEN 1 ELSE 0 END, 6) AS g{k}, round(greatest(p{k} * (1 - p{k}), 1e-6), 6) AS h{k}"
        for k in range(3)
    )
    + " FROM pr",
)

# --- splits ----------------------------------------------------------------------------------------------

CLASS_STATS = "CAST(1 AS DOUBLE) AS n, " + ", ".join(
    f"CAST(CASE WHEN cls = {k} THEN 1 ELSE 0 END AS DOUBLE) AS c{k}" for k in range(3)
)
RAW_XS = ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(FEATURES))
TRAIN_ROW = "account_id, day, part, part = 'train' AS used"
MEAN_Y = "(SELECT avg(y) FROM frame WHERE part = 'train')"


def best_of(rows: str, kind: str, point: str, lam: float = 1.0, gamma: float = 0.0) -> str:
    return (
        f"SELECT *, {point} AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) AS rn "
        f"FROM ({cuts_sql(rows, kind, lam, gamma)}) WHERE gain > 0) WHERE rn = 1"
    )


SPLIT_OUT = (
    f"{FEATURE_NAME} AS feature, round(threshold, 9) AS threshold, round(gain, 9) AS gain, "
    "CAST(l_n AS BIGINT) AS n_left, CAST(t_n - l_n AS BIGINT) AS n_right"
)
O["gini_best_split"] = query(
    [*EVENTS, f"r AS MATERIALIZED (SELECT {TRAIN_ROW}, 0 AS tree, account_id AS node, {RAW_XS}, {CLASS_STATS} FROM ft)"],
    f"SELECT node AS account_id, {SPLIT_OUT} FROM ({best_of('r', 'gini', 'v')})",
)
# The grouping column is left out of the searched features by making it constant.
O["mse_best_split"] = query(
    [
        *FRAME,
        f"r AS MATERIALIZED (SELECT {TRAIN_ROW}, 0 AS tree, x0 AS node, CAST(0 AS DOUBLE) AS x0, "
        f"{', '.join(f'x{i}' for i in range(1, 6))}, CAST(1 AS DOUBLE) AS n, y AS s, y * y AS q FROM frame)",
    ],
    f"SELECT round(node, 6) AS dow, {SPLIT_OUT} FROM ({best_of('r', 'mse', 'v')})",
)
GRADED = f"{TRAIN_ROW}, 0 AS tree, account_id AS node, {XS}, CAST(1 AS DOUBLE) AS n, {MEAN_Y} - y AS g, CAST(1 AS DOUBLE) AS h"
O["newton_best_split"] = query(
    [*FRAME, f"r AS MATERIALIZED (SELECT {GRADED} FROM frame)"],
    f"SELECT node AS account_id, {SPLIT_OUT} FROM ({best_of('r', 'newton', '(v + next_v) / 2')})",
)
O["newton_leaf_values"] = query(
    [*FRAME, f"r AS MATERIALIZED (SELECT {GRADED} FROM frame)"],
    "SELECT node AS account_id, count(*) AS n, round(-sum(g) / (sum(h) + 2), 6) AS leaf_value FROM r WHERE used GROUP BY node",
)


def oblivious_level(level_gain: str) -> str:
    rows = (
        f"r AS MATERIALIZED (SELECT {TRAIN_ROW}, account_id AS tree, CASE WHEN x3 > 0.2 THEN 1 ELSE 0 END AS node, {XS}, "
        f"CAST(1 AS DOUBLE) AS n, {MEAN_Y} - y AS g, CAST(1 AS DOUBLE) AS h FROM frame)"
    )
    nexts = "t AS MATERIALIZED (SELECT tree, f, v, lead(v) OVER (PARTITION BY tree, f ORDER BY v) AS next_v FROM (" + " UNION ".join(
        f"SELECT tree, {i} AS f, x{i} AS v FROM r WHERE used" for i in range(6)
    ) + "))"
    return query(
        [*FRAME, rows, nexts],
        f"SELECT tree AS account_id, {FEATURE_NAME} AS feature, round((v + next_v) / 2, 9) AS threshold, round(gain, 9) AS gain "
        f"FROM (SELECT g.*, t.next_v, row_number() OVER (PARTITION BY g.tree ORDER BY g.gain DESC, g.f, g.v) AS rn "
        f"FROM ({level_gain_sql('r', 3.0, level_gain)}) g JOIN t ON t.tree = g.tree AND t.f = g.f AND t.v = g.v "
        f"WHERE g.gain > 0 AND t.next_v IS NOT NULL) WHERE rn = 1",
    )


O["oblivious_best_split"] = oblivious_level("owner")
O["oblivious_best_split_sum"] = oblivious_level("sum")
O["oblivious_best_split_sum_ranges"] = O["oblivious_best_split_sum"]
O["mse_best_split_ranges"] = O["mse_best_split"]
O["assign_nodes"] = query(
    EVENTS,
    """SELECT account_id, day, CAST(8 + 4 * CASE WHEN prev1 > 75.5 THEN 1 ELSE 0 END + 2 * CASE WHEN n > 2 THEN 1 ELSE 0 END
  + CASE WHEN prev2 > 100 THEN 1 ELSE 0 END AS BIGINT) AS node FROM ft""",
)

# --- trees -----------------------------------------------------------------------------------------------


def tree_rows(kind: str) -> str:
    stats = CLASS_STATS if kind == "gini" else "CAST(1 AS DOUBLE) AS n, y AS s, y * y AS q"
    return (
        f"r AS MATERIALIZED (SELECT {TRAIN_ROW}, 0 AS tree, CAST(1 AS BIGINT) AS node, {XS}, {stats} FROM frame)"
    )


def model_rows(prefix: str, bests: list[str], number: int) -> str:
    inner = " UNION ALL ".join(f"SELECT tree, node, f, cut FROM {b}" for b in bests)
    return (
        f"SELECT {number} AS round, CAST(tree AS INTEGER) AS class, node AS node_id, FALSE AS is_leaf, {FEATURE_NAME} AS feature, "
        f"round(cut, 9) AS threshold, CAST(NULL AS DOUBLE) AS value FROM ({inner}) UNION ALL "
        f"SELECT {number}, CAST(tree AS INTEGER), node, TRUE, NULL, NULL, round(CAST(value AS DOUBLE), 6) FROM {prefix}_values"
    )


for key, kind in (("tree_classify", "gini"), ("tree_regress", "mse")):
    O[key] = query(
        [*FRAME_ORDERS, tree_rows(kind), *grow_depth("t", "r", kind, 3)],
        model_rows("t", [f"t_best{level}" for level in range(3)], 0),
    )
O["predict_tree"] = query(
    [*FRAME, tree_rows("gini"), *grow_depth("t", "r", "gini", 3)],
    "SELECT o.account_id, o.day, r.part, CAST(o.value AS INTEGER) AS pred FROM t_out o "
    "JOIN r ON r.account_id = o.account_id AND r.day = o.day",
)
O["forest_classify"] = query(
    [
        *FRAME,
        bagged(6),
        f"""r AS MATERIALIZED (SELECT frame.account_id, frame.day, frame.part, bag.tree IS NOT NULL AS used, t.tree,
  CAST(1 AS BIGINT) AS node, {XS}, {CLASS_STATS}
  FROM frame CROSS JOIN (SELECT CAST(unnest(range(6)) AS INTEGER) AS tree) t
  LEFT JOIN bag ON bag.tree = t.tree AND bag.account_id = frame.account_id AND bag.day = frame.day)""",
        *grow_depth("t", "r", "gini", 5),
        "votes AS (SELECT account_id, day, CAST(value AS INTEGER) AS pred, count(*) AS v FROM t_out GROUP BY ALL)",
    ],
    """SELECT w.account_id, w.day, f.part, w.pred FROM (SELECT *, row_number() OVER
  (PARTITION BY account_id, day ORDER BY v DESC, pred) AS rn FROM votes) w
JOIN frame f ON f.account_id = w.account_id AND f.day = w.day WHERE w.rn = 1""",
)

# --- boosting --------------------------------------------------------------------------------------------


def boosted(task: str, rounds: int, base=FRAME, **options) -> str:
    final = amount_scores if task == "amount" else class_scores
    return query([*base, *boost_ctes(task, rounds=rounds, **options)], final("m", rounds))


O["gb_regress"] = boosted("amount", 3, kind="mse", growth="depth", rate=0.05, depth=3, cut="observed")
O["gb_classify"] = boosted("class", 2, kind="mse", growth="depth", rate=0.01, depth=4, cut="observed")
O["newton_regress"] = boosted("amount", 3, kind="newton", growth="depth", rate=0.05, depth=3, lam=1.0, gamma=0.1)
O["newton_classify"] = boosted("class", 3, kind="newton", growth="depth", rate=0.01, depth=3, lam=2.0, gamma=0.5)
O["ensemble_scores"] = boosted(
    "amount", 5, FRAME_ORDERS, kind="newton", growth="depth", rate=0.05, depth=3, lam=1.0, gamma=0.0
)
# The same with many rounds, fitted on binned features and applied from the written model table.
O["predict_from_table"] = boosted("amount", 40, FRAME_ORDERS, kind="newton", growth="depth", rate=0.05, depth=3, lam=1.0, gamma=0.0)
O["gb_regress_binned"] = boosted("amount", 20, kind="mse", growth="depth", rate=0.05, depth=3, cut="observed")
O["gb_classify_binned"] = boosted("class", 10, kind="mse", growth="depth", rate=0.01, depth=4, cut="observed")
O["newton_regress_binned"] = boosted("amount", 20, kind="newton", growth="depth", rate=0.05, depth=3, lam=1.0, gamma=0.0)
O["newton_classify_binned"] = boosted("class", 20, kind="newton", growth="depth", rate=0.01, depth=3, lam=2.0, gamma=0.5)
O["oblivious_regress_binned"] = boosted("amount", 20, kind="newton", growth="level", rate=0.05, depth=4, lam=3.0)
O["oblivious_classify_binned"] = boosted("class", 10, kind="newton", growth="level", rate=0.01, depth=4, lam=10.0)
O["leafwise_regress_binned"] = boosted("amount", 4, kind="newton", growth="leaf", rate=0.05, lam=0.0, leaves=15, min_rows=20)


def accuracy_of(prefix: str, rounds: int, name: str) -> str:
    return (
        f"SELECT 'class' AS task, '{name}' AS model, 'accuracy' AS metric, round(avg(CASE WHEN s.pred = f.cls THEN 1.0 ELSE 0 "
        f"END), 6) AS value FROM ({class_scores(prefix, rounds)}) s JOIN frame f ON f.account_id = s.account_id "
        f"AND f.day = s.day WHERE f.part = 'test'"
    )


# Leaf limits of the sweep; fixed values.
LEAVES = (4, 8, 15, 31, 63)
O["sweep_leaves"] = query(
    [*FRAME]
    + [
        c
        for leaves in LEAVES
        for c in boost_ctes("class", "newton", "leaf", 1, 0.05, lam=0.1, leaves=leaves, min_rows=5, goss=True, prefix=f"l{leaves}_")
    ],
    " UNION ALL ".join(accuracy_of(f"l{leaves}_", 1, f"num_leaves={leaves}") for leaves in LEAVES),
)
O["leafwise_tree"] = query(
    [*FRAME, *boost_ctes("amount", "newton", "leaf", 1, 0.1, lam=0.1, leaves=15, min_rows=5)],
    model_rows("m1", [f"m1_best{s}" for s in range(1, 15)], 1),
)
O["leafwise_regress"] = boosted(
    "amount", 2, kind="newton", growth="leaf", rate=0.05, lam=0.1, leaves=15, min_rows=5, goss=True
)
O["leafwise_classify"] = boosted(
    "class", 2, kind="newton", growth="leaf", rate=0.01, lam=1.5, leaves=15, min_rows=20, goss=True
)
O["oblivious_tree"] = query(
    [*FRAME_ORDERS, *boost_ctes("amount", "newton", "level", 1, 0.05, depth=4, lam=3.0),
     "nodes AS (SELECT 0 AS level, CAST(1 AS BIGINT) AS node UNION ALL SELECT l.level, CAST(pow(2, l.level) + i.i AS BIGINT) "
     "FROM (SELECT unnest(range(1, 5)) AS level) l, (SELECT unnest(range(16)) AS i) i WHERE i.i < pow(2, l.level))",
     "cuts AS (" + " UNION ALL ".join(f"SELECT {i} AS level, f, cut FROM m1_cut{i}" for i in range(4)) + ")"],
    f"SELECT 1 AS round, 0 AS class, n.node AS node_id, c.cut IS NULL AS is_leaf, {FEATURE_NAME} AS feature, "
    f"round(c.cut, 9) AS threshold, CASE WHEN c.cut IS NULL THEN round(coalesce(v.value, 0), 6) END AS value "
    f"FROM nodes n LEFT JOIN cuts c ON c.level = n.level LEFT JOIN m1_values v ON v.node = n.node "
    f"WHERE n.level <= (SELECT count(*) FROM cuts)",
)
O["oblivious_regress"] = boosted("amount", 3, kind="newton", growth="level", rate=0.05, depth=4, lam=3.0)
O["oblivious_classify"] = boosted("class", 2, kind="newton", growth="level", rate=0.01, depth=4, lam=10.0)
O["oblivious_regress_sum"] = boosted(
    "amount", 2, kind="newton", growth="level", rate=0.05, depth=4, lam=3.0, level_gain="sum"
)


def encoded_ctes(label: str) -> list[str]:
    """Up to ``frame``: categories encoded by ``label``, all other features unscaled."""
    *head, plain = frame_ctes("events", scale=False)
    slot = "substr(md5(CAST(account_id AS VARCHAR)), 1, 3)"
    mean = f"(SELECT avg({label}) FROM plain WHERE part = 'train')"
    columns = []
    for x in ("x0", "x1"):
        known = f"CASE WHEN part = 'train' THEN CAST({label} AS DOUBLE) END"
        before = f"OVER (PARTITION BY part, {x} ORDER BY day, {slot}, account_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        everyone = f"OVER (PARTITION BY {x})"
        columns.append(
            f"CASE WHEN part = 'train' THEN (coalesce(sum({known}) {before}, 0) + 0.5 * {mean}) / (count({known}) {before} + 0.5) "
            f"ELSE (coalesce(sum({known}) {everyone}, 0) + 0.5 * {mean}) / (count({known}) {everyone} + 0.5) END AS {x}"
        )
    return [
        *head, plain.replace("frame AS MATERIALIZED", "plain AS MATERIALIZED", 1),
        f"frame AS MATERIALIZED (SELECT account_id, day, part, cls, amount, {', '.join(columns)}, x2, x3, x4, x5, y FROM plain)",
    ]


O["oblivious_encoded_regress"] = boosted("amount", 2, encoded_ctes("y"), kind="newton", growth="level", rate=0.05, depth=4, lam=3.0)
O["oblivious_encoded_classify"] = boosted("class", 2, encoded_ctes("cls"), kind="newton", growth="level", rate=0.01, depth=4, lam=10.0)
O["training_curve"] = query(
    [*FRAME, *boost_ctes("amount", "newton", "depth", 3, 0.05, depth=3, lam=1.0, gamma=0.1)],
    " UNION ALL ".join(
        f"SELECT {r} AS round, 'mse' AS metric, round(avg(pow(f.y - s.f, 2)), 6) AS value FROM frame f JOIN m_f{r} s "
        f"ON s.account_id = f.account_id AND s.day = f.day WHERE f.part = 'train'"
        for r in (1, 2, 3)
    ),
)


SWEEP = ((0.0, 0.0), (0.1, 0.0), (1.0, 0.0), (1.0, 0.1), (2.0, 0.5))
O["sweep_regularisation"] = query(
    [*FRAME]
    + [
        c
        for i, (lam, gamma) in enumerate(SWEEP)
        for c in boost_ctes("class", "newton", "depth", 2, 0.1, depth=3, lam=lam, gamma=gamma, prefix=f"s{i}_")
    ],
    " UNION ALL ".join(
        accuracy_of(f"s{i}_", 2, f"lambda={lam} gamma={gamma}") for i, (lam, gamma) in enumerate(SWEEP)
    ),
)

# One model per account.
FRAME_ACCOUNT = account_frame_ctes("events")
for key, kind, cast in (("tree_by_account", "gini", "CAST(o.value AS INTEGER)"), ("tree_regress_by_account", "mse", "round(o.value, 6)")):
    O[key] = query(
        [*FRAME_ACCOUNT, tree_rows(kind).replace("0 AS tree", "account_id AS tree"), *grow_depth("t", "r", kind, 3)],
        f"SELECT o.account_id, o.day, r.part, CASE WHEN bool_or(r.used) OVER (PARTITION BY o.account_id) THEN {cast} END AS pred "
        "FROM t_out o JOIN r ON r.account_id = o.account_id AND r.day = o.day",
    )
O["newton_regress_by_account"] = boosted(
    "amount", 4, FRAME_ACCOUNT, kind="newton", growth="depth", rate=0.05, depth=3, lam=1.0, gamma=0.0, per_account=True
)
O["newton_classify_by_account"] = boosted(
    "class", 2, FRAME_ACCOUNT, kind="newton", growth="depth", rate=0.1, depth=3, lam=2.0, gamma=0.0, per_account=True
)

# --- neighbours, linear, dense ---------------------------------------------------------------------------

KNN_SCALED = f"sc AS MATERIALIZED (SELECT ft.account_id, ft.day, ft.part, ft.cls, " + ", ".join(
    f"{scaled('ft.' + c, 'b.' + c + '_lo', 'b.' + c + '_hi')} AS x{i}" for i, c in enumerate(FEATURES)
) + " FROM ft LEFT JOIN b USING (account_id))"
KNN_NEAR = f"""near AS (SELECT * FROM (SELECT q.account_id, q.day, q.cls, t.cls AS label, row_number() OVER (
    PARTITION BY q.account_id, q.day ORDER BY round({' + '.join(f'abs(q.x{i} - t.x{i})' for i in range(6))}, 9), t.cls, t.day) AS rn
  FROM sc q JOIN sc t ON t.account_id = q.account_id WHERE q.part = 'test' AND t.part = 'train') WHERE rn <= 3)"""
O["knn_classify"] = query(
    [*EVENTS, _bounds("account_id"), KNN_SCALED, KNN_NEAR],
    """SELECT s.account_id, s.day, s.cls, v.label AS pred FROM sc s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY account_id, day
  ORDER BY votes DESC, label) AS o FROM (SELECT account_id, day, cls, label, count(*) AS votes FROM near GROUP BY ALL)) v
  ON v.account_id = s.account_id AND v.day = s.day AND v.o = 1 WHERE s.part = 'test'""",
)


def knn_sql(distance: str) -> str:
    return query(
        [
            "v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
            f"""near AS (SELECT * FROM (SELECT q.vec_id, q.label AS own, t.label, row_number() OVER (PARTITION BY q.vec_id
  ORDER BY round({distance}, 9), t.label, t.vec_id) AS rn FROM v q JOIN v t ON q.vec_id % 5 = 0 AND t.vec_id % 5 <> 0) WHERE rn <= 3)""",
        ],
        """SELECT vec_id, own AS label, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id
  ORDER BY votes DESC, label) AS o FROM (SELECT vec_id, own, label, count(*) AS votes FROM near GROUP BY ALL)) WHERE o = 1""",
    )


O["knn_vectors"] = knn_sql("list_sum([abs(q.e[i] - t.e[i]) for i in range(1, len(q.e) + 1)])")
O["knn_euclidean"] = knn_sql("list_distance(q.e, t.e)")
O["linear_fit_1d"] = query(
    ORDERS,
    """SELECT dow, round(regr_slope(amount / 1e6, prev1 / 1e6), 6) AS slope,
  round(regr_intercept(amount / 1e6, prev1 / 1e6), 6) AS intercept FROM ft WHERE part = 'train' GROUP BY dow""",
)


def net_sql(layers) -> tuple[list[list[list[float]]], list[list[float]]]:
    weights = [
        [[((3 * i + 2 * j + d) % 7 - 3) / 4 for j in range(b)] for i in range(a)] for d, (a, b) in enumerate(zip(layers, layers[1:]))
    ]
    return weights, [[(j % 3 - 1) / 8 for j in range(b)] for b in layers[1:]]


def layer_sums(inputs: list[str], weights, biases) -> list[str]:
    return [
        " + ".join([*(f"{x} * ({weights[i][j]})" for i, x in enumerate(inputs)), f"({biases[j]})"])
        for j in range(len(biases))
    ]


def net_ctes(hidden: int) -> list[str]:
    weights, biases = net_sql((6, hidden, 3))
    sums = layer_sums([f"x{i}" for i in range(6)], weights[0], biases[0])
    outs = layer_sums([f"greatest(z{j}, 0)" for j in range(hidden)], weights[1], biases[1])
    return [
        "l1 AS (SELECT *, " + ", ".join(f"CAST({s} AS DOUBLE) AS z{j}" for j, s in enumerate(sums)) + " FROM frame)",
        "l2 AS (SELECT *, " + ", ".join(f"CAST({s} AS DOUBLE) AS u{j}" for j, s in enumerate(outs)) + " FROM l1)",
        "net AS (SELECT *, " + ", ".join(f"exp(u{k}) / (exp(u0) + exp(u1) + exp(u2)) AS o{k}" for k in range(3)) + " FROM l2)",
    ]


O["dense_forward"] = query([*FRAME, *net_ctes(4)], f"SELECT {ID}, {rounded('o0', 'o1', 'o2')} FROM net")


def gradient_sql() -> str:
    weights, _ = net_sql((6, 2, 3))
    d3 = [f"d{k}" for k in range(3)]
    d2 = [
        f"(CASE WHEN z{j} > 0 THEN " + " + ".join(f"{d3[k]} * ({weights[1][j][k]})" for k in range(3)) + " ELSE 0 END)"
        for j in range(2)
    ]
    parts = []

    def add(layer, kind, row, col, expr):
        parts.append(
            f"SELECT {layer} AS layer, '{kind}' AS kind, {row} AS row, {col} AS col, round(sum({expr}), 6) AS total FROM err"
        )

    for j in range(2):
        for i in range(6):
            add(0, "weight", i, j, f"x{i} * {d2[j]}")
        add(0, "bias", 0, j, d2[j])
    for k in range(3):
        for j in range(2):
            add(1, "weight", j, k, f"greatest(z{j}, 0) * {d3[k]}")
        add(1, "bias", 0, k, d3[k])
    err = "err AS MATERIALIZED (SELECT *, " + ", ".join(
        f"o{k} - CASE WHEN cls = {k} THEN 1 ELSE 0 END AS d{k}" for k in range(3)
    ) + " FROM net WHERE part = 'train')"
    return query([*FRAME, *net_ctes(2), err], " UNION ALL ".join(parts))


O["dense_gradient_step"] = gradient_sql()
_LINEAR_STEP = ", ".join(
    [f"w{i} - 0.005 * 2 * avg(e * x{i}) AS w{i}" for i in range(6)] + ["b - 0.005 * 2 * avg(e) AS b"]
)
_LINEAR_OUT = " + ".join([*(f"x{i} * w{i}" for i in range(6)), "b"])
_WEIGHTS = ", ".join([*(f"w{i}" for i in range(6)), "b"])
O["linear_by_gradient"] = query(
    [
        *FRAME,
        "w_0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS w{i}" for i in range(6)) + ", CAST(0 AS DOUBLE) AS b)",
        *[
            f"w_{s} AS MATERIALIZED (SELECT {_LINEAR_STEP} FROM (SELECT *, {_LINEAR_OUT} - y AS e FROM frame CROSS JOIN w_{s - 1} "
            f"WHERE part = 'train') GROUP BY {_WEIGHTS})"
            for s in (1, 2)
        ],
    ],
    f"SELECT account_id, day, part, round({_LINEAR_OUT}, 6) AS pred FROM frame CROSS JOIN w_2",
)

O["loss_curve"] = query(
    [
        *FRAME,
        "w_0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS w{i}" for i in range(6)) + ", CAST(0 AS DOUBLE) AS b)",
        *[
            f"w_{s} AS MATERIALIZED (SELECT {_LINEAR_STEP} FROM (SELECT *, {_LINEAR_OUT} - y AS e FROM frame CROSS JOIN w_{s - 1} "
            f"WHERE part = 'train') GROUP BY {_WEIGHTS})"
            for s in (1, 2, 3)
        ],
    ],
    " UNION ALL ".join(
        f"SELECT {s + 1} AS epoch, round(sum(pow({_LINEAR_OUT} - y, 2)), 6) AS loss FROM frame CROSS JOIN w_{s} WHERE part = 'train'" for s in range(4)
    ),
)
O["logistic_gradient"] = query(
    ["c AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS class)", f"f AS (SELECT unnest([{', '.join(repr(f) for f in (*FEATURES, 'bias'))}]) AS feature)"],
    "SELECT class, feature, CAST(0 AS DOUBLE) AS total FROM c CROSS JOIN f",
)


def least_squares_ctes() -> list[str]:
    """``beta``: weights b0..b5 by elimination in the normal equations of centred columns; columns without a pivot get 0."""
    columns = [*(f"x{i}" for i in range(6)), "y"]
    means = ", ".join(f"avg({c}) AS m_{c}" for c in columns)
    sums = ", ".join(
        f"sum(({a} - m_{a}) * ({b} - m_{b})) AS a0_{i}_{j}" for i, a in enumerate(columns[:6]) for j, b in enumerate(columns)
    )
    ctes = [
        *FRAME, f"mu AS MATERIALIZED (SELECT {means} FROM frame WHERE part = 'train')",
        f"s0 AS MATERIALIZED (SELECT {sums}, {', '.join(f'any_value(m_{c}) AS m_{c}' for c in columns)} FROM frame CROSS JOIN mu WHERE part = 'train')",
    ]
    for k in range(6):
        has = f"a{k}_{k}_{k} > 1e-10 * a0_{k}_{k}"
        cells = ", ".join(
            f"CASE WHEN {has} THEN a{k}_{i}_{j} - a{k}_{i}_{k} * a{k}_{k}_{j} / a{k}_{k}_{k} ELSE a{k}_{i}_{j} END AS a{k + 1}_{i}_{j}"
            for i in range(k + 1, 6) for j in range(7) if j > k
        )
        ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT *{', ' + cells if cells else ''} FROM s{k})")
    last = "s6"
    for k in reversed(range(6)):
        rest = "".join(f" - a{k}_{k}_{j} * b{j}" for j in range(k + 1, 6))
        ctes.append(
            f"t{k} AS MATERIALIZED (SELECT *, CASE WHEN a{k}_{k}_{k} > 1e-10 * a0_{k}_{k} THEN (a{k}_{k}_6{rest}) / a{k}_{k}_{k} ELSE 0 END AS b{k} FROM {last})"
        )
        last = f"t{k}"
    return ctes


O["linear_regress"] = query(
    least_squares_ctes(),
    "SELECT account_id, day, part, round(m_y + " + " + ".join(f"b{i} * (x{i} - m_x{i})" for i in range(6)) + ", 6) AS pred FROM frame CROSS JOIN t0",
)

# --- evaluation ------------------------------------------------------------------------------------------

TREE2 = [*FRAME, tree_rows("gini"), *grow_depth("t", "r", "gini", 2)]
AMOUNT_ROWS = tree_rows("mse").replace("r AS", "ra AS", 1)
TREE2_AMOUNT = [AMOUNT_ROWS, *grow_depth("a", "ra", "mse", 2)]
JOINED = "frame f JOIN t_out o ON o.account_id = f.account_id AND o.day = f.day"
JOINED_AMOUNT = "frame f JOIN a_out o ON o.account_id = f.account_id AND o.day = f.day"
HIT = "avg(CASE WHEN o.value = f.cls THEN CAST(1 AS DOUBLE) ELSE 0 END)"
SPAN = "(SELECT amount_hi - amount_lo FROM bounds)"
O["accuracy"] = query(TREE2, f"SELECT f.part, round({HIT}, 6) AS accuracy, count(*) AS days FROM {JOINED} GROUP BY f.part")
O["rmse_units"] = query(
    [*FRAME, *TREE2_AMOUNT],
    f"SELECT f.part, round(avg(pow(o.value - f.y, 2)), 6) AS mse, "
    f"round(sqrt(avg(pow(o.value - f.y, 2))) * {SPAN}, 6) AS rmse FROM {JOINED_AMOUNT} GROUP BY f.part",
)
BASELINE = """(SELECT avg(CASE WHEN cls = (SELECT cls FROM ft WHERE part = 'train' GROUP BY cls
  ORDER BY count(*) DESC, cls LIMIT 1) THEN CAST(1 AS DOUBLE) ELSE 0 END) FROM ft WHERE part = 'test')"""
O["baseline_metrics"] = query(
    EVENTS, f"SELECT round(CAST(1 AS DOUBLE) / 3, 6) AS random_accuracy, round({BASELINE}, 6) AS majority_accuracy"
)
O["leaderboard"] = query(
    [
        *TREE2,
        *TREE2_AMOUNT,
        _bounds("account_id"),
        KNN_SCALED,
        KNN_NEAR,
        """knn AS (SELECT cls, label FROM (SELECT *, row_number() OVER (PARTITION BY account_id, day ORDER BY votes DESC, label)
  AS o FROM (SELECT account_id, day, cls, label, count(*) AS votes FROM near GROUP BY ALL)) WHERE o = 1)""",
        f"""metrics AS (
  SELECT 'class' AS task, 'tree' AS model, 'accuracy' AS metric, {HIT} AS value FROM {JOINED} WHERE f.part = 'test'
  UNION ALL SELECT 'class', 'neighbours', 'accuracy', avg(CASE WHEN cls = label THEN CAST(1 AS DOUBLE) ELSE 0 END) FROM knn
  UNION ALL SELECT 'class', 'majority', 'accuracy', {BASELINE}
  UNION ALL SELECT 'amount', 'tree', 'rmse', sqrt(avg(pow(o.value - f.y, 2))) * {SPAN} FROM {JOINED_AMOUNT} WHERE f.part = 'test'
  UNION ALL SELECT 'amount', 'mean', 'rmse', sqrt(avg(pow({MEAN_Y} - y, 2))) * {SPAN} FROM frame WHERE part = 'test')""",
        "m6 AS (SELECT task, model, metric, round(value, 6) AS value FROM metrics)",
    ],
    """SELECT *, CAST(rank() OVER (PARTITION BY task ORDER BY CASE WHEN metric = 'accuracy' THEN -value ELSE value END) AS INTEGER)
  AS place, rank() OVER (PARTITION BY task ORDER BY CASE WHEN metric = 'accuracy' THEN -value ELSE value END) = 1 AS winner FROM m6""",
)
O["run_comparison"] = query(
    [
        *FRAME,
        tree_rows("gini"),
        *[c for d in (1, 2) for c in grow_depth(f"d{d}", "r", "gini", d)],
    ],
    """SELECT f.part AS task, 'tree' AS model, 'accuracy' AS metric,
  round(avg(CASE WHEN a.value = f.cls THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS depth1,
  round(avg(CASE WHEN b.value = f.cls THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS depth2
FROM frame f JOIN d1_out a ON a.account_id = f.account_id AND a.day = f.day
JOIN d2_out b ON b.account_id = f.account_id AND b.day = f.day GROUP BY f.part""",
)
O["prediction_sample"] = query(
    TREE2,
    f"SELECT f.account_id, f.day, o.value = f.cls AS hit, {named('f.cls', LABELS)} AS actual, "
    f"{named('o.value', LABELS)} AS predicted FROM {JOINED} WHERE f.part = 'test' ORDER BY f.day, f.account_id LIMIT 5",
)
O["probability_sample"] = query(
    [*FRAME, *boost_ctes("class", rounds=3, kind="newton", growth="depth", rate=0.01, depth=3, lam=2.0, gamma=0.5)],
    f"SELECT f.account_id, f.day, s.pred = f.cls AS hit, {named('f.cls', LABELS)} AS actual, {named('s.pred', LABELS)} AS predicted, s.p0, s.p1, s.p2 "
    f"FROM ({class_scores('m', 3)}) s JOIN frame f ON f.account_id = s.account_id AND f.day = s.day "
    "WHERE f.part = 'test' ORDER BY f.day, f.account_id LIMIT 5",
)
O["amount_sample"] = query(
    [*FRAME, *TREE2_AMOUNT],
    f"SELECT f.account_id, f.day, round(o.value * {SPAN} + (SELECT amount_lo FROM bounds), 6) AS predicted, "
    f"round(f.amount, 6) AS actual FROM {JOINED_AMOUNT} WHERE f.part = 'test' ORDER BY f.day, f.account_id LIMIT 5",
)
REQUESTS = """req AS (SELECT account_id, day + 1 AS day, CAST(isodow(day + 1) - 1 AS INTEGER) AS dow,
  CAST(month(day + 1) AS INTEGER) AS month, amount AS prev1, before AS prev2 FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY day DESC) AS rn,
           lag(amount) OVER (PARTITION BY account_id ORDER BY day) AS before FROM daily)
  WHERE rn = 1 AND before IS NOT NULL)"""
USUAL = "(SELECT round_even(avg(n), 0) FROM ft)"


def fixed_tree(values) -> str:
    a, b, c, d = values
    return f"CASE WHEN x3 <= 0.2 THEN CASE WHEN x4 <= 0.15 THEN {a} ELSE {b} END ELSE CASE WHEN x0 <= 0.5 THEN {c} ELSE {d} END END"


O["score_new_days"] = query(
    [
        *FRAME,
        REQUESTS,
        f"""xr AS (SELECT req.*, {scaled('dow', 'dow_lo', 'dow_hi')} AS x0, {scaled(USUAL, 'n_lo', 'n_hi')} AS x3,
  {scaled('prev1', 'prev1_lo', 'prev1_hi')} AS x4, amount_lo, amount_hi FROM req CROSS JOIN bounds)""",
        f"sx AS (SELECT *, {fixed_tree((0, 1, 1, 2))} AS cls, {fixed_tree((0.05, 0.15, 0.25, 0.4))} AS a FROM xr)",
    ],
    f"SELECT account_id, day, {named('dow', WEEKDAYS)} AS weekday_name, month, cls, {named('cls', LABELS)} AS cls_name, "
    f"round(a * (amount_hi - amount_lo) + amount_lo, 6) AS amount FROM sx",
)
O["score_new_days_encoded"] = query(
    [
        *FRAME,
        REQUESTS,
        "st AS (SELECT dow, sum(cls) AS s, count(*) AS k FROM ft WHERE part = 'train' GROUP BY dow)",
        """sx AS (SELECT req.*, CASE WHEN (coalesce(s, 0) + 0.5 * (SELECT avg(cls) FROM ft WHERE part = 'train'))
  / (coalesce(k, 0) + 0.5) <= 0.8 THEN 0 ELSE 2 END AS cls, CASE WHEN prev1 <= 60 THEN 0.1 ELSE 0.3 END AS a
  FROM req LEFT JOIN st USING (dow))""",
    ],
    f"SELECT account_id, day, {named('dow', WEEKDAYS)} AS weekday_name, month, cls, {named('cls', LABELS)} AS cls_name, "
    f"round(a * {SPAN} + (SELECT amount_lo FROM bounds), 6) AS amount FROM sx",
)

# --- streams ---------------------------------------------------------------------------------------------
# Closed days: those whose end is not later than the largest spending time less the allowed delay.

CLOSED = """closed AS (SELECT * FROM daily WHERE CAST(day + 1 AS TIMESTAMP)
  <= (SELECT max(ts) FROM statement WHERE amount < 0) - INTERVAL 1 DAY)"""
O["stream_daily_spend"] = query(
    [STATEMENT["events"], DAILY, CLOSED], "SELECT account_id, day, amount, n, dow, month, weekend FROM closed"
)
O["stream_lag_features"] = query(
    [STATEMENT["events"], DAILY, CLOSED],
    """SELECT * FROM (SELECT account_id, day, amount, n, lag(amount, 1) OVER (PARTITION BY account_id ORDER BY day) AS prev1,
  lag(amount, 2) OVER (PARTITION BY account_id ORDER BY day) AS prev2 FROM closed) WHERE prev1 IS NOT NULL AND prev2 IS NOT NULL""",
)
O["stream_lags_in_order"] = query(
    [STATEMENT["events"], DAILY, CLOSED],
    """SELECT * FROM (SELECT account_id, day, amount, n, lag(amount, 1) OVER (PARTITION BY account_id ORDER BY day) AS prev1,
  lag(amount, 2) OVER (PARTITION BY account_id ORDER BY day) AS prev2 FROM closed)
WHERE prev1 IS NOT NULL AND prev2 IS NOT NULL AND day < (SELECT max(day) - 7 FROM closed)""",
)

ORACLES = O
