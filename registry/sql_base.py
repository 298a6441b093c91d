"""Shared parts of the check SQL: common table expressions over the given tables, for DuckDB.

Written from the formulas, independently of the Spark plans.
"""

from __future__ import annotations

FEATURES = ("dow", "month", "weekend", "n", "prev1", "prev2")
EVENT_EDGES = (0, 50, 120)
ORDER_EDGES = (0, 760000, 1230000)

STATEMENT = {
    "events": """statement AS (
  SELECT user_id AS account_id, ts,
         CAST(CASE WHEN event_type = 'signup' THEN value ELSE -value END AS DECIMAL(18,2)) AS amount
  FROM events)""",
    "orders": """statement AS (
  SELECT CAST(0 AS BIGINT) AS account_id, o_orderdate AS ts,
         CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(18,2)) AS amount
  FROM orders)""",
}

DAILY = """daily AS (
  SELECT account_id, CAST(ts AS DATE) AS day, CAST(abs(sum(amount)) AS DOUBLE) AS amount, count(*) AS n,
         CAST(isodow(CAST(ts AS DATE)) - 1 AS INTEGER) AS dow, CAST(month(CAST(ts AS DATE)) AS INTEGER) AS month,
         CASE WHEN isodow(CAST(ts AS DATE)) >= 6 THEN 1 ELSE 0 END AS weekend
  FROM statement WHERE amount < 0
  GROUP BY account_id, CAST(ts AS DATE))"""

LAGGED = """lagged AS (
  SELECT * FROM (
    SELECT *, lag(amount, 1) OVER (PARTITION BY account_id ORDER BY day) AS prev1,
              lag(amount, 2) OVER (PARTITION BY account_id ORDER BY day) AS prev2
    FROM daily) WHERE prev1 IS NOT NULL AND prev2 IS NOT NULL)"""


def class_sql(edges, column: str = "amount") -> str:
    a, b, c = edges
    return (
        f"CASE WHEN {column} > {a} AND {column} <= {b} THEN 0 WHEN {column} > {b} AND {column} <= {c} THEN 1 "
        f"WHEN {column} > {c} THEN 2 END"
    )


def table_ctes(source: str) -> list[str]:
    """Up to ``ft``: the feature table of a source."""
    edges = EVENT_EDGES if source == "events" else ORDER_EDGES
    split = f"""ft AS MATERIALIZED (
  SELECT account_id, day, amount, dow, month, weekend, n, prev1, prev2, {class_sql(edges)} AS cls,
         CASE WHEN row_number() OVER (PARTITION BY account_id ORDER BY day)
                   <= floor(CAST(0.8 AS DOUBLE) * count(*) OVER (PARTITION BY account_id))
              THEN 'train' ELSE 'test' END AS part
  FROM lagged)"""
    return [STATEMENT[source], DAILY, LAGGED, split]


def scaled(column: str, low: str, high: str) -> str:
    return f"coalesce((CAST({column} AS DOUBLE) - {low}) / nullif({high} - {low}, 0), 0)"


def frame_ctes(source: str, scale: bool = True) -> list[str]:
    """Up to ``frame``: pooled scaling by train bounds; ``x0..x5`` are the features, ``y`` the amount."""
    bounds = ", ".join(
        f"CAST(min({c}) AS DOUBLE) AS {c}_lo, CAST(max({c}) AS DOUBLE) AS {c}_hi" for c in (*FEATURES, "amount")
    )
    xs = ", ".join(
        f"{scaled('ft.' + c, 'b.' + c + '_lo', 'b.' + c + '_hi') if scale else f'CAST(ft.{c} AS DOUBLE)'} AS x{i}"
        for i, c in enumerate(FEATURES)
    )
    return [
        *table_ctes(source),
        f"bounds AS MATERIALIZED (SELECT {bounds} FROM ft WHERE part = 'train')",
        f"""frame AS MATERIALIZED (
  SELECT ft.account_id, ft.day, ft.part, ft.cls, ft.amount, {xs},
         {scaled('ft.amount', 'b.amount_lo', 'b.amount_hi')} AS y
  FROM ft CROSS JOIN bounds b)""",
    ]


def account_frame_ctes(source: str) -> list[str]:
    """Like ``frame_ctes`` with the bounds of every account's own train rows."""
    pooled = frame_ctes(source)
    bounds = ", ".join(
        f"CAST(min({c}) AS DOUBLE) AS {c}_lo, CAST(max({c}) AS DOUBLE) AS {c}_hi" for c in (*FEATURES, "amount")
    )
    keyed = f"bounds AS MATERIALIZED (SELECT account_id, {bounds} FROM ft WHERE part = 'train' GROUP BY account_id)"
    return [*pooled[:-2], keyed, pooled[-1].replace("CROSS JOIN bounds b", "LEFT JOIN bounds b ON b.account_id = ft.account_id")]


def query(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


# --- trees -----------------------------------------------------------------------------------------------


def _cells(rows: str, stats: tuple[str, ...]) -> str:
    sums = ", ".join(f"sum({s}) AS {s}" for s in stats)
    return " UNION ALL ".join(
        f"SELECT tree, node, {i} AS f, x{i} AS v, {sums} FROM {rows} WHERE used GROUP BY tree, node, x{i}"
        for i in range(len(FEATURES))
    )


def _gini(counts: list[str], n: str) -> str:
    return "(1 - (" + " + ".join(f"{c} * {c}" for c in counts) + f") / ({n} * {n}))"


STATS = {"gini": ("n", "c0", "c1", "c2"), "mse": ("n", "s", "q"), "newton": ("n", "g", "h")}


def gain_sql(kind: str, lam: float = 1.0, gamma: float = 0.0) -> str:
    """Gain from left sums ``l_*`` and totals ``t_*``."""
    right = {s: f"(t_{s} - l_{s})" for s in STATS[kind]}
    if kind == "gini":
        names = ("c0", "c1", "c2")
        return (
            f"{_gini([f't_{c}' for c in names], 't_n')}"
            f" - (l_n / t_n) * {_gini([f'l_{c}' for c in names], 'l_n')}"
            f" - ({right['n']} / t_n) * {_gini([right[c] for c in names], right['n'])}"
        )
    if kind == "mse":
        # The drop of the variance, written with the difference of the sides' means so that an offset cancels out first.
        return f"(l_n * {right['n']} / (t_n * t_n)) * pow(l_s / l_n - {right['s']} / {right['n']}, 2)"
    return (
        f"0.5 * (l_g * l_g / (l_h + {lam}) + {right['g']} * {right['g']} / ({right['h']} + {lam})"
        f" - t_g * t_g / (t_h + {lam})) - {gamma}"
    )


def size_sql(kind: str, lam: float = 1.0) -> str:
    """What the parts of a gain add up to before they cancel out."""
    right = {s: f"(t_{s} - l_{s})" for s in STATS[kind]}
    if kind == "gini":
        return "1"
    if kind == "mse":
        return f"1e-10 * (l_n * {right['n']} / (t_n * t_n)) * pow(abs(l_s / l_n) + abs({right['s']} / {right['n']}), 2)"
    return f"0.5 * (l_g * l_g / (l_h + {lam}) + {right['g']} * {right['g']} / ({right['h']} + {lam}))"


def settled_sql(gain: str, size: str) -> str:
    """Gains count above 1e-12 of their size and are compared as 24-bit numbers."""
    return f"CASE WHEN {gain} > 1e-12 * ({size}) THEN CAST(CAST({gain} AS FLOAT) AS DOUBLE) ELSE 0 END"


def cuts_sql(rows: str, kind: str, lam: float = 1.0, gamma: float = 0.0, min_rows: int = 1) -> str:
    """All allowed cuts of all nodes with their gain."""
    stats = STATS[kind]
    left = ", ".join(
        f"sum({s}) OVER (PARTITION BY tree, node, f ORDER BY v ROWS UNBOUNDED PRECEDING) AS l_{s}" for s in stats
    )
    total = ", ".join(f"sum({s}) OVER (PARTITION BY tree, node, f) AS t_{s}" for s in stats)
    return (
        f"SELECT *, {settled_sql(gain_sql(kind, lam, gamma), size_sql(kind, lam))} AS gain FROM ("
        f"SELECT tree, node, f, v, lead(v) OVER (PARTITION BY tree, node, f ORDER BY v) AS next_v, {left}, {total} "
        f"FROM ({_cells(rows, stats)})) WHERE next_v IS NOT NULL AND l_n >= {min_rows} AND t_n - l_n >= {min_rows}"
    )


def leaf_sql(kind: str, lam: float = 1.0) -> str:
    if kind == "gini":
        return "CASE WHEN sum(c0) >= greatest(sum(c1), sum(c2)) THEN 0 WHEN sum(c1) >= sum(c2) THEN 1 ELSE 2 END"
    if kind == "mse":
        return "sum(s) / sum(n)"
    return f"-sum(g) / (sum(h) + {lam})"


_PICK = "CASE b.f " + " ".join(f"WHEN {i} THEN r.x{i}" for i in range(len(FEATURES))) + " END"
_ROW = "r.account_id, r.day, r.part, r.used, r.tree"
_XS = ", ".join(f"r.x{i}" for i in range(len(FEATURES)))


def _moved(rows: str, best: str, stats, left: str, right: str) -> str:
    return (
        f"SELECT {_ROW}, CASE WHEN b.f IS NULL THEN r.node WHEN {_PICK} <= b.cut THEN {left} ELSE {right} END AS node, "
        f"{_XS}, {', '.join('r.' + s for s in stats)} "
        f"FROM {rows} r LEFT JOIN {best} b ON r.tree = b.tree AND r.node = b.node"
    )


def _leaves(prefix: str, rows: str, kind: str, lam: float) -> list[str]:
    return [
        f"{prefix}_values AS MATERIALIZED (SELECT tree, node, {leaf_sql(kind, lam)} AS value "
        f"FROM {rows} WHERE used GROUP BY tree, node)",
        f"{prefix}_out AS MATERIALIZED (SELECT r.account_id, r.day, r.tree, r.node, coalesce(v.value, 0) AS value "
        f"FROM {rows} r LEFT JOIN {prefix}_values v ON r.tree = v.tree AND r.node = v.node)",
    ]


def grow_depth(prefix, rows, kind, depth, cut="observed", lam=1.0, gamma=0.0) -> list[str]:
    """CTEs ``<prefix>_best<level>`` (splits), ``<prefix>_values`` (leaves) and ``<prefix>_out`` (row values).

    ``rows`` has account_id, day, part, used, tree, node (1), x0.., and the statistics.
    """
    ctes, current = [], rows
    point = "v" if cut == "observed" else "(v + next_v) / 2"
    for level in range(depth):
        best = f"{prefix}_best{level}"
        ctes.append(
            f"{best} AS MATERIALIZED (SELECT tree, node, f, {point} AS cut, gain FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY tree, node ORDER BY gain DESC, f, v) AS rn FROM ({cuts_sql(current, kind, lam, gamma)}) "
            f"WHERE gain > 0) WHERE rn = 1)"
        )
        moved = f"{prefix}_rows{level + 1}"
        ctes.append(f"{moved} AS MATERIALIZED ({_moved(current, best, STATS[kind], '2 * r.node', '2 * r.node + 1')})")
        current = moved
    return ctes + _leaves(prefix, current, kind, lam)


def grow_leaf(prefix, rows, leaves, lam=1.0, min_rows=1) -> list[str]:
    """Leaf-wise: one split per step, new leaves get the next two numbers."""
    ctes, current = [], rows
    for step in range(1, leaves):
        best = f"{prefix}_best{step}"
        ctes.append(
            f"{best} AS MATERIALIZED (SELECT tree, node, f, (v + next_v) / 2 AS cut, gain, "
            f"2 * (1 + coalesce({_splits_before(prefix, step)}, 0)) AS left_id FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY tree ORDER BY gain DESC, node, f, v) AS rn "
            f"FROM ({cuts_sql(current, 'newton', lam, 0.0, min_rows)}) WHERE gain > 0) c WHERE rn = 1)"
        )
        moved = f"{prefix}_rows{step}"
        ctes.append(f"{moved} AS MATERIALIZED ({_moved(current, best, STATS['newton'], 'b.left_id', 'b.left_id + 1')})")
        current = moved
    return ctes + _leaves(prefix, current, "newton", lam)


def _splits_before(prefix: str, step: int) -> str:
    if step == 1:
        return "0"
    earlier = " UNION ALL ".join(f"SELECT tree FROM {prefix}_best{s}" for s in range(1, step))
    return f"(SELECT count(*) FROM ({earlier}) e WHERE e.tree = c.tree)"


def level_gain_sql(rows: str, lam: float, level_gain: str) -> str:
    """(tree, f, v, gain) of a whole level."""
    if level_gain == "owner":
        return f"SELECT tree, f, v, max(gain) AS gain FROM ({cuts_sql(rows, 'newton', lam)}) GROUP BY tree, f, v"
    share = "{g} * {g} / ({h} + " + str(lam) + ")"
    gain = (
        f"0.5 * ({share.format(g='l_g', h='l_h')} + {share.format(g='(t_g - l_g)', h='(t_h - l_h)')}"
        f" - {share.format(g='t_g', h='t_h')})"
    )
    return (
        f"SELECT tree, f, v, {settled_sql(f'sum({gain})', f'sum({size_sql("newton", lam)})')} AS gain FROM ("
        f"SELECT p.tree, p.f, p.v, c.node, sum(CASE WHEN c.v <= p.v THEN c.g ELSE 0 END) AS l_g, "
        f"sum(CASE WHEN c.v <= p.v THEN c.h ELSE 0 END) AS l_h, sum(c.g) AS t_g, sum(c.h) AS t_h "
        f"FROM (SELECT DISTINCT tree, f, v FROM ({_cells(rows, STATS['newton'])})) p "
        f"JOIN ({_cells(rows, STATS['newton'])}) c ON c.tree = p.tree AND c.f = p.f GROUP BY p.tree, p.f, p.v, c.node) "
        f"GROUP BY tree, f, v"
    )


def grow_level(prefix, rows, depth, lam=3.0, level_gain="owner") -> list[str]:
    """Oblivious: one cut per level, halfway to the next value among all train rows."""
    ctes, current = [], rows
    ctes.append(
        f"{prefix}_next AS MATERIALIZED (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS next_v FROM ("
        + " UNION ".join(f"SELECT {i} AS f, x{i} AS v FROM {rows} WHERE used" for i in range(len(FEATURES)))
        + "))"
    )
    for level in range(depth):
        cut = f"{prefix}_cut{level}"
        ctes.append(
            f"{cut} AS MATERIALIZED (SELECT c.tree, c.f, (c.v + t.next_v) / 2 AS cut, c.gain FROM (SELECT g.*, "
            f"row_number() OVER (PARTITION BY g.tree ORDER BY g.gain DESC, g.f, g.v) AS rn "
            f"FROM ({level_gain_sql(current, lam, level_gain)}) g WHERE g.gain > 0) c "
            f"JOIN {prefix}_next t ON t.f = c.f AND t.v = c.v WHERE c.rn = 1 AND t.next_v IS NOT NULL)"
        )
        moved = f"{prefix}_rows{level + 1}"
        ctes.append(
            f"{moved} AS MATERIALIZED (SELECT {_ROW}, CASE WHEN b.f IS NULL THEN r.node "
            f"ELSE 2 * r.node + CASE WHEN {_PICK} > b.cut THEN 1 ELSE 0 END END AS node, {_XS}, "
            f"{', '.join('r.' + s for s in STATS['newton'])} FROM {current} r LEFT JOIN {cut} b ON r.tree = b.tree)"
        )
        current = moved
    return ctes + _leaves(prefix, current, "newton", lam)


# --- boosting --------------------------------------------------------------------------------------------


def _goss(prefix: str, rows: str, number: int, seed: str) -> list[str]:
    """Weighted sample per tree: the largest by |g|, and a hashed choice of the rest."""
    name = "account_id || '-' || day"
    return [
        f"""{prefix}_rank AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY round(abs(g), 9) DESC,
              md5('{seed}-{number}-' || tree || '-top-' || {name})) AS place,
         count(*) OVER (PARTITION BY tree) AS total FROM {rows} WHERE used)""",
        f"""{prefix}_pick AS MATERIALIZED (
  SELECT account_id, day, tree, 1.0 AS weight FROM {prefix}_rank
  WHERE place <= greatest(1, floor(total * CAST(0.2 AS DOUBLE)))
  UNION ALL
  SELECT account_id, day, tree, (1.0 - CAST(0.2 AS DOUBLE)) / CAST(0.1 AS DOUBLE) FROM (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY md5('{seed}-{number}-' || tree || '-rest-' || {name})) AS r
    FROM {prefix}_rank WHERE place > greatest(1, floor(total * CAST(0.2 AS DOUBLE))))
  WHERE r <= greatest(1, floor(total * CAST(0.1 AS DOUBLE))))""",
        f"""{prefix}_drawn AS MATERIALIZED (
  SELECT r.account_id, r.day, r.part, p.weight IS NOT NULL AS used, r.tree, r.node,
         {', '.join(f'r.x{i}' for i in range(len(FEATURES)))}, r.n, r.g * coalesce(p.weight, 1) AS g,
         r.h * coalesce(p.weight, 1) AS h
  FROM {rows} r LEFT JOIN {prefix}_pick p
    ON r.account_id = p.account_id AND r.day = p.day AND r.tree = p.tree)""",
    ]


def boost_ctes(
    task: str,
    kind: str,
    growth: str,
    rounds: int,
    rate: float,
    depth: int = 2,
    cut: str = "midpoint",
    lam: float = 1.0,
    gamma: float = 0.0,
    leaves: int = 4,
    min_rows: int = 1,
    goss: bool = False,
    seed: str = "42",
    level_gain: str = "owner",
    prefix: str = "m",
    per_account: bool = False,
) -> list[str]:
    """CTEs of a boosted fit over ``frame``; ``<prefix>_f<round>`` holds (account_id, day, tree, f) of all rows.

    ``per_account`` numbers the trees by account, so that accounts do not share any sums.
    """
    trees = 3 if task == "class" else 1
    if task == "class" and per_account:
        start = "CASE WHEN bool_or(part = 'train') OVER (PARTITION BY account_id) THEN ln(1.0 / 3) END"
    elif task == "class":
        start = "ln(1.0 / 3)"
    elif per_account:
        start = "avg(CASE WHEN part = 'train' THEN y END) OVER (PARTITION BY account_id)"
    else:
        start = "(SELECT avg(y) FROM frame WHERE part = 'train')"
    number_of_tree = f"t.tree + {trees} * account_id" if per_account else "t.tree"
    xs = ", ".join(f"r.x{i}" for i in range(len(FEATURES)))
    ctes = [
        f"{prefix}_f0 AS MATERIALIZED (SELECT account_id, day, {number_of_tree} AS tree, CAST({start} AS DOUBLE) AS f "
        f"FROM frame CROSS JOIN (SELECT unnest(range({trees})) AS tree) t)"
    ]
    for number in range(1, rounds + 1):
        p = f"{prefix}{number}"
        last = f"{prefix}_f{number - 1}"
        if task == "class":
            ctes.append(
                f"{p}_p AS MATERIALIZED (SELECT account_id, day, tree, exp(f - top) / "
                f"sum(exp(f - top)) OVER (PARTITION BY account_id, day) AS p "
                f"FROM (SELECT *, max(f) OVER (PARTITION BY account_id, day) AS top FROM {last}))"
            )
            g = "(q.p - CASE WHEN r.cls = q.tree % 3 THEN 1 ELSE 0 END)"
            h = "greatest(q.p * (1 - q.p), 1e-6)"
            source = f"{p}_p"
        else:
            g, h, source = "(q.f - r.y)", "CAST(1 AS DOUBLE)", last
        stats = f"{g} AS g, {h} AS h" if kind == "newton" else f"-{g} AS s, {g} * {g} AS q"
        ctes.append(
            f"{p}_in AS MATERIALIZED (SELECT r.account_id, r.day, r.part, r.part = 'train' AS used, q.tree, "
            f"CAST(1 AS BIGINT) AS node, {xs}, CAST(1 AS DOUBLE) AS n, {stats} "
            f"FROM frame r JOIN {source} q ON r.account_id = q.account_id AND r.day = q.day)"
        )
        rows = f"{p}_in"
        if goss:
            ctes += _goss(p, rows, number, seed)
            rows = f"{p}_drawn"
        if growth == "depth":
            ctes += grow_depth(p, rows, kind, depth, cut, lam, gamma)
        elif growth == "leaf":
            ctes += grow_leaf(p, rows, leaves, lam, min_rows)
        else:
            ctes += grow_level(p, rows, depth, lam, level_gain)
        ctes.append(
            f"{prefix}_f{number} AS MATERIALIZED (SELECT s.account_id, s.day, s.tree, s.f + {rate} * o.value AS f "
            f"FROM {last} s JOIN {p}_out o ON s.account_id = o.account_id AND s.day = o.day AND s.tree = o.tree)"
        )
    return ctes


def amount_scores(prefix: str, rounds: int) -> str:
    return (
        f"SELECT r.account_id, r.day, r.part, round(s.f, 6) AS pred FROM frame r "
        f"JOIN {prefix}_f{rounds} s ON r.account_id = s.account_id AND r.day = s.day"
    )


def class_scores(prefix: str, rounds: int) -> str:
    """Probabilities to 6 digits, and the class of the largest (lowest on ties, compared to 9 digits)."""
    r = [f"round(p{k}, 9)" for k in range(3)]
    probabilities = ", ".join(f"max(CASE WHEN tree % 3 = {k} THEN p END) AS p{k}" for k in range(3))
    return (
        f"SELECT account_id, day, part, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2, "
        f"CASE WHEN p0 IS NULL THEN NULL WHEN {r[0]} >= {r[1]} AND {r[0]} >= {r[2]} THEN 0 WHEN {r[1]} >= {r[2]} THEN 1 ELSE 2 END AS pred FROM ("
        f"SELECT account_id, day, part, {probabilities} FROM (SELECT s.account_id, s.day, r.part, s.tree, exp(s.f - top) "
        f"/ sum(exp(s.f - top)) OVER (PARTITION BY s.account_id, s.day) AS p FROM (SELECT *, max(f) OVER "
        f"(PARTITION BY account_id, day) AS top FROM {prefix}_f{rounds}) s "
        f"JOIN frame r ON r.account_id = s.account_id AND r.day = s.day) GROUP BY account_id, day, part)"
    )
