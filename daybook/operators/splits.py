"""Exact best-split search as aggregation.

Rows are summed per (node, feature, value) first, in the map tasks, so equal values meet as one partial row.
Running sums over the distinct values then give every possible cut. A feature with very many distinct values
is scanned in value ranges: sums inside a range plus the totals of the ranges before it, which is the same
exact result with no task holding more than one range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.losses import gini_gain, is_class, newton_gain, newton_leaf, newton_size, squared_gain, squared_size
from daybook.functions.text import case, name, number

# Parallel sums differ in the last bits, so a gain counts only above this share of what its parts add up to, and
# gains are compared as 24-bit numbers. Both are relative: units and outliers of the target don't matter.
GAIN_SHARE = "1E-12D"
# Up to this many distinct values one group of running sums is fine.
WIDE_VALUES = 200_000
# Values that one range of a wide feature is to hold.
_RANGE_VALUES = 50_000


@dataclass(frozen=True)
class Criterion:
    """Names of the additive statistics, and the gain of a cut as text from left and total statistics."""

    stats: tuple[str, ...]
    gain: Callable[[dict[str, str], dict[str, str]], str]
    size: Callable[[dict[str, str], dict[str, str]], str]

    def settled(self, left: dict[str, str], total: dict[str, str]) -> str:
        """The gain as it is compared; 0 where it is lost in the last bits."""
        return settled(self.gain(left, total), self.size(left, total))


def settled(gain: str, size: str) -> str:
    return f"IF({gain} > {GAIN_SHARE} * {size}, double(float({gain})), 0D)"


def gini_criterion(n_classes: int = 3) -> Criterion:
    names = tuple(f"c{k}" for k in range(n_classes))
    return Criterion(
        ("n", *names),
        lambda left, total: gini_gain([left[c] for c in names], [total[c] for c in names]),
        lambda left, total: "1D",
    )


def mse_criterion() -> Criterion:
    return Criterion(
        ("n", "s"),
        lambda left, total: squared_gain(left["n"], left["s"], total["n"], total["s"]),
        lambda left, total: squared_size(left["n"], left["s"], total["n"], total["s"]),
    )


def newton_criterion(lam: str = "1D", gamma: str = "0D") -> Criterion:
    return Criterion(
        ("n", "g", "h"),
        lambda left, total: newton_gain(left["g"], left["h"], total["g"], total["h"], lam, gamma),
        lambda left, total: newton_size(left["g"], left["h"], total["g"], total["h"], lam),
    )


def class_stats(label: str, n_classes: int = 3) -> dict[str, str]:
    """Row statistics as expression text: a one and a class indicator per class."""
    return {"n": "1D", **{f"c{k}": is_class(name(label), k) for k in range(n_classes)}}


@dataclass(frozen=True)
class Ranges:
    """Value ranges per feature position; ``None`` where one group per node is enough."""

    edges: tuple[tuple[float, ...] | None, ...]

    @property
    def needed(self) -> bool:
        return any(e for e in self.edges)


# For groups whose distinct values are bounded by nature, such as the days of one account.
BOUNDED = Ranges(())


def plan_ranges(
    rows: DataFrame,
    features: Sequence[str],
    wide: int = WIDE_VALUES,
    pieces: int | None = None,
    distinct: dict[str, int] | None = None,
) -> Ranges:
    """Decide once per fit which features need ranges. One aggregate, a few numbers per feature.

    Unless ``pieces`` is given, the number of ranges follows the number of distinct values.
    """
    if distinct is None:
        row = rows.selectExpr(*[f"approx_count_distinct({name(f)}) AS d{i}" for i, f in enumerate(features)]).first()
        distinct = {f: row[f"d{i}"] for i, f in enumerate(features)}
    large = [f for f in features if distinct[f] > wide]
    if not large:
        return Ranges((None,) * len(features))
    if pieces is None:
        pieces = max(2, -(-max(distinct[f] for f in large) // _RANGE_VALUES))
    steps = ", ".join(number(i / pieces) for i in range(1, pieces))
    marks = rows.selectExpr(
        *[f"percentile_approx(double({name(f)}), array({steps}), {10 * pieces}) AS {name(f)}" for f in large]
    ).first()
    return Ranges(tuple(tuple(sorted(set(marks[f]))) if f in large else None for f in features))


def _range_of(value: str, edges: Sequence[float]) -> str:
    """Number of edges not above the value, by halving: depth log2 of the number of edges."""

    def pick(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return case([(f"{value} < {number(edges[middle])}", pick(low, middle))], pick(middle + 1, high))

    return pick(0, len(edges))


def _piece(ranges: Ranges) -> str:
    """The value range a (feature, value) row belongs to."""
    wide = [(f"feature = {i}", _range_of("value", e)) for i, e in enumerate(ranges.edges) if e]
    return case(wide, "0")


def split_cuts(
    cells: DataFrame, by: Sequence[str], criterion: Criterion, ranges: Ranges | None = None
) -> DataFrame:
    """All cuts of all nodes.

    ``cells`` has the node columns ``by``, ``feature`` (position), ``value`` and the statistics, one row per
    row and feature or already summed. The result has one row per distinct value with the left sums
    (``l_*``), the node totals (``t_*``) and the next distinct value of the node (``next_value``).
    """
    stats = criterion.stats
    hist = cells.groupBy(*by, "feature", "value").agg(*[F.expr(f"sum({s})").alias(s) for s in stats])
    group = [*by, "feature"]
    keys = ", ".join(name(k) for k in group)
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    if ranges is None or not ranges.needed:
        ordered = f"OVER (PARTITION BY {keys} ORDER BY value"
        return hist.selectExpr(
            *[name(k) for k in group],
            "value",
            *[f"sum({s}) {ordered} {upto}) AS l_{s}" for s in stats],
            *[f"sum({s}) OVER (PARTITION BY {keys}) AS t_{s}" for s in stats],
            f"lead(value) {ordered}) AS next_value",
        )

    hist = hist.withColumn("piece", F.expr(_piece(ranges)))
    # At most nodes * features * pieces rows.
    sums = hist.groupBy(*group, "piece").agg(*[F.sum(s).alias(s) for s in stats], F.min("value").alias("low"))
    ordered = f"OVER (PARTITION BY {keys} ORDER BY piece"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    sums = sums.selectExpr(
        *[name(k) for k in group],
        "piece",
        *[f"coalesce(sum({s}) {ordered} {before}), 0D) AS b_{s}" for s in stats],
        *[f"sum({s}) OVER (PARTITION BY {keys}) AS t_{s}" for s in stats],
        f"lead(low) {ordered}) AS next_low",
    )
    # The sums come as rows of the range, one before its values and one after them, so the range is not joined with them.
    own = hist.selectExpr(*[name(k) for k in group], "piece", "1 AS place", "value", *stats, *[f"double(NULL) AS t_{s}" for s in stats])
    edge = ", ".join(["0 AS place, double(NULL) AS value", *[f"b_{s} AS {s}" for s in stats]])
    after = ", ".join(["2 AS place, next_low AS value", *[f"0D AS {s}" for s in stats]])
    edges = sums.selectExpr(
        *[name(k) for k in group], "piece", f"inline(array(struct({edge}), struct({after})))", *[f"t_{s}" for s in stats]
    ).select(*own.columns)
    whole = f"OVER (PARTITION BY {keys}, piece"
    inner = f"{whole} ORDER BY place, value"
    running = own.union(edges).selectExpr(
        *[name(k) for k in group],
        "place",
        "value",
        *[f"sum({s}) {inner} {upto}) AS l_{s}" for s in stats],
        *[f"max(t_{s}) {whole}) AS t_{s}" for s in stats],
        f"lead(value) {inner}) AS next_value",
    )
    return running.filter("place = 1").drop("place")


def with_gain(cuts: DataFrame, criterion: Criterion, min_rows: str = "1", as_parts: bool = False) -> DataFrame:
    """Add ``gain``: null where a side has fewer than ``min_rows`` rows. As parts: the bare gain and its ``size``."""
    sides = {s: f"l_{s}" for s in criterion.stats}, {s: f"t_{s}" for s in criterion.stats}
    allowed = f"next_value IS NOT NULL AND l_n >= {min_rows} AND t_n - l_n >= {min_rows}"
    if as_parts:
        parts = {"gain": criterion.gain(*sides), "size": criterion.size(*sides)}
        return cuts.selectExpr("*", *[f"{case([(allowed, e)])} AS {c}" for c, e in parts.items()])
    return cuts.withColumn("gain", F.expr(case([(allowed, criterion.settled(*sides))])))


def best_cut(cuts: DataFrame, by: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """The cut with the largest gain per group; on ties the lowest feature, then the lowest value.

    Groups without an allowed cut stay, with nulls and their totals.
    """
    payload = ", ".join(["feature", "value", "next_value", "gain", *[f"l_{s}" for s in stats]])
    rank = case([("gain IS NOT NULL", "struct(gain, -feature, -value)")])
    totals = ", ".join(f"t_{s}" for s in stats)
    return (
        cuts.groupBy(*by)
        .agg(
            F.expr(f"max_by(struct({payload}), {rank})").alias("__cut"),
            F.expr(f"min_by(struct({totals}), struct(feature, value))").alias("__totals"),
        )
        .select(*by, "__cut.*", "__totals.*")
    )


def unpivot_features(rows: DataFrame, by: Sequence[str], features: Sequence[str], stats: dict[str, str]) -> DataFrame:
    """One row per row and feature position with the statistics."""
    inputs = ", ".join(f"double({name(f)})" for f in features)
    named = rows.selectExpr(
        *[name(k) for k in by], f"array({inputs}) AS __inputs", *[f"{c} AS __{s}" for s, c in stats.items()]
    )
    return named.selectExpr(
        *[name(k) for k in by], "posexplode_outer(__inputs) AS (feature, value)", *[f"__{s} AS {s}" for s in stats]
    )


def threshold(kind: str) -> Column:
    """``observed`` cuts at the value itself, ``midpoint`` halfway to the node's next value."""
    if kind == "observed":
        return F.col("value")
    if kind == "midpoint":
        return (F.col("value") + F.col("next_value")) / 2
    raise ValueError("threshold kind is 'observed' or 'midpoint'")


def best_split(
    rows: DataFrame,
    by: Sequence[str],
    features: Sequence[str],
    stats: dict[str, str],
    criterion: Criterion,
    kind: str = "observed",
    min_rows: int = 1,
    ranges: Ranges | None = None,
) -> DataFrame:
    """Best cut of every node with a gain above zero.

    The value ranges are planned from the data unless given; ``BOUNDED`` says that every node is small.
    """
    ranges = plan_ranges(rows, features) if ranges is None else ranges
    cells = unpivot_features(rows, by, features, stats)
    cuts = with_gain(split_cuts(cells, by, criterion, ranges), criterion, str(min_rows))
    best = best_cut(cuts, by, criterion.stats).filter(F.col("gain") > 0)
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    return best.select(
        *by,
        names.alias("feature"),
        threshold(kind).alias("threshold"),
        "gain",
        F.col("l_n").cast("long").alias("n_left"),
        (F.col("t_n") - F.col("l_n")).cast("long").alias("n_right"),
    )


def gini_best_split(rows, by, features, label="cls", n_classes=3, **options) -> DataFrame:
    return best_split(rows, by, features, class_stats(label, n_classes), gini_criterion(n_classes), **options)


def mse_best_split(rows, by, features, target="y", **options) -> DataFrame:
    stats = {"n": "1D", "s": f"double({name(target)})"}
    return best_split(rows, by, features, stats, mse_criterion(), **options)


def newton_best_split(rows, by, features, g="g", h="h", lam=1.0, gamma=0.0, kind="midpoint", **options) -> DataFrame:
    stats = {"n": "1D", "g": name(g), "h": name(h)}
    return best_split(rows, by, features, stats, newton_criterion(number(lam), number(gamma)), kind, **options)


def node_cuts(cells: DataFrame, tree: Sequence[str], node: str, criterion: Criterion, ranges: Ranges | None = None) -> DataFrame:
    """Gain of every (feature, value) cut of each node by itself.

    The best cut of a level by ``owner`` is the best of these: the largest of the largest gains per value, so values need not meet.
    """
    gained = with_gain(split_cuts(cells, [*tree, node], criterion, ranges), criterion)
    return gained.select(*tree, "feature", "value", F.coalesce("gain", F.lit(0.0)).alias("gain"))


def oblivious_cuts(
    cells: DataFrame, tree: Sequence[str], node: str, criterion: Criterion, level_gain: str, ranges: Ranges | None = None
) -> DataFrame:
    """Gain of every (feature, value) cut of a whole level of a tree.

    ``owner``: the largest gain of a single node that has this value. ``sum``: the gains of all nodes of the
    level added up, where a node takes part with its rows up to the value. For the sum every node needs its
    running totals at every value of the level: a node keeps its last totals between its own values, so the
    level total is a running sum of the *changes* of each node's score.
    """
    if level_gain == "owner":
        return node_cuts(cells, tree, node, criterion, ranges).groupBy(*tree, "feature", "value").agg(F.max("gain").alias("gain"))
    if level_gain != "sum":
        raise ValueError("level_gain is 'owner' or 'sum'")
    by = [*tree, node]
    cuts = split_cuts(cells, by, criterion, ranges)
    # Gains that are added up are settled only as a sum. After a node's last value all its rows are left, so its
    # gain and size go back to zero.
    parts = ("gain", "size")
    gained = with_gain(cuts, criterion, as_parts=True).withColumns({p: F.coalesce(p, F.lit(0.0)) for p in parts})
    keys, level = ", ".join(name(k) for k in by), ", ".join(name(k) for k in (*tree, "feature"))
    if ranges is None or not ranges.needed:
        last = f"OVER (PARTITION BY {keys}, feature ORDER BY value)"
        steps = gained.selectExpr(*tree, "feature", "value", *[f"{p} - coalesce(lag({p}) {last}, 0D) AS {p}" for p in parts])
        steps = steps.groupBy(*tree, "feature", "value").agg(*[F.sum(p).alias(p) for p in parts])
        upto = f"OVER (PARTITION BY {level} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        sums = steps.selectExpr(*tree, "feature", "value", *[f"sum({p}) {upto} AS {p}" for p in parts])
        return sums.selectExpr(*tree, "feature", "value", f"{settled(*parts)} AS gain")
    # The same in value ranges: at its first value of a range a node leaves what it had at the end of its range before,
    # and a range begins with the sums of earlier ones, as a row before its values.
    gained = gained.withColumn("piece", F.expr(_piece(ranges)))
    ends = gained.groupBy(*by, "feature", "piece").agg(
        F.expr("CASE WHEN count(value) = count(1) THEN min(value) END AS value"),  # nulls come first
        *[F.max_by(p, "value").alias(f"end_{p}") for p in parts],
    )
    carry = f"OVER (PARTITION BY {keys}, feature ORDER BY piece)"
    at = [*map(name, tree), "feature", "piece", "value"]
    left = ends.selectExpr(*at, *[f"-coalesce(lag(end_{p}) {carry}, 0D) AS {p}" for p in parts])
    last = f"OVER (PARTITION BY {keys}, feature, piece ORDER BY value)"
    inside = gained.selectExpr(*at, *[f"{p} - coalesce(lag({p}) {last}, 0D) AS {p}" for p in parts])
    steps = inside.union(left).groupBy(*tree, "feature", "piece", "value").agg(*[F.sum(p).alias(p) for p in parts])
    totals = steps.groupBy(*tree, "feature", "piece").agg(*[F.sum(p).alias(f"total_{p}") for p in parts])
    before = f"OVER (PARTITION BY {level} ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    first = [*map(name, tree), "feature", "piece"]
    bases = totals.selectExpr(*first, "0 AS place", "double(NULL) AS value", *[f"coalesce(sum(total_{p}) {before}, 0D) AS {p}" for p in parts])
    rows = steps.selectExpr(*first, "1 AS place", "value", *parts).union(bases)
    upto = f"OVER (PARTITION BY {level}, piece ORDER BY place, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    sums = rows.selectExpr(*first, "place", "value", *[f"sum({p}) {upto} AS {p}" for p in parts]).filter("place = 1")
    return sums.selectExpr(*map(name, tree), "feature", "value", f"{settled(*parts)} AS gain")


def oblivious_best_split(
    rows: DataFrame,
    tree: Sequence[str],
    node: str,
    features: Sequence[str],
    g: str = "g",
    h: str = "h",
    lam: float = 3.0,
    level_gain: str = "owner",
    ranges: Ranges | None = None,
) -> DataFrame:
    """The one cut that a level of an oblivious tree applies to all its nodes.

    It lies halfway to the next value among all rows of the tree.
    """
    ranges = plan_ranges(rows, features) if ranges is None else ranges
    criterion = newton_criterion(number(lam))
    cells = unpivot_features(rows, [*tree, node], features, {"n": "1D", "g": name(g), "h": name(h)})
    cuts = node_cuts(cells, tree, node, criterion, ranges) if level_gain == "owner" else oblivious_cuts(cells, tree, node, criterion, level_gain, ranges)
    # A cut with a gain above zero has rows on its right, so a next value exists.
    best = (
        cuts.filter("gain > 0")
        .groupBy(*tree)
        .agg(F.expr("max_by(struct(feature, value, gain), struct(gain, -feature, -value))").alias("cut"))
        .select(*tree, "cut.*")
    )
    place = best.select(*tree, "feature", F.col("value").alias("cut_value"))
    following = (
        cells.select(*tree, "feature", "value")
        .join(place, [*tree, "feature"])
        .filter("value > cut_value")
        .groupBy(*tree)
        .agg(F.min("value").alias("next_value"))
    )
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    return best.join(following, list(tree)).select(
        *tree, names.alias("feature"), threshold("midpoint").alias("threshold"), "gain"
    )


def newton_leaf_values(rows: DataFrame, by: Sequence[str], g: str = "g", h: str = "h", lam: float = 1.0) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.expr(newton_leaf(f"sum({name(g)})", f"sum({name(h)})", number(lam))).alias("leaf_value")
    )


def gini_by_group(rows: DataFrame, keys: Sequence[str], label: str = "cls") -> DataFrame:
    """Impurity from class counts; the counts are summed before the groups meet."""
    counts = rows.groupBy(*keys, label).agg(F.count(F.lit(1)).cast("double").alias("c"))
    n = F.sum("c")
    return counts.groupBy(*keys).agg(
        n.cast("long").alias("n"), (1 - F.sum(F.col("c") * F.col("c")) / (n * n)).alias("gini")
    )


def mse_by_group(rows: DataFrame, keys: Sequence[str], target: str = "y") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.var_pop(target).alias("mse"))


def assign_nodes(rows: DataFrame, node: str, feature: str, cut: float) -> DataFrame:
    """Move every row to child ``2 * node`` or, right of the cut, ``2 * node + 1``."""
    return rows.withColumn(node, F.col(node) * 2 + F.when(F.col(feature) > F.lit(cut), 1).otherwise(0))
