"""Exact-size samples by distributed selection.

"The ``m`` smallest rows in some order" needs no global sort and no single-task window. A narrow band of values that holds
the m-th row comes from a mergeable quantile sketch, or from arithmetic where the values are evenly spread hashes. One
exact pass counts the rows below the band and the values inside it; the sample is then a plain comparison with the value
found. All orders share every pass, and what comes to the driver is bounded, whatever the size of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import case, name, number

#: Buckets that a band with too many values is cut into.
_BUCKETS = 1024
#: Values of all bands together that one pass may send to the driver.
_VALUES = 100_000
#: ``percentile_approx`` is off by one part in this many rows at most.
_ACCURACY = 10_000
_HALF = 2.0**52
_SPANS = ((0.0, _HALF), (0.0, _HALF), (0.0, 2.0**24))


@dataclass(frozen=True)
class Order:
    """A lexicographic row order of double expressions, a row filter and the number of rows wanted (all as text).

    ``spans`` says of a column that its values are spread evenly over an interval, as those of a hash; ``rows`` is the
    number of rows that pass the filter, where it is known.
    """

    columns: tuple[str, ...]
    want: int
    where: str = "TRUE"
    rows: int | None = None
    spans: tuple[tuple[float, float] | None, ...] = ()


def hash_order(seed: str, keys: Sequence[str]) -> tuple[str, str, str]:
    """Pseudo-random order of rows by the md5 text of seed and key, as three exact numbers: 52, 52 and 24 bits.

    Equals ordering by the md5 text itself.
    """
    text = f"md5(concat_ws('-', '{seed}', {', '.join(f'string({name(k)})' for k in keys)}))"
    return tuple(f"double(conv(substring({text}, {start}, {digits}), 16, 10))" for start, digits in ((1, 13), (14, 13), (27, 6)))


def by_hash(seed: str, keys: Sequence[str], want: int, where: str = "TRUE", rows: int | None = None) -> Order:
    return Order(hash_order(seed, keys), want, where, rows, _SPANS)


@dataclass
class _Open:
    """What is known of an order that is not settled: fixed values, rows wanted and present with them, the present band."""

    order: Order
    need: int
    rows: int | None
    cut: list[float] = field(default_factory=list)
    band: tuple[float, float] | None = None
    expected: float = 0.0
    last: bool = False  # the band reaches to the largest value
    slack: float = 1.0

    @property
    def column(self) -> str:
        return self.order.columns[len(self.cut)]

    @property
    def scope(self) -> str:
        return " AND ".join([f"({self.order.where})", *[f"{c} = {number(v)}" for c, v in zip(self.order.columns, self.cut)]])

    @property
    def span(self) -> tuple[float, float] | None:
        return self.order.spans[len(self.cut)] if len(self.cut) < len(self.order.spans) else None

    def place(self) -> tuple[float, float]:
        """Shares of the rows between which the wanted one lies."""
        at = min(1.0, self.need / self.rows)
        if self.span is None:
            half = self.slack * 2.0 / _ACCURACY
        else:
            half = self.slack * (7 * math.sqrt(at * (1 - at) / self.rows) + 12 / self.rows)
        return max(0.0, at - half), min(1.0, at + half)

    def narrow(self, low: float, high: float, expected: float, last: bool) -> None:
        self.band, self.expected, self.last = (low, high), expected, last


def first_rows(df: DataFrame, orders: dict[str, Order]) -> dict[str, str]:
    """A condition per order that holds for exactly its first ``want`` rows (all rows if there are fewer).

    The columns of an order must identify rows uniquely for the size to be exact. A null has no place in an order. Hashes
    of a known number of rows take one pass, other values two; ties, and bands of very many values, take one more each.
    """
    cuts: dict[str, list[float] | None] = {}
    waiting = {}
    for key, order in orders.items():
        if order.want > 0:
            waiting[key] = _Open(order, order.want, order.rows)
    while waiting:
        _place_bands(df, waiting)
        for key in [k for k, o in waiting.items() if o.band is None]:  # no more rows than wanted
            cuts[key] = waiting.pop(key).cut
        if not waiting:
            break
        found = _counted(df, waiting)
        for key, state in list(waiting.items()):
            if _settle(state, found[key]):
                cuts[key] = waiting.pop(key).cut
    return {key: _below(order, cuts.get(key, [])) for key, order in orders.items()}


def _below(order: Order, cut: list[float]) -> str:
    if order.want <= 0:
        return "FALSE"
    taken = []
    for depth, value in enumerate(cut):
        ties = [f"{c} = {number(v)}" for c, v in zip(order.columns, cut[:depth])]
        sign = "<=" if depth == len(cut) - 1 else "<"
        taken.append("(" + " AND ".join([*ties, f"{order.columns[depth]} {sign} {number(value)}"]) + ")")
    return f"(({order.where}) AND ({' OR '.join(taken) if taken else 'TRUE'}))"


def _place_bands(df: DataFrame, waiting: dict[str, _Open]) -> None:
    """Gives every order without a band one; those with ``need`` rows or fewer keep none."""
    sketched = []
    for state in waiting.values():
        if state.band is not None or (state.rows is not None and state.need >= state.rows):
            continue
        if state.span is not None and state.rows is not None:
            low, high = state.place()
            first, last = state.span
            state.narrow(first + (last - first) * low, first + (last - first) * high, (high - low) * state.rows, high >= 1.0)
        else:
            sketched.append(state)
    if not sketched:
        return
    columns, wanted = [], []
    for i, state in enumerate(sketched):
        value = case([(state.scope, state.column)])
        # Where the number of rows is not known yet, marks all over.
        shares = state.place() if state.rows is not None else [j / 256 for j in range(257)]
        wanted.append(shares)
        marks = ", ".join(number(x) for x in shares)
        columns += [
            f"count({value}) AS n{i}", f"min({value}) AS lo{i}", f"max({value}) AS hi{i}", f"percentile_approx({value}, array({marks}), {_ACCURACY}) AS q{i}",
        ]
    row = df.selectExpr(*columns).first()
    for i, state in enumerate(sketched):
        n, shares, marks = row[f"n{i}"], wanted[i], row[f"q{i}"]
        state.rows = n
        if state.need >= n:
            continue
        low, high = state.place()
        below = [m for share, m in zip(shares, marks) if share <= low + 1e-12]
        above = [m for share, m in zip(shares, marks) if share >= high - 1e-12]
        wide = shares[1] - shares[0] if len(shares) > 2 else 0.0
        first = below[-1] if below and low > 0.0 else row[f"lo{i}"]
        last = above[0] if above and high < 1.0 else row[f"hi{i}"]
        state.narrow(first, last, (high - low + 2 * wide + 2.0 / _ACCURACY) * n, last >= row[f"hi{i}"])


def _counted(df: DataFrame, waiting: dict[str, _Open]) -> dict[str, list[tuple]]:
    """Per order, in one pass: (place, rows, smallest, largest value): place -1 is below the band; inside it a row per value,
    or per bucket where there may be too many."""
    most = _VALUES // len(waiting)
    values, cells = [], []
    for i, state in enumerate(waiting.values()):
        low, high = state.band
        values.append(f"{case([(state.scope, state.column)])} AS v{i}")
        width = (high - low) / _BUCKETS
        if state.expected > most and width > 0 and math.isfinite(width):
            place, own = f"least(bigint(floor((v{i} - {number(low)}) / {number(width)})), {_BUCKETS - 1})", "CAST(NULL AS DOUBLE)"
        else:
            place, own = "0L", f"v{i}"
        at = case([(f"v{i} < {number(low)}", "-1L"), (f"v{i} <= {number(high)}", place)])
        cells.append(f"named_struct('o', {i}, 'at', {at}, 'own', IF(v{i} < {number(low)}, CAST(NULL AS DOUBLE), {own}), 'v', v{i})")
    rows = (
        df.selectExpr(*values)
        .selectExpr(f"inline(array({', '.join(cells)}))")
        .filter("at IS NOT NULL")
        .groupBy("o", "at", "own")
        .agg(F.expr("count(1)").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    names = list(waiting)
    found: dict[str, list[tuple]] = {key: [] for key in names}
    for r in rows:
        found[names[r["o"]]].append((r["at"], r["rows"], r["low"], r["high"]))
    return {key: sorted(cells, key=lambda c: (c[0], c[2])) for key, cells in found.items()}


def _settle(state: _Open, cells: list[tuple]) -> bool:
    """Takes in a count; true once the last value of ``cut`` is final."""
    below = sum(rows for at, rows, _, _ in cells if at < 0)
    inside = [c for c in cells if c[0] >= 0]
    need = state.need - below
    if need <= 0 or need > sum(c[1] for c in inside):
        if need > 0 and state.last and inside:  # nulls aside, fewer rows than wanted
            state.cut.append(inside[-1][3])
            return True
        state.slack *= 16.0  # the band was too narrow: improbable, but then a wider one
        state.band = None
        return False
    for _, rows, low, high in inside:
        if need > rows:
            need -= rows
            continue
        if low < high:
            # A bucket: what is below its smallest value is known from now on, and counted again with it.
            state.narrow(low, high, rows, False)
            return False
        state.cut.append(high)
        if need == rows or len(state.cut) == len(state.order.columns):
            return True
        state.need, state.rows, state.band, state.slack = need, rows, None, 1.0
        return False
    raise AssertionError("the band holds the wanted row")


def bag_samples(
    rows: DataFrame, trees: int, keys: Sequence[str], share: float = 0.8, seed: str = "13", count: int | None = None
) -> list[str]:
    """One condition per tree that keeps exactly ``int(share * n)`` rows without replacement; two passes for all trees."""
    n = rows.count() if count is None else count
    picks = first_rows(rows, {f"t{t}": by_hash(f"{seed}-{t}", keys, int(n * share), rows=n) for t in range(trees)})
    return [picks[f"t{t}"] for t in range(trees)]


def bag_sample(
    rows: DataFrame, trees: int, keys: Sequence[str], share: float = 0.8, seed: str = "13"
) -> DataFrame:
    """The rows of every tree's sample, one row per tree and sampled row.

    ``rows`` is read twice here and once more by the result; a caller that derives it at some cost keeps it.
    """
    picks = bag_samples(rows, trees, keys, share, seed)
    flags = ", ".join(case([(p, str(t))]) for t, p in enumerate(picks))
    return rows.selectExpr("*", f"explode(array_compact(array({flags}))) AS tree")


@dataclass(frozen=True)
class Goss:
    """Gradient-based one-side sampling: shares of large and of other rows."""

    top_rate: float = 0.2
    other_rate: float = 0.1

    @property
    def weight(self) -> float:
        return (1.0 - self.top_rate) / self.other_rate


def goss_weights(
    rows: DataFrame,
    gradients: dict[str, str],
    keys: Sequence[str],
    goss: Goss,
    seeds: dict[str, str],
    count: int | None = None,
) -> dict[str, str]:
    """Row weight per gradient: 1 for the largest, ``goss.weight`` for the sampled rest, else null.

    Large means by absolute gradient rounded to 9 digits; equal ones go by the hash order of the rows.
    """
    n = rows.count() if count is None else count
    large, small = max(1, int(n * goss.top_rate)), max(1, int(n * goss.other_rate))
    by_size = {
        key: Order((f"(-round(abs({g}), 9))", *hash_order(f"{seeds[key]}-top", keys)), large, "TRUE", n, (None, *_SPANS))
        for key, g in gradients.items()
    }
    top = first_rows(rows, by_size)
    left = max(0, n - large)
    rest = first_rows(rows, {key: by_hash(f"{seeds[key]}-rest", keys, small, f"NOT {top[key]}", left) for key in gradients})
    return {key: case([(top[key], "1D"), (rest[key], number(goss.weight))]) for key in gradients}


def goss_sample(rows: DataFrame, gradient: str, keys: Sequence[str], goss: Goss = Goss(), seed: str = "0") -> DataFrame:
    """The sampled rows with their ``weight``."""
    weight = goss_weights(rows, {"g": gradient}, keys, goss, {"g": seed})["g"]
    return rows.withColumn("weight", F.expr(weight)).filter("weight IS NOT NULL")
