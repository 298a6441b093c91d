"""Loss, gradient and gain formulas as expression text; arguments and results are Spark SQL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from daybook.functions.text import number

# The guard inside the logarithm and the floor of the second derivative.
LOG_GUARD = 1e-9
HESSIAN_FLOOR = 1e-6


def is_class(label: str, k: int) -> str:
    return f"double(({label}) = {k})"


def log_loss(probability: str) -> str:
    """Cross-entropy of the probability given to the true class."""
    return f"(-ln(({probability}) + {number(LOG_GUARD)}))"


def squared_gradient(score: str, target: str) -> tuple[str, str]:
    return f"(({score}) - ({target}))", "1D"


def softmax_gradient(probability: str, label: str, k: int) -> tuple[str, str]:
    p = f"({probability})"
    return f"({p} - {is_class(label, k)})", f"greatest({p} * (1D - {p}), {number(HESSIAN_FLOOR)})"


def _share(g: str, h: str, lam: str) -> str:
    # An empty side has g = h = 0; with lam = 0 that is 0/0 and counts as nothing.
    return f"coalesce(try_divide(({g}) * ({g}), ({h}) + ({lam})), 0D)"


def newton_gain(gl: str, hl: str, g: str, h: str, lam: str = "1D", gamma: str = "0D") -> str:
    """Loss drop of cutting a node with sums (g, h) into a left part (gl, hl) and the rest."""
    left, right = _share(gl, hl, lam), _share(f"({g}) - ({gl})", f"({h}) - ({hl})", lam)
    return f"(0.5D * ({left} + {right} - {_share(g, h, lam)}) - ({gamma}))"


def newton_size(gl: str, hl: str, g: str, h: str, lam: str = "1D") -> str:
    """What the parts of a Newton gain add up to before they cancel out."""
    return f"(0.5D * ({_share(gl, hl, lam)} + {_share(f'({g}) - ({gl})', f'({h}) - ({hl})', lam)}))"


def newton_leaf(g: str, h: str, lam: str = "1D") -> str:
    return f"coalesce(try_divide(-({g}), ({h}) + ({lam})), 0D)"


def squared_gain(nl: str, sl: str, n: str, s: str) -> str:
    """Drop of the mean squared error, by the difference of the sides' means: an offset of the target cancels out first."""
    left, right = f"try_divide({sl}, {nl})", f"try_divide({s} - {sl}, {n} - {nl})"
    return f"({nl} * ({n} - {nl}) / ({n} * {n}) * pow({left} - {right}, 2))"


def squared_size(nl: str, sl: str, n: str, s: str) -> str:
    """The drop that means of this size would give by a difference in their eleventh digit, over the share that counts."""
    left, right = f"try_divide({sl}, {nl})", f"try_divide({s} - {sl}, {n} - {nl})"
    return f"(1E-10D * {nl} * ({n} - {nl}) / ({n} * {n}) * pow(abs({left}) + abs({right}), 2))"


def gini_gain(left: Sequence[str], total: Sequence[str]) -> str:
    """Drop of the gini impurity from class counts of the left part and of the whole node."""
    right = [f"({t} - {c})" for t, c in zip(total, left)]

    def squares(counts):
        return "(" + " + ".join(f"{c} * {c}" for c in counts) + ")"

    def size(counts):
        return "(" + " + ".join(counts) + ")"

    parts = f"try_divide({squares(left)}, {size(left)}) + try_divide({squares(right)}, {size(right)})"
    return f"(({parts} - {squares(total)} / {size(total)}) / {size(total)})"


def relu(z: str) -> str:
    return f"greatest(0D, {z})"
