"""Parameter sets of the compared models. Fixed values, named by what they really are."""

from __future__ import annotations

from daybook.operators.boosting import BoostParams
from daybook.operators.sampling import Goss

# Own runs.
OWN_CLASSIFIERS = {
    "boosted": BoostParams(kind="mse", cut="observed", rounds=150, learning_rate=0.01, max_depth=4),
    "newton": BoostParams(rounds=200, learning_rate=0.01, max_depth=3, lam=2.0, gamma=0.5),
    "leafwise": BoostParams(
        growth="leaf", rounds=380, learning_rate=0.01, num_leaves=15, min_rows=20, lam=1.5, goss=Goss()
    ),
    "oblivious": BoostParams(growth="oblivious", rounds=180, learning_rate=0.01, max_depth=4, lam=10.0),
}
OWN_REGRESSORS = {
    "boosted": BoostParams("amount", kind="mse", cut="observed", rounds=100, learning_rate=0.05, max_depth=3),
    "newton": BoostParams("amount", rounds=100, learning_rate=0.05, max_depth=3, lam=1.0, gamma=0.1),
    "leafwise": BoostParams(
        "amount", growth="leaf", rounds=100, learning_rate=0.05, num_leaves=15, min_rows=5, lam=0.1, goss=Goss()
    ),
    "oblivious": BoostParams("amount", growth="oblivious", rounds=100, learning_rate=0.05, max_depth=4, lam=3.0),
}

# Library runs: the same learners with the library runs' settings (no row sampling).
LIBRARY_CLASSIFIERS = {
    "boosted": BoostParams(kind="mse", cut="midpoint", rounds=150, learning_rate=0.01, max_depth=4),
    "newton": BoostParams(rounds=200, learning_rate=0.01, max_depth=3, lam=2.0, gamma=0.5),
    "leafwise": BoostParams(growth="leaf", rounds=200, learning_rate=0.01, num_leaves=15, min_rows=20, lam=1.5),
    "oblivious": BoostParams(
        growth="oblivious", level_gain="sum", rounds=180, learning_rate=0.01, max_depth=4, lam=10.0
    ),
}
LIBRARY_REGRESSORS = {
    "boosted": BoostParams("amount", kind="mse", cut="midpoint", rounds=100, learning_rate=0.05, max_depth=3),
    "newton": BoostParams("amount", rounds=100, learning_rate=0.05, max_depth=3, lam=1.0),
    "leafwise": BoostParams("amount", growth="leaf", rounds=100, learning_rate=0.05, num_leaves=15, min_rows=20, lam=0.0),
    "oblivious": BoostParams(
        "amount", growth="oblivious", level_gain="sum", rounds=100, learning_rate=0.05, max_depth=4, lam=3.0
    ),
}
OWN_FOREST = {"n_trees": 6, "max_depth": 5, "share": 0.8, "seed": "13"}
LIBRARY_FOREST = {"n_trees": 20, "max_depth": 10, "seed": 13}
TREE_DEPTH = 3
KNN_NEIGHBOURS = 3
LIBRARY_NETS = {"class": (10, 6), "amount": (6, 3)}

# Sweeps: (lambda, gamma) pairs, and leaf limits.
REGULARISATION_SWEEP = ((0.0, 0.0), (0.1, 0.0), (1.0, 0.0), (1.0, 0.1), (2.0, 0.5))
LEAVES_SWEEP = (4, 8, 15, 31, 63)


def regularisation_runs(rounds: int = 100) -> dict[str, BoostParams]:
    return {
        f"lambda={lam} gamma={gamma}": BoostParams(rounds=rounds, learning_rate=0.1, max_depth=3, lam=lam, gamma=gamma)
        for lam, gamma in REGULARISATION_SWEEP
    }


def leaves_runs(rounds: int = 100) -> dict[str, BoostParams]:
    return {
        f"num_leaves={leaves}": BoostParams(
            growth="leaf", rounds=rounds, learning_rate=0.05, num_leaves=leaves, min_rows=5, lam=0.1, goss=Goss()
        )
        for leaves in LEAVES_SWEEP
    }
