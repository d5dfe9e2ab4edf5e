"""Differential evolution on the driver: maximises a function of a real vector."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def differential_evolution(f: Callable[[np.ndarray], float], first: np.ndarray, spread: float = 1.0, patience: int = 100, weight: float = 0.8, crossover: float = 0.9, seed: int = 1) -> tuple[np.ndarray, float]:
    """The best vector and its value. Population ten times the dimensions, the first individual given; stops after `patience` generations without gain."""
    rng = np.random.default_rng(seed)
    first = np.asarray(first, float)
    n, dims = max(4, 10 * len(first)), len(first)
    pop = first + rng.normal(scale=spread, size=(n, dims))
    pop[0] = first
    val = np.array([f(p) for p in pop])
    still = 0
    while still < patience:
        best = val.max()
        for i in range(n):
            a, b, c = pop[rng.choice(np.delete(np.arange(n), i), 3, replace=False)]
            take = rng.random(dims) < crossover
            take[rng.integers(dims)] = True
            trial = np.where(take, a + weight * (b - c), pop[i])
            if (v := f(trial)) >= val[i]:
                pop[i], val[i] = trial, v
        still = 0 if val.max() > best + 1e-12 else still + 1
    i = int(val.argmax())
    return pop[i], float(val[i])
