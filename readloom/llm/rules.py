"""Ordered rule lists by incremental reduced-error pruning, and their SQL."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Test:
    """A feature below, at most, above or at least a threshold."""

    feature: int
    sign: str  # <, <=, > or >=
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column, t = x[:, self.feature], self.threshold
        return {"<": column < t, "<=": column <= t, ">": column > t, ">=": column >= t}[self.sign]


def covered(rule: list[Test], x: np.ndarray) -> np.ndarray:
    """The rows for which all tests of a rule hold."""
    hit = np.ones(len(x), bool)
    for test in rule:
        hit &= test.holds(x)
    return hit


def simplest(low: float, high: float) -> float:
    """The number of fewest decimal places from low to high, the one nearest to their middle of several."""
    for places in range(17):
        scale = 10.0**places
        first, last = math.ceil(low * scale), math.floor(high * scale)
        if first <= last:
            n = min(max(round((low + high) / 2 * scale), first), last)
            if low <= n / scale <= high:
                return n / scale
    return low


def _between(feature: int, inside: float, outside: float) -> Test:
    """The test that holds for the value `inside` and not for `outside`, with the simplest threshold between them: what lies
    there wasn't seen, and stated bounds are round numbers."""
    t = simplest(min(inside, outside), max(inside, outside))
    sign = "<" if inside < outside else ">"
    return Test(feature, sign + ("=" if t == inside else ""), t)


def _best_test(x: np.ndarray, y: np.ndarray) -> Test | None:
    """The test of highest information gain (FOIL's) for the rows still covered."""
    p0, n0 = int(y.sum()), int((~y).sum())
    base = np.log2(p0 / (p0 + n0))
    best: tuple[float, Test | None] = (0.0, None)
    for feature in range(x.shape[1]):
        order = np.argsort(x[:, feature], kind="stable")
        v, pos = x[order, feature], np.cumsum(y[order])
        ends = np.flatnonzero(v[1:] != v[:-1])  # the last row of each value but the highest
        p_low, n_low = pos[ends], ends + 1 - pos[ends]
        for p, n, low in ((p_low, n_low, True), (p0 - p_low, n0 - n_low, False)):
            if not len(p):
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-12:
                a, b = float(v[ends[k]]), float(v[ends[k] + 1])
                best = (float(gain[k]), _between(feature, a, b) if low else _between(feature, b, a))
    return best[1]


def _grow(x: np.ndarray, y: np.ndarray, rule: list[Test]) -> list[Test]:
    """Adds tests until no row of the other class is covered, or none helps."""
    rule, hit = list(rule), covered(rule, x)
    while hit.any() and not y[hit].all() and y[hit].any():
        test = _best_test(x[hit], y[hit])
        if test is None:
            break
        rule.append(test)
        hit &= test.holds(x)
    return rule


def _prune(rule: list[Test], x: np.ndarray, y: np.ndarray) -> list[Test]:
    """Cuts final tests while the error on rows not used for growing doesn't rise."""

    def worth(r: list[Test]) -> float:
        hit = covered(r, x)
        p, n = int(y[hit].sum()), int((~y[hit]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def _box(row: np.ndarray) -> list[Test]:
    """The rule of one row's values only."""
    return [Test(i, sign, float(v)) for i, v in enumerate(row) for sign in ("<=", ">=")]


def _widened(rule: list[Test], x: np.ndarray, y: np.ndarray) -> list[Test]:
    """The rule as general as the rows allow: tests that keep no row of the other class out are dropped, the others are moved
    outward up to the first such row. Each goes to the simplest threshold between it and the last row of the own class."""
    rule = list(rule)
    for test in list(rule):
        others = [t for t in rule if t is not test]
        hit = covered(others, x)
        if y[hit].all():
            rule = others
            continue
        low = test.sign[0] == "<"
        column = x[hit, test.feature] * (1 if low else -1)  # the test holds for small values
        first_false = column[~y[hit]].min()
        own = column[y[hit] & (column < first_false)]
        if len(own):
            a, b = float(own.max()), float(first_false)
            wider = _between(test.feature, a, b) if low else _between(test.feature, -a, -b)
            rule[rule.index(test)] = wider
    return rule


def induce(x: np.ndarray, y: np.ndarray, seed: int = 1) -> list[list[Test]]:
    """Rules for the true class, in order, that cover all its rows and no other.

    Each is grown on two thirds of the rows left and pruned on the rest; since the labels have no noise, a rule that still
    covers a row of the other class anywhere in the sample is specialised on the whole sample, then widened as far as the
    sample allows. Covered rows are then taken away. Where growing fails, the rule is begun anew from the values of one true
    row left, so every round covers one at least and the list ends when none is left. A row whose values a row of the
    other class has too is left out."""
    rng = np.random.default_rng(seed)
    rules: list[list[Test]] = []
    false = {r.tobytes() for r in x[~y]}
    left = y & np.array([r.tobytes() not in false for r in x], bool) if len(y) else y
    while left.any():
        rows = np.flatnonzero(left | ~y)
        rng.shuffle(rows)
        grow, prune = rows[: -(-2 * len(rows) // 3)], rows[-(-2 * len(rows) // 3) :]
        if not y[grow].any():
            grow = rows
        rule = _prune(_grow(x[grow], y[grow], []), x[prune], y[prune])
        rule = _grow(x[rows], y[rows], rule)
        hit = covered(rule, x)
        if (hit & ~y).any() or not (hit & left).any():
            rule = _box(x[np.flatnonzero(left)[0]])
        rule = _widened(rule, x, y)
        rules.append(rule)
        left &= ~covered(rule, x)
    return rules


def to_sql(rules: list[list[Test]], names: list[str], yes: str, no: str) -> str:
    """The list as a CASE expression over columns of doubles."""
    if not rules:
        return f"'{no}'"
    lines = [" AND ".join(f"{names[t.feature]} {t.sign} {t.threshold!r}D" for t in rule) or "true" for rule in rules]
    return "CASE " + " ".join(f"WHEN {line} THEN '{yes}'" for line in lines) + f" ELSE '{no}' END"
