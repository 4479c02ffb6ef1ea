"""Ordered rules of threshold conjunctions, learned by sequential covering, as Spark expressions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    bound: float

    def holds(self, column: np.ndarray) -> np.ndarray:
        return column >= self.bound if self.above else column < self.bound

    def expression(self) -> Column:
        return F.col(self.name) >= F.lit(self.bound) if self.above else F.col(self.name) < F.lit(self.bound)


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    rows = np.ones(n, bool)
    for condition in rule:
        rows &= condition.holds(table[condition.name])
    return rows


def _bounds(column: np.ndarray, cuts: int) -> np.ndarray:
    """Thresholds halfway between neighbouring values, at quantiles where there are many."""
    values = np.unique(column)
    if len(values) > cuts:
        values = np.unique(np.quantile(values, np.linspace(0, 1, cuts)))
    return (values[1:] + values[:-1]) / 2


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, cuts: int, longest: int) -> Rule:
    """Add the condition with the highest information gain until only bad rows are covered."""
    rule: list[Condition] = []
    rows = rows.copy()
    while len(rule) < longest:
        p, n = (rows & bad).sum(), (rows & ~bad).sum()
        if not p or not n:
            break
        base = np.log2(p / (p + n))
        best, gain = None, 1e-9
        for name, column in table.items():
            for bound in _bounds(column[rows], cuts):
                for above in (True, False):
                    condition = Condition(name, above, float(bound))
                    now = rows & condition.holds(column)
                    q, m = (now & bad).sum(), (now & ~bad).sum()
                    if q and (value := q * (np.log2(q / (q + m)) - base)) > gain:
                        best, gain = condition, value
        if best is None:
            break
        rule.append(best)
        rows &= best.holds(table[best.name])
    return tuple(rule)


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Drop conditions from the end as long as the rule gets no worse on rows it wasn't grown on."""

    def worth(candidate: Rule) -> float:
        covered = rows & _covered(candidate, table, len(bad))
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for length in range(len(rule) - 1, 0, -1):
        if worth(rule[:length]) >= worth(best):
            best = rule[:length]
    return best


def sequential_covering(
    table: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, cuts: int = 48, longest: int = 4,
    most_rules: int = 24, seed: int = 9,
) -> list[Rule]:
    """Rules for the bad rows, in order of discovery.

    Each rule is grown on two thirds of the rows that no earlier rule covers and pruned on
    the others; learning ends with the first rule that covers no bad row there or whose
    share of bad rows among all it covers is under ``precision``.
    """
    n = len(bad)
    growing = np.random.default_rng(seed).random(n) < 2 / 3
    left, rules = np.ones(n, bool), []
    while len(rules) < most_rules and (left & bad).any():
        rule = _grow(table, bad, left & growing, cuts, longest)
        if not rule:
            break
        rule = _prune(rule, table, bad, left & ~growing)
        covered = left & _covered(rule, table, n)
        hits = (covered & bad).sum()
        if hits < 2 or hits < precision * covered.sum():
            break
        rules.append(rule)
        left &= ~covered
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, null if none does."""
    if not rules:
        return F.lit(None).cast("int")
    chain = None
    for number, rule in enumerate(rules):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.expression()
        chain = F.when(holds, number) if chain is None else chain.when(holds, number)
    return chain
