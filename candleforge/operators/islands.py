"""Runs of equal or true rows within a series, and states that follow them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleforge.operators.series import by_series
from candleforge.schema import KEY, by_time, so_far


def runs(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds {name}_id, which rises where value changes, and {name}_n, the row's place in its run."""
    changed = F.when(F.lag(value).over(by_time()).eqNullSafe(F.col(value)) & (F.row_number().over(by_time()) > 1), 0).otherwise(1)
    marked = df.withColumn("__changed", changed).withColumn(f"{name}_id", F.sum("__changed").over(so_far())).drop("__changed")
    return marked.withColumn(f"{name}_n", F.row_number().over(Window.partitionBy(*KEY, f"{name}_id").orderBy("ts")))


def in_long_run(df: DataFrame, flag: str, least: int, name: str) -> DataFrame:
    """Adds a boolean: the row is in a run of at least so many true rows."""
    marked = runs(df, flag, "__run")
    size = F.count("*").over(Window.partitionBy(*KEY, "__run_id"))
    return marked.withColumn(name, F.col(flag) & (size >= least)).drop("__run_id", "__run_n")

def _previous(values: np.ndarray, before: float | None) -> np.ndarray:
    return np.concatenate([[np.nan if before is None else before], values[:-1]])


def filled(values: np.ndarray, before: float) -> np.ndarray:
    """Each NaN as the last number before it."""
    at = np.maximum.accumulate(np.where(np.isnan(values), -1, np.arange(len(values))))
    return np.where(at >= 0, values[at], before)


def _place(begins: np.ndarray, before: int) -> np.ndarray:
    """How many rows each one's run has up to it, the rows of an open run before included."""
    n = np.arange(len(begins))
    at = np.maximum.accumulate(np.where(begins, n, -1))
    return np.where(at >= 0, n - at + 1, n + 1 + before)


@dataclass
class RunLength:
    """The number of true rows up to here since the last false one; a series' first row counts 0."""

    flag: str
    name: str

    def __post_init__(self):
        self.reads, self.adds = [self.flag], [self.name]

    def __call__(self, cols, state):
        down = ~(cols[self.flag] > 0)
        if state is None:
            down[0] = True
        run = _place(down, state or 0) - 1.0
        run += ~np.maximum.accumulate(down)  # before the first false row there's none to count from
        return {self.name: run}, int(run[-1])


@dataclass
class ConfirmedSign:
    """The sign of value where it has held for at least so many rows, else 0."""

    value: str
    least: int
    name: str
    carry_zero: bool

    def __post_init__(self):
        self.reads, self.adds = [self.value], [self.name]

    def __call__(self, cols, state):
        before, held = state or (None, 0)
        sign = np.sign(np.nan_to_num(cols[self.value], nan=0.0))
        if self.carry_zero:
            sign = filled(np.where(sign == 0, np.nan, sign), np.nan if before is None else before)
        last = _previous(sign, before)
        same = (sign == last) | (np.isnan(sign) & np.isnan(last))
        same[0] &= state is not None
        n = _place(~same, held)
        return {self.name: np.where(n >= self.least, sign, 0.0 * np.abs(sign))}, (sign[-1], int(n[-1]))


@dataclass
class Cooldown:
    """The locked signal: after a switch at row i, the next is possible from row i + rows + 1 on.

    Within a run of equal signals the locked value changes at most once, at the run's start or when the lock ends.
    """

    signal: str
    rows: int
    name: str

    def __post_init__(self):
        self.reads, self.adds = [self.signal], [self.name]

    def __call__(self, cols, state):
        sig = cols[self.signal]
        now, free = state or (float(sig[0]), 0)  # free: rows until the lock ends
        heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        out = np.empty(len(sig))
        for a, b, x in zip(heads.tolist(), [*heads[1:].tolist(), len(sig)], sig[heads].tolist(), strict=True):
            since = max(a, free)
            if x == x and x != now and since < b:
                out[a:since], out[since:b] = now, x
                now, free = x, since + self.rows + 1
            else:
                out[a:b] = now
        return {self.name: out}, (now, max(0, free - len(sig)))


@dataclass
class RollingQuantile:
    """The q-quantile, linear between neighbours, of the numbers among the last n rows, where there are at least so many."""

    x: str
    q: float
    n: int
    least: int
    name: str

    def __post_init__(self):
        self.reads, self.adds = [self.x], [self.name]

    def __call__(self, cols, state):
        x = np.concatenate([np.full(self.n - 1, np.nan) if state is None else state, cols[self.x]])
        out = np.empty(len(cols[self.x]))
        for a in range(0, len(out), 4096):
            rows = np.sort(np.lib.stride_tricks.sliding_window_view(x[a : a + 4096 + self.n - 1], self.n), axis=1)  # NaNs come last
            have = (~np.isnan(rows)).sum(axis=1)
            place = np.maximum(have - 1, 0) * self.q
            low = np.floor(place).astype(int)
            at = np.arange(len(rows))
            lower, higher = rows[at, low], rows[at, np.ceil(place).astype(int)]
            value = np.where(lower == higher, lower, (low + 1 - place) * lower + (place - low) * higher)
            out[a : a + 4096] = np.where(have >= self.least, value, np.nan)
        return {self.name: out}, x[len(x) - self.n + 1 :]


@dataclass
class Each:
    """What follows from a row alone."""

    reads: list[str]
    adds: list[str]
    f: Callable[..., tuple[np.ndarray, ...]]

    def __call__(self, cols, state):
        return dict(zip(self.adds, self.f(*(cols[c] for c in self.reads)), strict=True)), None


def run_length(df: DataFrame, flag: str, name: str) -> DataFrame:
    """Adds the number of true rows up to here since the last false one; the first row counts 0."""
    return by_series(df, [RunLength(flag, name)])


def confirmed_sign(df: DataFrame, value: str, least: int, name: str, carry_zero: bool) -> DataFrame:
    """Adds the sign of value where it has held for at least so many rows, else 0.

    carry_zero: a 0 (or NULL) inherits the sign before it; otherwise it is a sign of its own. Rows that
    have no sign to inherit are NULL.
    """
    return by_series(df, [ConfirmedSign(value, least, name, carry_zero)])


def cooldown(df: DataFrame, signal: str, rows: int, name: str) -> DataFrame:
    """Adds the locked signal: after a switch at row i, the next is possible from row i + rows + 1 on. A NULL switches nothing."""
    return by_series(df, [Cooldown(signal, rows, name)])
