"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell, that is by source, language and topic. Raking scales the cells'
weights to one marginal after the other until all hold. Without a budget the weights, divided
by the largest, are the probabilities with which the documents of a cell are kept, so the
expected tokens of the sample have the target marginals, and the smallest cell may decide how
many these are. With a budget the expected tokens are given: cells that would need more than
they have are kept whole, and the others are raked to what is left. Whether a document is kept follows from a hash of its
id, so a task that runs again decides alike.

With given targets, categories are those that they name and ``other``, so the cells are at
most the product of these numbers. With shares tempered by powers every value is a category
of its own, null included; the driver then rakes all cells that occur, as a hash for each
column and two numbers, and the documents meet them in a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.session import staged

OTHER = "other"
MOST_CELLS = 1_000_000
ROUNDS, CLOSE = 1000, 1e-10

Targets = Mapping[str, Mapping[str, float]]


def n_words(text: Column) -> Column:
    """Words of a text, which stand for its tokens; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def form_topic(text: Column) -> Column:
    """A topic by the form of a text: table, shouting, symbols, licence, note or prose."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(t.contains(" | "), "table")
        .when(t.contains("!! "), "shouting")
        .when(t.rlike(r"[$%&*#]{3}"), "symbols")
        .when(t.contains("License") | t.contains("rights reserved"), "licence")
        .when(~t.contains("\n"), "note")
        .otherwise("prose")
    )


def tempered_targets(docs: DataFrame, powers: Mapping[str, float], tokens: str, most: int = 50) -> dict[str, dict[str, float]]:
    """Targets that flatten the present shares of tokens: each to its column's power, then scaled to 1.

    Of each column the ``most`` largest categories are named. The others stay together as one,
    whose share is the sum of theirs; :func:`fit_tempered` keeps them apart.
    """
    out = {}
    for c, power in powers.items():
        sums = docs.groupBy(F.col(c).cast("string").alias("k")).agg(F.sum(tokens).alias("n")).where("n > 0").select("k", F.pow("n", F.lit(power)).alias("p"), "n")
        top = {r.k: r.p for r in sums.where("k is not null").orderBy(F.desc("n"), "k").limit(most).collect()}
        rest = sums.where(F.col("k").isNull() | ~F.col("k").isin(list(top))).agg(F.sum("p")).first()[0] or 0.0
        flat = top | ({OTHER: top.get(OTHER, 0.0) + rest} if rest > 0 else {})
        out[c] = {k: v / sum(flat.values()) for k, v in flat.items()}
    return out


def rake(tokens: np.ndarray, members: Sequence[np.ndarray], shares: Sequence[np.ndarray]) -> np.ndarray:
    """Weights of cells with which their ``tokens`` have the ``shares`` along each marginal.

    ``members`` has the category of each cell, one array per marginal. Categories without
    tokens can't have a share; the others' are scaled to 1. Where the marginals contradict
    each other for want of cells, the last round's weights are returned.
    """
    goals = []
    for at, share in zip(members, shares, strict=True):
        there = np.bincount(at, tokens, len(share)) > 0
        goal = np.where(there, share, 0.0)
        goals.append(goal / goal.sum() if goal.sum() > 0 else there / max(1, there.sum()))
    weights = np.full(len(tokens), 1 / max(tokens.sum(), 1e-300))
    for _ in range(ROUNDS):
        off = 0.0
        for at, goal in zip(members, goals, strict=True):
            now = np.bincount(at, weights * tokens, len(goal))
            factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            off = max(off, float(np.abs(now - goal).max()))
            weights *= factor[at]
        if off < CLOSE:
            break
    return weights


def _filled(have: np.ndarray, share: np.ndarray, budget: float) -> np.ndarray:
    """``budget`` tokens dealt by ``share``, but no category more than it has; the others get its rest."""
    goal, whole = np.zeros(len(have)), np.zeros(len(have), bool)
    while True:
        free = np.where(whole, 0.0, share)
        left = budget - have[whole].sum()
        goal = np.where(whole, have, free * (max(0.0, left) / free.sum() if free.sum() > 0 else 0.0))
        over = ~whole & (goal > have)
        if not over.any():
            return goal
        whole |= over


def rake_within(tokens: np.ndarray, members: Sequence[np.ndarray], shares: Sequence[np.ndarray], budget: float) -> np.ndarray:
    """Probabilities of cells, at most 1, with which ``budget`` tokens are expected, with the ``shares`` as far as there are tokens.

    Where a category's share is more than it has, it is kept whole. Cells that reach 1 stay
    there, and the others are raked to what is left, until none is above. The budget is no
    more than the categories with a share have. Where marginals contradict each other, raking
    ends when it gains nothing more; the budget then holds, the shares as near as that came, and no
    cell with a share gets less than about a hundredth of the budget's part of all tokens.
    """
    have = [np.bincount(at, tokens, len(share)) for at, share in zip(members, shares, strict=True)]
    budget = min([budget, *(h[share > 0].sum() for h, share in zip(have, shares, strict=True))])
    if budget <= 0:
        return np.zeros(len(tokens))
    goals = [_filled(h, np.where(h > 0, share, 0.0), budget) for h, share in zip(have, shares, strict=True)]
    least = 0.01 * budget / tokens.sum()
    loose, p = tokens > 0, np.full(len(tokens), budget / tokens.sum())
    while loose.any():
        n, at = tokens[loose], [m[loose] for m in members]
        left, rest = budget - tokens[~loose].sum(), []
        for a, m, goal in zip(at, members, goals, strict=True):
            free = np.bincount(a, n, len(goal))
            r = np.where((free > 0) & (goal > 0), np.maximum(goal - np.bincount(m[~loose], tokens[~loose], len(goal)), least * free), 0.0)
            rest.append(r * (left / r.sum() if r.sum() > 0 else 0.0))
        x, before = p[loose], np.inf
        for turn in range(ROUNDS):
            off = 0.0
            for a, goal in zip(at, rest, strict=True):
                now = np.bincount(a, n * x, len(goal))
                x = x * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[a]
                off = max(off, float(np.abs(now - goal).max()) / budget)
            if off < CLOSE:
                break
            if turn % 20 == 19:
                if off > 0.9 * before:
                    break
                before = off
        if off >= CLOSE:
            x = np.where(x > 0, np.maximum(x, least), 0.0)
        p[loose] = np.minimum(1.0, x)
        if not (x > 1 + 1e-9).any():
            break
        loose[loose] = x < 1
    loose = (tokens > 0) & (p < 1)
    kept = float((p * tokens)[loose].sum())
    if kept > 0:
        p[loose] = np.minimum(1.0, p[loose] * (budget - tokens[~loose].sum()) / kept)
    return p


def _weighed(n: np.ndarray, members: Sequence[np.ndarray], shares: Sequence[np.ndarray], budget: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each cell, 1 on the average of tokens, and probability."""
    if budget is None:
        weights = rake(n, members, shares) if len(n) else n
        top = weights[n > 0].max(initial=0.0)
        probability = np.minimum(1.0, weights / top) if top > 0 else weights * 0.0
    else:
        weights = probability = rake_within(n, members, shares, budget) if len(n) else n
    kept = float((weights * n).sum())
    return np.where(n > 0, weights * (n.sum() / kept if kept > 0 else 0.0), 0.0), np.where(n > 0, probability, 1.0)


def _category(column: str, named: Sequence[str]) -> Column:
    value = F.col(column).cast("string")
    return F.when(value.isin(list(named)), value).otherwise(F.lit(OTHER))


@dataclass(frozen=True)
class Mix:
    """Weight and probability of each cell; ``names`` has the categories of each column."""

    names: dict[str, list[str]]
    cells: list[tuple]

    def keys(self) -> dict[str, Column]:
        return {f"_mix_{i}": _category(c, names) for i, (c, names) in enumerate(self.names.items())}

    def applied(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``mix_weight`` and ``mix_probability``; the cells are few, as MOST_CELLS bounds them."""
        keys = self.keys()
        schema = ", ".join([*(f"{k} string" for k in keys), "mix_weight double", "mix_probability double"])
        table = F.broadcast(docs.sparkSession.createDataFrame(self.cells, schema))
        return docs.withColumns(keys).join(table, list(keys)).drop(*keys)


def fit_mix(docs: DataFrame, targets: Targets, tokens: str, budget: float | None = None) -> Mix:
    """Weights and probabilities of the cells of ``docs``.

    A category that the targets of its column don't name, null included, is ``other``, which
    gets what the named shares leave of 1, or its own target if that is named. ``budget`` is
    the number of tokens wanted, dealt as :func:`rake_within` says; without it the sample is
    the largest with exactly these shares.
    Documents of cells without tokens have weight 0 and are kept, as they weigh nothing.
    """
    names = {c: sorted({str(k) for k in t} | {OTHER}) for c, t in targets.items()}
    if np.prod([float(len(n)) for n in names.values()]) > MOST_CELLS:
        raise ValueError(f"targets make more than {MOST_CELLS} cells")
    keys = Mix(names, []).keys()
    summed = docs.withColumns(keys).groupBy(*keys).agg(F.sum(tokens).alias("n")).collect()
    cells = sorted((tuple(r[k] for k in keys), float(r["n"] or 0)) for r in summed)
    n = np.array([v for _, v in cells])
    members, shares = [], []
    for i, (c, named) in enumerate(names.items()):
        members.append(np.array([named.index(k[i]) for k, _ in cells], np.int64))
        given = {str(k): float(v) for k, v in targets[c].items()}
        given.setdefault(OTHER, max(0.0, 1 - sum(given.values())))
        shares.append(np.array([given[k] for k in named]))
    found = _weighed(n, members, shares, budget)
    return Mix(names, [(*k, w, p) for (k, _), w, p in zip(cells, *(x.tolist() for x in found), strict=True)])


@dataclass(frozen=True)
class CellMix:
    """Weight and probability of each cell of ``columns``, told by the hashes of their values."""

    columns: list[str]
    cells: pa.Table

    def keys(self) -> dict[str, Column]:
        return {f"_mix_{i}": F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.xxhash64(F.col(c).cast("string"))) for i, c in enumerate(self.columns)}

    def applied(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``mix_weight`` and ``mix_probability``."""
        keys = self.keys()
        table = staged(docs.sparkSession.createDataFrame(self.cells), "mix-cells")
        return docs.withColumns(keys).join(table, list(keys)).drop(*keys)


def fit_tempered(docs: DataFrame, powers: Mapping[str, float], tokens: str, part: float) -> CellMix:
    """Weights and probabilities of the cells of ``docs`` with flattened shares of tokens.

    The share of each value of a column, null included, is its present one to the column's
    power, scaled so that all make 1. The sample's expected tokens are ``part`` of all; what
    would need more than it has is kept whole. Documents of cells without tokens have weight 0 and
    are kept.
    """
    keys = CellMix(list(powers), pa.table({})).keys()
    summed = docs.withColumns(keys).groupBy(*keys).agg(F.coalesce(F.sum(tokens), F.lit(0)).cast("double").alias("n")).toArrow()
    summed = summed.sort_by([(k, "ascending") for k in keys])
    n = summed.column("n").to_numpy()
    members, shares = [], []
    for k, power in zip(keys, powers.values(), strict=True):
        members.append(np.unique(summed.column(k).to_numpy(), return_inverse=True)[1])
        have = np.bincount(members[-1], n)
        flat = np.where(have > 0, np.maximum(have, 1e-300) ** power, 0.0)
        shares.append(flat / max(flat.sum(), 1e-300))
    weight, probability = _weighed(n, members, shares, part * float(n.sum()))
    cells = {k: summed.column(k) for k in keys} | {"mix_weight": pa.array(weight), "mix_probability": pa.array(probability)}
    return CellMix(list(powers), pa.table(cells))


def kept_by_hash(probability: Column, id_col: str, text_col: str, seed: int = 1) -> Column:
    """Whether a document is in the sample; a row without id is told apart by its text."""
    value = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.lit(seed), F.col(id_col))).otherwise(F.xxhash64(F.lit(seed), F.col(text_col)))
    return F.shiftrightunsigned(value, 11) / F.lit(float(1 << 53)) < probability


def mix(
    docs: DataFrame, targets: Targets, tokens: str, budget: float | None = None, id_col: str = "doc_id", text_col: str = "text", seed: int = 1
) -> DataFrame:
    """``docs`` with ``mix_weight``, ``mix_probability`` and ``mix_kept``.

    Rows that repeat an id are kept or left together if they are of one cell. An empty table
    gives an empty result.
    """
    weighed = fit_mix(docs, targets, tokens, budget).applied(docs)
    return weighed.withColumn("mix_kept", kept_by_hash(F.col("mix_probability"), id_col, text_col, seed))
