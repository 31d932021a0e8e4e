"""Quality score of documents by a generalised additive model with pairwise interactions.

Each document becomes FEATURES numbers about its characters, words and lines. Boosting goes
round the features in cycles; each step fits a shallow tree on the binned values of one
feature to the residuals and adds a part of it to the feature's lookup table. Then pairs of
features whose coarse joint bins explain most of what is left get tables by the same cycles.
A score is the logistic of the sum of the looked-up entries, taken for whole batches at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.labelled import labelled_sample
from shelfspark.llm.words import as_bytes, id_and_text, is_held_out

SAMPLE = 20_000  # labelled documents that the model learns from, at most
BINS, PAIR_BINS, PAIRS = 64, 8, 10
CYCLES, PAIR_CYCLES, RATE, LEAVES, LEAST = 150, 60, 0.1, 4, 5

FEATURES = (
    "log_chars", "log_words", "mean_word", "longest_word", "share_space", "share_upper", "share_digit", "share_high",
    "share_point", "share_excited", "share_symbol", "share_bar", "share_bracket", "words_with_symbol", "words_upper",
    "words_short", "words_alpha", "distinct_words", "top_word", "top_pair", "same_next_word", "entropy_chars",
    "log_lines", "mean_line", "distinct_lines", "lines_ended", "lines_bulleted", "compressed",
)


def _of(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _DIGIT, _SPACES = _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of("0123456789"), _of(" \t\n\r\x0b\x0c")
_POINT, _EXCITED, _SYMBOL, _BAR, _BRACKET = _of(".,;:"), _of("!?"), _of("#$%&*@^~=+<>_\\/"), _of("|"), _of("()[]{}")
_HIGH = np.arange(256) >= 128
_MARKS = b"!?#$%&*@^~=+<>_\\/|"


def features(text: bytes) -> list[float]:
    """FEATURES of one text; all ratios are 0 where there is nothing to count."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts / max(n, 1)
    words = text.split()
    m = len(words)
    m1 = max(m, 1)
    lengths = np.fromiter(map(len, words), np.int64, m)
    often = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [x for x in text.split(b"\n") if x.strip()]
    k1 = max(len(lines), 1)
    seen = share[share > 0]
    marked = sum(c for w, c in often.items() if w[-1:] in _MARKS_SET or w[:1] in _MARKS_SET)
    shouted = sum(c for w, c in often.items() if len(w) > 1 and w.isupper())
    plain = sum(c for w, c in often.items() if w.isalpha())
    return [
        np.log1p(n), np.log1p(m), lengths.mean() if m else 0, lengths.max() if m else 0, share[_SPACES].sum(), share[_UPPER].sum(),
        share[_DIGIT].sum(), share[_HIGH].sum(), share[_POINT].sum(), share[_EXCITED].sum(), share[_SYMBOL].sum(), share[_BAR].sum(),
        share[_BRACKET].sum(), marked / m1, shouted / m1, (lengths <= 3).sum() / m1, plain / m1, len(often) / m1,
        max(often.values(), default=0) / m1, max(pairs.values(), default=0) / m1,
        sum(c for (a, b), c in pairs.items() if a == b) / m1, float(-(seen * np.log2(seen)).sum()), np.log1p(len(lines)),
        n / k1, len(set(lines)) / k1, sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":") for x in lines) / k1,
        sum(x.lstrip()[:1] in (b"-", b"*", b"|") for x in lines) / k1, len(zlib.compress(text, 1)) / max(n, 1),
    ]


_MARKS_SET = frozenset(bytes([x]) for x in _MARKS)


@dataclass
class AdditiveModel:
    """Bin edges and tables; ``pairs`` maps two features to a table over their coarse bins."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for (i, j), table in self.pairs.items():
            a, b = (np.searchsorted(self.coarse[f], x[:, f], "right") for f in (i, j))
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int) -> np.ndarray:
    """Value of each bin in a tree of a few leaves, grown best split first on bin sums."""
    parts, out = [(0, len(g))], np.zeros(len(g))
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for lo, hi in parts:
            if hi - lo < 2:
                continue
            cg, ch, cn = (np.cumsum(v[lo:hi]) for v in (g, h, n))
            left, right = (cg[:-1], ch[:-1], cn[:-1]), (cg[-1] - cg[:-1], ch[-1] - ch[:-1], cn[-1] - cn[:-1])
            gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - cg[-1] ** 2 / (ch[-1] + 1)
            gain[(left[2] < LEAST) | (right[2] < LEAST)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], (lo, hi), lo + at + 1)
        if best[1] is None:
            break
        lo, hi = best[1]
        parts.remove((lo, hi))
        parts += [(lo, best[2]), (best[2], hi)]
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boost the tables on features and 0/1 labels. With one label only, its share is the score."""
    rate = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(rate / (1 - rate))))
    if len(set(y.tolist())) < 2:
        return model
    model.edges = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    model.coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(CYCLES):
        for b, table in zip(bins, model.tables, strict=True):
            g, h = residuals()
            step = RATE * _tree(*(np.bincount(b, v, len(table)) for v in (g, h, np.ones(len(y)))), LEAVES)
            table += step
            total += step[b]

    g, h = residuals()
    gains = {}
    for i, j in combinations(range(x.shape[1]), 2):
        cell = coarse[i] * PAIR_BINS + coarse[j]
        gains[i, j] = (np.bincount(cell, g) ** 2 / (np.bincount(cell, h) + 1)).sum()
    chosen = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pairs = {pair: np.zeros((PAIR_BINS, PAIR_BINS)) for pair in chosen}
    for _ in range(PAIR_CYCLES):
        for (i, j), table in model.pairs.items():
            g, h = residuals()
            cell = coarse[i] * PAIR_BINS + coarse[j]
            sums = [np.bincount(cell, v, PAIR_BINS**2).reshape(table.shape) for v in (g, h, np.ones(len(y)))]
            # one cut of the first feature, and on each side a shallow tree of the second
            rows = _tree(*(v.sum(1) for v in sums), 2)
            at = int(np.flatnonzero(np.diff(rows))[0]) + 1 if len(set(rows)) > 1 else PAIR_BINS // 2
            for part in (slice(0, at), slice(at, None)):
                step = RATE * _tree(*(v[part].sum(0) for v in sums), 2)
                table[part] += step
            total = _total(model, bins, coarse, total.shape)
    return model


def _total(model: AdditiveModel, bins: list, coarse: list, shape) -> np.ndarray:
    out = np.full(shape, model.base)
    for b, table in zip(bins, model.tables, strict=True):
        out += table[b]
    for (i, j), table in model.pairs.items():
        out += table[coarse[i], coarse[j]]
    return out


def _measure(batches: Iterator[pa.RecordBatch], model=None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([features(t) for t in as_bytes(batch.column("text"))]).reshape(-1, len(FEATURES))
        if model is None:
            last, name = pa.array(x.tolist(), pa.list_(pa.float64())), "features"
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), last, batch.column("label")], ["doc_id", name, "label"])
        else:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(x))], ["doc_id", "score"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> AdditiveModel:
    """Model from at most SAMPLE labelled documents, none of them held out; only their features
    come to the driver."""
    rows = labelled_sample(docs, labels, label_col, SAMPLE, id_col, text_col)
    found = rows.mapInArrow(_measure, "doc_id long, features array<double>, label int").orderBy("doc_id", "features").collect()
    x = np.array([r.features for r in found]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.label for r in found], np.int64))


def quality_scores(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row; the score is a probability of label 1.

    A null text is empty; an empty one is scored by its features like any other. Rows that
    repeat an id, or have none, are scored one by one; a null id isn't held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = id_and_text(docs, id_col, text_col).mapInArrow(partial(_measure, model=shared), "doc_id long, score double")
    return found.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
