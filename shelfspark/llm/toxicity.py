"""Toxicity by a support vector machine on a gapped string kernel with Nystrom landmarks.

A unit is a word, or a run of single letters written apart, as letters only. The kernel of
two units sums over the subsequences of four letters that both have, each occurrence weighted
by DECAY to the power of the letters it spans, up to SPAN of them, so a unit with letters
inserted or left out stays close to the plain one. Both ends of a unit count as a letter.
Units are divided by the norm that a unit of that length with distinct letters has.

Units near a sample of landmarks get Nystrom features and a linear machine in these. Its
decision is linear in the kernel with the landmarks, which is linear in the weights of a
unit's subsequences: a model is one weight for each four letters, and a unit's score the
sum over its subsequences.

There are two machines. Some units make a text toxic by themselves: by the first machine a
text is as toxic as its worst unit. Others do so in company only, as clean texts have one like
them now and then: by the second machine a text is as toxic as the second worst of its
different units. The worse of the two decides.

Labels are those of whole documents. Which of their units make them toxic, alone or in
company, is found from how they set toxic documents apart; the machines learn those against
units of clean documents, in turns that add the clean units that looked worst.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.labelled import labelled_sample
from shelfspark.llm.words import as_bytes, id_and_text, is_held_out, mixed

SAMPLE = 2500  # labelled documents of each label that the model learns from, at most
SPAN, DECAY = 7, 0.7
LANDMARKS = 250
TURNS = 3
LONGEST = 24  # letters of a unit; longer ones are cut into overlapping windows
REMEMBERED = 400_000  # a worker forgets the scores of words beyond this many; results don't depend on it

# letters that stand for others inside words
_LOOKS = str.maketrans("0134578@$€áàâãåéèêëíìîïóòôõúùûçñýÿ", "oieastbase" + "aaaaa" + "eeee" + "iiii" + "oooo" + "uuu" + "cnyy")
_LETTER = {chr(ord("a") + i): i + 1 for i in range(26)} | {"ä": 27, "ö": 28, "ü": 29}
_END, _OTHER = 30, 31
_POINTS = ".,;:!?\"'()[]{}|#%&<>…«»“”"
_APART = re.compile(r"(?<!\S)(?:[^\W\d_][ .*_-]+){2,}[^\W\d_](?!\S)")
_OFFSETS = [(i, j, k) for k in range(3, SPAN) for j in range(2, k) for i in range(1, j)]


def units_of(word: str) -> list[str]:
    """Letters of a word, in windows of at most LONGEST; none where fewer than three are left."""
    letters = word.lower()
    if not letters.isalpha():
        letters = letters.strip(_POINTS)
    if not (letters.isalpha() and letters.isascii()):
        if not any(map(str.isalpha, letters)):
            return []
        letters = "".join(filter(str.isalpha, letters.translate(_LOOKS)))
    if len(letters) < 3:
        return []
    if len(letters) <= LONGEST:
        return [letters]
    return [letters[i : i + LONGEST] for i in range(0, len(letters) - LONGEST // 2, LONGEST // 2)]


def words_of(text: str) -> set[str]:
    """Distinct words of a text and its runs of single letters written apart."""
    found = set(text.split())
    # a run of letters worth looking at has three that differ
    if sum(len(w) == 1 and w.isalpha() for w in found) >= 3:
        found.update("".join(m.split()) for m in _APART.findall(text))
    return found


def _letter_codes() -> np.ndarray:
    out = np.full(0x250, _OTHER, np.int32)
    out[0] = 0
    for letter, code in _LETTER.items():
        out[ord(letter)] = code
    return out


_CODES = _letter_codes()


def _letters(units: list[str]) -> np.ndarray:
    """Codes of the units' letters between two ends, a row each, with room for SPAN zeros."""
    lengths = np.array([len(u) for u in units])
    width = int(lengths.max(initial=1))
    points = np.array(units, f"U{width}").view(np.uint32).reshape(len(units), width)
    out = np.zeros((len(units), width + 2 + SPAN), np.int32)
    out[:, 0] = _END
    out[:, 1 : width + 1] = _CODES[np.minimum(points, len(_CODES) - 1)]
    out[np.arange(len(units)), lengths + 1] = _END
    return out


def _self_norms() -> np.ndarray:
    """By the number of letters; shorter units than four count as four, so none is all one subsequence."""
    out = np.ones(LONGEST + 1)
    for n in range(LONGEST + 1):
        letters = max(n, 4) + 2
        out[n] = math.sqrt(sum(max(0, letters - k) * DECAY ** (2 * (k + 1)) for *_, k in _OFFSETS))
    return out


_NORMS = _self_norms()


def _codes(letters: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Codes of all subsequences with the same gaps, 0 beyond a unit's end, and their weight."""
    width = letters.shape[1] - SPAN
    for i, j, k in _OFFSETS:
        a, b, c, d = (letters[:, x : x + width] for x in (0, i, j, k))
        yield np.where(d > 0, (a << 15) | (b << 10) | (c << 5) | d, 0), DECAY ** (k + 1)


def kernel_features(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes that the units have, 0 first, and the units' normed weights of these."""
    found = list(_codes(_letters(units)))
    codes = np.unique(np.concatenate([[0], *(c.ravel() for c, _ in found)]))
    out = np.zeros((len(units), len(codes)), np.float32)
    rows = np.arange(len(units))[:, None]
    for code, weight in found:
        np.add.at(out, (rows, np.searchsorted(codes, code)), weight)
    out[:, 0] = 0
    return codes, out / _NORMS[[len(u) for u in units]][:, None]


def sums(units: list[str], table: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """For each unit the normed sum of its subsequences' rows of ``table``; row 0 must be 0.

    ``place`` leads from a code to its row where the table has fewer rows than there are codes.
    """
    out = np.zeros((len(units), *table.shape[1:]), np.result_type(table, np.float64))
    lengths = np.array([len(u) for u in units], np.int64)
    order = np.argsort(lengths, kind="stable")
    step = 4096 if table.ndim == 1 else 256
    for at in range(0, len(units), step):
        which = order[at : at + step]
        got = 0
        for code, weight in _codes(_letters([units[i] for i in which])):
            got = got + weight * table[code if place is None else place[code]].sum(1)
        norms = _NORMS[lengths[which]]
        out[which] = got / (norms if table.ndim == 1 else norms[:, None])
    return out


@dataclass
class ToxicModel:
    """Per machine one weight per four letters, and how a document's worst unit, or its second
    worst, becomes a probability.

    ``table`` has the first machine's weights as real parts, the second's as imaginary ones;
    ``slope`` and ``bias`` have an entry per machine. ``known`` has the scores of words that a
    worker has seen; they stay with their model.
    """

    table: np.ndarray
    slope: tuple[float, float]
    bias: tuple[float, float]
    known: dict[str, tuple[float, float]] = field(default_factory=dict, init=False, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def probability(self, worst: np.ndarray) -> np.ndarray:
        """Of rows of :func:`worst_units`; the worse of the machines' two."""
        z = np.clip(np.array(self.slope) * worst + np.array(self.bias), -30, 30)
        return (1 / (1 + np.exp(-z))).max(axis=1)


def _machine(x: np.ndarray, y: np.ndarray, c: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss and classes of equal weight, by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, ridge = np.zeros(x1.shape[1]), np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(25):
        inside = y * (x1 @ w) < 1
        xi, wi = x1[inside], (c * weight)[inside]
        new = np.linalg.solve(ridge + (xi * wi[:, None]).T @ xi, (xi * wi[:, None]).T @ y[inside])
        done = np.abs(new - w).max() < 1e-7
        w = new if done else 0.5 * (w + new) if not inside.any() else new
        if done:
            break
    return w[:-1], float(w[-1])


class _Landmarks:
    """Nystrom features: kernels with the landmarks times the root of their inverse kernel matrix."""

    def __init__(self, bad: list[str], good: list[str], seed: int) -> None:
        draw = np.random.default_rng(seed)
        marks = [*draw.permutation(bad)[: LANDMARKS * 3 // 5], *draw.permutation(good)[: LANDMARKS * 2 // 5]]
        self.codes, phi = kernel_features(list(dict.fromkeys(map(str, marks))))
        values, vectors = np.linalg.eigh(phi @ phi.T)
        keep = values > 1e-6 * values[-1]
        self.phi, self.half = phi.T, vectors[:, keep] / np.sqrt(values[keep])
        self.place = np.zeros(1 << 20, np.int32)
        self.place[self.codes] = np.arange(len(self.codes))

    def features(self, units: list[str]) -> np.ndarray:
        return sums(units, self.phi, self.place) @ self.half

    def table(self, w: np.ndarray) -> np.ndarray:
        """Weight of each code in the decision of a machine with weights ``w``."""
        out = np.zeros(1 << 20, np.float32)
        out[self.codes] = self.phi @ (self.half @ w)
        return out


def _stems(unit: str) -> set[str]:
    """The unit itself, how it begins, and its runs of five letters."""
    return {f"^{unit}$", "^" + unit[:4], "^" + unit[:5], *(unit[i : i + 5] for i in range(len(unit) - 4))}


def _shared_stems(units: list[str], doc: np.ndarray, company: int) -> list[str]:
    """Stems that so many of a document's units have, in an order that depends on the text alone."""
    if company == 1:
        return sorted({s for u in doc.tolist() for s in _stems(units[u])})
    counted = Counter(s for u in doc.tolist() for s in _stems(units[u]))
    return sorted(s for s, n in counted.items() if n >= company)


def telling_units(units: list[str], docs: list[np.ndarray], y: np.ndarray, company: int = 1) -> tuple[set[int], set[str]]:
    """Units by which toxic documents differ from clean ones, and their stems. With ``company``
    2 a document has a stem only where two of its units have it.

    Whole units of many toxic documents and no clean one come first. Then stems are chosen
    one by one: the one that most sets apart the toxic documents without a chosen stem, as
    long as it does so by clearly more than chance reaches among so many stems. So what
    merely looks like a telling unit, or shares its documents, isn't chosen, and documents
    that nothing tells apart teach nothing.
    """
    toxic = [d for d, v in zip(docs, y, strict=True) if v == 1]
    names: dict[str, int] = {}
    of_toxic = [np.array(sorted(names.setdefault(s, len(names)) for s in _shared_stems(units, d, company)), np.int32) for d in toxic]
    if not names:
        return set(), set()
    n1, n0 = len(toxic), int((y == 0).sum())
    c0, c1 = np.zeros(len(names)), np.zeros(len(names))
    for d in (d for d, v in zip(docs, y, strict=True) if v == 0):
        c0[[names[s] for s in _shared_stems(units, d, company) if s in names]] += 1
    for s in of_toxic:
        c1[s] += 1
    length = np.array([len(s) + 10 * s.endswith("$") for s in names])
    least = min(n0, n1)
    bar = 1.5 * math.sqrt(2 * math.log(max(2, len(names))))

    def apart() -> np.ndarray:
        return (c1 / n1 - 5 * c0 / n0) / np.sqrt((c0 + c1 + 1) / (n0 + n1) / least)

    # whole units that many toxic documents have, and no clean one
    sure = np.flatnonzero((apart() > 2 * bar) & (length > 10) & (c0 == 0))
    left, chosen = set(range(n1)), sure.tolist()
    for at, mine in enumerate(of_toxic):
        if np.isin(sure, mine).any():
            left.remove(at)
            c1[mine] -= 1
    while left:
        z = apart()
        best = int(np.lexsort((length, z))[-1])
        if z[best] <= bar or c1[best] < 5:
            break
        chosen.append(best)
        for at in [i for i in left if best in of_toxic[i]]:
            left.remove(at)
            c1[of_toxic[at]] -= 1
    taken = set(chosen)
    stems = {s for s, at in names.items() if at in taken}
    found = set()
    for d in toxic:
        mine = [u for u in d.tolist() if not stems.isdisjoint(_stems(units[u]))]
        found.update(mine if len(mine) >= company else [])
    return found, stems


def _one_of_copies(docs: list[np.ndarray]) -> list[int]:
    """Places of documents without those that share most units with an earlier one, by MinHash:
    of documents with nine tenths of their units in common all but 3 in 100 are found, of those
    with three tenths, such as two of one language, 1 in 100 is left out."""
    draw = np.random.default_rng(3)
    times = draw.integers(0, 1 << 62, (4, 5), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    seen, out = set(), []
    for at, d in enumerate(docs):
        keys = {(i, *(int((mixed((d.astype(np.uint64) + np.uint64(1)) * t)).min()) for t in row)) for i, row in enumerate(times)} if len(d) else {at}
        if not keys & seen:
            out.append(at)
        seen |= keys
    return out


def _with_insertions(bad: list[str], known: set[str], seed: int) -> list[str]:
    """Units of five letters and more with a letter inserted, up to three for each, that no document has."""
    draw = np.random.default_rng(seed)
    out = set()
    for unit in (u for u in draw.permutation(bad).tolist() if 5 <= len(u) < LONGEST):
        for at in draw.integers(1, len(unit), 3).tolist():
            out.add(unit[:at] + chr(ord("a") + int(draw.integers(26))) + unit[at:])
    return sorted(out - known)


def fit(texts: list[str], labels: list[int], seed: int = 5) -> ToxicModel:
    """Learn from whole labelled documents. Where labels don't tell any unit apart, nothing is toxic."""
    nothing = ToxicModel(np.zeros(1 << 20, np.complex64), (1.0, 1.0), (-2.0, -2.0))
    held: dict[str, int] = {}
    docs = [np.array(sorted({held.setdefault(u, len(held)) for w in sorted(words_of(t)) for u in units_of(w)}), np.int64) for t in texts]
    one = _one_of_copies(docs)
    units, docs, y = list(held), [docs[i] for i in one], np.array([labels[i] for i in one])
    if not units or len(set(y.tolist())) < 2:
        return nothing
    in_toxic, in_clean = (np.bincount(np.concatenate([d for d, v in zip(docs, y, strict=True) if v == c]), minlength=len(units)) for c in (1, 0))
    n_toxic, n_clean = (y == 1).sum(), (y == 0).sum()
    alone, _ = telling_units(units, docs, y)
    bad = sorted(u for u in alone if in_toxic[u] / n_toxic > 10 * in_clean[u] / n_clean)
    clean = np.flatnonzero(in_clean > 0)
    model = nothing
    if bad:
        table, score, b = _learned(units, bad, clean, seed)
        model.table.real = table
        worst = np.array([score[d].max() if len(d) else -3.0 for d in docs])
        slope, bias = _sigmoid(worst, y)
        model.slope, model.bias = (slope, 1.0), (bias + slope * b, -2.0)
        # what the first machine has found teaches the second nothing
        open_docs = [i for i in range(len(docs)) if y[i] == 0 or slope * worst[i] + bias < 0]
    else:
        open_docs = list(range(len(docs)))
    docs, y = [docs[i] for i in open_docs], y[open_docs]
    if not (y == 1).any():
        return model
    pairs, stems = telling_units(units, docs, y, company=2)
    if pairs:
        # clean documents have single units like these: they say nothing against them
        others = np.array([u for u in clean.tolist() if stems.isdisjoint(_stems(units[u]))], np.int64)
        if len(others):
            table, score, b = _learned(units, sorted(pairs), others, seed)
            model.table.imag = table
            second = np.array([np.partition(score[d], -2)[-2] if len(d) > 1 else -3.0 for d in docs])
            slope, _ = _sigmoid(second, y)
            model.slope, model.bias = (model.slope[0], slope), (model.bias[0], slope * (b - _cut(second, y)))
    return model


def _cut(x: np.ndarray, y: np.ndarray) -> float:
    """Score that parts toxic from clean documents with the least cost, a clean one taken for
    toxic counting thrice; the middle of the scores that cost about as little."""
    order = np.argsort(x, kind="stable")
    # below a place all is taken for clean, from it on for toxic
    cost = 3 * ((y == 0).sum() - np.cumsum(y[order] == 0)) + np.cumsum(y[order] == 1)
    near = np.flatnonzero(cost <= cost.min() + 0.02 * (y == 1).sum())
    return float((x[order][near[0]] + x[order][min(near[-1] + 1, len(x) - 1)]) / 2)


def _learned(units: list[str], bad: list[int], clean: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of a machine that tells bad units from clean ones, all units' decisions, and its offset."""
    good = np.setdiff1d(np.random.default_rng(seed).choice(clean, min(len(clean), 3000), replace=False), bad)
    inserted = _with_insertions([units[u] for u in bad], set(units), seed)
    for turn in range(TURNS):
        names = [units[u] for u in bad] + inserted, [units[u] for u in good]
        marks = _Landmarks(*names, seed + turn)
        w, b = _machine(marks.features(names[0] + names[1]), np.repeat([1.0, -1.0], [len(names[0]), len(names[1])]))
        table = marks.table(w)
        score = sums(units, table) + b
        # the clean units that look worst are learnt from in the next turn
        good = np.union1d(good, np.setdiff1d(clean[np.argsort(-score[clean], kind="stable")[:1500]], bad))
    return table, score, b


def _sigmoid(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias that make scores probabilities; taking a clean document for toxic weighs thrice."""
    weight = np.where(y == 1, 1.0, 3.0)
    goal = np.where(y == 1, ((y == 1).sum() + 1) / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2))
    a = np.array([1.0, 0.0])
    x1 = np.stack([x, np.ones(len(x))], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x1 @ a, -30, 30)))
        step = np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + 1e-3 * np.eye(2), x1.T @ (weight * (goal - p)) - 1e-3 * a)
        a = a + step * min(1.0, 2.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return max(0.1, float(a[0])), float(a[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicModel:
    """Model from at most SAMPLE labelled documents of each label, none of them held out."""
    rows = labelled_sample(docs, labels, label_col, SAMPLE, id_col, text_col, each=True).orderBy("doc_id", "text")
    texts, y = [], []
    for r in rows.toLocalIterator():
        texts.append(r.text)
        y.append(r.label)
    return fit(texts, y)


_NONE = (-1e9, -1e9)


def worst_units(texts: list[str], table: np.ndarray, known: dict[str, tuple[float, float]]) -> np.ndarray:
    """Of each text the largest unit score by the first machine and the second largest of its
    different units by the second, without the machines' offsets; -1e9 where there is none.
    ``table`` has the machines' weights as real and imaginary parts."""
    words = [words_of(t) for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
    new = list(set().union(*words) - known.keys()) if words else []
    parts = [units_of(w) for w in new]
    known.update(dict.fromkeys(new, _NONE))
    full = [(w, p) for w, p in zip(new, parts, strict=True) if p]
    if full:
        starts = np.cumsum([0, *(len(p) for _, p in full[:-1])])
        # both machines' weights are looked up at once, as the parts of complex numbers
        both = sums([u for _, p in full for u in p], table)
        worst = [np.maximum.reduceat(x, starts).tolist() for x in (both.real, both.imag)]
        known.update(zip([w for w, _ in full], zip(*worst, strict=True), strict=True))
    return np.array([_worst_of(w, known) for w in words]).reshape(len(texts), 2)


def _worst_of(words: set[str], known: dict[str, tuple[float, float]]) -> tuple[float, float]:
    found = [known[w] for w in words]
    if not found:
        return _NONE
    # words that differ in case or points are one unit, and have equal scores
    second = sorted({b for _, b in found}, reverse=True)
    return max(found)[0], second[1] if len(second) > 1 else -1e9


def _score(batches: Iterator[pa.RecordBatch], text: int, model, column: str | None, keep_below: float | None) -> Iterator[pa.RecordBatch]:
    m = model.value
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [t.decode("utf-8", "replace") for t in as_bytes(part.column(text))]
            p = m.probability(worst_units(texts, m.table, m.known))
            if keep_below is not None:
                yield part.filter(pa.array(p < keep_below))
            else:
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], ["doc_id", column])


def toxicity_scores(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row; the score is a probability.

    A null or empty text, or one without any unit, gets the least score. Rows that repeat an
    id, or have none, are scored one by one; a null id isn't held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = id_and_text(docs, id_col, text_col).mapInArrow(
        partial(_score, text=1, model=shared, column="score", keep_below=None), "doc_id long, score double"
    )
    return found.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(partial(_score, text=at, model=shared, column=None, keep_below=threshold), docs.schema)
