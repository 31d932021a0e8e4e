"""Benchmark passages in documents, by SimHash of item-sized windows and by rare shingles.

The words of an item and of each window of as many words in a document become shingles. Two
measures compare them: shared over joint shingles, plain and weighted. A shingle's weight is
1 over the number of distinct item texts that have it, in the whole benchmark; the better
measure counts, so what items share with each other never hides a near copy of one.

A window can only reach the similarity if that part of its own shingles, or of their weight,
is known from items; others aren't looked at. For those left, candidates come from two sides.
The weighted shingles become a 64-bit SimHash, cut into BLOCKS; a table per block lists under
each value the items whose block differs from it in at most RADIUS // BLOCKS bits, which
names all items within RADIUS. That is a matter of chance, so each item is also listed under
its rarest shingles: so many that no window without any of them can reach the similarity.
The exact similarity then decides.

The benchmark travels to the tasks in blocks of at most BLOCK_CHARS characters of items,
made one at a time; each block is one pass over the documents. Shingles that several item
texts share travel with all blocks, 12 bytes each, so that results don't depend on blocks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import as_bytes, id_and_text, mixed, shingles, word_hashes

Common = tuple[np.ndarray, np.ndarray]  # shingles and their weights

BITS, BLOCKS, RADIUS = 64, 8, 23
CELLS = 1 << 20  # windows times items that are compared at once
BLOCK_CHARS = 20_000_000
_EDGE = b".,;:!?\"'()[]{}|*#$%&<>-"

_BYTE = np.array([[(x >> (7 - b)) & 1 for b in range(8)] for x in range(256)], np.uint8)
_POP8 = _BYTE.sum(1).astype(np.uint8)


def passage_words(text: bytes) -> list[bytes]:
    """Words in lower case without punctuation at their ends; those of punctuation alone don't count."""
    low = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
    return [w for x in low.split() if (w := x.strip(_EDGE))]


def _signs(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted +1 and -1 for each bit of each shingle."""
    bits = np.unpackbits(mixed(found).view(np.uint8).reshape(-1, 8), axis=1)
    return np.where(bits, weights[:, None], -weights[:, None]).astype(np.float32)


class Benchmark:
    """One block of items, ready to be looked up; small enough to send to every task."""

    def __init__(self, items: list[tuple[int, bytes]], k: int, similarity: float, common: Common | None = None) -> None:
        """``common`` has the weights of the whole benchmark; without it the items are all there is."""
        self.k, self.similarity = k, similarity
        self.ids: list[int] = []
        self.sizes: list[int] = []
        self.bags: list[dict[int, int]] = []
        found, texts = [], {}
        for item, text in items:
            words = passage_words(text)
            if words:
                mine = shingles(word_hashes(words), k)
                found.append(mine)
                self.ids.append(item)
                self.sizes.append(len(words))
                self.bags.append(Counter(mine.tolist()))
                texts[b" ".join(words)] = self.bags[-1]
        self.known = np.array(sorted({s for bag in self.bags for s in bag}), np.uint64)
        if common is None:
            often = Counter(s for bag in texts.values() for s in bag)
            keys = np.array(sorted(s for s, n in often.items() if n > 1), np.uint64)
            common = keys, np.array([1 / often[int(s)] for s in keys], np.float32)
        self.common = common
        self.weights = self.weigh(self.known)
        prints = [self.fingerprint(_signs(x, self.weigh(x)).sum(0)) for x in found]
        self.prints = np.concatenate(prints) if prints else np.empty((0, 8), np.uint8)
        self.of_size = {n: np.flatnonzero(np.array(self.sizes) == n) for n in sorted(set(self.sizes))}
        self.tables = {n: self._tables(which) for n, which in self.of_size.items()}
        self.places = [np.unique(self.place(np.array(list(bag), np.uint64))) for bag in self.bags]
        self.counts = [sum(bag.values()) for bag in self.bags]
        self.totals = [sum(float(self.weights[i]) * bag[int(self.known[i])] for i in at) for at, bag in zip(self.places, self.bags, strict=True)]
        # two sets of as many shingles share 2s / (1 + s) of them at similarity s, others at least s of the larger
        self.rare = self._rare((1 - similarity) / (1 + similarity))
        self.rare_short = self._rare(1 - similarity)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"common": None}  # sent once for all blocks

    def _rare(self, part: float) -> tuple[np.ndarray, np.ndarray]:
        """Items by known shingle, under the rarest of each: more than ``part`` of its shingles and enough of their weight."""
        at, of = [], []
        for item, (places, bag) in enumerate(zip(self.places, self.bags, strict=True)):
            places = places[np.argsort(-self.weights[places], kind="stable")]
            times = np.array([bag[int(s)] for s in self.known[places]])
            missed, lost = np.cumsum(times), np.cumsum(times * self.weights[places].astype(np.float64))
            enough = (missed > part * self.counts[item] + 1e-9) & (lost > (1 - self.similarity) * self.totals[item] + 1e-6)
            n = int(np.argmax(enough)) + 1 if enough.any() else len(places)
            at.append(places[:n])
            of.append(np.full(n, item))
        if not at:
            return np.zeros(1, np.int64), np.empty(0, np.int64)
        places, items = np.concatenate(at), np.concatenate(of)
        order = np.argsort(places, kind="stable")
        return np.searchsorted(places[order], np.arange(len(self.known) + 1)), items[order]

    def named(self, placed: np.ndarray, rare: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Items listed under any of the known shingles at these places."""
        first, items = rare
        found = [items[first[i] : first[i + 1]] for i in np.unique(placed[placed >= 0])]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)

    @staticmethod
    def fingerprint(sums: np.ndarray) -> np.ndarray:
        return np.packbits(np.atleast_2d(sums) > 0, axis=1)

    def place(self, found: np.ndarray) -> np.ndarray:
        """Positions among the known shingles, -1 for others."""
        if not len(self.known):
            return np.full(len(found), -1)
        at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        return np.where(self.known[at] == found, at, -1)

    def weigh(self, found: np.ndarray) -> np.ndarray:
        """Weights of shingles; one that no two item texts share weighs 1."""
        keys, weights = self.common
        if not len(keys):
            return np.ones(len(found), np.float32)
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        return np.where(keys[at] == found, weights[at], 1).astype(np.float32)

    def _tables(self, which: np.ndarray) -> np.ndarray:
        """For each block and value whether each item's block differs in few enough bits."""
        near = _POP8[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // BLOCKS
        return np.stack([near[:, self.prints[which, block]] for block in range(BLOCKS)])

    def within(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items of all fingerprints within RADIUS of an item of this size.

        Windows are looked up in slices of at most CELLS windows times items, however many
        windows a document has; only those within the radius are kept of a slice.
        """
        which = self.of_size[size]
        step = max(1, CELLS // max(1, len(which)))
        found = [self._within(size, prints[at : at + step], at) for at in range(0, len(prints), step)]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([w for w, _ in found]), np.concatenate([i for _, i in found])

    def _within(self, size: int, prints: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        tables, which = self.tables[size], self.of_size[size]
        named = tables[0][prints[:, 0]]
        for block in range(1, BLOCKS):
            named |= tables[block][prints[:, block]]
        windows, items = np.nonzero(named)
        items = which[items]
        close = _POP8[self.prints[items] ^ prints[windows]].sum(1) <= RADIUS
        return windows[close] + first, items[close]

    def exact(self, item: int, found: np.ndarray) -> float:
        """Similarity of a window's shingles and an item's: shared over joint weight or number, whichever is more."""
        bag, mine = self.bags[item], Counter(found.tolist())
        keys = list(bag.keys() | mine.keys())
        weights = self.weigh(np.array(keys, np.uint64))
        low = sum(w * min(bag.get(s, 0), mine.get(s, 0)) for s, w in zip(keys, weights, strict=True))
        high = sum(w * max(bag.get(s, 0), mine.get(s, 0)) for s, w in zip(keys, weights, strict=True))
        both = sum(min(bag.get(s, 0), mine.get(s, 0)) for s in keys)
        return max(float(low / high), both / (self.counts[item] + len(found) - both))

    def matches(self, text: bytes) -> list[tuple[int, float, int]]:
        """``(item, similarity, first word)`` of the best window for each item found."""
        hashes = word_hashes(passage_words(text))
        best: dict[int, tuple[float, int]] = {}
        if not len(hashes) or not self.sizes:
            return []
        by_k: dict[int, list[int]] = defaultdict(list)
        for n in self.of_size:
            by_k[min(n, self.k)].append(n)
        for k, sizes in by_k.items():
            if len(hashes) < k:
                continue
            found = shingles(hashes, k)
            placed = self.place(found)
            for lo, hi in _regions(np.flatnonzero(placed >= 0), max(sizes), len(found)):
                self._region(found[lo:hi], placed[lo:hi], lo, k, sizes, best)
        return [(self.ids[i], s, at) for i, (s, at) in sorted(best.items())]

    def _region(self, found, placed, base: int, k: int, sizes: list[int], best: dict) -> None:
        weights = self.weigh(found)
        held, weight = _running(placed >= 0), _running(weights.astype(np.float64))
        heavy = _running(np.where(placed >= 0, weights, 0.0).astype(np.float64))
        total, shared = None, {}
        listed: dict[bool, np.ndarray] = {}
        for size in sizes:
            # a document with fewer words than the item is one window
            width = min(size - k + 1, len(found))
            short = width < size - k + 1
            starts = np.arange(len(found) - width + 1)
            known = (held[starts + width] - held[starts]) / width
            part = (heavy[starts + width] - heavy[starts]) / (weight[starts + width] - weight[starts])
            starts = starts[np.maximum(known, part) >= self.similarity - 1e-6]
            if not len(starts):
                continue
            if total is None:
                total = np.concatenate([np.zeros((1, BITS)), np.cumsum(_signs(found, weights), 0, np.float64)])
            if short not in listed:
                listed[short] = self.named(placed, self.rare_short if short else self.rare)
            _, near = self.within(size, self.fingerprint(np.round(total[starts + width] - total[starts], 3)))
            items = np.union1d(near, np.intersect1d(listed[short], self.of_size[size], assume_unique=True))
            for item in items.tolist():
                if item not in shared:
                    has = np.isin(placed, self.places[item])
                    shared[item] = _running(np.where(has, weights, 0.0).astype(np.float64)), _running(has)
                # what a window shares is at most its shingles that the item has
                low, both = (x[starts + width] - x[starts] for x in shared[item])
                joint = np.maximum(weight[starts + width] - weight[starts] + self.totals[item] - low, 1e-9)
                most = np.maximum(low / joint, both / np.maximum(width + self.counts[item] - both, 1))
                for i in np.argsort(-most, kind="stable").tolist():
                    if most[i] < max(self.similarity, best.get(item, (0.0, 0))[0]) - 1e-6:
                        break
                    alike = self.exact(item, found[starts[i] : starts[i] + width])
                    if alike >= self.similarity and alike > best.get(item, (0.0, 0))[0]:
                        best[item] = (alike, base + int(starts[i]))


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def _regions(anchors: np.ndarray, size: int, n: int) -> Iterator[tuple[int, int]]:
    """Stretches of shingles that hold all windows of up to ``size`` words around anchors."""
    if not len(anchors):
        return
    gaps = np.flatnonzero(np.diff(anchors) > 2 * size)
    firsts = anchors[np.concatenate([[0], gaps + 1])]
    lasts = anchors[np.concatenate([gaps, [len(anchors) - 1]])]
    for a, b in zip(firsts, lasts, strict=True):
        yield max(0, int(a) - size), min(n, int(b) + size)


def _text_shingles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(xxhash.xxh3_64_intdigest(b" ".join(words)), np.unique(shingles(word_hashes(words), k))) for words in map(passage_words, as_bytes(batch.column("t")))]
        of = np.repeat(np.array([t for t, _ in rows], np.uint64), [len(x) for _, x in rows])
        found = np.concatenate([np.empty(0, np.uint64), *(x for _, x in rows)])
        yield pa.RecordBatch.from_arrays([pa.array(of.view(np.int64)), pa.array(found.view(np.int64))], ["words", "shingle"])


def common_shingles(rows: DataFrame, k: int) -> Common:
    """Shingles that several distinct item texts have, ascending, and their weights: 1 over how many have them."""
    found = rows.select("t").mapInArrow(partial(_text_shingles, k=k), "words long, shingle long").distinct()
    often = found.groupBy("shingle").agg(F.count("*").cast("int").alias("n")).where("n > 1").toArrow()
    keys = often.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], (1 / often.column("n").to_numpy()[order]).astype(np.float32)


def benchmark_blocks(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 5, similarity: float = 0.8
) -> Iterator[tuple[Broadcast, Broadcast]]:
    """The items in blocks of at most BLOCK_CHARS characters each, about, by hash of the id, and the common shingles.

    A block is made and sent before the next one. Items without an id or without words take no part.
    """
    context = items.sparkSession.sparkContext
    rows = items.select(items[id_col].cast("long").alias("item"), F.coalesce(items[text_col], F.lit("")).alias("t")).where("item is not null").distinct()
    chars = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = max(1, -(-2 * chars // BLOCK_CHARS) if chars > BLOCK_CHARS else 1)
    common = common_shingles(rows, k)
    sent = context.broadcast(common)
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == block).orderBy("item", "t")
        yield context.broadcast(Benchmark([(r.item, r.t.encode()) for r in part.toLocalIterator()], k, similarity, common)), sent


def _received(bench, common) -> Benchmark:
    block = bench.value
    block.common = common.value
    return block


def _hits(batches: Iterator[pa.RecordBatch], bench, common) -> Iterator[pa.RecordBatch]:
    block = _received(bench, common)
    for batch in batches:
        rows = [
            (doc, *hit)
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True)
            for hit in block.matches(text)
        ]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "similarity", "start_word"])


def benchmark_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", k: int = 5, similarity: float = 0.8,
) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word)``: a row for each document and item found in it.

    ``similarity`` is the best of the document's windows and ``start_word`` its first word,
    counting words that aren't punctuation alone from 0. An item is found in a document if
    a window of as many words, or the whole of a document with fewer, has at least the
    similarity; items with fewer than ``k`` words
    are one shingle. Null or empty texts, and items without words, give no row. Rows that
    repeat an id are looked at one by one, and a null id is returned as null.
    """
    texts = id_and_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, similarity double, start_word long"
    out = None
    for block, common in benchmark_blocks(items, item_col, item_text_col, k, similarity):
        found = texts.mapInArrow(partial(_hits, bench=block, common=common), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _clean(batches: Iterator[pa.RecordBatch], text: int, bench, common) -> Iterator[pa.RecordBatch]:
    block = _received(bench, common)
    for batch in batches:
        keep = [not block.matches(t) for t in as_bytes(batch.column(text))]
        yield batch.filter(pa.array(keep, pa.bool_()))


def without_benchmark(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    k: int = 5, similarity: float = 0.8,
) -> DataFrame:
    """The rows of ``docs``, with all columns, in whose texts no item is found."""
    at = docs.columns.index(text_col)
    for block, common in benchmark_blocks(items, item_col, item_text_col, k, similarity):
        docs = docs.mapInArrow(partial(_clean, text=at, bench=block, common=common), docs.schema)
    return docs
