"""Words, word hashes and word shingles, shared by the operators that compare texts.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, with A-Z in lower case. These helpers run inside Spark's tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A worker forgets its word hashes beyond this many; results don't depend on it.
REMEMBERED = 400_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs, under fixed names; other columns can't clash with its own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, in order; of all words as one where there are fewer."""
    n = min(k, len(hashes))
    if n == 0:
        return np.empty(0, np.uint64)
    at = len(hashes) - n + 1
    out = np.full(at, n, np.uint64)
    for j in range(n):
        out = mixed(out * _M1 + hashes[j : j + at])
    return out


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    return np.unique(shingles(word_hashes(text.lower().split()), k))


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts of batches whose columns are ``doc_id`` and ``text``."""
    for batch in batches:
        yield batch.column("doc_id"), as_bytes(batch.column("text"))


def is_held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
