"""Lines that many documents repeat, found through sharded minimal perfect hashes.

Each distinct line key is a 128-bit hash. The distinct hashes are dealt into shards of about
SHARD keys; a shard's minimal perfect hash gives each of its keys a slot of its own, and
small arrays by slot hold a fingerprint, the number of documents and, for frequent keys, the
largest id. Documents send the hashes of their lines to the shard's arrays, so no line text
meets another, and a shard costs a few bytes a key.

A shard that a very common line makes hot is copied and its probes are dealt out over the
copies. How many copies follows from the counts, which equal the probes to come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import as_bytes, id_and_text, mixed, text_batches
from shelfspark.session import staged

SHARD = 4096  # distinct keys in a shard, about
PROBES = 16384  # probes that meet one copy of a shard, about
_SPACE = b" \t\n\x0b\x0c\r"
_LEVEL = 0x9E3779B97F4A7C15


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line stripped and in lower case; None if it has fewer code points."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys, as levels of bits.

    A key's slot is the rank of the first set bit it meets. On a level the keys still left
    are thrown into twice as many bits; those alone in theirs stay, the others go on.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.base = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.rank = [np.cumsum(x) - 1 for x in levels]

    @staticmethod
    def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(mixed(h1 + np.uint64((level + 1) * _LEVEL % 2**64)) ^ h2) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels = []
        while len(h1):
            size = 64 * -(-2 * len(h1) // 64)
            at = cls._place(h1, h2, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that the hash wasn't built from, any slot for others."""
        out = np.full(len(h1), -1)
        left = np.arange(len(h1))
        for k, bits in enumerate(self.levels):
            at = self._place(h1[left], h2[left], k, len(bits))
            hit = bits[at]
            out[left[hit]] = self.base[k] + self.rank[k][at[hit]]
            left = left[~hit]
        return out

    def dump(self) -> list[bytes]:
        return [np.packbits(x).tobytes() for x in self.levels]

    @classmethod
    def load(cls, levels) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in levels])


_SHARD_SQL = "shard long, levels array<binary>, marks binary, counts binary, last_ids binary"


def build_shard(rows: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    """One row with a shard's hash and arrays from its distinct keys with counts."""
    h1, h2 = (rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    index = PerfectHash.build(h1, h2)
    order = np.argsort(index.slots(h1, h2))
    n = rows["n"].to_numpy()[order]
    last = rows["last_id"].to_numpy()[order]
    return pd.DataFrame(
        {
            "shard": [rows["shard"].iloc[0]],
            "levels": [index.dump()],
            "marks": [(h2[order] >> np.uint64(32)).astype(np.uint32).tobytes()],
            "counts": [np.minimum(n, 65535).astype(np.uint16).tobytes()],
            "last_ids": [last[n >= min_docs].astype(np.int64).tobytes()],
        }
    )


def probe_shard(probes: pd.DataFrame, shard: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    """``(doc_id, h1)`` of the probes whose line goes: frequent, and not in its last document."""
    if not len(probes) or not len(shard):
        return pd.DataFrame({"doc_id": np.empty(0, np.int64), "h1": np.empty(0, np.int64)})
    row = shard.iloc[0]
    marks, counts = np.frombuffer(row["marks"], np.uint32), np.frombuffer(row["counts"], np.uint16)
    frequent = counts >= min_docs
    last = np.full(len(counts), -1, np.int64)
    last[frequent] = np.frombuffer(row["last_ids"], np.int64)
    h1, h2 = (probes[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    slot = PerfectHash.load(row["levels"]).slots(h1, h2)
    known = (slot >= 0) & (marks[slot] == (h2 >> np.uint64(32)).astype(np.uint32))
    return probes.loc[known & frequent[slot] & (last[slot] != probes["doc_id"].to_numpy()), ["doc_id", "h1"]]


def _line_hashes(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_batches(batches):
        docs, digests = [], []
        for doc, text in zip(ids.to_pylist(), texts, strict=True):
            keys = {k for line in text.split(b"\n") if (k := line_key(line, min_chars)) is not None}
            docs += [doc] * len(keys)
            digests += map(xxhash.xxh3_128_digest, keys)
        pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        columns = [pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1])), pa.array(docs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id"])


def _rewrite(batches: Iterator[pa.RecordBatch], min_chars: int, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        drops = batch.column("drops").to_pylist()
        out: tuple[list, ...] = ([], [], [])
        for text, drop in zip(as_bytes(batch.column("text")), drops, strict=True):
            lines = text.split(b"\n")
            kept = lines
            if drop:
                gone = set(drop)
                kept = [x for x in lines if (k := line_key(x, min_chars)) is None or _first_half(k) not in gone]
            joined = b"\n".join(kept)
            out[0].append(len(lines))
            out[1].append(len(lines) - len(kept))
            out[2].append(hashlib.sha256(joined).hexdigest().encode() if digest else joined)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()).cast(pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256" if digest else "kept_text"],
        )


def _first_half(key: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_128_digest(key)[:8], "little", signed=True)


def line_index(lines: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame, int]:
    """Shards of the index over the distinct keys of ``lines`` ``(h1, h2, doc_id)``,
    ``(shard, copies)`` and the number of shards, which follows that of distinct keys."""
    keys = staged(lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("last_id")), "line-keys")
    shards = max(1, -(-keys.count() // SHARD))
    dealt = keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
    built = dealt.groupBy("shard").applyInPandas(partial(build_shard, min_docs=min_docs), _SHARD_SQL)
    copies = dealt.groupBy("shard").agg(F.ceil(F.sum("n") / PROBES).alias("copies"))
    return staged(built, "line-shards"), staged(copies, "line-copies"), shards


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, digest: bool = False
) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)`` per row, or ``kept_sha256`` with ``digest``.

    Texts are split at line feeds; a null or empty text is one empty line. A line's key is
    the line without white space at its ends and with A-Z in lower case. Keys of at least
    ``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines,
    except in the document with the largest id. ``min_docs`` is at most 65535. Rows that
    repeat an id each count as a document and are treated alike. A row without an id keeps
    its lines and counts for none. An empty table gives an empty result.
    """
    if not 1 <= min_docs <= 65535:
        raise ValueError("min_docs is between 1 and 65535")
    texts = id_and_text(docs, id_col, text_col)
    named = texts.where(F.col("doc_id").isNotNull())
    lines = staged(named.mapInArrow(partial(_line_hashes, min_chars=min_chars), "h1 long, h2 long, doc_id long"), "lines")
    shards, copies, n_shards = line_index(lines, min_docs)

    probes = lines.withColumn("shard", F.pmod("h1", F.lit(n_shards))).join(copies, "shard")
    probes = probes.select("shard", F.pmod(F.xxhash64("doc_id", "h2"), F.col("copies")).alias("copy"), "h1", "h2", "doc_id")
    copied = shards.join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    hits = (
        probes.groupBy("shard", "copy")
        .cogroup(copied.groupBy("shard", "copy"))
        .applyInPandas(partial(probe_shard, min_docs=min_docs), "doc_id long, h1 long")
    )
    drops = hits.groupBy("doc_id").agg(F.collect_set("h1").alias("drops"))
    joined = texts.join(drops, "doc_id", "left")
    name = "kept_sha256" if digest else "kept_text"
    return joined.mapInArrow(
        partial(_rewrite, min_chars=min_chars, digest=digest), f"doc_id long, n_lines long, n_dropped long, {name} string"
    )
