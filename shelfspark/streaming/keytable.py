"""Rows kept once per key, in segments that are merged as they grow in number.

Every batch adds one segment of its new rows. When a level has ``FAN_OUT`` segments besides
the newest, they are merged into one of the next level, so a table of n batches has some
``FAN_OUT * log(n)`` segments, not n. A segment is cut by the first hex digits of its keys'
digests, by as many that a piece has about ``PIECE_ROWS`` rows: a small batch is one file.

Each piece has a Bloom filter of its keys. A batch is tested against the filters first and
opens only pieces that may hold one of its keys; the keys of most batches are new, so most
pieces stay shut. What the table holds is named by a manifest, which changes in one step:
a reader sees all of a batch or nothing, and merged segments replace their parts at once.

Rows know the run and batch that brought them. A batch that is run again doesn't see its own
rows, nor those of later batches, and adds nothing where it has been merged already.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators.dedup import dedup_first_wins
from shelfspark.streaming.incremental import run_id
from shelfspark.sources.manifest import Manifest, StaleVersion

FAN_OUT = 8
PIECE_ROWS = 1_000_000
BITS_PER_KEY, HASHES = 10, 7
MAX_DIGITS = 6

_RUN, _BATCH, _PIECE, _SEGMENT = "_run", "_batch", "_piece", "_segment"


def _digest(key: Column) -> Column:
    return F.sha1(key.cast("binary"))


def _positions(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """Places of keys in a filter of so many bits, a row per hash."""
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        return (high + steps * (low | np.uint64(1))) % np.uint64(bits)


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(table.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("high", "low"))


def _filter_of(table: pa.Table) -> pa.Table:
    """One piece's Bloom filter."""
    high, low = _halves(table)
    bits = max(64, BITS_PER_KEY * len(high))
    marks = np.zeros(bits, np.bool_)
    marks[_positions(high, low, bits).ravel()] = True
    packed = np.packbits(marks).tobytes()
    return pa.table({_PIECE: table.column(_PIECE)[:1], "n_bits": pa.array([bits], pa.int64()), "bits": pa.array([packed], pa.binary())})


def _may_hold(keys: pa.Table, filters: pa.Table) -> Iterator[pa.RecordBatch] | pa.Table:
    """The piece, if its filter doesn't rule out all of the keys."""
    none = pa.table({_SEGMENT: pa.array([], pa.string()), _PIECE: pa.array([], pa.string())})
    if not len(keys) or not len(filters):
        return none
    high, low = _halves(keys)
    bits = filters.column("n_bits")[0].as_py()
    marks = np.unpackbits(np.frombuffer(filters.column("bits")[0].as_py(), np.uint8), count=bits).astype(np.bool_)
    if not marks[_positions(high, low, bits)].all(axis=0).any():
        return none
    return pa.table({c: filters.column(c)[:1] for c in (_SEGMENT, _PIECE)})


class KeyTable:
    """The kept rows under ``path``; ``schema`` are the rows' columns and ``key`` the one that
    decides. Rows whose key is null are kept all."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "key_id") -> None:
        self.spark, self.path, self.key = spark, path, key
        places = [T.StructField(_RUN, T.StringType()), T.StructField(_BATCH, T.LongType())]
        self.schema = T.StructType([*schema.fields, *places])
        self.names = schema.names
        self.manifest = Manifest(spark, f"{path}/manifest")

    def _folder(self, segment: dict, kind: str = "rows") -> str:
        return f"{self.path}/{kind}/{segment['id']}"

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)

    def segments(self) -> list[dict]:
        return self.manifest.read()[1].get("segments", [])

    def rows(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the latest by default."""
        found = self.manifest.read(version)[1].get("segments", [])
        return self._read([self._folder(s) for s in found]).drop(_RUN, _BATCH)

    def batches(self) -> DataFrame:
        """All rows with the batch that brought them."""
        return self._read([self._folder(s) for s in self.segments()]).withColumnRenamed(_BATCH, "batch").drop(_RUN)

    def pieces_to_open(self, keys: DataFrame, segments: list[dict]) -> list[str]:
        """Folders of the pieces that may hold one of ``keys``, by their filters."""
        if not segments:
            return []
        # a key meets one piece of every segment, and segments are a few dozen
        places = F.array(*(F.struct(F.lit(s["id"]).alias(_SEGMENT), _piece(self.key, s["digits"]).alias(_PIECE)) for s in segments))
        asked = keys.select(F.explode(places).alias("place"), *_two_halves(F.col(self.key))).select("place.*", "high", "low")
        filters = self.spark.read.schema(f"{_SEGMENT} string, {_PIECE} string, n_bits long, bits binary").parquet(
            *(self._folder(s, "filters") for s in segments)
        )
        by = (_SEGMENT, _PIECE)
        hits = asked.groupBy(*by).cogroup(filters.groupBy(*by)).applyInArrow(_may_hold, f"{_SEGMENT} string, {_PIECE} string")
        return sorted(f"{self.path}/rows/{h[_SEGMENT]}/{_PIECE}={h[_PIECE]}" for h in hits.collect())

    def new_rows(self, rows: DataFrame, run: str, batch: int) -> DataFrame:
        """Those of ``rows``, one per key, whose key no other run and no earlier batch has kept."""
        segments = [s for s in self.segments() if not (s["level"] == 0 and s["run"] == run and s["batch"] >= batch)]
        keys = rows.where(F.col(self.key).isNotNull()).select(self.key)
        opened = self.pieces_to_open(keys, [s for s in segments if s["keyed"]])
        if not opened:
            return rows
        seen = self._read(opened).where((F.col(_RUN) != run) | (F.col(_BATCH) < batch)).select(self.key)
        hits = seen.join(keys, self.key, "left_semi")
        return rows.join(hits, self.key, "left_anti")

    def _write(self, rows: DataFrame, n_rows: int | None) -> dict:
        """A segment of the rows, cut by key so that a piece has about ``PIECE_ROWS`` of them."""
        segment = {"id": uuid.uuid4().hex, "digits": 0}
        if n_rows and n_rows > PIECE_ROWS:
            segment["digits"] = min(MAX_DIGITS, int(np.ceil(np.log(n_rows / PIECE_ROWS) / np.log(16))))
        placed = rows.withColumn(_PIECE, _piece(self.key, segment["digits"]))
        folder = self._folder(segment)
        spread = placed.coalesce(1) if not segment["digits"] else placed.repartition(_PIECE)
        spread.write.partitionBy(_PIECE).parquet(folder)
        back = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_PIECE, T.StringType())])).parquet(folder)
        keyed = back.where(F.col(self.key).isNotNull()).select(_PIECE, *_two_halves(F.col(self.key)))
        made = keyed.groupBy(_PIECE).applyInArrow(_filter_of, f"{_PIECE} string, n_bits long, bits binary")
        made = made.select(F.lit(segment["id"]).alias(_SEGMENT), _PIECE, "n_bits", "bits")
        made.coalesce(1).write.parquet(self._folder(segment, "filters"))
        segment["rows"] = back.count()
        segment["keyed"] = not back.where(F.col(self.key).isNotNull()).isEmpty()
        return segment

    def append(self, rows: DataFrame, run: str, batch: int) -> int:
        """Add a batch's rows; one that was added before takes the place of its earlier rows,
        or adds nothing where those have been merged. Returns the version made."""
        while True:
            version, held = self.manifest.read()
            segments = held.get("segments", [])
            if batch <= held.get("merged_to", {}).get(run, -1):
                return version
            same = [s for s in segments if s["level"] == 0 and s["run"] == run and s["batch"] == batch]
            marked = rows.withColumns({_RUN: F.lit(run), _BATCH: F.lit(batch).cast("long")}).select(*self.schema.names)
            segment = self._write(marked, None) | {"level": 0, "run": run, "batch": batch}
            kept = [s for s in segments if s not in same] + ([segment] if segment["rows"] else [])
            try:
                version = self.manifest.commit(version, {**held, "segments": kept})
                break
            except StaleVersion:
                self._drop([segment])
        self.merge()
        return version

    def merge(self) -> None:
        """Merge full levels; the newest segment stays apart, as its batch may be run again."""
        while True:
            version, held = self.manifest.read()
            segments = held.get("segments", [])
            newest = max((s["batch"] for s in segments if s["level"] == 0), default=None)
            for level in sorted({s["level"] for s in segments}):
                full = [s for s in segments if s["level"] == level and not (level == 0 and s["batch"] == newest)]
                if len(full) >= FAN_OUT:
                    break
            else:
                break
            one = self._write(self._read([self._folder(s) for s in full]), sum(s["rows"] for s in full)) | {"level": level + 1}
            merged_to = dict(held.get("merged_to", {}))
            for s in full:
                if s["level"] == 0:
                    merged_to[s["run"]] = max(merged_to.get(s["run"], -1), s["batch"])
            try:
                self.manifest.commit(version, {"segments": [s for s in segments if s not in full] + [one], "merged_to": merged_to})
            except StaleVersion:
                self._drop([one])
                continue
        self._forget()

    def _forget(self) -> None:
        """Remove old versions and the segments that only they name."""
        gone = self.manifest.forget()
        named = {s["id"] for v in self.manifest.versions() for s in self.manifest.read(v)[1].get("segments", [])}
        left = {s["id"]: s for held in gone for s in held.get("segments", []) if s["id"] not in named}
        self._drop(list(left.values()))

    def _drop(self, segments: list[dict]) -> None:
        for s in segments:
            for kind in ("rows", "filters"):
                self.manifest.remove(self._folder(s, kind))


def _piece(key: str, digits: int) -> Column:
    """Name of the piece that a key belongs to; rows without a key have one of their own."""
    return F.when(F.col(key).isNull(), "none").otherwise(F.concat(F.lit("p"), F.substring(_digest(F.col(key)), 1, digits)))


def _two_halves(key: Column) -> list[Column]:
    """128 bits of a key as two longs, for the filters."""
    return [F.xxhash64(F.lit(1), key.cast("binary")).alias("high"), F.xxhash64(F.lit(2), key.cast("binary")).alias("low")]


def dedup_into(table: KeyTable, file: str = "file_rank", pos: str = "pos") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for first-wins de-duplication across batches into a key table.

    A key kept by an earlier batch always wins; within a batch the first by ``(file, pos)`` does.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        winners = dedup_first_wins(batch, table.key, file, pos).persist()
        try:
            name = run_id(batch.sparkSession)
            table.append(table.new_rows(winners, name, batch_id), name, batch_id)
        finally:
            winners.unpersist()

    return run
