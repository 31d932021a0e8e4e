"""SentencePiece ids of whole texts, by a table of distinct chunks, and texts of ids.

Where no piece holds other characters before a whitespace marker, a text's ids are those of
its chunks, a run of markers and what follows up to the next. Documents are cut in blocks of
bounded size: a block's distinct chunks are numbered by their frequency and its documents
become numbers. The distinct chunks go to the shard that their hash names, where
each is segmented once for all blocks, and the ids go back to the block, to be put in the
places of the numbers. All rows of both shuffles hold many chunks or documents and are
compressed, so moving them costs little more than the text compressed.

A shard's share is even whatever the words' frequencies, as a block sends a chunk once. A
block's id has a hash of its contents: were a lost task run again on rows in another order,
its rows would not meet those of the first run, and the job would fail instead of joining
wrong places.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from shelfspark.llm.words import id_and_text

BLOCK_CHARS = 32_000_000  # a block ends with the document that brings it to so many characters
BLOCK_CHUNKS = 1_500_000  # or to so many distinct chunks
PAGE_WORDS = 1 << 16  # numbers of a block's documents in a row, but for one long document
SHARDS = 4  # per shuffle partition
MARK = "▁"

HEAD, CHUNKS, PAGE = 0, 1, 2
_ROWS = "route long, block long, kind int, seq long, payload binary"
_FIELDS = ("route", "block", "kind", "seq", "payload")
_cut = re.compile(" +[^ ]*").findall


@lru_cache(maxsize=4)
def processor(path: str) -> SentencePieceProcessor:
    """The worker's processor of a model file."""
    return SentencePieceProcessor(model_file=path)


def can_be_cut(path: str) -> bool:
    """Whether the model's ids of a text are its chunks' ids: pair merging, no normalisation
    but a marker in front, no piece across a marker, no pieces that users or texts force."""
    made = sentencepiece_model_pb2.ModelProto()
    made.ParseFromString(processor(path).serialized_model_proto())
    norm, kinds = made.normalizer_spec, type(made).SentencePiece
    plain = not norm.precompiled_charsmap and not norm.normalization_rule_tsv and not made.denormalizer_spec.precompiled_charsmap
    spaces = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
    return bool(
        plain and spaces and made.trainer_spec.model_type == made.trainer_spec.BPE
        and not made.trainer_spec.treat_whitespace_as_suffix
        and all(p.type in (kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE) for p in made.pieces)
        and not any(MARK in p.piece.lstrip(MARK) for p in made.pieces if p.type == kinds.NORMAL)
    )


def chunks_of(text: str) -> list[str]:
    """The marked chunks of a text, markers as spaces; none of an empty text."""
    return _cut(" " + text.replace(MARK, " ")) if text else []


def segment(model: SentencePieceProcessor, chunks: list[str]) -> list[list[int]]:
    """Ids of marked chunks; the library puts one marker in front itself."""
    found = model.encode([c[1:] for c in chunks], num_threads=1)
    for i, c in enumerate(chunks):
        if c == " ":  # a marker alone, which the library doesn't add to an empty text
            found[i] = model.encode("a ")[len(model.encode("a")) :]
    return found


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed row: their kinds and lengths, then their bytes."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    return zstandard.ZstdCompressor(level=15).compress(head + b"\n" + b"".join(a.tobytes() for a in arrays))


def _unpack(row: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(row)
    at = data.index(b"\n")
    out, at = [], at + 1
    for part in data[: at - 1].decode().split(";"):
        kind, n = part.split(",")
        out.append(np.frombuffer(data, kind, int(n), at))
        at += out[-1].nbytes
    return out


def _planes(x: np.ndarray) -> list[np.ndarray]:
    """Low to high bytes of numbers, apart, as they compress better so."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return [((x >> (8 * i)) & 255).astype(np.uint8) for i in range(width)]


def _joined(planes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(planes[0]), np.int64)
    for i, p in enumerate(planes):
        out |= p.astype(np.int64) << (8 * i)
    return out


class _Block:
    """Documents of one block as numbers of distinct chunks.

    Chunks that the block has several times are numbered from 1, the most frequent first. All
    others are written as 0: the next chunk that occurs once. So few bytes tell them apart.
    """

    def __init__(self, shards: int, number: int) -> None:
        self.shards, self.number = shards, number
        self.known: dict[str, int] = {}
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str) -> None:
        known = self.known
        self.docs.append((doc_id, np.array([known.setdefault(c, len(known)) for c in chunks_of(text)], np.int32)))
        self.chars += len(text)

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.known) >= BLOCK_CHUNKS

    def _pages(self, codes: np.ndarray) -> Iterator[bytes]:
        """Rows of documents; of each row the chunks that occur once in the rows before."""
        waiting, words, once = [], 0, 0
        for k, (doc_id, numbers) in enumerate(self.docs):
            waiting.append((doc_id, codes[numbers]))
            words += len(numbers)
            if words >= PAGE_WORDS or k == len(self.docs) - 1:
                ids, coded = zip(*waiting, strict=True)
                every = np.concatenate(coded)
                yield _pack(
                    np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.bool_),
                    np.array([once], np.int64), np.array([len(x) for x in coded], np.int64), *_planes(every),
                )
                once += int((every == 0).sum())
                waiting, words = [], 0

    def rows(self) -> Iterator[tuple]:
        """``(route, block, kind, seq, payload)``: a head, a row per shard in use, the pages."""
        n = len(self.known)
        counts = np.bincount(np.concatenate([x for _, x in self.docs]), minlength=n)
        several = np.flatnonzero(counts > 1)
        several = several[np.argsort(-counts[several], kind="stable")]
        codes = np.zeros(n, np.int64)
        codes[several] = np.arange(1, len(several) + 1)
        chunks = list(self.known)
        chunks = [chunks[i] for i in np.concatenate([several, np.flatnonzero(counts == 1)]).tolist()]
        pages = list(self._pages(codes))

        shards: dict[int, list[str]] = {}
        homes = np.empty(n, np.int64)
        for i, c in enumerate(chunks):
            home = homes[i] = xxhash.xxh3_64_intdigest(c) % self.shards
            shards.setdefault(home, []).append(c)
        seen = xxhash.xxh3_64(f"{TaskContext.get().partitionId()}:{self.number}")
        for page in pages:
            seen.update(page)
        for c in chunks:
            seen.update(c)
        block = seen.intdigest() - (1 << 63)
        aside = (block + np.arange(len(pages) + 1, dtype=object)) % self.shards + self.shards
        yield int(aside[0]), block, HEAD, 0, _pack(np.array([len(pages), len(several)], np.int64), *_planes(homes))
        for home, own in shards.items():
            texts = [c.encode() for c in own]
            yield int(home), block, CHUNKS, int(home), _pack(np.array([len(t) for t in texts], np.uint32), np.frombuffer(b"".join(texts), np.uint8))
        for i, page in enumerate(pages):
            yield int(aside[i + 1]), block, PAGE, i, page


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(_FIELDS))


def _in_batches(rows: Iterator[tuple], size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1])
        if n >= size:
            yield _batch(held)
            held, n = [], 0
    if held:
        yield _batch(held)


def _to_blocks(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    block, number = _Block(shards, 0), 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            block.add(doc_id, text.as_py() or "")
            if block.full():
                yield from _in_batches(block.rows())
                number += 1
                block = _Block(shards, number)
    if block.docs:
        yield from _in_batches(block.rows())


def _segmented(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Chunks of a shard become ids, each distinct chunk segmented once; a shard's rows come together."""
    model = processor(path)
    kind_of = np.uint16 if model.vocab_size() <= 1 << 16 else np.uint32
    shard, known = None, {}

    def answers() -> Iterator[tuple]:
        nonlocal shard, known
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _FIELDS), strict=True):
                if row[2] != CHUNKS:
                    yield row
                    continue
                if row[0] != shard:
                    shard, known = row[0], {}
                sizes, data = _unpack(row[4])
                whole, ends = data.tobytes(), np.cumsum(sizes.astype(np.int64))
                texts = [whole[a:b].decode() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                new = [t for t in texts if t not in known]
                known.update(zip(new, (np.array(x, kind_of).tobytes() for x in segment(model, new)), strict=True))
                ids = [known[t] for t in texts]
                counts = np.array([len(x) for x in ids], np.int64) // np.dtype(kind_of).itemsize
                flat = np.frombuffer(b"".join(ids), kind_of)
                cuts = _planes(counts)
                yield *row[:4], _pack(np.array([len(cuts)], np.int64), *cuts, *_planes(flat))

    yield from _in_batches(answers())


def _ids_in_place(numbers: np.ndarray, starts: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of chunks, in the order of their numbers, and the number of ids up to each chunk."""
    n = counts[numbers]
    ends = np.cumsum(n)
    within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)
    return flat[np.repeat(starts[numbers], n) + within], ends


def _put_back(batches: Iterator[pa.RecordBatch], path: str, finish: Callable, names: list[str], bos: bool, eos: bool) -> Iterator[pa.RecordBatch]:
    """A block's rows come together: its head, its shards' ids in order, its pages."""
    model = processor(path)
    before, after = [model.bos_id()] * bos, [model.eos_id()] * eos
    block, parts, table, left, several, homes = None, [], None, 0, 0, None

    def whole() -> tuple[np.ndarray, ...]:
        counts = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        if len(counts) != len(homes):
            raise RuntimeError("a block's chunks came back incomplete: its input changed while the job ran")
        order = np.argsort(homes, kind="stable")
        starts, sizes = np.empty(len(counts), np.int64), np.empty(len(counts), np.int64)
        starts[order], sizes[order] = np.cumsum(counts) - counts, counts
        return starts, sizes, flat

    for batch in batches:
        for b, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "payload")), strict=True):
            if kind == HEAD:
                if left:
                    raise RuntimeError("a block's pages came back incomplete: its input changed while the job ran")
                n, *planes = _unpack(payload)
                block, parts, table, left, several, homes = b, [], None, int(n[0]), int(n[1]), _joined(planes)
                continue
            if b != block:
                raise RuntimeError("a block came back without its head: its input changed while the job ran")
            if kind == CHUNKS:
                n, *planes = _unpack(payload)
                parts.append((_joined(planes[: int(n[0])]), _joined(planes[int(n[0]) :])))
                continue
            if table is None:
                table, parts = whole(), []
            left -= 1
            doc_ids, nulls, once, sizes, *planes = _unpack(payload)
            numbers = _joined(planes)
            single = numbers == 0
            numbers = np.where(single, several + int(once[0]) + np.cumsum(single) - 1, numbers - 1)
            ids, ends = _ids_in_place(numbers, *table)
            cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
            each = (before + ids[a:b].tolist() + after for a, b in zip(cuts, cuts[1:], strict=False))
            yield from finish(model, pa.array(doc_ids, mask=nulls), each, names)
    if left:
        raise RuntimeError("a block's pages came back incomplete: its input changed while the job ran")


def _encode_whole(batches: Iterator[pa.RecordBatch], path: str, finish: Callable, names: list[str], bos: bool, eos: bool) -> Iterator[pa.RecordBatch]:
    model = processor(path)
    for batch in batches:
        each = (model.encode(t.as_py() or "", add_bos=bos, add_eos=eos) for t in batch.column("text"))
        yield from finish(model, batch.column("doc_id"), each, names)


def _as_lists(model: SentencePieceProcessor, doc_ids: pa.Array, each: Iterator[list[int]], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at, part in _slices(each):
        yield pa.RecordBatch.from_arrays([doc_ids.slice(at, len(part)), pa.array(part, pa.list_(pa.int32()))], names)


def _as_digests(model: SentencePieceProcessor, doc_ids: pa.Array, each: Iterator[list[int]], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at, part in _slices(each):
        ids = [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in part]
        texts = [hashlib.sha256(model.decode(x).encode()).hexdigest() for x in part]
        counts = pa.array([len(x) for x in part], pa.int64())
        yield pa.RecordBatch.from_arrays([doc_ids.slice(at, len(part)), counts, pa.array(ids), pa.array(texts)], names)


def _slices(each: Iterator[list[int]], size: int = 256) -> Iterator[tuple[int, list[list[int]]]]:
    at, held = 0, []
    for ids in each:
        held.append(ids)
        if len(held) == size:
            yield at, held
            at, held = at + size, []
    if held:
        yield at, held


def _encoded(docs: DataFrame, model: str, finish: Callable, schema: str, bos: bool, eos: bool, id_col: str, text_col: str) -> DataFrame:
    rows = id_and_text(docs, id_col, text_col)
    given = {"path": model, "finish": finish, "names": [c.split()[0] for c in schema.split(", ")], "bos": bos, "eos": eos}
    if not can_be_cut(model):
        return rows.mapInArrow(partial(_encode_whole, **given), schema)
    shards = SHARDS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.mapInArrow(partial(_to_blocks, shards=shards), _ROWS)
    sharded = blocks.repartition("route").sortWithinPartitions("route", "block")
    answered = sharded.mapInArrow(partial(_segmented, path=model), _ROWS)
    home = answered.repartition("block").sortWithinPartitions("block", "kind", "seq").select("block", "kind", "payload")
    return home.mapInArrow(partial(_put_back, **given), schema)


def encode(docs: DataFrame, model: str, bos: bool = False, eos: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids that the library gives for every row's whole text.

    ``model`` is the path of a model file that every worker can read. A null text is empty
    and has no ids but ``bos`` and ``eos``. Rows with equal or null ids are kept as they are;
    the order of rows is not. An empty table gives an empty one.
    """
    return _encoded(docs, model, _as_lists, "doc_id long, ids array<int>", bos, eos, id_col, text_col)


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = processor(path)
    for batch in batches:
        texts = [model.decode(x.as_py() or []) for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)``: the library's text of every row's ids; of null or no ids the empty text."""
    ids = rows.select(rows[id_col].cast("long").alias("doc_id"), rows[ids_col].cast("array<int>").alias("ids"))
    return ids.mapInArrow(partial(_decoded, path=model), "doc_id long, text string")


def encoded_digests(docs: DataFrame, model: str, bos: bool = True, eos: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the rows of :func:`encode` and
    of the texts that the library decodes from them."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, model, _as_digests, schema, bos, eos, id_col, text_col)
