"""Token ids in flat binary files with 64-bit document offsets.

Layout of a folder, part by part in ascending order of ids: ``ids-NNNNNN.bin`` holds the
token ids of the part's documents one after the other, as little-endian unsigned integers of
16 bits where the vocabulary allows it, else 32; ``offsets-NNNNNN.bin`` holds for each
document the position of its first id, counted from the first part, as little-endian
unsigned 64-bit integers, and the part's end after them; ``docs-NNNNNN.bin`` holds the
documents' ids as signed 64-bit integers. ``parts`` is a Parquet table of the parts.

Documents are dealt to parts by range of id. A part's task writes its files under a name of
its own attempt and renames them when they are whole, so a task that runs again replaces
them by equal ones. Where a part begins follows from the prefix sums of the parts' counts.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from shelfspark.llm.words import id_and_text
from shelfspark.session import scratch_dir

# A worker forgets pieces that it hasn't met among the last this many new ones; results don't depend on it.
REMEMBERED = 200_000
CHUNK = 128  # documents encoded at a time
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SIGNS = r"!-&(-/:-@\[-`{-~"  # printable ASCII signs but the apostrophe, which begins contractions
# A word before a space, a line feed or signs; signs after a word; a sole line feed; else
# all up to the next space. Each but the last is a token of the pre-tokenizer.
_PIECE = re.compile(
    f" ?[{_LETTERS}]+(?=[ \n{_SIGNS}]|$)|(?<=[{_LETTERS}])[{_SIGNS}]+(?=[ \n]|$)|(?<=\\S)\n(?=\\S)| ?[^ ]+"
)
_SPACES = re.compile(r" \s")


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones as
    themselves, the others as the letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_letters()
_SPACE = _BYTES[32]
_TAIL = ".,!:;?"
_LATIN_END = "\u0250"  # letters before it are letters by any version of the character database


def _is_word(piece: str) -> bool:
    """Whether a piece is Latin letters throughout, after one space or none."""
    letters = piece[1:] if piece[:1] == " " else piece
    return letters.isalpha() and (letters.isascii() or max(letters) < _LATIN_END)


class PieceEncoder(dict):
    """Ids of whole texts, encoded piece by piece; as a dict, the ids of the pieces met so far.

    A byte-level pre-tokenizer always begins a new token where white space follows other
    text, so a text may be cut before such a space and the ids of the pieces joined. It also
    begins one between a letter or digit and the points after it, and takes a word as one
    token. Most pieces recur, and each is encoded once. Texts with an added token's
    characters, and all texts where the tokenizer is of another kind, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.before: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.model, self.code = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        self.cuts = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
        self.cuts = self.cuts and made["normalizer"] is None and made["post_processor"] is None and made["model"]["type"] == "BPE"

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _word(self, piece: str) -> bytes:
        if piece.isascii():
            letters = _SPACE + piece[1:] if piece[0] == " " else piece
        else:
            letters = piece.encode().decode("latin-1").translate(_BYTES)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        """Ids of a piece that isn't known yet, or not any more."""
        if piece in self.before:
            ids = self[piece] = self.before[piece]
            return ids
        at = piece.find("\n")
        if 0 < at < len(piece) - 1 and not piece[at - 1].isspace() and not piece[at + 1].isspace():
            # a sole line feed is a token of its own
            return self[piece[:at]] + self["\n"] + self[piece[at + 1 :]]
        if _is_word(piece):
            ids = self[piece] = self._word(piece)
            return ids
        core = piece.rstrip(_TAIL)
        if _is_word(core):
            ids = self.get(core)
            if ids is None:
                ids = self[core] = self._word(core)
        elif len(core) < len(piece) and core[-1:].isalnum() and core[-1:] < _LATIN_END:
            ids = self[core]
        else:
            ids = self[piece] = self._ids([piece])[0]
            return ids
        if len(core) < len(piece):
            ids += self[piece[len(core) :]]
            self[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as bytes of ``dtype``, one entry per text."""
        if not self.cuts:
            return self._ids(texts)
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()
        get = self.__getitem__
        return [self._ids([t])[0] if any(a in t for a in self.added) else b"".join(map(get, self._pieces(t))) for t in texts]

    @staticmethod
    def _pieces(text: str) -> list[str]:
        if text[:1] != " " and text[-1:] != " " and not _SPACES.search(text):
            return _PIECE.findall(text)
        first, *rest = text.split(" ")
        # white space that isn't one space before other text goes with the piece it follows
        pieces, blank = [first], ""
        for x in rest:
            if not x:
                blank += " "
                continue
            piece, joins = blank + " " + x, blank or x[0].isspace()
            blank = ""
            if joins and (not pieces[-1] or pieces[-1][-1].isspace()):
                pieces[-1] += piece
            else:
                pieces.append(piece)
        pieces[-1] += blank
        return pieces


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder.replace("file:///", "file:/").replace("file:/", "file:///"))


def _name(folder: str, kind: str, part: int) -> str:
    return f"{folder}/{kind}-{part:06d}.bin"


class _Whole:
    """A file that appears under its name only when it has been written to the end."""

    def __init__(self, folder: str, kind: str, part: int) -> None:
        self.fs, base = _filesystem(folder)
        self.name = _name(base, kind, part)
        self.attempt = f"{self.name}.{TaskContext.get().taskAttemptId()}"
        self.fs.create_dir(base, recursive=True)
        self.out = self.fs.open_output_stream(self.attempt)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.attempt, self.name)


def _write_ids(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int | None):
    part = TaskContext.get().partitionId()
    model = encoder(tokenizer)
    end = b"" if end_id is None else np.array([end_id], model.dtype).tobytes()
    file = None
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            rows = batch.slice(at, CHUNK)
            if file is None:
                file = _Whole(folder, "ids", part)
            data = [x + end for x in model.encode([t or "" for t in rows.column("text").to_pylist()])]
            file.out.write(b"".join(data))
            n = rows.num_rows
            counts = pa.array([len(x) // model.dtype.itemsize for x in data], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), rows.column("doc_id"), counts], ["part", "doc_id", "n_tokens"]
            )
    if file:
        file.close()


def _write_offsets(batches: Iterator[pa.RecordBatch], folder: str):
    """Rows of a part come together and in order, each with the part's base."""
    part, files, at = None, (), 0
    for batch in batches:
        parts, docs, counts, bases = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "doc_id", "n_tokens", "base"))
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(parts)] if len(parts) else []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if parts[lo] != part:
                yield from _end(part, files, at)
                part, at = int(parts[lo]), int(bases[lo])
                files = tuple(_Whole(folder, kind, part) for kind in ("offsets", "docs"))
            ends = at + np.cumsum(counts[lo:hi])
            files[0].out.write(np.concatenate([[at], ends[:-1]]).astype("<u8").tobytes())
            files[1].out.write(docs[lo:hi].astype("<i8").tobytes())
            at = int(ends[-1])
    yield from _end(part, files, at)


def _end(part: int | None, files: tuple, at: int):
    if part is not None:
        files[0].out.write(np.array([at], "<u8").tobytes())
        for f in files:
            f.close()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], ["part"])


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", parts: int | None = None,
) -> DataFrame:
    """Encode ``docs`` into ``folder``; returns its table of parts.

    ``folder`` is one that all executors reach. ``tokenizer`` is the path of a tokenizer
    file, ``end_id`` an id written after each document. A null text is empty. Documents are
    ordered by id, those that share an id by text; rows without an id are left out, as the
    files name each document. An empty table writes no part.
    """
    spark = docs.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = id_and_text(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    ordered = texts.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    wrote = ordered.mapInArrow(partial(_write_ids, folder=folder, tokenizer=tokenizer, end_id=end_id), "part int, doc_id long, n_tokens long")
    wrote.withColumn("at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")

    # one row per part: as many as there were tasks
    sums = counts.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = sums.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    based.coalesce(1).write.mode("overwrite").parquet(f"{folder}/parts")
    table = spark.read.parquet(f"{folder}/parts")

    rows = counts.join(table.select("part", "base"), "part").repartition("part").sortWithinPartitions("part", "at")
    rows.drop("at").mapInArrow(partial(_write_offsets, folder=folder), "part int").write.mode("overwrite").parquet(f"{folder}/offsets")
    return table


def _mapped(folder: str, kind: str, part: int, dtype) -> np.ndarray:
    """A file as an array; memory-mapped where the file system is a local or mounted one."""
    fs, base = _filesystem(folder)
    name = _name(base, kind, part)
    size = fs.get_file_info(name).size
    if not size:
        return np.empty(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(name, dtype, "r")
    with fs.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype)


def _read(batches: Iterator[pa.RecordBatch], folder: str, width: int, make: Callable, names: list[str]):
    for batch in batches:
        for part in batch.column("part").to_pylist():
            offsets, docs = _mapped(folder, "offsets", part, "<u8"), _mapped(folder, "docs", part, "<i8")
            ids = _mapped(folder, "ids", part, f"<u{width}")
            base = int(offsets[0])
            for lo in range(0, len(docs), 4096):
                hi = min(lo + 4096, len(docs))
                cut = offsets[lo : hi + 1].astype(np.int64)
                made = [make(ids[a - base : b - base]) for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[lo:hi]), pa.array(cut[:-1]), pa.array(np.diff(cut)), pa.array(made)], names
                )


def _crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def read_token_files(spark: SparkSession, folder: str, tokenizer: str, digest: bool = False) -> DataFrame:
    """One row per document: ``(doc_id, start, n_tokens, ids)``, or ``ids_crc32`` instead of
    ``ids``: the crc32 of the ids as little-endian unsigned 32-bit integers."""
    width = encoder(tokenizer).dtype.itemsize
    parts = spark.read.parquet(f"{folder}/parts").select("part")
    # by number: a table of a few integers would be read by one task, and so all files by it
    parts = parts.repartition(max(1, parts.count()))
    name, kind, make = ("ids_crc32", "long", _crc32) if digest else ("ids", "array<long>", lambda ids: ids.astype(np.int64).tolist())
    columns = ["doc_id", "start", "n_tokens", name]
    return parts.mapInArrow(
        partial(_read, folder=folder, width=width, make=make, names=columns), f"doc_id long, start long, n_tokens long, {name} {kind}"
    )


def token_files(
    docs: DataFrame, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text",
    folder: str | None = None, digest: bool = True,
) -> DataFrame:
    """Write ``docs`` as token files, by default into the shared folder, and read them back."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    write_token_files(docs, folder, tokenizer, end_id, id_col, text_col)
    return read_token_files(spark, folder, tokenizer, digest)
