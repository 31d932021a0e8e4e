"""Merkle-tree fingerprints of documents over sections, paragraphs and pieces of paragraphs.

Paragraphs are lines. A paragraph is cut into pieces of about PIECE words and the paragraphs
into sections of about SECTION, each where the content says so (a word's hash, a paragraph's
digest, or an empty paragraph), so an edit changes the pieces it touches and no others. What
has no spaces for LONG bytes, such as Chinese or minified text, is cut where a rolling hash of
its bytes says so, between characters, into pieces of LEAST to MOST bytes. A node's digest covers those of its children; the root tells whether two texts are equal, and
only where digests differ does a comparison descend.

A fingerprint is text: the root, ``|``, and the sections joined by ``;``, each with its
paragraphs joined by ``,``, each with its pieces' shortened digests, LEAF hex digits apiece.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfspark.llm.words import id_and_text, mixed, text_batches, word_hashes

PIECE, SECTION, LEAF = 8, 8, 12
LONG, LEAST, MOST = 512, 32, 512  # bytes
WINDOW, EVERY = 24, 64  # bytes that a rolling hash covers, and bytes from cut to cut, about
DOCS_PER_RANGE, MOST_RANGES = 500, 100_000


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _pieces(line: bytes) -> list[bytes]:
    return [part for piece in _worded(line) for part in (_rolled(piece) if len(piece) > LONG else [piece])]


def _rolled(piece: bytes) -> list[bytes]:
    """A long piece, cut where the hash of the bytes before says so."""
    data = np.frombuffer(piece, np.uint8)
    n = len(data) - WINDOW + 1
    rolling = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        rolling = mixed(rolling * np.uint64(31) + data[j : j + n].astype(np.uint64) + np.uint64(1))
    begins = np.append((data & 0xC0) != 0x80, True)  # places where a character begins
    places = np.flatnonzero(rolling % np.uint64(EVERY) == 0) + WINDOW
    cuts, at = [], 0
    for place in [*places[begins[places]].tolist(), len(data)]:
        while place - at > MOST:
            at += MOST
            while not begins[at]:
                at -= 1
            cuts.append(at)
        if place - at >= LEAST or place == len(data):
            cuts.append(place)
            at = place
    return [piece[a:b] for a, b in zip([0, *cuts], cuts, strict=False) if b > a]


def _worded(line: bytes) -> list[bytes]:
    words = line.split(b" ")
    if len(words) <= 1:
        return [line]
    ends = np.flatnonzero(word_hashes(words) % np.uint64(PIECE) == 0) + 1
    cuts = [0, *ends.tolist()]
    if cuts[-1] != len(words):
        cuts.append(len(words))
    return [b" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def fingerprint(text: bytes) -> str:
    """The tree of a text, as described above; an empty text is one empty paragraph."""
    sections, paragraphs, digests, tops = [], [], [], []
    for line in text.split(b"\n"):
        leaves = [_digest(x) for x in _pieces(line)]
        node = _digest(b"".join(leaves))
        paragraphs.append("".join([x.hex()[:LEAF] for x in leaves]))
        digests.append(node)
        if not line or node[0] % SECTION == 0:
            tops.append(_digest(b"".join(digests)))
            sections.append(",".join(paragraphs))
            paragraphs, digests = [], []
    if digests:
        tops.append(_digest(b"".join(digests)))
        sections.append(",".join(paragraphs))
    return _digest(b"".join(tops)).hex() + "|" + ";".join(sections)


def _leaves(branch: str) -> Counter:
    found: Counter = Counter()
    for paragraph in branch.replace(";", ",").split(","):
        found.update([paragraph[i : i + LEAF] for i in range(0, len(paragraph), LEAF)])
    return found


def likeness(a: str, b: str) -> float:
    """Share of pieces that two fingerprints have in common, from 0 to 1; 1 for equal roots."""
    if a.partition("|")[0] == b.partition("|")[0]:
        return 1.0
    x, y = (_leaves(f.partition("|")[2]) for f in (a, b))
    common = sum(min(n, y[k]) for k, n in x.items() if k in y)
    return 2 * common / (x.total() + y.total())


def edited_paragraphs(a: str, b: str) -> list[int]:
    """Numbers, from 0, of the paragraphs of ``a`` that aren't in ``b``; only sections that ``b``
    doesn't have are looked into."""
    if a.partition("|")[0] == b.partition("|")[0]:
        return []
    theirs = b.partition("|")[2].split(";")
    whole, paragraphs = Counter(theirs), Counter(p for s in theirs for p in s.split(","))
    out, at = [], 0
    for section in a.partition("|")[2].split(";"):
        parts = section.split(",")
        if whole[section] > 0:
            whole[section] -= 1
            paragraphs.subtract(parts)
        else:
            for i, p in enumerate(parts):
                if paragraphs[p] > 0:
                    paragraphs[p] -= 1
                else:
                    out.append(at + i)
        at += len(parts)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, fingerprint)`` for every row; a null text is empty."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches):
            chars = [len(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(chars, pa.int64()), pa.array([fingerprint(t) for t in texts], pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(make, "doc_id long, n_chars long, fingerprint string")


def compare(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` of fingerprints with ``equal``, ``likeness`` and ``edited``, the paragraphs of
    ``a`` that ``b`` lacks. Null where a fingerprint is."""

    @pandas_udf("struct<equal boolean, likeness double, edited array<int>>")
    def made(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = [
            (None, None, None) if p is None or q is None else (p.partition("|")[0] == q.partition("|")[0], likeness(p, q), edited_paragraphs(p, q))
            for p, q in zip(x, y, strict=True)
        ]
        return pd.DataFrame(rows, columns=["equal", "likeness", "edited"])

    return pairs.withColumn("compared", made(F.col(a), F.col(b))).select(*pairs.columns, "compared.*")


_EDITED = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, in order of id, those copied from the next range at the end."""
    last = None  # range, id, text and fingerprint of the row before
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = []
            spans, copies = part.column("span").to_pylist(), part.column("copied").to_pylist()
            for (ids, texts) in text_batches([part]):
                for span, copied, doc, data in zip(spans, copies, ids.to_pylist(), texts, strict=True):
                    if copied and (last is None or last[0] != span):
                        continue
                    text, mine = data.decode("utf-8", "replace"), fingerprint(data)
                    if last is not None and last[0] == span:
                        rows.append(_one_edit(*last[1:], text, mine))
                    last = None if copied else (span, doc, text, mine)
            yield pa.RecordBatch.from_pylist(rows, schema=_EDITED)


def _one_edit(doc: int, text: str, mine: str, after: str, its: str) -> dict:
    half = len(text) // 2
    edited = (text[: len(text) - half] + after[:half]).encode()
    changed = fingerprint(edited)
    return {
        "doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited).hexdigest(),
        "fingerprint": mine, "edited_fingerprint": changed, "near_edited": likeness(mine, changed),
        "near_next": likeness(mine, its),
    }


def edited_by_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text whose last half is the next document's first.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``. The last floor(n_chars / 2) code points give way to as many first ones of
    the next document by id, or all it has; the document after the last is the first. A null
    text is empty. Rows that repeat an id are ordered by text. Rows without an id have no
    place in the order and are left out. A sole document is its own next; an empty table
    gives an empty result.

    Texts move once, to their range of ids. A range also gets a copy of the first document
    after it, so neighbours meet in one task. The driver sees the ranges' bounds and first
    ids, at most MOST_RANGES of each.
    """
    texts = id_and_text(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    spark = docs.sparkSession
    n = min(MOST_RANGES, -(-texts.count() // DOCS_PER_RANGE))
    if n == 0:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    shares = [i / n for i in range(1, n)]
    cuts = texts.select(F.percentile_approx("doc_id", shares, 10 * n).alias("q")).first()["q"] if shares else []
    bounds = np.array(sorted(set(cuts)), np.int64)

    @pandas_udf("int")
    def span_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), "left").astype(np.int32))

    firsts = dict(texts.select("doc_id", span_of("doc_id").alias("span")).groupBy("span").agg(F.min("doc_id")).collect())
    filled = sorted(firsts)
    after = [(firsts[b], a) for a, b in zip(filled, filled[1:] + filled[:1], strict=True)]
    copied = texts.join(F.broadcast(spark.createDataFrame(after, "doc_id long, span int")), "doc_id")
    both = texts.select("doc_id", "text", span_of("doc_id").alias("span"), F.lit(False).alias("copied")).unionByName(
        copied.select("doc_id", "text", "span", F.lit(True).alias("copied"))
    )
    ordered = both.repartition("span").sortWithinPartitions("span", "copied", "doc_id", "text")
    return ordered.mapInArrow(
        _edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
