"""Piece ids and texts against the library."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shelfspark.llm import pieces
from shelfspark.llm.queries import op12_pieces, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return tokenizer_path("piece_bpe_32k.model")


def expected(model, text):
    sp = pieces.processor(model)
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


ODD = [
    None, "", " ", "  ", "   a", "a ", "a  ", "▁", "▁▁a▁", "a▁ b", "\n \n", " \t x", "é😀 ￿ \x00 \x01", "<s> </s> <unk> <0x41>",
    "x" * 3000, " " * 70 + "y", "a" + " " * 40 + "b", "ﬁ ａ é ½", "中文 没有 空格的一行", "9" * 500 + " " + "9" * 500,
]


def compared(spark, model, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, ids int")
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.encoded_digests(docs, model).collect())
    assert found == Counter((i, *expected(model, t)) for i, t in rows)


def test_odd_texts_equal_the_library(spark, model):
    compared(spark, model, [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id"), (None, None)])


def test_random_texts_in_small_blocks(spark, model, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 300)
    monkeypatch.setattr(pieces, "PAGE_WORDS", 20)
    rng = random.Random(1)
    letters = "ab é▁ \n\t😀中<0x>1 "
    compared(spark, model, [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(400)])


def test_blocks_end_where_they_should(monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 100)
    block = pieces._Block(4, 0)
    block.add(1, "a b " * 20)
    assert not block.full()
    block.add(2, "a b " * 20)
    assert block.full() and len(block.known) == 3


def test_ids_and_back(spark, model):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    ids = pieces.encode(docs, model)
    sp = pieces.processor(model)
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: sp.encode(t or "") for i, t in enumerate(ODD)}
    texts = {r.doc_id: r.text for r in pieces.decode(ids, model).collect()}
    assert texts == {i: sp.decode(sp.encode(t or "")) for i, t in enumerate(ODD)}


def test_empty_table(spark, model, nothing):
    assert pieces.encoded_digests(nothing, model).count() == 0


def test_a_block_of_another_run_is_noticed(model):
    class Task:
        def partitionId(self):  # noqa: N802 - Spark's name
            return 0

    import pyspark

    given = pieces.TaskContext.get
    pieces.TaskContext.get = staticmethod(lambda: Task())
    try:
        block = pieces._Block(2, 0)
        block.add(1, "some words in a row")
        rows = list(block.rows())
    finally:
        pieces.TaskContext.get = given
    answered = list(pieces._segmented(iter([pieces._batch(sorted(rows))]), model))
    kept = [r for b in answered for r in zip(*(b.column(c).to_pylist() for c in pieces._FIELDS), strict=True)]
    kept.sort(key=lambda r: r[1:4])

    def put(some):
        return list(pieces._put_back(iter([pieces._batch(some)]), model, pieces._as_digests, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], True, True))

    assert put(kept)[0].num_rows == 1
    for gone in (pieces.CHUNKS, pieces.HEAD, pieces.PAGE):
        at = next(i for i, r in enumerate(kept) if r[2] == gone)
        with pytest.raises(RuntimeError):
            put(kept[:at] + kept[at + 1 :])
    assert pyspark.TaskContext is pieces.TaskContext


def test_query_equals_the_library(spark, given, model):
    _, texts = given
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op12_pieces(spark, SF_DIR).collect()}
    assert found == {i: expected(model, t) for i, t in texts.items()}
