"""Token files read back against the tokenizer on whole texts."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from shelfspark.llm.token_files import PieceEncoder, read_token_files, token_files, write_token_files  # noqa: E402

PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    return tokenizers.Tokenizer.from_file(PATH)


def test_files_equal_whole_encodings(spark, given, whole, tmp_path):
    docs, texts = given
    folder = str(tmp_path / "tokens")
    write_token_files(docs, folder, PATH, 2, parts=5)
    digests = {r.doc_id: r for r in read_token_files(spark, folder, PATH, digest=True).collect()}
    ids = {r.doc_id: r.ids for r in read_token_files(spark, folder, PATH).collect()}
    at = 0
    for i in sorted(texts):
        expected = [*whole.encode(texts[i], add_special_tokens=False).ids, 2]
        assert ids[i] == expected
        assert (digests[i].start, digests[i].n_tokens, digests[i].ids_crc32) == (at, len(expected), zlib.crc32(np.array(expected, "<u4").tobytes()))
        at += len(expected)
    assert len(list(tmp_path.glob("tokens/ids-*.bin"))) > 1
    assert sum(f.stat().st_size for f in tmp_path.glob("tokens/ids-*.bin")) == 2 * at


def test_pieces_equal_whole_texts(whole):
    draw = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "a", "b", "é", ".", "'s", "'", "1", "23", "中", "　", "\xa0", "<|endoftext|>", "!!", " \n", "\r\n", "😀", "​", "\x1c", "\x85"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(12))) for _ in range(20_000)]
    got = PieceEncoder(PATH).encode(texts)
    assert got == [np.array(e.ids, "<u2").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_edges(edges, nothing, whole):
    found = token_files(edges, PATH, 2).collect()
    assert len(found) == edges.where("doc_id is not null").count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_tokens == by_id[2].n_tokens == 1 and by_id[1].start == 0 and by_id[2].start == 1
    assert by_id[8].n_tokens == len(whole.encode("x " * 60_000, add_special_tokens=False).ids) + 1
    assert sum(r.n_tokens for r in found) == max(r.start + r.n_tokens for r in found)
    assert token_files(nothing, PATH, 2).count() == 0


def test_pieces_of_signs_words_and_feeds_equal_the_tokenizer(whole):
    model = PieceEncoder(PATH)
    rng = random.Random(8)
    parts = ["Foo", "bar", "é", "ñtab", "1", "99", "'s", "'", "’s", ".", ",", "!!", "***", "&&&", "_", "-", "\n", " ", "  ", "\t", "😀", "ʼ", "ß", "×", "中", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for t, found, ids in zip(texts, model.encode(texts), wanted, strict=True):
        assert np.frombuffer(found, model.dtype).tolist() == ids, t


def test_files_are_read_by_as_many_tasks_as_there_are_parts(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    table = write_token_files(docs, str(tmp_path), PATH, 2, parts=6)
    found = read_token_files(spark, str(tmp_path), PATH, digest=True)
    assert found.count() == 400 and table.count() == 6
    tasks = found.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 3 and found.rdd.getNumPartitions() == 6
