"""Fingerprints against the contract's own words."""

import hashlib

from shelfspark.llm.merkle import LONG, MOST, _pieces, compare, edited_by_next, edited_paragraphs, fingerprint, fingerprints, likeness


def test_edited_texts(given):
    docs, texts = given
    rows = {r.doc_id: r for r in edited_by_next(docs).collect()}
    order = sorted(texts)
    for at, i in enumerate(order):
        text, after = texts[i], texts[order[(at + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint(text.encode()), fingerprint(edited.encode()))
        assert (r.near_edited, r.near_next) == (likeness(r.fingerprint, r.edited_fingerprint), likeness(r.fingerprint, fingerprint(after.encode())))
    long = [r for r in rows.values() if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_equal_texts_equal_fingerprints(given):
    docs, texts = given
    marks = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    by_text = {}
    for i, t in texts.items():
        by_text.setdefault(t, set()).add(marks[i])
    assert all(len(m) == 1 for m in by_text.values()) and len(set().union(*by_text.values())) == len(by_text)


def test_edits_are_located(spark):
    lines = [f"paragraph {i} has some words of its own and ends here" for i in range(200)]
    a = fingerprint("\n".join(lines).encode())
    changed = list(lines)
    changed[57] = "another paragraph altogether"
    b = fingerprint("\n".join(changed[:100] + ["one more"] + changed[100:]).encode())
    assert edited_paragraphs(a, b) == [57] and edited_paragraphs(b, a) == [57, 100] and edited_paragraphs(a, a) == []
    assert 0.97 < likeness(a, b) < 1 and likeness(a, a) == 1.0
    pairs = spark.createDataFrame([(1, a, b), (2, a, a), (3, None, a)], "id int, a string, b string")
    got = {r.id: (r.equal, r.edited) for r in compare(pairs).collect()}
    assert got == {1: (False, [57]), 2: (True, []), 3: (None, None)}


def test_edges(edges, nothing, spark):
    rows = edited_by_next(edges).collect()
    assert len(rows) == edges.where("doc_id is not null").count()
    assert fingerprints(edges).count() == edges.count()
    sole = edited_by_next(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert sole.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and sole.near_next == 1.0
    assert edited_by_next(nothing).count() == 0 and fingerprints(nothing).count() == 0


def test_texts_without_spaces_are_cut_too():
    import random

    rng = random.Random(3)
    for letters in ("的一是不了人我在有他这为之大来以个中上们", "abcdef{};=", "x\t1\u00e9", "😀😁😂"):
        text = "".join(rng.choice(letters) for _ in range(6000))
        data = text.encode()
        parts = _pieces(data)
        assert b"".join(parts) == data and max(map(len, parts)) <= MOST and all(p.decode() for p in parts)
        half = "".join(rng.choice(letters) for _ in range(3000))
        near = likeness(fingerprint(data), fingerprint((text[:3000] + half).encode()))
        assert 0.4 < near < 0.62
        # an insertion in front moves no other cut
        assert likeness(fingerprint(data), fingerprint(("zz" + text).encode())) > 0.9
    assert len(_pieces(b"9" * 5000)) >= 5000 // MOST and _pieces(b"a" * LONG) == [b"a" * LONG]
