"""Base spans against Python's regular expressions, and the weak supervision on planted candidates."""

import re

from shelfspark.llm.pii import KINDS, LABELERS, joined, personal_data, reliabilities, span_classifier

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in worth) % 10 == 0


def brute(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(out))


ODD = [
    None, "", "a@b.co_x@y.zz a@b.c.d..e x@y @z.q a@b.com@c.de", " 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "4111 1111 1111 1111  4111-1111-1111-1111",
    "+1 (415) 555-0100. +49 30 1234567890123456 +1 2", "1.2.3.4.5 256.1.1.1 001.02.3.0000255 é1.2.3.4 1.2.3.300",
    "\x01\x01 4111\x011111\x0111111111 4111 1111 1111 1111", " ".join(["1 2"] * 20_000), "a." * 20_000 + "@" + "b." * 20_000 + "c", "9" * 100_000,
    "+" + "1 " * 50_000, "😀 x@y.zz 😀 10.0.0.1", "+1-415-555-0100+1-415-555-0101", "-4111111111111111-",
]


def spans(found, column="base"):
    return [(r.doc_id, r[0]) for r in found.select(joined(found[column]), "doc_id").collect()]


def test_base_spans_equal_python(spark, given):
    docs, texts = given
    odd = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = dict(spans(personal_data(docs.select("doc_id", "text").unionByName(odd))))
    expected = texts | {100_000 + i: t for i, t in enumerate(ODD)}
    assert got == {i: brute(t) for i, t in expected.items()}


def test_adds_what_the_labelers_agree_on(spark):
    plain = [(i, f"mail me at user{i}@mail.example.com or call +1 415 555 01{i:02d}, ip 10.0.0.{i}, card 4111 1111 1111 1111") for i in range(60)]
    odd = [(100, "email: jane dot doe at example dot com please"), (101, "write to joe [at] gmail [dot] com now"), (102, "card 4111.1111.1111.1111 ok"),
           (103, "we met at noon.then left"), (104, "order no 1234.5678.9012.3456 is late")]
    found = personal_data(spark.createDataFrame(plain + odd, "doc_id long, text string"))
    added = dict(spans(found, "added"))
    assert added[101].startswith("email:") and added[102] == "card:5:24"
    assert added[103] == "" and added[104] == "" and all(added[i] == "" for i in range(60))
    assert dict(spans(found))[0].count(",") == 3


def test_reliabilities_tell_labelers_apart():
    good, bad = (1, 1, 1, 0, 0), (0, -1, -1, 0, -1)
    found = reliabilities([("email", *good, 90), ("email", *bad, 60), ("email", 0, 1, 1, 1, 0, 10)])
    shares = found["email"]["chance"][LABELERS.index("check")]
    assert shares[1][1] > 0.8 and shares[0][-1] > 0.8 and 0.4 < found["email"]["share"] < 0.8
    weights = span_classifier([("email", *good, 0, 0, 90), ("email", *bad, 0, 0, 60)], found)
    assert len(weights) == 1 + len(KINDS) + len(LABELERS) + 2 and weights[1 + len(KINDS) + 1] > 0


def test_edges(edges, nothing):
    found = personal_data(edges)
    assert found.count() == edges.count() and personal_data(nothing).count() == 0
    assert all(s == "" for _, s in spans(found))


def test_main_path_runs_no_python(edges):
    plan = personal_data(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
