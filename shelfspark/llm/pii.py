"""Personal data by weak supervision, in DataFrame functions throughout.

Four kinds have a base pattern each; its matches that pass the kind's test are base spans.
Looser patterns of the same kinds give further candidates: addresses written out with "at"
and "dot", numbers in other groupings. Labelers vote on each candidate, for, against or not
at all: regex labelers by its shape and check digits, gazetteer labelers by the domain's
ending and by providers' names, context labelers by the words before it. Votes are counted
by kind and pattern of votes, and expectation-maximisation estimates from these counts how
reliable each labeler is. Its posteriors are the labels of a logistic span classifier over
the votes and two features of the span, and what that takes for personal data is added.

Patterns are written so that no group repeats without bound, since such groups recurse in
the regex engine and long texts would end it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.matches import before, with_matches
from shelfspark.llm.words import id_and_text
from shelfspark.session import staged

KINDS = ("email", "ip", "card", "phone")
BEFORE = 40  # code points before a candidate that context labelers see
EM_ROUNDS, PRIOR = 50, 0.5
THRESHOLD = 0.9

# A character that marks a joint inside a chain. A text's own give way to one that no pattern has.
_JOINT, _INSTEAD = "\x01", "\x02"

# Endings and names for the gazetteer labelers.
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us")
PROVIDERS = ("gmail", "yahoo", "hotmail", "outlook", "icloud", "proton", "gmx", "example", "mail")

_WORDS_BEFORE = {
    "email": r"(?i)(e-?mail|mail|contact|write|reach|address)\W*(\w+\W+){0,2}$",
    "ip": r"(?i)(\bip\b|host|server|address|login|from)\W*(\w+\W+){0,2}$",
    "card": r"(?i)(card|visa|mastercard|credit|payment|pay|account)\W*(\w+\W+){0,2}$",
    "phone": r"(?i)(phone|tel|call|mobile|fax|ring|whatsapp)\W*(\w+\W+){0,2}$",
}
_AGAINST_BEFORE = r"(?i)(version|v|section|isbn|issn|id|no|nr|order|invoice|page|#)\W*$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn test."""
    turned = F.reverse(digits)

    def worth(d: Column, i: Column) -> Column:
        v = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    ds = F.filter(F.split(turned, ""), lambda d: d != "")
    return F.aggregate(F.transform(ds, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _small_parts(ip: Column) -> Column:
    """All parts of a dotted number at most 255."""
    parts = F.transform(F.split(ip, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _count(match: Column) -> Column:
    return F.length(_digits(match))


def _chained(text: Column, before: str, joint: str, after: str) -> Column:
    """The text with JOINT for every joint between two of the given characters."""
    return F.regexp_replace(text, f"(?<={before}){joint}(?={after})", _JOINT)


_LOCAL, _LABEL = r"A-Za-z0-9._%+\-", r"A-Za-z0-9\-"


def _prepared(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.when(text.contains("@"), _chained(text, f"[{_LABEL}]", r"\.", f"[{_LABEL}]"))
    if kind == "card":
        return F.when(text.rlike("[0-9][ -]?[0-9]"), _chained(text, "[0-9]", "[ -]", "[0-9]"))
    if kind == "ip":
        return F.when(text.rlike(r"[0-9]\.[0-9]"), text)
    return F.when(text.rlike(r"\+[0-9]"), text)


# A match begins where a run does or right after the last match, so no run is tried from its middle.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}{_JOINT}])|\G)[{_LOCAL}{_JOINT}]++@[{_LABEL}]++{_JOINT}[{_LABEL}{_JOINT}]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # chains of other lengths fail the test, so only whole ones of 14 to 19 digits are looked for
    "card": rf"(?<![0-9{_JOINT}])(?:[0-9]{_JOINT}?){{14,19}}+(?![0-9{_JOINT}])",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return _small_parts(match)
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return _count(match).between(10, 15)
    return F.lit(True)


# Looser patterns, for candidates beside the base spans, and what a text must have to be searched.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+(?: ?(?:\[at\]|\(at\)) ?| at )[A-Za-z0-9-]{2,63}(?: ?(?:\[dot\]|\(dot\)) ?| dot |\.)[A-Za-z]{2,10}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?: \. |\[\.\]|\(\.\))[0-9]{1,3}(?: \. |\[\.\]|\(\.\))[0-9]{1,3}(?: \. |\[\.\]|\(\.\))[0-9]{1,3}(?![0-9.])",
    "card": r"(?<![0-9.+-])[0-9]{4}[._/][0-9]{4}[._/][0-9]{4}[._/][0-9]{2,7}(?![0-9])",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|0[0-9]{2,4}[ /-]|00[0-9]{2}[ -])[0-9]{3,4}(?:[ -][0-9]{2,4}){1,3}(?![0-9])",
}
_HINTS = {
    "email": r"[\[(]at[\])]| at [A-Za-z0-9-]+(?: dot |\.[A-Za-z]|[ ]?[\[(]dot)", "ip": r"[0-9](?: \. |\[\.\]|\(\.\))[0-9]",
    "card": r"[0-9]{4}[._/][0-9]{4}", "phone": r"\([0-9]{3}\)|0[0-9]{2}",
}
def _of_kind(array: str, kind: str, tested: bool) -> Column:
    """The matches as spans of the kind; ``tested`` ones only if they pass its test."""
    kept = F.filter(array, lambda s: _passes(kind, s["match"])) if tested else F.col(array)
    place = F.lit(KINDS.index(kind)).alias("place")
    return F.transform(
        kept, lambda s: F.struct(s["start"].alias("start"), place, s["end"].alias("end"), F.lit(kind).alias("kind"), s["match"].alias("match"))
    )


def _with_all_spans(texts: DataFrame) -> DataFrame:
    """``texts`` with ``base`` and ``loose`` spans; a loose one overlaps no base span."""
    rows = texts.withColumn("text", F.replace(F.coalesce("text", F.lit("")), F.lit(_JOINT), F.lit(_INSTEAD)))
    for kind in KINDS:
        rows = with_matches(rows, f"_base_{kind}", _prepared(kind, F.col("text")), PATTERNS[kind])
        hinted = F.when(F.col("text").rlike(_HINTS[kind]), F.col("text"))
        rows = with_matches(rows, f"_loose_{kind}", hinted, LOOSE[kind])
    rows = rows.withColumn("base", F.concat(*(_of_kind(f"_base_{k}", k, True) for k in KINDS)))
    rows = rows.withColumn("loose", F.concat(*(_of_kind(f"_loose_{k}", k, False) for k in KINDS)))
    apart = F.filter("loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.select("doc_id", "text", "base", apart.alias("loose"))


LABELERS = ("shape", "check", "gazetteer", "context", "against")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _by_kind(kind: Column, **of: Column) -> Column:
    out = F.lit(False)
    for name, value in of.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def votes(kind: Column, match: Column, context_text: Column, is_base: Column) -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1, -1, or 0 for none."""
    digits = _digits(match)
    n = F.length(digits)
    dotted = F.regexp_replace(F.regexp_replace(match, r"[^0-9]+", "."), r"^\.|\.$", "")
    ending = F.lower(F.regexp_extract(match, r"([A-Za-z]+)$", 1))
    provider = F.lower(match).rlike(f"({'|'.join(PROVIDERS)})")
    context = _by_kind(kind, **{k: context_text.rlike(words) for k, words in _WORDS_BEFORE.items()})
    return {
        "shape": _vote(is_base, F.length(match) > 60),
        "check": _vote(
            _by_kind(kind, email=~match.contains(".."), ip=_small_parts(dotted), card=luhn(digits), phone=n.between(10, 13)),
            _by_kind(kind, ip=~_small_parts(dotted), card=~luhn(digits), phone=~n.between(8, 15)),
        ),
        "gazetteer": _vote(
            _by_kind(
                kind, email=ending.isin(*ENDINGS) | provider, ip=dotted.rlike(r"^(10|127|172|192)\."), card=digits.rlike("^[3456]"),
                phone=digits.rlike("^(00|1|49|33|34|44)"),
            ),
            _by_kind(kind, email=~ending.isin(*ENDINGS)),
        ),
        "context": _vote(context, F.lit(False)),
        "against": _vote(F.lit(False), context_text.rlike(_AGAINST_BEFORE)),
    }


def features(kind: Column, match: Column, context_text: Column, is_base: Column) -> dict[str, Column]:
    """The votes and two features of the span itself."""
    found = votes(kind, match, context_text, is_base)
    found["long_match"] = (F.length(match) > 30).cast("int")
    found["digit_run"] = match.rlike("[0-9]{9}").cast("int")
    return found


def reliabilities(patterns: list[tuple]) -> dict[str, dict]:
    """Expectation-maximisation over counted patterns ``(kind, *votes, n)``, kind by kind.

    For each kind the share of personal data, and for each labeler the chances of its three
    votes in either class. Smoothing leans on labelers being right more often than not.
    """
    out = {}
    for kind in KINDS:
        rows = [(r[1:-1], r[-1]) for r in patterns if r[0] == kind]
        share = PRIOR
        chance = [{1: {1: 0.6, 0: 0.3, -1: 0.1}, 0: {1: 0.1, 0: 0.3, -1: 0.6}} for _ in LABELERS]
        for _ in range(EM_ROUNDS):
            post = [(votes, n, _posterior(votes, share, chance)) for votes, n in rows]
            total = sum(n for _, n, _ in post)
            share = (sum(n * p for _, n, p in post) + 1) / (total + 2)
            for j in range(len(LABELERS)):
                for c in (1, 0):
                    sums = {v: (2.0 if v == (1 if c else -1) else 1.0) for v in (1, 0, -1)}
                    for votes, n, p in post:
                        sums[votes[j]] += n * (p if c else 1 - p)
                    chance[j][c] = {v: x / sum(sums.values()) for v, x in sums.items()}
        out[kind] = {"share": share, "chance": chance}
    return out


def _posterior(votes: tuple, share: float, chance: list) -> float:
    yes, no = math.log(share), math.log(1 - share)
    for v, c in zip(votes, chance, strict=True):
        yes, no = yes + math.log(c[1][v]), no + math.log(c[0][v])
    return 1 / (1 + math.exp(min(700, no - yes)))


def span_classifier(counts: list[tuple], labels: dict[str, dict]) -> list[float]:
    """Weights of a logistic classifier on spans, from counted feature rows.

    ``counts`` has ``(kind, *votes, long_match, digit_run, n)``. Features are a constant, the
    kinds, the votes and the two features; the labels are the posteriors, by weighted Newton
    steps over the distinct rows.
    """
    rows = []
    for r in counts:
        p = _posterior(r[1 : 1 + len(LABELERS)], **labels[r[0]])
        rows.append((_inputs(r[0], r[1:-1]), p, r[-1]))
    size = 1 + len(KINDS) + len(LABELERS) + 2
    w = [0.0] * size
    for _ in range(30):
        grad, hess = [-x for x in w], [[float(i == j) for j in range(size)] for i in range(size)]
        for x, p, n in rows:
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x, strict=True))))))
            for i in range(size):
                grad[i] += n * (p - q) * x[i]
                for j in range(size):
                    hess[i][j] += n * q * (1 - q) * x[i] * x[j]
        step = _solved(hess, grad)
        w = [a + max(-3.0, min(3.0, s)) for a, s in zip(w, step, strict=True)]
        if max(map(abs, step)) < 1e-6:
            break
    return w


def _inputs(kind: str, values: tuple) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS), *map(float, values)]


def _solved(a: list[list[float]], b: list[float]) -> list[float]:
    """Solution of a small system of equations, by elimination."""
    n = len(b)
    m = [[*row, y] for row, y in zip(a, b, strict=True)]
    for i in range(n):
        top = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[top] = m[top], m[i]
        for r in range(n):
            if r != i:
                f = m[r][i] / m[i][i]
                m[r] = [x - f * y for x, y in zip(m[r], m[i], strict=True)]
    return [m[i][n] / m[i][i] for i in range(n)]


def _taken(span: Column, weights: list[float]) -> Column:
    """Whether the classifier takes a loose span for personal data."""
    total = F.lit(weights[0])
    for k, w in zip(KINDS, weights[1:], strict=False):
        total = total + F.when(span["kind"] == k, w).otherwise(0.0)
    found = features(span["kind"], span["match"], span["before"], F.lit(False))
    for value, w in zip(found.values(), weights[1 + len(KINDS) :], strict=True):
        total = total + value * F.lit(w)
    return total > math.log(THRESHOLD / (1 - THRESHOLD))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, added)`` per row: arrays of (start, place, end, kind) in code points.

    ``base`` has the spans of the base patterns, ordered by start and then kind as in KINDS,
    and ``added`` those that the classifier adds, which overlap no base span. Ends are
    exclusive. A null text is empty. Every row is searched on its own, so ids may repeat or
    be null. An empty table gives an empty result.

    The votes are counted over all candidates. At most 4 * 3 ** 5 * 4 rows of counts come to
    the driver, whatever the data.
    """
    spans = _with_all_spans(id_and_text(docs, id_col, text_col))

    def with_before(array: str) -> Column:
        return F.transform(array, lambda s: s.withField("before", before(F.col("text"), s["start"], BEFORE)))

    rows = staged(spans.select("doc_id", with_before("base").alias("base"), with_before("loose").alias("loose")), "pii-spans")
    candidates = rows.select(F.explode("base").alias("s"), F.lit(True).alias("is_base")).unionByName(
        rows.select(F.explode("loose").alias("s"), F.lit(False).alias("is_base"))
    )
    flat = candidates.select("s.kind", "s.match", "s.before", "is_base")
    found = features(*(F.col(c) for c in flat.columns))
    counted = sorted(tuple(r) for r in flat.select("kind", *(v.alias(k) for k, v in found.items())).groupBy("kind", *found).count().collect())
    patterns: dict[tuple, int] = {}
    for r in counted:
        key = r[: 1 + len(LABELERS)]
        patterns[key] = patterns.get(key, 0) + r[-1]
    weights = span_classifier(counted, reliabilities([(*k, n) for k, n in sorted(patterns.items())]))

    def plain(spans: Column | str) -> Column:
        return F.array_sort(
            F.transform(
                spans, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))
            )
        )

    return rows.select("doc_id", plain("base").alias("base"), plain(F.filter("loose", lambda s: _taken(s, weights))).alias("added"))


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
