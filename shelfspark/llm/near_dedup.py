"""MinHash near-duplicates, verified by odd sketches and then on full shingle sets.

A document's MinHash samples are cut into bands; documents equal in a band are candidates.
The same samples are folded into an odd sketch: each sample flips one bit, so the XOR of two
sketches holds the parity of the samples on which they differ, and its population count
tells how similar the sets are, precisely where they are similar. Candidates whose sketches
are too far apart are no further work. The rest is decided on the full sets.

Only components are wanted, so a bucket's members aren't paired with each other. Texts with
equal sets are one class. Then each bucket names its most central member its hub, the one
that shares buckets with most others, and each member meets the hub closest to it; what is
linked is one component from there on. Last, in buckets that still hold several components,
every member outside the largest visits blocks of the others and is compared with each of
another component there, so no link between different texts is lost to a hub. A block is a
bounded task, and only links leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.components import connected_components
from shelfspark.llm.words import id_and_text, mixed, shingle_set, text_batches
from shelfspark.session import staged

BANDS, ROWS = 40, 5  # at similarity 0.8 a pair shares no band once in 8 million pairs
WORDS = 8  # 64-bit words of an odd sketch
DEVIATIONS = 5  # standard deviations by which a pair at the threshold may look less alike
GROUP = 128  # members that meet one copy of a hub
BLOCK = 256  # documents that visitors are compared with at once
SHARE = 256  # visitors of a block that are compared in one task

_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)
_SIGNED_SQL = "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"


def _constants(samples: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(0, 1 << 32, samples, np.uint32) | np.uint32(1), draw.integers(0, 1 << 32, samples, np.uint32)


def minhashes(sets: list[np.ndarray], samples: int) -> np.ndarray:
    """One row of 32-bit samples per set; an empty set has the largest value throughout."""
    times, plus = _constants(samples)
    out = np.full((len(sets), samples), np.iinfo(np.uint32).max, np.uint32)
    for row, found in zip(out, sets, strict=True):
        high = (found >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(high), 256):
            np.minimum(row, (high[at : at + 256, None] * times + plus).min(0), out=row)
    return out


def odd_sketches(samples: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Parity bitmaps of MinHash samples, as rows of 64-bit words."""
    n, k = samples.shape
    place = mixed(samples.astype(np.uint64) + (np.arange(k, dtype=np.uint64) << np.uint64(32))) % np.uint64(64 * words)
    place = place.astype(np.int64) + 64 * words * np.arange(n)[:, None]
    odd = (np.bincount(place.ravel(), minlength=64 * words * n) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, 64 * words), axis=1).view(np.int64)


def largest_distance(similarity: float, samples: int = BANDS * ROWS, words: int = WORDS) -> int:
    """XOR population count up to which a pair may have the similarity.

    The mean for the expected number of differing samples, plus DEVIATIONS standard
    deviations: those of that number and of the parities.
    """
    bits, differ = 64 * words, samples * (1 - similarity)
    keep = (1 - 2 / bits) ** (2 * differ)
    slope = 2 * keep
    parity = bits / 4 * (1 - (1 - 4 / bits) ** (2 * differ))
    return math.ceil(bits / 2 * (1 - keep) + DEVIATIONS * math.sqrt(slope**2 * differ * similarity + parity))


def _sign(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_batches(batches):
        for at in range(0, len(texts), 512):
            sets = [shingle_set(t, k) for t in texts[at : at + 512]]
            samples = minhashes(sets, BANDS * ROWS)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sets), BANDS))
            for j in range(ROWS):
                band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + samples[:, j::ROWS])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, 512),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    _lists(band.view(np.int64)),
                    _lists(odd_sketches(samples)),
                ],
                schema=_SIGNED,
            )


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel()))


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_batches(batches):
        for at in range(0, len(texts), 256):
            part = [shingle_set(t, k).tobytes() for t in texts[at : at + 256]]
            yield pa.RecordBatch.from_arrays([ids.slice(at, 256), pa.array(part, pa.binary())], ["doc_id", "shingles"])


def _similar(one: np.ndarray, many: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``many`` sets have at least ``percent`` hundredths of the union in common with ``one``."""
    sizes = np.array([len(m) for m in many])
    flat = np.concatenate(many)
    hit = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    common = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(sizes)[:-1]]), dtype=np.int64)
    return 100 * common >= percent * (len(one) + sizes - common)


def _meet(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by hub and share of its members, the hub's own row (null member) first."""
    found = None
    for batch in batches:
        hubs, members, sets = (batch.column(c).to_pylist() for c in ("hub", "member", "shingles"))
        linked = []
        for hub, member, data in zip(hubs, members, sets, strict=True):
            mine = np.frombuffer(data, np.uint64)
            if member is None:
                found = mine
            elif _similar(found, [mine], percent)[0]:
                linked.append((hub, member))
        yield _pairs(linked)


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in (0, 1)], ["a", "b"])


class _Residents:
    """The documents of one block, and what a visitor is linked with there."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def ready(self) -> None:
        self.ids, self.parts, sketches, self.sets = zip(*self.rows, strict=True)
        self.part_of = np.array(self.parts)
        self.sketches = np.array(sketches, np.int64).view(np.uint64)
        self.sizes = np.array([len(x) for x in self.sets])
        self.rows = []

    def links(self, part: int, sketch: np.ndarray, mine: np.ndarray, percent: int, farthest: int) -> list[int]:
        """One resident of each other component that the visitor is linked with."""
        sizes = 100 * np.minimum(self.sizes, len(mine)) >= percent * np.maximum(self.sizes, len(mine))
        far = np.bitwise_count(self.sketches ^ sketch).sum(1)
        near = np.flatnonzero((self.part_of != part) & sizes & (far <= farthest))
        if not len(near):
            return []
        linked = near[_similar(mine, [self.sets[i] for i in near], percent)]
        return list({self.parts[i]: self.ids[i] for i in linked}.values())


def _visit(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by copy of a block, its residents before its visitors."""
    here, block, farthest = _Residents(), None, largest_distance(percent / 100)
    for batch in batches:
        names = ("home", "block", "copy", "visits", "doc_id", "part", "sketch", "shingles")
        linked = []
        for home, no, copy, visits, doc, part, sketch, data in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if (home, no, copy) != block:
                here, block = _Residents(), (home, no, copy)
            mine = np.frombuffer(data, np.uint64)
            if not visits:
                here.rows.append((doc, part, sketch, mine))
                continue
            if here.rows:
                here.ready()
            linked += [(other, doc) for other in here.links(part, np.array(sketch, np.int64).view(np.uint64), mine, percent, farthest)]
        yield _pairs(linked)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``(hub, member)`` pairs whose full sets are similar, as ``(a, b)``.

    The members of a hub are dealt into groups of about GROUP, each with a copy of the hub's
    set, so a hub with many members is many small tasks.
    """
    count = pairs.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).alias("shares"))
    dealt = pairs.join(count, "hub").withColumn("share", F.pmod(F.xxhash64("member"), F.col("shares")))
    copies = count.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    of_member = dealt.join(sets.withColumnRenamed("doc_id", "member"), "member").select("hub", "share", "member", "shingles")
    of_hub = copies.join(sets.withColumnRenamed("doc_id", "hub"), "hub").select(
        "hub", "share", F.lit(None).cast("long").alias("member"), "shingles"
    )
    together = of_member.unionByName(of_hub).repartition("hub", "share")
    sorted_ = together.sortWithinPartitions("hub", "share", F.col("member").asc_nulls_first())
    return sorted_.mapInArrow(partial(_meet, percent=percent), "a long, b long")


def _may_link(percent: int) -> Column:
    """Sizes allow the similarity and the odd sketches are close enough."""
    sizes = 100 * F.least("x.n_shingles", "y.n_shingles") >= percent * F.greatest("x.n_shingles", "y.n_shingles")
    return sizes & (_distance() <= largest_distance(percent / 100))


def _distance() -> Column:
    return sum((F.bit_count(F.expr(f"x.sketch[{i}] ^ y.sketch[{i}]")) for i in range(1, WORDS)), F.bit_count(F.expr("x.sketch[0] ^ y.sketch[0]")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Documents are linked if their sets of distinct ``k``-word shingles have at least
    ``percent`` hundredths of their union in common; ``component_id`` is the least id that
    links reach and ``kept`` marks its document. A text of fewer than ``k`` words has its
    whole sequence as its one shingle. A text without words, or null, has none and is
    linked with nothing. A row without an id is linked with nothing either, has no
    component and is kept. Rows that repeat an id are one document to links; each is
    returned. An empty table gives an empty result.
    """
    texts = id_and_text(docs, id_col, text_col)
    signed = staged(texts.mapInArrow(partial(_sign, k=k), _SIGNED_SQL), "signed")
    able = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = staged(able.groupBy("set_key").agg(F.min("doc_id").alias("class_id")), "classes")

    # a class whose id stands for several sets, because rows repeat an id, keeps them all
    first = able.join(classes, "set_key").where(F.col("doc_id") == F.col("class_id"))
    first = first.dropDuplicates(["set_key"]).select("doc_id", "n_shingles", "bands", "sketch")
    in_band = first.select("doc_id", F.explode("bands").alias("bucket"))
    full = in_band.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = _packed(in_band.join(full, "bucket").select("bucket", "doc_id", "n"), "buckets")
    central = buckets.groupBy("doc_id").agg(F.sum("n").alias("central"))
    alike = _packed(central.join(first.select("doc_id", "n_shingles", "sketch").dropDuplicates(["doc_id"]), "doc_id"), "alike")
    # alike at every size: the ids outgrow a broadcast soon
    wanted = texts.join(alike.select("doc_id").hint("merge"), "doc_id", "left_semi").mapInArrow(partial(_sets, k=k), "doc_id long, shingles binary")
    sets = staged(wanted.dropDuplicates(["doc_id"]), "sets")

    # sets are compared by as many tasks as there are partitions, and only what is found is packed
    links = staged(confirmed(_packed(_hub_pairs(buckets, alike, percent), "hub-pairs"), sets, percent), "links")
    parts = connected_components(links)
    parts = connected_components(links.unionByName(staged(_visited(buckets, alike, sets, parts, percent), "visited")))

    of_class = classes.join(parts, classes.class_id == parts.node, "left").select(
        "set_key", F.coalesce("component", "class_id").alias("component_id")
    )
    mine = signed.withColumn("key", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("set_key")))
    joined = mine.select("doc_id", "n_shingles", "key").join(of_class, F.col("key") == F.col("set_key"), "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _packed(df: DataFrame, label: str) -> DataFrame:
    """Staged in fewer files than there are partitions: rows of a few numbers for some of the
    documents are a small part of the texts' size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.coalesce(max(1, n // 8)), label)


def _hubs(buckets: DataFrame, alike: DataFrame) -> DataFrame:
    """``(bucket, hub, hub_central)``: the most central member of each bucket, the least id on a tie."""
    order = F.struct("central", (-F.col("doc_id")).alias("id"))
    top = buckets.join(alike.select("doc_id", "central"), "doc_id").groupBy("bucket").agg(F.max(order).alias("top"))
    return top.select("bucket", (-F.col("top.id")).alias("hub"), F.col("top.central").alias("hub_central"))


def _hub_pairs(buckets: DataFrame, alike: DataFrame, percent: int) -> DataFrame:
    """Each member with the closest of the hubs of its buckets, by their sketches."""
    met = buckets.join(_hubs(buckets, alike), "bucket").where(F.col("doc_id") != F.col("hub"))
    pairs = met.select("hub", F.col("doc_id").alias("member")).distinct()
    x, y = alike.alias("x"), alike.alias("y")
    near = pairs.join(x, F.col("member") == F.col("x.doc_id")).join(y, F.col("hub") == F.col("y.doc_id"))
    near = near.where(_may_link(percent)).select("hub", "member", _distance().alias("far"))
    return near.groupBy("member").agg(F.min(F.struct("far", "hub")).alias("best")).select("best.hub", "member")


def _visited(buckets: DataFrame, alike: DataFrame, sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket, one at least for each pair of
    components that is linked in it.

    A document's home is the most central of its buckets' hubs, and the documents of a home
    are dealt into blocks. A bucket's members outside its largest component visit the blocks
    of all its members. A block with many visitors is copied, and they are dealt over its
    copies, so that a task has at most a block and a share of its visitors.
    """
    named = buckets.select("bucket", "doc_id").join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = named.select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("part"))
    sizes = named.groupBy("bucket", "part").agg(F.count("*").alias("n")).groupBy("bucket")
    several = sizes.agg(F.max(F.struct("n", "part")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    several = several.select("bucket", F.col("most.part").alias("largest"))
    named = _packed(named.join(several, "bucket"), "open-buckets")

    hubs = _hubs(named, alike)
    homes = named.join(hubs, "bucket").groupBy("doc_id", "part").agg(F.max(F.struct("hub_central", "hub")).alias("h"))
    homes = homes.select("doc_id", "part", F.col("h.hub").alias("home"))
    blocks = homes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = homes.join(blocks, "home").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    residents = _packed(placed.select("doc_id", "part", "home", "block"), "residents")

    in_bucket = named.join(residents.drop("part"), "doc_id").select("bucket", "home", "block").distinct()
    visitors = named.where(F.col("part") != F.col("largest")).select("bucket", "doc_id", "part")
    visits = visitors.join(in_bucket, "bucket").select("doc_id", "part", "home", "block").distinct()
    visits = _packed(visits, "visits")
    copies = visits.groupBy("home", "block").agg(F.ceil(F.count("*") / SHARE).alias("copies"))
    shared = residents.join(copies, ["home", "block"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    dealt = visits.join(copies, ["home", "block"]).withColumn("copy", F.pmod(F.xxhash64("doc_id"), F.col("copies")))
    columns = ("doc_id", "part", "home", "block", "copy")
    both = shared.select(*columns, F.lit(False).alias("visits")).unionByName(dealt.select(*columns, F.lit(True).alias("visits")))
    whole = both.join(alike.select("doc_id", "sketch"), "doc_id").join(sets, "doc_id")
    ordered = whole.repartition("home", "block", "copy").sortWithinPartitions("home", "block", "copy", "visits", "doc_id")
    return ordered.mapInArrow(partial(_visit, percent=percent), "a long, b long")
