"""Near-duplicates by MinHash with odd sketches, links confirmed on the full shingle sets.

* Documents with equal shingle sets form a class with a number of its own, which the text of its least
  id stands for from then on. Classes that have an id in common are one component from the start.
* 128 MinHash samples of a class make 32 bands of four; classes that agree in a band are candidates.
  At a similarity of 0.8 a pair has no band in common once in 20 million.
* The samples are folded into an odd sketch, a bitmap of 512 parities. The population count of two
  sketches' XOR tells how many samples differ, most precisely for high similarities. Pairs further
  apart than any pair at the threshold would be (seven standard deviations) are dropped.
* In each band bucket the least class is the hub. A class is first held against its best hub, then
  against every other candidate of its buckets in another component that a finer sketch (1024
  samples) leaves possible. Members that are connected already need no pair of their own, so groups
  of near copies never give all their pairs; no link between components is lost.
* A bucket is dealt out in blocks of bounded size, and two blocks meet in a group of their own, so a
  bucket of any size is shared by many tasks. Blocks of the bucket's largest component do not meet each
  other: its members are copied once for every block of members outside it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.bytewindows import mixed
from rowguard.llm.common import written
from rowguard.llm.graph import components
from rowguard.llm.shingles import Shingler

SAMPLES, ROWS, BITS = 128, 4, 512
#: The finer sketch, for classes whose buckets hold several components.
FINE_SAMPLES, FINE_BITS = 1024, 4096
#: Members of a bucket in one of its blocks, on average.
BLOCK = 512
#: Up to so many ids are broadcast to pick the texts to compare (8 bytes each); beyond, both shuffle.
BROADCAST_IDS = 1_000_000
_rng = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _rng.integers(0, 1 << 31, FINE_SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _rng.integers(0, 1 << 32, FINE_SAMPLES, dtype=np.uint32)
del _rng

_SIGNED = (
    "doc_id bigint, key bigint, n_shingles bigint, set_a bigint, set_b bigint, sketch array<bigint>, bands array<bigint>"
)


def minhashes(own: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """The samples of a set of hashes; the set must not be empty."""
    small = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(samples, 0xFFFFFFFF, dtype=np.uint32)
    step = (1 << 18) // samples
    for at in range(0, len(small), step):
        part = small[at : at + step, None] * _FACTORS[:samples] + _OFFSETS[:samples]
        np.minimum(least, part.min(axis=0), out=least)
    return least


def odd_sketch(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """A bitmap in 64-bit words; each sample turns one bit over. ``bits`` is a power of two."""
    place = np.arange(len(samples), dtype=np.uint64) << np.uint64(32)
    bit = (mixed(samples.astype(np.uint64) | place) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(bit, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.arange(SAMPLES // ROWS, dtype=np.uint64)
    for column in samples.astype(np.uint64).reshape(-1, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def largest_distance(percent: int, samples: int = SAMPLES, bits: int = BITS, deviations: int = 7) -> int:
    """More bits than this differ for no pair at the threshold, but for chance: so many standard
    deviations of the number of samples that differ."""
    share = 1 - percent / 100
    differing = samples * share + deviations * math.sqrt(samples * share * (1 - share))
    return math.ceil(bits / 2 * (1 - (1 - 2 / bits) ** (2 * min(samples, differing))))


def _sign(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                n, a, b, sketches, bands = [], [], [], [], []
                for own in shingler.sets(batch.column("text").to_pylist()):
                    n.append(len(own))
                    a.append(int(np.sum(own, dtype=np.uint64).view(np.int64)))
                    b.append(int(np.bitwise_xor.reduce(mixed(own), initial=np.uint64(0)).view(np.int64)))
                    samples = minhashes(own) if len(own) else None
                    sketches.append(odd_sketch(samples) if len(own) else None)
                    bands.append(band_keys(samples) if len(own) else None)
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
                columns = [pa.array(x, type=t) for x, t in zip((n, a, b, sketches, bands), kinds)]
                names = ["doc_id", "key", "n_shingles", "set_a", "set_b", "sketch", "bands"]
                own = [batch.column("doc_id"), batch.column("key")]
                yield pa.RecordBatch.from_arrays([*own, *columns], names=names)

    return sign


def _confirm(width: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                keep = []
                pairs = zip(*(shingler.sets(batch.column(c).to_pylist()) for c in ("text_u", "text_v")))
                for a, b in pairs:
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both) > 0)
                yield batch.select(["u", "v"]).filter(pa.array(keep, type=pa.bool_()))

    return confirm


def _refine(width: int):
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                fine = [
                    odd_sketch(minhashes(own, FINE_SAMPLES), FINE_BITS) if len(own) else None
                    for own in shingler.sets(batch.column("text").to_pylist())
                ]
                column = pa.array(fine, type=pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), column], names=["id", "fine"])

    return refine


_HELD = ("band", "one", "two", "block", "id", "label", "n", "sketch", "fine", "bands")


def _apart_within(percent: int):
    """Candidates (u, v) of different components in each group of equal (band, one, two); groups
    come whole and one after the other. A pair counts in the first band that it shares only."""
    coarse_most = largest_distance(percent)
    fine_most = largest_distance(percent, FINE_SAMPLES, FINE_BITS, 6)

    def pairs(group: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        band, one, two, block, ids, label, n, sketch, fine, bands = group
        # Of signed numbers, numpy counts the bits of the absolute value.
        sketch, fine = sketch.view(np.uint64), fine.view(np.uint64)
        if one[0] == two[0]:
            left = right = np.arange(len(ids))
        else:
            left, right = np.nonzero(block == one[0])[0], np.nonzero(block == two[0])[0]
        found_u, found_v = [], []
        for at in range(0, len(left), 128):
            some = left[at : at + 128]
            small = np.minimum(n[some, None], n[right])
            large = np.maximum(n[some, None], n[right])
            may = (label[some, None] != label[right]) & (small * 100 >= large * percent)
            if one[0] == two[0]:
                may &= some[:, None] < right
            x, y = np.nonzero(may)
            u, v = some[x], right[y]
            for words, most in ((sketch, coarse_most), (fine, fine_most)):
                near = [
                    np.bitwise_count(words[u[i : i + 8192]] ^ words[v[i : i + 8192]]).sum(axis=1, dtype=np.int64) <= most
                    for i in range(0, len(u), 8192)
                ]
                near = np.concatenate(near) if near else np.zeros(0, dtype=bool)
                u, v = u[near], v[near]
            once = bands[u, np.argmax(bands[u] == bands[v], axis=1)] == band[0]
            found_u.append(ids[u[once]])
            found_v.append(ids[v[once]])
        u, v = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (found_u, found_v))
        return np.maximum(u, v), np.minimum(u, v)

    def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
        out = []
        for name in _HELD:
            column = batch.column(name)
            if pa.types.is_list(column.type):
                out.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
            else:
                out.append(column.to_numpy(zero_copy_only=False))
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(group: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(group[0]) > 1:
                u, v = pairs(group)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        open_group: list[np.ndarray] | None = None
        for batch in batches:
            rows = arrays(batch)
            if open_group is not None:
                rows = [np.concatenate(x) for x in zip(open_group, rows)]
            if not len(rows[0]):
                continue
            changed = np.any([x[1:] != x[:-1] for x in rows[:3]], axis=0)
            starts = np.concatenate([[0], np.nonzero(changed)[0] + 1])
            for start, end in zip(starts[:-1], starts[1:]):
                yield from answer([x[start:end] for x in rows])
            open_group = [x[starts[-1] :] for x in rows]
        if open_group is not None:
            yield from answer(open_group)

    return compare


def _distance(a: str, b: str) -> Column:
    differ = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)]
    return sum(differ[1:], differ[0])


def _near(percent: int) -> Column:
    """Sizes and sketches of the pair allow for the similarity."""
    small, large = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    return (small * 100 >= large * percent) & (_distance("sketch_u", "sketch_v") <= largest_distance(percent))


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose sets are similar enough."""
    for end in ("u", "v"):
        pairs = pairs.join(texts.select(F.col("id").alias(end), F.col("text").alias(f"text_{end}")), end)
    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(_confirm(width, percent), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of distinct ``width``-word shingles have a Jaccard similarity
    of ``percent`` or more; ``component_id`` is the least id that links reach. Null, empty and blank
    texts have no shingles and no links. Rows with one id are one document with several texts: its
    links are those of all of them, and each row has the ``n_shingles`` of its own text. A row without
    an id is linked with nothing: its component is null and it is kept. Other columns are not read, and
    an empty table gives no rows.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    narrow = narrow.withColumn("key", F.xxhash64("text"))
    signed = written(narrow.mapInArrow(_sign(width), _SIGNED), "near-signed")
    usable = signed.filter("doc_id is not null and n_shingles > 0")
    # A class's text and signature come from its least id; key tells the texts of one id apart.
    own = F.struct("doc_id", "key", F.col("n_shingles").alias("n"), "sketch", "bands")
    classes = usable.groupBy("set_a", "set_b").agg(F.min_by(own, "doc_id").alias("own"))
    classes = written(classes.select("set_a", "set_b", "own.*"), "near-classes")
    # Numbered in the order of their least ids, so that the earliest of near copies tends to be the hub.
    order = ("doc_id", "set_a", "set_b")
    numbered = classes.repartitionByRange(*order).sortWithinPartitions(*order)
    reps = written(numbered.withColumn("id", F.monotonically_increasing_id()), "near-reps")
    buckets = reps.select("id", F.explode("bands").alias("band"))
    hubs = buckets.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("m")).filter("m > 1")
    ends = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    pairs = (
        buckets.join(hubs, "band").filter("id <> hub").select(F.col("id").alias("u"), F.col("hub").alias("v")).distinct()
    )
    near = pairs.join(ends("u"), "u").join(ends("v"), "v").filter(_near(percent))
    tried = written(near.select("u", "v", _distance("sketch_u", "sketch_v").alias("distance")), "near-hubs")

    best = Window.partitionBy("u").orderBy("distance", "v")
    first = tried.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("u", "v")
    first = written(first, "near-first")
    ids = first.select(F.col("u").alias("id")).unionByName(first.select(F.col("v").alias("id")))
    links = _links(first, _texts(narrow, reps, ids.distinct()), width, percent)
    links = written(links.unionByName(_of_one_id(usable, reps)), "near-links")
    labels = components(links)

    # Buckets that still hold several components: their other pairs.
    held = buckets.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "label", F.coalesce("label", "id")
    )
    sizes = held.groupBy("band", "label").agg(F.count("*").alias("size"))
    largest = F.max(F.struct("size", "label"))
    mixed_buckets = sizes.groupBy("band").agg(F.sum("size").alias("m"), largest.alias("largest")).filter("m > largest.size")
    held = written(held.join(mixed_buckets, "band"), "near-mixed")
    texts = _texts(narrow, reps, held.select("id").distinct())
    fine = texts.mapInArrow(_refine(width), "id bigint, fine array<bigint>").join(
        reps.select("id", "n", "sketch", "bands"), "id"
    )
    # Blocks of the largest component are numbered first, those of all others behind them; a bucket of
    # one block's size is a single block.
    small, inside = F.col("m") <= BLOCK, F.col("label") == F.col("largest.label")
    of_largest, of_all = F.ceil(F.col("largest.size") / BLOCK), F.ceil((F.col("m") - F.col("largest.size")) / BLOCK)
    of_all = of_all + of_largest
    number = F.xxhash64("id")
    outside = of_largest + F.pmod(number, of_all - of_largest)
    block = F.when(small, 0).when(inside, F.pmod(number, of_largest)).otherwise(outside)
    from_block = F.when(~small & inside, of_largest).otherwise(0)
    to_block = F.when(small, 0).otherwise(of_all - 1)
    dealt = (
        held.withColumn("block", block.cast("long"))
        .withColumn("other", F.explode(F.sequence(from_block.cast("long"), to_block.cast("long"))))
        .select("band", "id", "label", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        .join(fine, "id")
        .select(*_HELD)
    )
    groups = dealt.repartition("band", "one", "two").sortWithinPartitions("band", "one", "two")
    others = groups.mapInArrow(_apart_within(percent), "u bigint, v bigint").distinct()
    others = written(others.join(first, ["u", "v"], "left_anti"), "near-others")
    if not others.isEmpty():
        links = written(links.unionByName(_links(others, texts, width, percent)), "near-links")
        labels = components(links)

    # A component is called by its least id; classes without a link by their own.
    linked_ids = labels.join(reps.select(F.col("id").alias("node"), "doc_id"), "node")
    least = linked_ids.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    called = labels.join(least, "label").select(F.col("node").alias("id"), "component_id")
    named = reps.join(called, "id", "left").select(
        "set_a", "set_b", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    # The class of a document may be the largest by far; it is the other side that has one row of it.
    out = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    linked = F.col("n_shingles") > 0
    component = F.when(linked & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _of_one_id(usable: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (u, v) between the classes that one id's texts lie in: each to the least of them."""
    spans = [f(c).alias(f"{n}_{c}") for c in ("set_a", "set_b") for f, n in ((F.min, "min"), (F.max, "max"))]
    several = usable.groupBy("doc_id").agg(*spans).filter("min_set_a < max_set_a or min_set_b < max_set_b")
    sets = usable.join(several.select("doc_id"), "doc_id").select("doc_id", "set_a", "set_b").distinct()
    sets = written(sets.join(reps.select("set_a", "set_b", "id"), ["set_a", "set_b"]).select("doc_id", "id"), "near-ids")
    least = sets.groupBy("doc_id").agg(F.min("id").alias("v"))
    return sets.join(least, "doc_id").filter("id > v").select(F.col("id").alias("u"), "v")


def _texts(narrow: DataFrame, reps: DataFrame, ids: DataFrame) -> DataFrame:
    """id and text of the classes named by ``ids``. Texts of one id are told apart by ``key``, a hash of
    64 bits; rows equal in both are taken as equal."""
    named = written(ids.join(reps.select("id", "doc_id", "key"), "id"), "near-ids")
    doc_ids = named.select("doc_id").distinct()
    side = F.broadcast(doc_ids) if named.count() <= BROADCAST_IDS else doc_ids
    found = narrow.join(side, "doc_id", "left_semi").groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    return written(found.join(named, ["doc_id", "key"]).select("id", "text"), "near-texts")


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one whose id is the component's. Rows
    without an id or without shingles stay; of rows with one id all stay or go."""
    gone = near_duplicates(docs, width, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
