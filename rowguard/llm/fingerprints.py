"""Order MinHash fingerprints of documents, with built-in functions only.

The k-mers of a text are runs of ``k`` neighbouring words (in scripts written without spaces: letters),
each numbered by how often it has occurred before. A hash of k-mer and number puts each into one of ``slots`` slots; the ``tuple_size`` least of
a slot are kept, in their order in the text, and hashed together. Texts with the same k-mers in
another order therefore differ, as they do in edit distance. Everything happens within the row: the
hash of a k-mer and its place share one 64-bit number, so that sorting an array groups them.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import parts_for, text_bytes, text_or_empty

_PLACE_BITS = 24
_PLACE = (1 << _PLACE_BITS) - 1
_LEVELS = 24
#: Scripts written without spaces, as ranges of code points: each letter is a word.
_LONE = (
    r"[\x{0E00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{19E0}-\x{19FF}\x{2E80}-\x{A4CF}"
    r"\x{AA60}-\x{AA7F}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}]"
)


def words_of(text: Column) -> Column:
    """Words between white space; letters of scripts without spaces are words of their own."""
    apart = F.when(text.rlike(_LONE), F.regexp_replace(text, f"({_LONE})", " $1 ")).otherwise(text)
    return F.array_remove(F.split(apart, r"\s+"), "")


def _key(x: Column) -> Column:
    return F.shiftright(x, _PLACE_BITS)


def with_fingerprint(
    df: DataFrame, text: str, name: str, *, k: int = 3, slots_log2: int = 6
) -> DataFrame:
    """``df`` with ``name``: the fingerprint as a sorted array, one number of 32 bits per slot in use
    (slot in the upper bits). A text shorter than ``k`` words has one k-mer, one without words an
    empty fingerprint. Pairs are kept per slot. Of texts of more than 2^24 words (some 100 MB) the order
    is told apart less well; equal texts still have equal fingerprints."""
    a, b, c, levels = (f"_{name}_{x}" for x in ("a", "b", "c", "levels"))
    df = df.withColumn(b, F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)))
    n = F.size(b)
    mers = (
        F.when(n == 0, F.array().cast("array<bigint>"))
        .when(n < k, F.array(F.xxhash64(F.col(b))))
        .otherwise(
            F.transform(
                F.sequence(F.lit(0), n - k),
                lambda i: F.xxhash64(*[F.get(F.col(b), i + j) for j in range(k)]),
            )
        )
    )
    df = df.withColumn(a, mers).drop(b)

    # Without repeats every number is 0. With repeats: in a sorted array of k-mers and places equal
    # ones are neighbours in text order, and a k-mer's number is its distance from the first of them,
    # which doubling steps find, as many as the longest run asks for.
    def repeats(distance: int) -> Column:
        later = F.when(F.size(b) > distance, F.sequence(F.lit(0), F.size(b) - 1 - distance))
        same = lambda i: _key(F.get(F.col(b), i)) == _key(F.get(F.col(b), i + distance))
        return F.coalesce(F.exists(later, same), F.lit(False))

    def placed(h: Column, i: Column) -> Column:
        return h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long"))

    some = F.size(F.array_distinct(a)) < F.size(a)
    df = df.withColumn(b, F.when(some, F.sort_array(F.transform(a, placed))))
    needed = F.when(F.col(b).isNull(), 0)
    for level in range(1, _LEVELS):
        needed = needed.when(~repeats(1 << level), level)
    df = df.withColumn(levels, needed.otherwise(_LEVELS))
    first = F.transform(
        b,
        lambda x, i: F.when(_key(x) != _key(F.get(F.col(b), i - 1)), i).otherwise(F.lit(0)),
    )

    def doubled(firsts: Column, step: Column) -> Column:
        return F.transform(
            firsts, lambda v, i: F.greatest(v, F.coalesce(F.get(firsts, i - step), F.lit(0)))
        )

    steps = F.slice(F.array(*[F.lit(1 << t) for t in range(_LEVELS)]), 1, F.col(levels))
    df = df.withColumn(c, F.when(F.col(levels) > 0, F.aggregate(steps, first, doubled)))

    def hashed(x: Column, number: Column | None = None) -> Column:
        of_mer = x if number is None else F.when(number == 0, x).otherwise(F.xxhash64(_key(x), number))
        return F.shiftrightunsigned(of_mer, 1)

    numbered = F.transform(
        b, lambda x, i: placed(hashed(x, i - F.get(F.col(c), i)), x.bitwiseAND(F.lit(_PLACE)))
    )
    plain = F.transform(a, lambda h, i: placed(hashed(h), i))
    df = df.withColumn(c, F.sort_array(F.when(F.col(b).isNull(), plain).otherwise(numbered)))
    df = df.drop(a, b, levels)
    slot_shift = 63 - slots_log2

    def slot(x: Column) -> Column:
        return F.shiftright(x, slot_shift)

    least = F.filter(
        c, lambda x, i: (i < 2) | (slot(x) != slot(F.get(F.col(c), i - 2)))
    )
    df = df.withColumn(a, least).drop(c)

    def pair(i: Column) -> Column:
        x, y = F.get(F.col(a), i), F.get(F.col(a), i + 1)
        x_place, y_place = x.bitwiseAND(F.lit(_PLACE)), y.bitwiseAND(F.lit(_PLACE))
        both = (
            F.when(y.isNull() | (slot(y) != slot(x)), F.xxhash64(_key(x)))
            .when(x_place < y_place, F.xxhash64(_key(x), _key(y)))
            .otherwise(F.xxhash64(_key(y), _key(x)))
        )
        low = both.bitwiseAND(F.lit((1 << (32 - slots_log2)) - 1))
        return F.shiftleft(slot(x), 32 - slots_log2).bitwiseOR(low)

    heads = F.filter(
        F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: (i == 0) | (slot(F.get(F.col(a), i)) != slot(F.get(F.col(a), i - 1))),
    )
    return df.withColumn(name, F.transform(heads, pair)).drop(a)


def likeness(a: Column, b: Column) -> Column:
    """Share of the slots in use in which two fingerprints agree; 1 for two empty ones."""
    same = F.size(F.array_intersect(a, b))

    def slots(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 26))

    used = F.size(F.array_union(slots(a), slots(b)))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.hex(v), 8, "0")), "")


def _part(doc_id: Column, cuts: list[int]) -> Column:
    """Number of the range that an id lies in, larger ids first and null last: the number of cuts
    above it, counted in two levels."""
    if not cuts:
        return F.lit(0).cast("long")
    width = ceil(sqrt(len(cuts)))
    chunks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    tops = F.array(*[F.lit(chunk[-1]) for chunk in chunks])
    whole = F.size(F.filter(tops, lambda c: c > doc_id))
    nested = F.array(*[F.array(*[F.lit(c) for c in chunk]) for chunk in chunks])
    inside = F.coalesce(F.size(F.filter(F.get(nested, whole), lambda c: c > doc_id)), F.lit(0))
    found = (whole * width + inside).cast("long")
    return F.coalesce(F.when(doc_id.isNotNull(), found), F.lit(len(cuts) + 1).cast("long"))


def fingerprint_documents(docs: DataFrame, *, bytes_per_part: int = 8 << 20) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text has its last half (floor of the number of code points) replaced by the beginning
    of the next document in descending order of the id; after the last comes the first. Equal ids
    are ordered by a hash of the text; a null id comes last; null text is empty; an empty table gives
    no rows; other columns are not read. Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Texts are
    shuffled once, to ranges of ids; each range also gets the first document of the next one.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    parts = parts_for(text_bytes(docs), bytes_per_part)
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares or [0.5], 100 * parts).alias("c")).first()["c"]
    cuts = sorted(set(found or []), reverse=True) if shares else []
    rows = rows.withColumn("_part", _part(F.col("doc_id"), cuts))
    rows = rows.withColumn("_order", F.xxhash64("text"))
    heads = rows.groupBy("_part").agg(
        F.max_by(F.struct("doc_id", "text", "_order"), F.struct("doc_id", "_order")).alias("_head")
    )
    # Which range each head goes to: over the numbers alone, without the texts.
    numbers = rows.select("_part").distinct()
    before = numbers.select(
        F.col("_part").alias("_own"), F.lag("_part").over(Window.orderBy("_part")).alias("_before")
    ).crossJoin(F.broadcast(numbers.agg(F.max("_part").alias("_last"))))
    heads = heads.join(F.broadcast(before), F.col("_part") == F.col("_own")).select(
        "_head.*", F.coalesce("_before", "_last").alias("_part"), F.lit(1).alias("_guest")
    )
    order = Window.partitionBy("_part").orderBy("_guest", F.desc("doc_id"), F.desc("_order"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    both = rows.withColumn("_guest", F.lit(0)).unionByName(heads)
    both = both.withColumn("_next", F.lead("text").over(order)).select(
        "doc_id",
        "_part",
        "_order",
        "_guest",
        "text",
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half)).alias("_edited"),
    )
    both = both.withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    both = with_fingerprint(both, "text", "_own").drop("text")
    both = with_fingerprint(both, "_edited", "_new").drop("_edited")
    both = both.withColumn("_following", F.lead("_own").over(order)).filter("_guest = 0")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_new")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_new")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_following")).alias("near_next"),
    )
