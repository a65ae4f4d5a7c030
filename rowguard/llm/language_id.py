"""Language identification with bit-sliced Bloom filters of n-grams.

A slot of the filter holds one bit per language. An n-gram sets the bits of the languages it belongs
to in a few slots, and looking it up takes the AND of those slots: the bitmask of all languages that
contain it (and of some that do not, by chance). The bits are counted per language over all n-grams
of a text, the counts are corrected for the chance hits that each language's share of set bits leads
to, and the largest one decides.

An n-gram belongs to a language if its share there is a fair part of its largest share in any
language, so stray foreign lines in the learning documents do no harm. All learning documents are
counted, and the filter has as many slots as the language with the most n-grams needs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.llm.bytewindows import mixed
from rowguard.llm.common import written

HASHES = 3
LEAST_SLOTS_LOG2 = 20
_BLOCK = 1 << 19
#: Odd, so that code points times its powers tell n-grams of all scripts apart.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def _units(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Code points of some texts with single zeros for all that is no letter, and the number of the
    text for each; long texts come in parts that overlap by what a 4-gram needs."""
    block, numbers, held = [], [], 0

    def done():
        points = np.concatenate(block)
        return points, np.repeat(numbers, [len(x) for x in block])

    for number, text in enumerate(texts):
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        known = points < 0x10000
        letter = _letters()[np.where(known, points, 0)]
        for i in np.nonzero(~known)[0]:
            letter[i] = chr(points[i]).isalpha()
        points = np.where(letter, points, 0).astype(np.uint64)
        points = np.concatenate([[np.uint64(0)], points, [np.uint64(0)]])
        points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
        for at in range(0, max(1, len(points) - 3), _BLOCK):
            part = points[at : at + _BLOCK + 3]
            if block and held + len(part) > _BLOCK:
                yield done()
                block, numbers, held = [], [], 0
            block.append(part)
            numbers.append(number)
            held += len(part)
    if block:
        yield done()


def _grams(points: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 3- and 4-grams of words with their edges, and the number of their text."""
    found = []
    for n in (3, 4):
        if len(points) < n:
            continue
        m = len(points) - n + 1
        ok = of[:m] == of[n - 1 :]
        code = np.full(m, n, dtype=np.uint64)
        for j in range(n):
            if 0 < j < n - 1:
                ok &= points[j : j + m] != 0
            code = code * _FACTOR + points[j : j + m]
        # A part of a long text begins with what the one before it ended with.
        found.append((mixed(code[ok]), of[:m][ok]))
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _slots(grams: np.ndarray, slots_log2: int) -> list[np.ndarray]:
    step = (mixed(grams ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)).astype(np.uint64)
    mask = np.uint64((1 << slots_log2) - 1)
    return [((grams + step * np.uint64(i)) & mask).astype(np.int64) for i in range(HASHES)]


def _count(languages: list[str]):
    index = {name: i for i, name in enumerate(languages)}
    schema = pa.schema([("gram", pa.int64()), ("language", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 5000):
                batch = whole.slice(start, 5000)
                lang = np.array([index[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
                keys = []
                for points, of in _units(batch.column("text").to_pylist()):
                    grams, number = _grams(points, of)
                    keys += [(g, i, n) for i in np.unique(lang[number]) for g, n in [np.unique(grams[lang[number] == i], return_counts=True)]]
                for i in {k[1] for k in keys}:
                    grams = np.concatenate([g for g, j, _ in keys if j == i])
                    counts = np.concatenate([n for _, j, n in keys if j == i])
                    grams, where = np.unique(grams, return_inverse=True)
                    counts = np.bincount(where, counts).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grams.view(np.int64)), pa.array(np.full(len(grams), i, dtype=np.int32)), pa.array(counts)], schema=schema
                    )

    return count


def _spread(slots_log2: int):
    schema = pa.schema([("slot", pa.int64()), ("word", pa.int32()), ("mask", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_numpy(zero_copy_only=False).view(np.uint64)
            lang = batch.column("language").to_numpy(zero_copy_only=False).astype(np.int64)
            for slots in _slots(grams, slots_log2):
                mask = np.uint64(1) << (lang % 64).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array((lang // 64).astype(np.int32)), pa.array(mask.view(np.int64))], schema=schema
                )

    return spread


class Filters:
    """The learned filter: ``masks[word][slot]``, a bit for each of 64 languages per word."""

    def __init__(self, languages: list[str], masks: np.ndarray, slots_log2: int) -> None:
        self.languages, self.masks, self.slots_log2 = languages, masks, slots_log2
        full = [np.count_nonzero(masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(languages))]
        self.chance = (np.array(full, dtype=np.float64) / (1 << slots_log2)) ** HASHES

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        counts = np.zeros((len(self.languages), len(texts)))
        total = np.zeros(len(texts))
        for points, of in _units(texts):
            grams, number = _grams(points, of)
            total += np.bincount(number, minlength=len(texts))
            slots = _slots(grams, self.slots_log2)
            for word, masks in enumerate(self.masks):
                mask = masks[slots[0]]
                for s in slots[1:]:
                    mask = mask & masks[s]
                for i in range(word * 64, min(len(self.languages), word * 64 + 64)):
                    hit = (mask >> np.uint64(i % 64)) & np.uint64(1)
                    counts[i] += np.bincount(number, hit, minlength=len(texts))
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        real = (counts - total * self.chance[:, None]) / np.maximum(1e-9, 1 - self.chance[:, None])
        best = np.argmax(real, axis=0)
        share = np.clip(real.max(axis=0) / np.maximum(total, 1), 0, 1)
        names = [self.languages[b] if t else "und" for b, t in zip(best, total)]
        return names, [float(s) if t else 0.0 for s, t in zip(share, total)]


def slots_for(members: int, chance: float) -> int:
    """Binary logarithm of the slots with which ``members`` n-grams of one language lead to chance
    hits for at most this share of others."""
    full = chance ** (1 / HASHES)
    needed = HASHES * members / -np.log1p(-full)
    return max(LEAST_SLOTS_LOG2, int(np.ceil(np.log2(max(1.0, needed)))))


def learn(
    samples: DataFrame,
    *,
    slots_log2: int | None = None,
    chance: float = 0.01,
    fair: float = 0.2,
    least: int = 2,
) -> Filters:
    """Filters from the columns ``text`` and ``lang`` of ``samples``; null in either teaches nothing.

    Without ``slots_log2`` the largest number of n-grams of a language decides on the slots, so that
    chance hits stay under the share ``chance``. The driver receives the languages, their totals and
    numbers of n-grams, and at most as many slots per 64 languages as the filter has: 8 bytes each,
    about 12 to 25 slots per n-gram of the largest language.
    """
    if not 0 < chance < 1:
        raise ValueError("chance must lie between 0 and 1")
    samples = samples.select("text", "lang").filter("text is not null and lang is not null")
    languages = sorted(r["lang"] for r in samples.select("lang").distinct().collect())
    words = max(1, -(-len(languages) // 64))
    if not languages:
        slots_log2 = slots_log2 or LEAST_SLOTS_LOG2
        return Filters([], np.zeros((words, 1 << slots_log2), dtype=np.uint64), slots_log2)
    counts = samples.mapInArrow(_count(languages), "gram bigint, language int, n bigint")
    counts = written(counts.groupBy("gram", "language").agg(F.sum("n").alias("n")), "language-grams")
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "language").withColumn("share", F.col("n") / F.col("total"))
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    members = shares.join(top, "gram").filter((F.col("share") >= fair * F.col("top")) & (F.col("n") >= least))
    members = members.select("gram", "language")
    if slots_log2 is None:
        members = written(members, "language-members")
        most = members.groupBy("language").count().agg(F.max("count").alias("n")).first()["n"]
        slots_log2 = slots_for(most or 0, chance)
    masks = np.zeros((words, 1 << slots_log2), dtype=np.uint64)
    slots = members.mapInArrow(_spread(slots_log2), "slot bigint, word int, mask bigint")
    rows = slots.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    slot, word = (rows.column(c).to_numpy() for c in ("slot", "word"))
    masks[word, slot] = rows.column("mask").to_numpy().view(np.uint64)
    return Filters(languages, masks, slots_log2)


def identified(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (share of n-grams that belong to the language, after
    correction), from ``text`` alone. ``und`` and 0 for null and for texts without letters. Columns
    of those two names are replaced; no rows give no rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    held = docs.drop("lang_pred", "score")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(filters)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    schema = f"{kept}, lang_pred string, score double"
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.slice(start, 1000)
                names, scores = shared.value.identify(batch.column("text").to_pylist())
                columns = [c.cast(f.type) if c.type != f.type else c for c, f in zip(batch.columns, arrow)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names), pa.array(scores)], schema=arrow)

    return held.mapInArrow(run, schema)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % 3 == 1


def identify_documents(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learns from the text and lang of documents
    that are not held out; a document without an id is not learned from and not held out."""
    filters = learn(docs.filter(~held_out()), **options)
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return identified(rows, filters).select("doc_id", "held_out", "lang_pred", "score")


def with_language(
    docs: DataFrame, languages: Sequence[str] | None = None, least_score: float = 0.2, **options
) -> DataFrame:
    """``docs`` that are in a language, as predicted: one of ``languages`` (null: any learned one),
    with at least the share ``least_score`` of their n-grams belonging to it.

    So null texts, texts without letters and texts of mostly foreign n-grams go. If nothing teaches a
    language, nothing can be told and all rows stay. The columns stay as they are.
    """
    filters = learn(docs.filter(~held_out()), **options)
    if not filters.languages:
        return docs
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct("*").alias("row"), "text") if len(names) < len(docs.columns) else docs
    told = (F.col("lang_pred") != "und") & (F.col("score") >= least_score)
    if languages is not None:
        told &= F.col("lang_pred").isin(list(languages))
    found = identified(rows, filters).filter(told)
    return found.select("row.*") if len(names) < len(docs.columns) else found.select(*[f"`{c}`" for c in names])
