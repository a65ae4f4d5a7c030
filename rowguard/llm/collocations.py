"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces and words, and each piece into *chunks*. A chunk begins where a piece
begins and where the hash of the next ``OVERLAP`` words says so, so that equal passages are cut alike
wherever they stand; after 64 words without such a trigger it ends as well. A chunk runs ``OVERLAP``
words into the next one and *owns* the places before that. A phrase of up to ``OVERLAP + 1`` words
therefore stands, whole, in the one chunk that owns its first word, and counting by that chunk counts
it once. Equal chunks become one row of a dictionary with their frequency, and phrases are counted in
distinct chunks, weighted.

Phrases of n words are counted after those of n - 1: one that stands 30 times consists of shorter ones
that do. A filter of bounded size over the frequent shorter phrases goes to all tasks; it lets each of
them pass and a few others, which the exact count then drops. However full the filter is, results are
the same.

Null text is empty, null ``lang`` is ``und``. Every row counts, repeated ones and those with equal or
null ids too. A text is worked on in portions of some megabytes that end with a piece; only a single
piece longer than that takes more memory. Tables without words give no rows. Of other columns nothing
is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import release_memory, text_or_empty, written

#: Words that a chunk shares with the next one, and words of the longest phrase.
OVERLAP = 3
LONGEST = OVERLAP + 1
#: Words are triggers in one of so many places; a chunk owns no more words than the second figure.
TRIGGER, MOST_WORDS = 16, 64
#: Bytes of text that a task works on at once.
PORTION = 4 << 20
#: The filter has 16 bits a phrase, but no more than 2^27 in all (16 MB).
FILTER_LOG2 = 27

_BLANK, _END = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[2]
    return (x ^ (x >> np.uint64(29))) * _ODD[1]


def _runs(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """begin[0], begin[0] + 1, ... of every run one after the other, and where runs begin in that."""
    at = np.concatenate(([0], np.cumsum(length)))
    return np.repeat(begin - at[:-1], length) + np.arange(at[-1]), at


def _word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, the same wherever the word stands."""
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    places = np.arange(int((end - begin).max()))
    power = _ODD[0] ** places.astype(np.uint64)
    spots, at = _runs(begin, end - begin)
    inside = np.arange(len(spots)) - np.repeat(at[:-1], end - begin)
    total = np.add.reduceat((data[spots].astype(np.uint64) + np.uint64(1)) * power[inside], at[:-1])
    return _mixed(total + (end - begin).astype(np.uint64))


def _parsed(data: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Chunks of lower-cased bytes: their text, the words they own, and where they begin.

    Words are joined by one space. ``data`` ends with the end of a piece.
    """
    kind = _KIND[data]
    edge = np.diff(np.concatenate(([0], kind == 0, [0])).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words = len(begin)
    if not words:
        return pa.array([], pa.string()), begin, begin
    piece = np.searchsorted(np.flatnonzero(kind == _END), begin)
    hashes = _word_hashes(data, begin, end)
    first = np.concatenate(([True], piece[1:] != piece[:-1]))
    trigger = np.zeros(words, dtype=bool)
    if words >= OVERLAP:
        window = reduce(
            lambda h, k: _mixed(h + hashes[k : words - OVERLAP + 1 + k]),
            range(1, OVERLAP),
            hashes[: words - OVERLAP + 1],
        )
        whole = piece[OVERLAP - 1 :] == piece[: words - OVERLAP + 1]
        trigger[: words - OVERLAP + 1] = whole & (window % np.uint64(TRIGGER) == 0)
    number = np.arange(words)
    cuts = first | trigger
    since = number - np.maximum.accumulate(np.where(cuts, number, 0))
    start = np.flatnonzero(cuts | (since % MOST_WORDS == 0))
    following = np.append(start[1:], words)
    closing = np.append(np.flatnonzero(first)[1:], words)
    close = closing[np.searchsorted(closing, start, side="right")]
    last = np.minimum(following + OVERLAP, close)
    word, at = _runs(start, last - start)
    size = end[word] - begin[word] + 1
    size[at[1:] - 1] -= 1  # no space behind a chunk's last word
    byte, place = _runs(begin[word], size)
    text = np.append(data, np.uint8(32))[byte]
    spaces = np.ones(len(word), dtype=bool)
    spaces[at[1:] - 1] = False
    text[place[1:][spaces] - 1] = 32
    offsets = pa.py_buffer(place[at].astype(np.int32))
    chunks = pa.StringArray.from_buffers(len(start), offsets, pa.py_buffer(np.ascontiguousarray(text)))
    return chunks, following - start, begin[start]


def _portions(texts: list[bytes]) -> Iterator[tuple[list[int], bytes]]:
    """Numbers of texts and their bytes, each closed by the end of a piece, some megabytes at a time."""
    numbers, parts, total = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while len(text) - at > PORTION:
            cut = max((text.rfind(e, at, at + PORTION) for e in b".,;:!?\n\r\x0b\x0c"), default=-1)
            if cut < at:
                found = [p for e in b".,;:!?\n\r\x0b\x0c" if (p := text.find(e, at + PORTION)) >= 0]
                cut = min(found, default=len(text) - 1)
            yield [number], text[at : cut + 1] + b"\n"
            at = cut + 1
        numbers.append(number)
        parts.append(text[at:] + b"\n")
        total += len(text) - at
        if total >= PORTION:
            yield numbers, b"".join(parts)
            numbers, parts, total = [], [], 0
    if parts:
        yield numbers, b"".join(parts)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, own, chunk, n: distinct chunks of each portion with their frequency."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        langs = batch.column("lang")
        for numbers, text in _portions(texts):
            data = _LOWER[np.frombuffer(text, dtype=np.uint8)]
            chunks, own, begin = _parsed(data)
            if len(chunks):
                ends = np.cumsum([len(texts[n]) + 1 for n in numbers]) if len(numbers) > 1 else [len(text)]
                row = np.array(numbers)[np.searchsorted(ends, begin, side="right")]
                found = pa.table(
                    {"lang": langs.take(pa.array(row)), "own": pa.array(own, pa.int32()), "chunk": chunks}
                ).group_by(["lang", "own", "chunk"], use_threads=False).aggregate([([], "count_all")])
                yield from found.rename_columns(["lang", "own", "chunk", "n"]).to_batches()
        release_memory()


def chunk_dictionary(docs: DataFrame) -> DataFrame:
    """``lang``, ``own`` (words owned), ``chunk`` and ``n``: every distinct chunk and how often it
    stands in the texts of a language."""
    return (
        docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
        .mapInArrow(_chunk_rows, "lang string, own int, chunk string, n bigint")
        .groupBy("lang", "own", "chunk")
        .agg(F.sum("n").alias("n"))
    )


def _string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    strings = strings.cast(pa.large_binary())
    if not len(strings):
        return np.zeros(0, dtype=np.uint64)
    at = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)
    filled = at[1:] > at[:-1]
    hashes = np.zeros(len(strings), dtype=np.uint64)
    hashes[filled] = _word_hashes(data, at[:-1][filled], at[1:][filled])
    return hashes


def _phrase_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    return reduce(lambda h, w: _mixed(h * _ODD[0] + w), words, lang)


def _slots(hashes: np.ndarray, log2: int) -> list[np.ndarray]:
    return [hashes >> np.uint64(64 - log2), (hashes * _ODD[0]) >> np.uint64(64 - log2)]


class _Filter:
    """A Bloom filter over phrases: never misses one, and passes a few others."""

    def __init__(self, phrases: DataFrame, size: int) -> None:
        """``phrases`` (lang, phrase) all have ``size`` words."""
        rows = phrases.count()
        self.log2 = log2 = min(FILTER_LOG2, max(10, (16 * rows).bit_length()))

        def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                split = pc.split_pattern(batch.column("phrase"), " ").flatten()
                words = _string_hashes(split).reshape(-1, size)
                hashes = _phrase_hashes(_string_hashes(batch.column("lang")), list(words.T))
                slot = np.unique(np.concatenate(_slots(hashes, log2)))
                word, bit = slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63))
                places, at = np.unique(word, return_index=True)
                ored = np.bitwise_or.reduceat(bit, at) if len(at) else bit
                columns = [pa.array(places.astype(np.int64)), pa.array(ored.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "bits"])

        found = (
            phrases.select("lang", "phrase")
            .mapInArrow(bits, "word bigint, bits bigint")
            .groupBy("word")
            .agg(F.bit_or("bits").alias("bits"))
            .toArrow()
        )
        table = np.zeros(1 << (log2 - 6), dtype=np.uint64)
        table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        self.bits = phrases.sparkSession.sparkContext.broadcast(table)

    def __getstate__(self) -> dict:
        return {"log2": self.log2, "bits": self.bits}

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        table, found = self.bits.value, np.ones(len(hashes), dtype=bool)
        for slot in _slots(hashes, self.log2):
            found &= table[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1) > 0
        return found


def _phrases(chunks: pa.Table, size: int, known: _Filter | None) -> pa.RecordBatch:
    """lang, phrase, n: the phrases of ``size`` words in places that chunks own, weighted; only those
    whose two parts of ``size - 1`` words are known."""
    split = pc.split_pattern(chunks.column("chunk").combine_chunks(), " ")
    at = split.offsets.to_numpy().astype(np.int64)
    length = np.diff(at)
    words = split.flatten().dictionary_encode()
    code = words.indices.to_numpy().astype(np.int64)
    lang = chunks.column("lang").combine_chunks().dictionary_encode()
    row = np.repeat(np.arange(len(chunks)), length)
    inside = np.arange(len(code)) - np.repeat(at[:-1], length)
    own, weight = chunks.column("own").to_numpy(), chunks.column("n").to_numpy()
    start = np.flatnonzero((inside < own[row]) & (inside + size <= length[row]))
    langs = lang.indices.to_numpy().astype(np.int64)
    if known is not None and len(start):
        hashes = _string_hashes(words.dictionary)
        tongue = _string_hashes(lang.dictionary)
        for shift in (0, 1):
            parts = [hashes[code[start + shift + k]] for k in range(size - 1)]
            start = start[known.passes(_phrase_hashes(tongue[langs[row[start]]], parts))]
    key = langs[row[start]]
    first = np.arange(len(start))
    for k in range(size):  # numbers of (lang, word 1, ..., word k)
        _, first, key = np.unique(
            key * len(words.dictionary) + code[start + k], return_index=True, return_inverse=True
        )
    n = np.zeros(len(first), dtype=np.int64)
    np.add.at(n, key, weight[row[start]])
    one = start[first]
    phrase = pc.binary_join_element_wise(
        *[words.dictionary.take(pa.array(code[one + k])) for k in range(size)], " "
    )
    tongues = lang.dictionary.take(pa.array(langs[row[one]]))
    return pa.RecordBatch.from_arrays([tongues, phrase, pa.array(n)], ["lang", "phrase", "n"])


def frequent_phrases(
    dictionary: DataFrame, size: int, least: int, known: _Filter | None = None
) -> DataFrame:
    """``lang``, ``phrase`` and ``n`` of the phrases of ``size`` words that stand ``least`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            held.append(batch)
            total += batch.column("chunk").nbytes
            if total >= PORTION:
                yield _phrases(pa.Table.from_batches(held), size, known)
                held, total = [], 0
                release_memory()
        if held:
            yield _phrases(pa.Table.from_batches(held), size, known)

    return (
        dictionary.mapInArrow(count, "lang string, phrase string, n bigint")
        .groupBy("lang", "phrase")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


def score_of(a: str, left: str, right: str) -> Column:
    """floor(2000000 a / (left + right)), exact where the product passes 64 bits."""
    a, left, right = (f"cast({name} as decimal(20,0))" for name in (a, left, right))
    return F.expr(f"(cast(2000000 as decimal(7,0)) * {a}) div ({left} + {right})")


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two to four words of each ``lang``: lang, rank, phrase, a, l, r, n, score.

    ``a`` is how often the phrase stands, ``least`` times at least; ``l`` and ``r`` are the counts of
    the two parts at the cut that scores lowest (ties: the first), ``n`` all words of the language and
    ``score`` floor(2000000 a / (l + r)). A phrase inside a longer one that stands in ``percent`` of
    its places is left out. Order: score, a (both falling), phrase.
    """
    dictionary = written(chunk_dictionary(docs), "collocations-chunks")
    exact = "decimal(38,0)"
    words = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    levels = [written(frequent_phrases(dictionary, 1, least), "collocations-1")]
    for size in range(2, LONGEST + 1):
        known = _Filter(levels[-1], size - 1)
        found = frequent_phrases(dictionary, size, least, known)
        levels.append(written(found, f"collocations-{size}"))
    counts = reduce(DataFrame.unionByName, levels)
    candidates = reduce(
        DataFrame.unionByName,
        [level.withColumn("size", F.lit(size + 1)) for size, level in enumerate(levels)][1:],
    ).withColumnRenamed("n", "a")

    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    parts = cuts.withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', cut)"),
            "right": F.expr("substring_index(phrase, ' ', cut - size)"),
        }
    )
    parts = parts.join(counts.toDF("lang", "left", "l"), ["lang", "left"]).join(
        counts.toDF("lang", "right", "r"), ["lang", "right"]
    )
    scored = parts.withColumn("score", score_of("a", "l", "r"))
    lowest = scored.groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low")
    )

    longer = candidates.filter("size > 2").select("lang", "phrase", "size", F.col("a").alias("longer"))
    inner = longer.select(
        "lang",
        "longer",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
                "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
            )
        ).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull()
        | (F.col("longer").cast(exact) * 100 < F.col("a").cast(exact) * F.lit(percent))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("low.l").alias("l"),
        F.col("low.r").alias("r"),
        "n",
        F.col("low.score").alias("score"),
    )
