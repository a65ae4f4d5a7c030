"""Benchmark passages in documents, re-parameterised ones included, with built-in functions only.

Texts become templates: numbers, names (a capitalised word inside a sentence) and units (a unit's
name behind a number) turn into typed placeholders, all else is lower-cased, punctuation goes.
Hashes of ``window`` template tokens are joined with those of the benchmark, and in the same join
hashes of as many literal tokens (lower-cased, without placeholders), which every item has. A window
without placeholders is the same in both kinds. Matches of a document and an item at the same
distance belong together; their placeholders' values must fit: one value of the item stands for one
value of the document, and the other way round. Literal windows need no such test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import text_or_empty, written

# Units that count as such behind a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "ton", "tons", "ounce", "ounces", "pound", "pounds", "ml", "l", "liter",
    "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "minute", "minutes",
    "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "cent",
    "cents", "dollar", "dollars", "euro", "euros", "percent", "degree", "degrees", "watt", "watts",
    "volt", "volts", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "gram",
    "grams", "kilogram", "kilograms",
)
#: Begins a placeholder: a private character, which texts have no words with.
_MARK = "\ue000"
#: Up to so many windows of the benchmark are broadcast (16 bytes each); beyond, both sides shuffle.
BROADCAST_WINDOWS = 1_000_000
_NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"
# A capitalised word behind something that does not end a sentence.
_NAME = r"(?<=[^.!?\s][ \t]{1,3})\p{Lu}[\p{Ll}\p{M}]*(?![\p{L}\p{M}])"
_UNIT = rf"(?<=\p{{N}}[ \t]{{0,2}})(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{M}}])"
# Letters of scripts written without spaces are tokens of their own.
_LONE = (
    r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
    "\u3005\u30fc\uff70"
)
_WORD = rf"[\p{{L}}&&[{_LONE}]]\p{{M}}*|[\p{{L}}&&[^{_LONE}]](?:[\p{{L}}&&[^{_LONE}]]|\p{{M}})*"
_RAW_TOKEN = rf"{_NUMBER}|{_WORD}"
_TOKEN = rf"{_MARK}\p{{L}}+|{_WORD}"


def template_tokens(text: Column) -> Column:
    """Template tokens of a text, as many as ``raw_tokens`` gives."""
    plain = F.translate(text, _MARK, " ")
    named = F.regexp_replace(plain, _NAME, f" {_MARK}name ")
    valued = F.regexp_replace(
        F.regexp_replace(named, f"(?i){_UNIT}", f" {_MARK}unit "), _NUMBER, f" {_MARK}number "
    )
    typed = F.when(text.rlike(r"\p{N}"), valued).otherwise(named)
    return F.regexp_extract_all(F.lower(typed), F.lit(_TOKEN), F.lit(0))


def raw_tokens(text: Column) -> Column:
    """Words and numbers as they stand in the text."""
    return F.regexp_extract_all(F.translate(text, _MARK, " "), F.lit(_RAW_TOKEN), F.lit(0))


def literal_tokens(text: Column) -> Column:
    """``raw_tokens`` in lower case."""
    return F.transform(raw_tokens(text), lambda t: F.lower(t))


def _windows(tokens: str, places: Column, length: int) -> Column:
    """Hashes of the windows of a length at some places; of an array of hashed tokens."""
    return F.transform(
        places, lambda i: F.xxhash64(F.lit(length), *[F.get(F.col(tokens), i + j) for j in range(length)])
    )


def _exploded(df: DataFrame, template: list[int], literal: list[int]) -> DataFrame:
    """A row per window of each of the lengths, ``place`` and ``hash``. Literal windows are hashed
    only where a token differs from the template's, as the others are the same in both kinds; but of
    lengths without template windows all are."""
    none = F.array().cast("array<int>")
    n = F.size("_words")
    differs = F.filter(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none),
        lambda i: F.get(F.col("_kinds"), i) != F.get(F.col("_words"), i),
    )
    df = df.withColumn("_differs", differs)
    places, hashes = [], []
    for length in sorted({*template, *literal}):
        every = F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(none)
        around = F.transform(
            "_differs",
            lambda d, length=length: F.sequence(F.greatest(F.lit(0), d - (length - 1)), F.least(d, n - length)),
        )
        some = F.when(n >= length, F.array_distinct(F.flatten(around))).otherwise(none)
        if length in template:
            df = df.withColumn(f"_all{length}", every)
            places.append(f"_all{length}")
            hashes.append(_windows("_kinds", F.col(places[-1]), length))
        if length in literal:
            df = df.withColumn(f"_own{length}", some if length in template else every)
            places.append(f"_own{length}")
            hashes.append(_windows("_words", F.col(places[-1]), length))
    df = df.withColumn("_places", F.concat(*places))
    df = df.select("*", F.posexplode(F.concat(*hashes)).alias("_at", "hash"))
    return df.withColumn("place", F.get("_places", F.col("_at")))


def _slots(kinds: Column, raw: Column, place: Column, length: Column) -> Column:
    """Values of the placeholders of a window, in lower case, in their order."""
    pairs = F.arrays_zip(
        F.slice(kinds, place + 1, length).alias("kind"), F.slice(raw, place + 1, length).alias("value")
    )
    return F.transform(
        F.filter(pairs, lambda p: p["kind"].startswith(_MARK)),
        lambda p: F.concat(p["kind"], F.lit(":"), F.lower(p["value"])),
    )


def benchmark_windows(benchmark: DataFrame, window: int, least_literal: float) -> DataFrame:
    """Windows of the benchmark: hash, item_id, place, length, literal, slots. Items shorter than
    ``window`` give one of their own length. Every window is there with its literal tokens; those of
    five tokens at least, enough of them literal, also as a template: others would say nothing."""
    text = text_or_empty()
    items = benchmark.select(
        "item_id",
        template_tokens(text).alias("_kinds"),
        raw_tokens(text).alias("_raw"),
        literal_tokens(text).alias("_words"),
    )
    items = items.filter(F.size("_raw") > 0)
    length = F.least(F.size("_raw"), F.lit(window))
    places = items.withColumn("length", length).withColumn(
        "place", F.explode(F.sequence(F.lit(0), F.size("_raw") - F.col("length")))
    )
    own = F.slice("_kinds", F.col("place") + 1, F.col("length"))
    plain = F.size(F.filter(own, lambda t: ~t.startswith(_MARK)))

    def kind(rows: DataFrame, tokens: str, least: int, slots: Column) -> DataFrame:
        # As xxhash64 of the length and each token, which is what documents' windows get.
        rows = rows.withColumn("_hashed", F.transform(tokens, lambda t: F.xxhash64(t)))
        hashed = F.lit(None).cast("bigint")
        for n in range(least, window + 1):
            parts = [F.get(F.col("_hashed"), F.col("place") + j) for j in range(n)]
            hashed = F.when(F.col("length") == n, F.xxhash64(F.lit(n), *parts)).otherwise(hashed)
        return rows.select(
            hashed.alias("hash"),
            "item_id",
            F.col("place").alias("item_place"),
            "length",
            F.size("_raw").alias("item_tokens"),
            (F.size(slots) == 0).alias("literal"),
            slots.alias("item_slots"),
        )

    typed = places.filter((F.col("length") >= 5) & (plain >= F.ceil(F.col("length") * least_literal)))
    slots = _slots(F.col("_kinds"), F.col("_raw"), F.col("place"), F.col("length"))
    both = kind(typed, "_kinds", 5, slots).unionByName(
        kind(places, "_words", 1, F.array().cast("array<string>"))
    )
    return both.distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 10, least_literal: float = 0.6
) -> DataFrame:
    """Pairs of a document and a benchmark item of which a window stands in the document.

    Per pair: doc_id, item_id, n_windows (matching windows of the best alignment), n_tokens (they
    span), coverage (of the item's tokens), exact (all placeholder values are the item's own). An
    item shorter than ``window`` must be there as a whole, and one of a single word is wherever that
    word is. Null texts and texts without letters and numbers match nothing; a null doc_id or
    item_id is kept as it is; rows with one id count as one document. Empty tables give no rows.
    """
    if not 5 <= window <= 64:
        raise ValueError("window must be from 5 to 64 tokens")
    bench = written(benchmark_windows(benchmark, window, least_literal), "decontamination-windows")
    sizes = bench.groupBy("length", "literal").count().collect()  # at most two rows per length
    literal = sorted(r["length"] for r in sizes if r["literal"]) or [window]
    template = sorted(r["length"] for r in sizes if not r["literal"])
    side = F.broadcast(bench) if sum(r["count"] for r in sizes) <= BROADCAST_WINDOWS else bench
    texts = docs.select("doc_id", text_or_empty().alias("_text"))
    texts = texts.withColumn("_kinds", F.transform(template_tokens(F.col("_text")), lambda t: F.xxhash64(t)))
    texts = texts.withColumn("_words", F.transform(literal_tokens(F.col("_text")), lambda t: F.xxhash64(t)))
    found = _exploded(texts, template, literal).join(side, "hash")
    # A text is tokenised once more for its placeholders, however many windows of it match. Texts
    # with one id that are equal are one; other texts differ in 128 bits of hashes.
    hit = F.struct("item_id", "place", "item_place", "length", "item_tokens", "literal", "item_slots")
    by_text = found.groupBy(
        F.xxhash64("doc_id", "_text").alias("_one"), F.xxhash64(F.lit(1), "_text", "doc_id").alias("_two")
    ).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("_text").alias("_text"),
        F.collect_set(hit).alias("_hits"),
        F.max(F.size("item_slots")).alias("_slots"),
    )
    none = F.array().cast("array<string>")
    tokens = {
        "_kinds": F.when(F.col("_slots") > 0, template_tokens(F.col("_text"))).otherwise(none),
        "_raw": F.when(F.col("_slots") > 0, raw_tokens(F.col("_text"))).otherwise(none),
    }
    # Dealt anew, so that tokens are made once and not for each hit, into which they would be inlined.
    tokenised = by_text.withColumns(tokens).repartition("_one", "_two")

    def with_slots(h: Column) -> Column:
        own = _slots(F.col("_kinds"), F.col("_raw"), h["place"], h["length"])
        slots = F.when(F.size(h["item_slots"]) == 0, none).otherwise(own)
        return F.struct(
            h["item_id"].alias("item_id"),
            h["place"].alias("place"),
            (h["place"] - h["item_place"]).alias("distance"),
            h["length"].alias("length"),
            h["item_tokens"].alias("item_tokens"),
            h["literal"].alias("literal"),
            F.arrays_zip(h["item_slots"].alias("item"), slots.alias("doc")).alias("slots"),
        )

    hits = tokenised.select("doc_id", F.explode(F.transform("_hits", with_slots)).alias("_hit"))
    hits = hits.select("doc_id", "_hit.*")

    def matched(which: Column) -> Column:
        """Windows and the tokens they span; an item's windows bound the set."""
        place, end = F.when(which, F.col("place")), F.when(which, F.col("place") + F.col("length"))
        return F.struct(
            F.size(F.collect_set(place)).alias("n_windows"), (F.max(end) - F.min(place)).alias("n_tokens")
        )

    aligned = hits.groupBy("doc_id", "item_id", "distance", "item_tokens").agg(
        matched(F.lit(True)).alias("all"),
        matched(F.col("literal")).alias("own"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    pairs = F.size("slots")
    fits = (F.size(F.array_distinct("slots.item")) == pairs) & (F.size(F.array_distinct("slots.doc")) == pairs)
    exact = ~F.exists("slots", lambda s: s["item"] != s["doc"])
    # Values that do not fit speak against the templates, not against what stands there literally.
    taken = F.when(fits, F.col("all")).otherwise(F.col("own"))
    best = F.struct("taken.n_windows", "taken.n_tokens", (exact | ~fits).alias("exact"), "item_tokens")
    return (
        aligned.withColumn("taken", taken)
        .filter("taken.n_windows > 0")
        .groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n_windows").cast("long").alias("n_windows"),
            F.col("best.n_tokens").cast("long").alias("n_tokens"),
            F.least(F.lit(1.0), F.col("best.n_tokens") / F.col("best.item_tokens")).alias("coverage"),
            F.col("best.exact").alias("exact"),
        )
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a benchmark passage. Rows with a null id are kept: nothing
    tells them apart."""
    found = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
