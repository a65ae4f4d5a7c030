"""The text operators on small tables, against brute force where there is no SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowguard.llm import (
    decontamination,
    fingerprints,
    html_text,
    language_id,
    licenses,
    near_duplicates,
    packing,
    sharding,
    suffix_dedup,
    toxicity,
)
from rowguard.llm.graph import components

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
TEXTS = {1: LONG, 2: LONG, 3: "Before it " + LONG + " after it", 4: None, 5: "", 6: "é1!" * 30, 7: LONG + " x"}
SCHEMA = "doc_id bigint, text string, lang string, shard string, n_bytes int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "clash", 1) for i, t in TEXTS.items()], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_repeated_bytes_equal_brute_force(docs):
    seen, found = set(), by_id(suffix_dedup.repeated_bytes(docs, 50))
    for i, text in TEXTS.items():
        raw = (text or "").encode()
        gone, own = set(), set()
        for p in range(len(raw) - 49):
            own.add(raw[p : p + 50])
            if raw[p : p + 50] in seen:
                gone.update(range(p, p + 50))
        seen |= own
        kept = bytes(b for p, b in enumerate(raw) if p not in gone)
        assert found[i]["n_removed"] == len(gone)
        assert found[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    cut = suffix_dedup.without_repeats(docs, 50)
    assert cut.columns == [*docs.columns, "n_removed"]
    assert by_id(cut)[3]["text"].startswith("Before it ")


def test_near_duplicates(docs):
    found = by_id(near_duplicates.near_duplicates(docs, 4, 80))
    assert {i: r["component_id"] for i, r in found.items()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 1}
    assert [found[i]["n_shingles"] for i in (1, 4, 5, 6)] == [16, 0, 0, 1]


def test_packing_and_sharding(docs):
    pieces = packing.pack_documents(docs, capacity=16).collect()
    ends = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 16 and {r["doc_id"] for r in pieces} == set(TEXTS)
    rows = sharding.shard_documents(docs, 3).collect()
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(3)}
    assert all(v == list(range(len(v))) and len(v) in (2, 3) for v in slots.values())


def test_encoder_equals_the_json_form():
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    own = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in ("", " \n\t ", "it's 42 €uro", "<|endoftext|>", "日本語 mixed été́", "a" * 3000):
        assert own.encode_ordinary(text) == other.encode(text, add_special_tokens=False).ids


def test_license_notices_are_told_apart(spark):
    work = "This work is licensed under a Creative Commons Attribution"
    texts = {
        f"{work}-NonCommercial 4.0 International License.": "cc-by-nc",
        f"{work}-ShareAlike 4.0 International License.": "cc-by-sa",
        f"{work} 4.0 International License.": "cc-by",
        f"{work} 3.0 Unported License.": "cc-by",
        f"{work}-NoDerivatives 4.0 International License.": "",
        "This work is licensed under the GNU General Public License version 2": "",
        "This work is licensed under the very GNU General Public License version 3": "gpl-3",
        "Licensed under the Apache License version 1.1": "",
        # The right words in another order.
        "with or without modification are permitted and use in source and binary forms provided that the "
        "following conditions redistribution and use in source": "",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = by_id(licenses.license_scan(docs))
    assert {t: found[i]["labels"] for i, t in enumerate(texts)} == texts
    assert found[0]["score"] == 1.0


def test_usual_licenses_have_their_notices(spark):
    gnu = "under the terms of the GNU{} General Public License as published by the Free Software Foundation, either version"
    later = "of the License, or (at your option) any later version."
    work = "This work is licensed under a Creative Commons Attribution"
    texts = {
        f"{gnu.format('')} 2 {later}": "gpl-2",
        f"{gnu.format('')} 3 {later}": "gpl-3",
        f"{gnu.format(' Lesser')} 2.1 {later}": "lgpl-2.1",
        f"{gnu.format(' Lesser')} 3 {later}": "lgpl-3",
        f"{gnu.format(' Affero')} 3 {later}": "agpl-3",
        f"{work}-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa",
        f"{work}-NonCommercial-NoDerivatives 4.0 International License.": "cc-by-nc-nd",
        "Text licensed under CC BY 4.0 by its author": "cc-by",
        "Text licensed under CC BY-SA 4.0 by its author": "cc-by-sa",
        "Someone has waived all copyright and related or neighboring rights to this text.": "cc0",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.": "isc",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "# SPDX-License-Identifier: MIT": "mit",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2",
        "# SPDX-License-Identifier: BSD-3-Clause": "bsd",
        "# SPDX-License-Identifier: LicenseRef-own": "",
        "The SPDX license identifier is a short text; the software is provided as is.": "",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = by_id(licenses.license_scan(docs))
    assert {t: found[i]["labels"] for i, t in enumerate(texts)} == texts


def test_every_notice_is_found_in_its_own_words_alone(spark):
    notices = licenses.NOTICES
    docs = spark.createDataFrame([(i, n[0]) for i, n in enumerate(notices)], "doc_id int, text string")
    found = by_id(licenses.license_scan(docs, phrases=()))
    assert [(found[i]["labels"], found[i]["score"]) for i in range(len(notices))] == [(n[1], 1.0) for n in notices]


def test_base_phrases_of_the_given_documents_equal_a_plain_count(spark):
    """The contract's places, of whole texts, against a loop over all words."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    more = ["cc by nc cc by nc", "Apache License, Version 2", "under the mit\u00e9 license", "mit license", None, ""]
    rows = [(r.doc_id, r.text) for r in rows] + list(enumerate(more, 1 + max(r.doc_id for r in rows)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = by_id(licenses.license_scan(docs))
    for i, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [
            (p, label)
            for phrase, label in licenses.BASE_PHRASES
            for p in range(len(words))
            if words[p : p + len(phrase.split())] == phrase.split()
        ]
        at = [p for p, _ in places]
        expected = (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert tuple(found[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == expected
        assert set(found[i]["labels"].split(",")) - {""} >= {x for _, x in places}
    assert sum(r["n_base"] > 0 for r in found.values()) > 3


def test_added_tokens_are_those_of_the_json_form(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endoftext|", "it's  "]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(packing.pack_documents(rows, keep_ids=True))
    for i, text in enumerate(texts):
        assert found[i]["ids"] == [*other.encode(text, add_special_tokens=False).ids, 0]


def test_licenses(spark):
    texts = ["Released under the MIT License.", "x under the MIT license; under the mit license", None, "none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = by_id(licenses.license_scan(docs))
    assert [found[i]["n_base"] for i in range(4)] == [1, 2, 0, 0]
    assert (found[1]["first_word"], found[1]["last_word"], found[1]["base_labels"]) == (1, 5, "mit")
    assert (found[2]["n_words"], found[2]["first_word"], found[2]["labels"]) == (0, None, "")


def test_pack_carries_columns_of_any_name(spark):
    rows = [(i % 7, 0, 1 + i % 5) for i in range(40)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    names = ["_bucket", "_n", "_before", "_rank", "_number", "sequence_id", "_Rank_"]
    for name in names:
        pieces = pieces.withColumn(name, F.lit("own"))
    packed = packing.pack(pieces, capacity=8, per_bucket=6)
    found = packed.collect()
    assert len(found) == 40
    assert all(r[name] == "own" for r in found for name in names if name != "sequence_id")
    ends = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert ends.filter("n <> end OR n > 8").isEmpty()


def test_decontamination_sees_other_values(spark):
    item = "A train of 12 km length leaves when Anna counts 12 cars and then stops at noon"
    docs = spark.createDataFrame(
        [
            (1, item.replace("12", "7").replace("Anna", "Bert")),
            (2, "A train of 12 km length leaves when Anna counts 13 cars and then stops at noon"),
            (3, "nothing of the kind"), (4, None),
        ], "doc_id int, text string",
    )
    bench = spark.createDataFrame([(9, item), (8, None), (7, "")], "item_id int, text string")
    found = by_id(decontamination.contaminated(docs, bench))
    assert found[1]["item_id"] == 9 and not found[1]["exact"] and 3 not in found and 4 not in found


def test_decontamination_finds_exact_copies_of_every_item(spark):
    items = {
        1: "Compute 12 + 7 * 3 - 4 / 2.", 2: "What is 3 + 4 + 5?", 3: "Where is the capital of Peru",
        4: "日本で一番高い山は何という山ですか", 5: "6 * 71", 6: "1 2 3 4 5 6 7 8 9 10 11 12 13", 7: "...",
        8: "Is a cat of 3 kg more than a dog of 5 kg if both of them are fed 3 kg",
    }
    texts = {i: f"Question: {text} Answer: none." for i, text in items.items()}
    # Values that do not fit at the end; what comes before them is a copy.
    texts[18] = "Is a cat of 3 kg more than a dog of 5 kg if both of them are fed 4 kg"
    texts[14] = "昔々日本で一番高い山は何という山ですかと聞いた"
    texts[11] = "Compute 12 + 8 * 3 - 4 / 2."
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id int, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontamination.contaminated(docs, bench).collect()}
    expected = {(i, i) for i in items if i != 7} | {(18, 8), (14, 4)}
    assert set(found) == expected and all(found[p]["exact"] for p in expected)
    assert all(found[i, i]["coverage"] == 1 for i in items if i != 7)


def test_decontamination_of_many_copies_in_one_document(spark):
    """1000 re-numbered copies of one item in a document, and as many exact ones."""
    item = "A train of 12 km length leaves the yard at noon when the guard counts 15 cars in a row"
    many = " . ".join(item.replace("12", str(100 + i)).replace("15", str(3000 + i)) for i in range(1000))
    docs = spark.createDataFrame([(1, many), (2, f"{item} . " * 1000), (3, "no")], "doc_id int, text string")
    bench = spark.createDataFrame([(9, item)], "item_id int, text string")
    started = time.perf_counter()
    found = by_id(decontamination.contaminated(docs, bench))
    assert time.perf_counter() - started < 60
    assert not found[1]["exact"] and found[2]["exact"] and set(found) == {1, 2}
    assert found[1]["coverage"] == found[2]["coverage"] == 1


def test_language_filter_decides_by_the_prediction(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de") for i in range(60)]
    odd = [(60, None, "en"), (61, "12 !", None), (62, "xqzj wvkk ypff xqqz jjkw", "en"), (63, "die katze und der hund", "en")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string")
    kept = {r["doc_id"] for r in language_id.with_language(docs).collect()}
    assert kept == {*range(60), 63}
    english = {r["doc_id"] for r in language_id.with_language(docs, ["en"]).collect()}
    assert english == set(range(1, 60, 2))
    untaught = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.with_language(untaught).count() == docs.count()


def test_language_and_toxicity(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame([*rows, (60, None, "en"), (61, "12 !", None)], "doc_id bigint, text string, lang string")
    found = by_id(language_id.identify_documents(docs))
    assert all(found[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    assert found[60]["lang_pred"] == found[61]["lang_pred"] == "und"
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id bigint, quality int, toxic int")
    scored = by_id(toxicity.score_documents(docs, labels))
    assert all(scored[i]["toxic"] == bool(i % 2) for i in range(60)) and not scored[60]["toxic"]


def test_language_filters_grow_with_their_members(spark, monkeypatch):
    """More n-grams of one language than the least number of slots holds."""
    monkeypatch.setattr(language_id, "LEAST_SLOTS_LOG2", 8)
    rng = random.Random(1)
    letters = {"aa": "abcdefghijklm", "bb": "nopqrstuvwxyz"}
    words = lambda lang, n: " ".join("".join(rng.choices(letters[lang], k=6)) for _ in range(n))
    rows = [(words("aa", 4000), "aa"), (words("bb", 40) * 2, "bb")]
    filters = language_id.learn(spark.createDataFrame(rows, "text string, lang string"), least=1)
    assert max(filters.chance) <= 0.012
    assert filters.identify([words("aa", 200)])[0] == ["aa"]
    assert language_id.slots_for(4_000_000, 0.01) == 26


def test_pages(spark):
    menu = "<div><b>Site</b> menu of all</div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{menu}<p>Text &amp; number {i}</p>") for i in range(4)]
    pages = spark.createDataFrame([*rows, (9, None, None)], "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.extract_pages(pages).collect()}
    assert found == {**{i: f"Text & number {i}" for i in range(4)}, 9: ""}


def test_elements_without_their_end_tag_end_somewhere():
    pages = {
        '<p>one <svg class="i"/> two</p><p>three</p>': "one two\n\nthree",
        "<html><head><title>t</title><meta charset=x><body><p>one</p>": "one",
        "<head><title>t</title><p>one</p>": "one",
        "<p>one <svg><path> two</p><p>three</p>": "one two\n\nthree",
        "<p>one <select><option>x</p><p>two</p>": "one x\n\ntwo",
        "<div>one <svg><g><svg>x</svg>y</g></svg> two</div><svg>z</svg>": "one two",
        "<p>one</p><script>x<p>two</p>": "one",
    }
    for page, text in pages.items():
        assert html_text.main_text(page) == text, page


def test_names_that_only_look_like_menus_keep_their_text():
    for name in ("has-sidebar", "container sidebar-right", "nav-fixed", "sidebar", "page menu"):
        assert html_text.main_text(f"<div class='{name}'><article><p>one</p></article></div>") == "one"
    inner = (
        "<h2 id='related-work'>a</h2><section id='search'>b</section><p class='alert'>c</p>"
        "<div class='market-share'>d</div><p class='ad'>x</p><div class='share' data-id='q'>y</div>"
    )
    assert html_text.main_text(f"<article>{inner}</article>") == "a\n\nb\n\nc\n\nd"
    aside = "<aside><article>teaser</article></aside><div class='comments'><article>no</article></div>"
    assert html_text.main_text(f"<article>one</article>{aside}") == "one"
    assert html_text.main_text("<form class='widget'><main><p>one</p></main></form>") == "one"


def test_fingerprints(docs):
    found = by_id(fingerprints.fingerprint_documents(docs))
    assert found[1]["fingerprint"] == found[2]["fingerprint"] != ""
    order = sorted(TEXTS, reverse=True)
    for i, n in zip(order, order[1:] + order[:1]):
        own, following = TEXTS[i] or "", TEXTS[n] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert found[2]["near_next"] == 1.0


def test_empty_tables(none):
    assert suffix_dedup.repeated_bytes(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert sharding.shard_documents(none).count() == 0
    assert licenses.license_scan(none).count() == 0
    assert language_id.identify_documents(none).count() == 0
    assert fingerprints.fingerprint_documents(none).count() == 0
    assert near_duplicates.near_duplicates(none).count() == 0


def linked_by_brute_force(texts, width, percent):
    """Component of each id from all pairs of shingle sets."""
    sets = {}
    for i, text in texts.items():
        words = (text or "").lower().split()
        sets[i] = {tuple(words[p : p + width]) for p in range(max(1, len(words) - width + 1))} if words else set()
    label = {i: i for i in texts}
    for a, b in itertools.combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) > 0:
            low, high = sorted((label[a], label[b]))
            label = {i: low if own == high else own for i, own in label.items()}
    return label


@pytest.mark.parametrize("block", [3, 512])
def test_near_duplicates_around_the_threshold_equal_brute_force(spark, monkeypatch, block):
    """Edited copies of one template: many share buckets, some pairs only are links."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    texts = {}
    for i in range(70):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(150)] = f"e{i}x{rng.random()}"
        texts[i] = " ".join(words)
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    expected = linked_by_brute_force(texts, 4, 80)
    found = by_id(near_duplicates.near_duplicates(rows, 4, 80))
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert len(set(expected.values())) > 2


@pytest.mark.parametrize("block", [2, 512])
def test_texts_of_one_id_keep_the_links_of_all_of_them(spark, monkeypatch, block):
    """An id with several texts is one document; which text is longest does not matter."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    a, b, c = (" ".join(f"{x}{k}" for k in range(n)) for x, n in (("a", 40), ("b", 60), ("c", 50)))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, c), (4, c), (7, c + " y"), (9, "else"), (9, None)]
    rows += [(20 + k // 2, " ".join(f"own{k}x{j}" for j in range(30))) for k in range(12)]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 80)
    expected = {1: 1, 2: 1, 3: 1, 4: 4, 7: 4, 9: 9} | {20 + k: 20 + k for k in range(6)}
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == set(expected.items())
    assert found.count() == len(rows)
    assert {(r["n_shingles"], r["kept"]) for r in found.filter("doc_id = 1").collect()} == {(37, True), (57, True)}


def test_pairs_of_blocks_find_every_near_pair_once():
    """Every pair within the distance and of other components, whatever the batches are."""
    rng = np.random.default_rng(3)
    n, blocks = 40, 3
    base = rng.integers(0, 1 << 32, near_duplicates.FINE_SAMPLES, dtype=np.uint32)
    rows, samples = [], []
    for i in range(n):
        own = base.copy()
        own[rng.random(len(own)) < 0.08] = rng.integers(0, 1 << 32)
        samples.append(own)
        coarse, fine = near_duplicates.odd_sketch(own[:128]), near_duplicates.odd_sketch(own, near_duplicates.FINE_BITS)
        for other in range(blocks):
            one, two = sorted((i % blocks, other))
            rows.append((7, one, two, i % blocks, i, i // 2, 100, coarse, fine, np.full(32, 7)))
    rows.sort(key=lambda r: r[:3])
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * 3
    whole = pa.RecordBatch.from_arrays(
        [pa.array(list(column), type=kind) for column, kind in zip(zip(*rows), kinds)], names=list(near_duplicates._HELD)
    )
    expected = {
        (v, u)
        for u, v in itertools.combinations(range(n), 2)
        if u // 2 != v // 2
        and all(
            sum((int(x) ^ int(y)).bit_count() if (int(x) ^ int(y)) >= 0 else ((int(x) ^ int(y)) + (1 << 64)).bit_count()
                for x, y in zip(near_duplicates.odd_sketch(samples[u][:s], b), near_duplicates.odd_sketch(samples[v][:s], b)))
            <= near_duplicates.largest_distance(80, s, b, d)
            for s, b, d in ((128, 512, 7), (1024, 4096, 6))
        )
    }
    for size in (5, 1000):
        batches = [whole.slice(at, size) for at in range(0, len(whole), size)]
        found = [p for b in near_duplicates._apart_within(80)(iter(batches)) for p in zip(*(c.to_pylist() for c in b.columns))]
        assert len(found) == len(set(found)) and set(found) == expected and expected


def test_components_of_paths_and_stars(spark):
    edges = [(9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (1, 20), (21, 20), (30, 31), (40, 30), (40, 32), (50, 50)]
    found = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r["node"]: r["label"] for r in found} == {
        **{k: 4 for k in range(4, 10)}, 1: 1, 20: 1, 21: 1, 30: 30, 31: 30, 32: 30, 40: 30,
    }
    assert len(found) == 13


def test_pages_without_article_keep_the_element_that_holds_their_text():
    pages = {
        "<form id='aspnetForm'><p>one two three four</p></form>": "one two three four",
        "<nav>a b c d e f g</nav><div class='content search'><p>one two</p></div>": "one two",
        "<div role='search main'><p>one two</p></div>": "one two",
        "<div class='social'><p>one</p></div>": "one",
        "<div><p>the main text</p></div><form><p>mail</p></form>": "the main text",
        "<p>one</p><div class='comments'>many words of readers, more than the page</div>": "one",
        "<article><p>a</p><div class='dialog'>b</div></article>": "a\n\nb",
        "<p class=x'>one</p>": "one",
        "<p title=\"a>b\">one</p><p a='x\">two</p>": "one\n\ntwo",
    }
    for page, text in pages.items():
        assert html_text.main_text(page) == text, page


@pytest.mark.parametrize("nested", ["<article>", "<div>", "<nav>", "<div><td>", "<li><p>", "<aside><article>x"])
def test_deep_pages_take_time_in_proportion(nested):
    def seconds(n):
        best = []
        for _ in range(3):
            started = time.perf_counter()
            page = nested * n + "x" + "</b>" * n
            html_text.hash_subtrees(html_text.parse(page))
            html_text.main_text(page)
            best.append(time.perf_counter() - started)
        return min(best)

    assert seconds(16_000) < 12 * seconds(4_000)


def test_boxes_that_recur_in_articles_go_and_shared_sentences_stay(spark):
    box = "<div><b>Share</b> this on all</div>"
    texts = [f"<p>Text number {i}</p>" + ("<p>Known saying</p>" if i < 3 else "") for i in range(8)]
    rows = [(i, "http://h.example/", f"<body><article>{t}{box}</article></body>") for i, t in enumerate(texts)]
    # Copies of one article among other things are one page: its text is no template.
    rows += [(100 + i, "http://copies.example/", f"<i>{i}</i><article><p>same</p>{box}</article>") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.extract_pages(pages).collect()}
    assert all(found[i] == f"Text number {i}" + ("\n\nKnown saying" if i < 3 else "") for i in range(8))
    assert all(found[100 + i] == "same\n\nShare this on all" for i in range(9))
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_equal_rows_spread_over_shards_and_arrangements_are_uniform(spark):
    """100,000 equal rows and null keys: no cell holds them all, sizes stay exact."""
    rows = spark.range(100_000, numPartitions=8).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.lit("same").alias("text"), F.col("id").alias("_h"), F.col("id").alias("_row")
    )
    placed = sharding.uniform_shards(rows, ["doc_id", "text"], 16)
    sizes = placed.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert sorted(r["shard"] for r in sizes) == list(range(16))
    assert all(r["n"] == r["d"] == r["m"] + 1 == 6250 for r in sizes)
    # Chi-square of where each eighth of the table went: 7 * 15 degrees of freedom.
    counts = placed.groupBy(F.floor(F.col("_row") / 12_500).alias("eighth"), "shard").count().collect()
    expected = 100_000 / 8 / 16
    assert sum((r["count"] - expected) ** 2 / expected for r in counts) < 105 + 5 * (2 * 105) ** 0.5


def test_ngrams_of_other_scripts_have_other_numbers():
    """Han and Hangul letters, letters beyond 16 bits: equal n-grams only from equal letters."""
    words = ["丂七丄", "츂츃츄", "丂츃丄", "\U0001d400\U0001d401\U0001d402", "\U00010400bc"]
    grams = []
    for word in words:
        [(points, of)] = language_id._units([word])
        grams.append(set(language_id._grams(points, of)[0].tolist()))
    assert all(len(g) == 5 for g in grams)
    for a, b in itertools.combinations(grams, 2):
        assert not a & b


def order_min_hash(text, k=3, slots_log2=6):
    """The fingerprint by its definition, a k-mer at a time."""
    import re

    import xxhash

    def chained(*values, seed=42):
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else (v % 2**64).to_bytes(8, "little"), seed)
        return seed

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    words = [chained(w) for w in re.findall(r"[一-鿿]|[^\s一-鿿]+", text, re.A)]
    if len(words) < k:
        mers = [chained(*words)] if words else []
    else:
        mers = [chained(*words[i : i + k]) for i in range(len(words) - k + 1)]
    seen, slots = {}, {}
    for place, mer in enumerate(mers):
        key = signed(mer) >> 24
        number = seen.get(key, 0)
        seen[key] = number + 1
        if len(set(mers)) < len(mers) and number:
            mer = xxhash.xxh64_intdigest(number.to_bytes(4, "little"), chained(key))
        elif len(set(mers)) < len(mers):
            mer = (signed(mer) >> 24 << 24 | place) % 2**64
        hashed = (mer >> 1) >> 24
        slots.setdefault(hashed >> (39 - slots_log2), []).append((hashed, place))
    out = []
    for slot in sorted(slots):
        pair = sorted(sorted(slots[slot])[:2], key=lambda x: x[1])
        out.append(slot << (32 - slots_log2) | chained(*[h for h, _ in pair]) & (1 << (32 - slots_log2)) - 1)
    return "".join(f"{x:08X}" for x in out)


def test_fingerprints_equal_a_plain_order_min_hash(spark):
    rng = random.Random(4)
    texts = [None, "", " \n", "one", "one two", "a b c", " ".join(rng.choices([f"w{i}" for i in range(300)], k=2000))]
    texts += [" ".join(rng.choices("abc", k=400)), "x " * 500, "字漢語文" * 300 + " end", "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(fingerprints.fingerprint_documents(rows))
    for i, text in enumerate(texts):
        own, following = text or "", texts[i - 1] or ""
        half = len(own) // 2
        assert found[i]["fingerprint"] == order_min_hash(own), i
        edited = own[: len(own) - half] + following[:half]
        assert found[i]["edited_fingerprint"] == order_min_hash(edited), i
    # Half of 2000 letters without a space is the same text: both least of a slot, a third each.
    assert 0.05 < found[10]["near_edited"] < 0.25
