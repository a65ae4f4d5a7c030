"""License notices by diagonal voting.

All rolling word ``k``-gram hashes of the texts are joined with the positions of the same hashes in
the notices looked for. A hit votes for a diagonal: its place in the text minus its place in the
notice. Votes are summed per diagonal, neighbouring diagonals (a few words put in or left out) are
merged, and the spans found are verified: a short phrase must be there word for word, a notice to a
share of its k-grams, each once and in order, together with the words that tell it from others. Of
notices on the same words the best one counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import lower_ascii, text_or_empty

# The base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Wording of public licenses and of usual notices, with the label each one speaks for and,
# where others read much the same, the words that must be there as they are.
NOTICES = (
    ("released under the mit license", "mit", "the mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including "
     "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
     "copies of the software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2", "license version 2"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "by nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     "cc-by-nc", "attribution noncommercial"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "by sa"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license",
     "cc-by-sa", "attribution sharealike"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by",
     "attribution 4"),
    ("this work is licensed under a creative commons attribution 3 0 unported license", "cc-by", "attribution 3"),
    ("this work is licensed under a creative commons attribution 2 5 generic license", "cc-by", "attribution 2"),
    ("this work is licensed under a creative commons attribution 2 0 generic license", "cc-by", "attribution 2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3", "license version 3"),
    ("this work is licensed under the gnu general public license v3", "gpl-3", "license v3"),
    ("under the terms of the gnu general public license as published by the free software foundation either "
     "version 3 of the license or at your option any later version", "gpl-3", "version 3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2", "license v 2"),
    ("this source code form is subject to the terms of the mozilla public license version 2 0", "mpl-2",
     "license version 2"),
    ("licensed under cc by 4 0", "cc-by", "by 4"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", "nc sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", "nc nd"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "by nd"),
    ("this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
     "cc-by-nc-sa", "noncommercial sharealike"),
    ("this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
     "cc-by-nc-nd", "noncommercial noderivatives"),
    ("has waived all copyright and related or neighboring rights to", "cc0"),
    ("cc0 1 0 universal", "cc0"),
    ("under the terms of the gnu general public license as published by the free software foundation either "
     "version 2 of the license or at your option any later version", "gpl-2", "version 2 of"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation either "
     "version 2 1 of the license or at your option any later version", "lgpl-2.1", "lesser general public", "version 2 1"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation either "
     "version 3 of the license or at your option any later version", "lgpl-3", "lesser general public", "version 3"),
    ("under the terms of the gnu affero general public license as published by the free software foundation either "
     "version 3 of the license or at your option any later version", "agpl-3", "affero general public", "version 3"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software", "zlib"),
    ("boost software license version 1 0", "bsl-1", "software license version"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     "epl-2", "eclipse public license 2"),
)
# Short identifiers as they stand behind "SPDX-License-Identifier:", in words, with their labels.
SPDX = (
    ("mit", "mit"), ("apache 2 0", "apache-2"), ("gpl 2 0", "gpl-2"), ("gpl 3 0", "gpl-3"), ("lgpl 2 1", "lgpl-2.1"),
    ("lgpl 3 0", "lgpl-3"), ("agpl 3 0", "agpl-3"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd"), ("isc", "isc"),
    ("mpl 2 0", "mpl-2"), ("epl 2 0", "epl-2"), ("bsl 1 0", "bsl-1"), ("cc0 1 0", "cc0"), ("unlicense", "unlicense"),
    ("zlib", "zlib"), ("cc by 4 0", "cc-by"), ("cc by sa 4 0", "cc-by-sa"), ("cc by nc 4 0", "cc-by-nc"),
    ("cc by nd 4 0", "cc-by-nd"), ("cc by nc sa 4 0", "cc-by-nc-sa"), ("cc by nc nd 4 0", "cc-by-nc-nd"),
)
# An identifier must stand there whole.
NOTICES += tuple((f"spdx license identifier {name}", label, f"identifier {name}") for name, label in SPDX)
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# One entry without a template per document keeps those without hits.
_EMPTY, _MARKER = -1, 0


def _grams(words: str, k: int) -> Column:
    places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(k)]))


def _templates(docs: DataFrame, phrases, notices, k: int) -> DataFrame:
    """A row per k-gram: hash, template, place, number of k-grams, words, label, base."""
    rows = [(i, t.split(), label, True) for i, (t, label) in enumerate(phrases)]
    rows += [(i + len(rows), t.split(), label, False) for i, (t, label, *_) in enumerate(notices)]
    if any(len(words) < k for _, words, _, _ in rows):
        raise ValueError(f"a notice has fewer than {k} words")
    df = docs.sparkSession.createDataFrame(
        rows, "template int, template_words array<string>, label string, base boolean"
    )
    df = df.withColumn("grams", F.size("template_words") - (k - 1)).select(
        "*", F.posexplode(_grams("template_words", k)).alias("template_place", "hash")
    )
    marker = docs.sparkSession.createDataFrame([(_EMPTY, 0, _MARKER)], "template int, template_place int, hash bigint")
    return df.unionByName(marker, allowMissingColumns=True)


def _chain(hits: dict[int, list[int]], near: int) -> tuple[list[tuple[int, int]], int]:
    """The longest run of hits, as (place in the text, in the notice), in which both places grow and
    neighbours lie at most ``near`` diagonals apart. ``hits`` has the notice's places by diagonal."""
    points = sorted((d + t, -t) for d, places in hits.items() for t in places)
    done: dict[int, tuple[list[int], list[tuple[int, int]]]] = {}  # by diagonal: places, best up to each
    length, before = [], []
    for number, (at, t) in enumerate(points):
        own, best = at + t, (0, -1)
        for d in range(own - near, own + near + 1):
            if d in done:
                upto = bisect_left(done[d][0], min(at, d - t)) - 1
                if upto >= 0:
                    best = max(best, done[d][1][upto])
        length.append(best[0] + 1)
        before.append(best[1])
        places, tops = done.setdefault(own, ([], []))
        places.append(at)
        tops.append(max((length[-1], number), tops[-1]) if tops else (length[-1], number))
    last = max(range(len(points)), key=length.__getitem__)
    run = []
    while last >= 0:
        run.append((points[last][0], -points[last][1]))
        last = before[last]
    return run[::-1], len(run)


def _holds(run: list[tuple[int, int]], begin: int, end: int, k: int) -> bool:
    """Whether the notice's words from ``begin`` to ``end`` stand in the text as they are."""
    hits = set(run)
    needed = range(begin, max(begin, end - k) + 1) if end - begin > k else None
    if needed is None:
        return any(t <= begin and end <= t + k for _, t in run)
    return any(t == begin and all((at + n - begin, n) in hits for n in needed) for at, t in run)


def _judge(notices: dict[int, tuple[str, int, list[list[tuple[int, int]]]]], k: int, near: int, least_share: float):
    """Labels and best share of a document's hits: (notice, diagonal, places in the notice). A notice
    comes with its label, its number of k-grams and the places of each of its required runs of words."""

    def judge(found: list[dict]) -> tuple[set[str], float]:
        spans, score = [], 0.0
        by_notice: dict[int, dict[int, list[int]]] = {}
        for hit in found:
            by_notice.setdefault(hit["template"], {})[hit["diagonal"]] = hit["places"]
        for notice, diagonals in by_notice.items():
            label, grams, required = notices[notice]
            order = sorted(diagonals)
            cuts = [0, *(i for i in range(1, len(order)) if order[i] - order[i - 1] > near), len(order)]
            for a, b in zip(cuts, cuts[1:]):
                run, n = _chain({d: diagonals[d] for d in order[a:b]}, near)
                score = max(score, n / grams)
                if n / grams >= least_share and all(any(_holds(run, *r, k) for r in places) for places in required):
                    spans.append((n / grams, run[0][0], run[-1][0] + k, label))
        labels = set()
        for share, begin, end, label in spans:
            beaten = any(
                other > share and name != label and 2 * (min(end, stop) - max(begin, start)) > min(end - begin, stop - start)
                for other, start, stop, name in spans
            )
            if not beaten:
                labels.add(label)
        return labels, score

    return judge


def license_scan(
    docs: DataFrame,
    *,
    phrases=BASE_PHRASES,
    notices=NOTICES,
    k: int = 3,
    near: int = 2,
    least_share: float = 0.6,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are the
    smallest and largest start among them. A notice counts if a span of it holds ``least_share`` of its
    k-grams, each once and in order, and each of its required runs of words (a notice's values from the third on),
    and no other label has a larger share of the same words; ``score`` is the best share of any
    phrase or notice. Null and empty texts have no
    words. Every row is a document of its own, whatever its id. One pass and one shuffle, of the hits
    (and one row per document); the notices are a parameter and small, so they are broadcast.
    """
    text = lower_ascii(text_or_empty())
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), text.alias("_text"))
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(_WORD), F.lit(0))).drop("_text")
    templates = F.broadcast(_templates(docs, phrases, notices, k))
    grams = F.concat(
        F.array(F.lit(_MARKER).cast("bigint")),
        F.coalesce(_grams("_words", k), F.array().cast("array<bigint>")),
    )
    joined = rows.select("*", F.posexplode(grams).alias("_at", "hash")).join(templates, "hash")
    place = F.col("_at") - 1
    hits = joined.select(
        "_row",
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        "template",
        "label",
        "base",
        "grams",
        "template_place",
        (place - F.col("template_place")).alias("diagonal"),
        F.when(
            F.col("base"),
            F.slice("_words", F.greatest(F.lit(1), place - F.col("template_place") + 1), F.size("template_words"))
            == F.col("template_words"),
        ).alias("verbatim"),
    )
    votes = hits.groupBy("_row", "template", "diagonal").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "base", "grams")],
        F.collect_set("template_place").alias("places"),
        F.bool_and("verbatim").alias("verbatim"),
    )
    whole = F.col("base") & F.col("verbatim") & (F.size("places") == F.col("grams"))
    merged = votes.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_words")],
        F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(whole, F.col("label")))).alias("_base"),
        F.collect_list(F.when(~F.col("base"), F.struct("template", "diagonal", "places"))).alias("_hits"),
    )
    known = {}
    for i, (words, label, *required) in enumerate(notices, len(phrases)):
        words, runs = words.split(), []
        for own in (r.split() for r in required):
            runs.append([(p, p + len(own)) for p in range(len(words)) if words[p : p + len(own)] == own])
            if not runs[-1]:
                raise ValueError(f"a notice does not hold its required words {' '.join(own)!r}")
        known[i] = (label, len(words) - k + 1, runs)
    judge = _judge(known, k, near, least_share)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = [], []
            for base, found in zip(batch.column("_base").to_pylist(), batch.column("_hits").to_pylist()):
                own, score = judge(found)
                labels.append(",".join(sorted({*base, *own})))
                scores.append(1.0 if base else score)
            kept = [batch.column(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
            bases = [",".join(base) for base in batch.column("_base").to_pylist()]
            columns = [*kept, pa.array(bases, pa.string()), pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return merged.drop("_row").mapInArrow(
        verify,
        f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, n_base bigint, first_word bigint, "
        "last_word bigint, base_labels string, labels string, score double",
    )
