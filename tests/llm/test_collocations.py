"""Collocations against a plain count in Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from rowguard.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, least, percent=80, top=2000):
    """The contract, by lists."""
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, _, left, right = min(
                (2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def found(spark, rows, **kw):
    return sorted(tuple(r) for r in C.collocations(spark.createDataFrame(rows, SCHEMA), **kw).collect())


def random_rows(seed, docs, words, vocabulary):
    rng = random.Random(seed)
    known = [rng.choice(["a", "Bb", "É", "漢字", "x y", "0", "q\x00"]) + str(i) for i in range(vocabulary)]
    passage = [rng.choice(known) for _ in range(150)]
    rows = []
    for i in range(docs):
        own = [rng.choice(known) for _ in range(rng.randrange(words))]
        at = rng.randrange(len(own) + 1)
        own[at:at] = passage[rng.randrange(60) :] if rng.random() < 0.5 else []
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t ", ". ", ",", "\n", "\x0b"]) for w in own)
        rows.append((i, text, rng.choice(["en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_count(spark, seed):
    rows = random_rows(seed, 120, 60, 25)
    rows += [(1, None, "en"), (1, "", None), (None, " \t", "de"), rows[0], rows[0], rows[3]]
    rows.append((5, "same " * 500 + "end", "en"))  # longer than any chunk, and one word over and over
    rows.append((6, " ".join(f"w{i % 7}" for i in range(300)), "en"))  # no end of a piece
    assert found(spark, rows, least=3, top=40) == plain(rows, 3, top=40)
    assert found(spark, rows, least=30) == plain(rows, 30)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = random_rows(3, 60, 400, 12)
    monkeypatch.setattr(C, "FILTER_LOG2", 6)
    assert found(spark, rows, least=5) == plain(rows, 5)


def test_portions_and_short_chunks_change_no_count(monkeypatch):
    """In this process, as constants of workers are not patched."""
    rows = random_rows(6, 40, 300, 12)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(rows), "text": [t for _, t, _ in rows]})
    counts = []
    for portion, most in ((C.PORTION, C.MOST_WORDS), (300, 5), (1, 1)):
        monkeypatch.setattr(C, "PORTION", portion)
        monkeypatch.setattr(C, "MOST_WORDS", most)
        chunks = pa.Table.from_batches(list(C._chunk_rows(iter([batch]))))
        found = [C._phrases(chunks, size, None).to_pydict() for size in (1, 2, 3, 4)]
        counts.append([dict(zip(x["phrase"], x["n"])) for x in found])
    assert counts[0] == counts[1] == counts[2] and len(counts[0][3]) > 100


def test_chunks_own_every_place_once(spark):
    rows = random_rows(4, 30, 300, 40)
    chunks = C.chunk_dictionary(spark.createDataFrame(rows, SCHEMA)).collect()
    owned = Counter()
    for row in chunks:
        words = row["chunk"].split(" ")
        assert 0 < row["own"] <= len(words) <= row["own"] + C.OVERLAP
        for i in range(row["own"]):
            owned[tuple(words[i : i + C.LONGEST])] += row["n"]
    direct = Counter()
    for _, text, _ in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text.lower().replace("É".lower(), "É")):
            words = re.findall(r"[^ \t]+", piece)
            direct.update(tuple(words[i : i + C.LONGEST]) for i in range(len(words)))
    assert owned == direct


def test_empty_tables_and_other_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, None), (2, " .,\n", "en")]) == []
    rows = random_rows(5, 40, 80, 6)
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("n", "own", "chunk", "phrase", "a", "rank", "score", "size", "Lang2"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    assert sorted(tuple(r) for r in C.collocations(docs, least=4).collect()) == plain(rows, 4)


def test_scores_do_not_overflow(spark):
    """Counts whose product with 2,000,000 passes 64 bits."""
    big = 3 * 10**17
    score = spark.range(1).selectExpr(f"{big} AS a", f"{big} AS l", f"{big + 7} AS r")
    assert score.select(C.score_of("a", "l", "r").alias("s")).first()["s"] == 2000000 * big // (2 * big + 7)
