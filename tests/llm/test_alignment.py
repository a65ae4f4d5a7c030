"""Token alignment against whole texts encoded at once and aligned by a plain loop."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rowguard.llm import alignment

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, portion string, keys string, n_a int, key int"

TEXTS = [
    "The quick brown fox isn't lazy.\n\nIt's 12,345 km away!  Two  spaces",
    "naïve café – “quoted” … Ünïcödé straße",
    "漢字かな交じり文 と 한국어 텍스트, עברית العربية",
    "emoji 😀😀🏳️‍🌈 family 👨‍👩‍👧‍👦 and \U0001f9ff\U0002a6d6",
    " leading and trailing \t tabs\t\n ",
    "   ",
    "many    spaces     in      the middle",
    "     spaces first and last    ",
    "\n",
    "a",
    "<|endoftext|> and <s> </s> <unk> <0x41> are plain ▁ text▁here",
    "x" * 5000 + " " + "ab" * 300,
    "zero\x00byte \x01 control ​ ﻿  nbsp　wide \x85 next",
    "é combining ̈ alone  ́",
    "in einem langen Dokument " * 400,
    "import os\n    def f(x):\n        return x ** 2  # done\r\n",
]


def decoder(tokenizer):
    known = {c: b for c, b in alignment._byte_alphabet().items()}
    return {i: bytes(known[c] for c in t) for t, i in tokenizer.get_vocab(with_added_tokens=False).items()
            if all(c in known for c in t)}


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), decoder(a)


def ends(raw):
    total, result = 0, []
    for piece in raw:
        total += len(piece)
        result.append(total)
    return result


def plain_groups(models, text):
    """Groups of (A ids, B ids) of a text, or None where it has no tokens."""
    a, b, a_bytes = models
    if not text:
        return None
    whole = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [a_bytes[i] for i in ids_a]
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
             else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
        return None
    common = sorted(set(ends(raw_a)) & set(ends(raw_b)))
    groups = [([], []) for _ in common]
    for side, (ids, raw) in enumerate(((ids_a, raw_a), (ids_b, raw_b))):
        for i, end in zip(ids, ends(raw)):
            groups[next(k for k, c in enumerate(common) if c >= end)][side].append(i)
    return groups


def plain(models, rows):
    grouped = [(doc_id, plain_groups(models, text)) for doc_id, text in rows]
    links = [Counter((x, y) for left, right in g or [] for x in left for y in right) for _, g in grouped]
    count = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    result = []
    for (doc_id, g), own in zip(grouped, links):
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g or [])
        result.append((
            doc_id, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []),
            sum(own.values()), sum(n for p, n in own.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(written.encode()).hexdigest() if g else "",
        ))
    return sorted(result, key=repr)


def found(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, "en", "x", "y", 1, 2) for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in alignment.align_tokens(docs, A_PATH, B_PATH, **kw).collect()), key=repr)


def test_equals_whole_texts_aligned_plainly(spark, models):
    rows = [*enumerate(TEXTS), (None, None), (30, ""), (None, TEXTS[0]), (2, TEXTS[2]), (2, TEXTS[2])]
    expected = plain(models, rows)
    assert found(spark, rows) == expected
    assert sum(r[1] > 0 for r in expected) >= len(TEXTS)


def test_portions_do_not_change_the_counts(spark, models, monkeypatch):
    """In this process, as constants of workers are not patched."""
    for name, value in (("REMEMBERED", 10), ("JOINED", 5), ("MANY", 2)):
        monkeypatch.setattr(alignment, name, value)
    known = alignment._Known(A_PATH, B_PATH)
    texts = [t for t in [*TEXTS, "", *TEXTS] if len(t) < 4000]
    rows = list(enumerate(texts))
    expected = plain(models, rows)
    for begin in range(0, len(texts), 3):
        part = rows[begin : begin + 3]
        got = alignment._aligned(known, "p", [i for i, _ in part], [t for _, t in part], False)
        for at, (i, _) in enumerate(part):
            want = next(r for r in expected if r[0] == i)
            names = ("n_a", "n_b", "n_groups", "n_links")
            assert tuple(got[n][at] for n in names) == want[1:5] and got["groups_sha256"][at] == want[7]
            assert sum(got["times"][at].as_py()) == want[4]
        held = Counter(k for keys in got["keys"].to_pylist()[:-1] for k in keys)
        assert dict(zip(got["keys"][len(part)].as_py(), got["times"][len(part)].as_py())) == held


def test_given_documents(spark, models):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    result = alignment.align_tokens(docs, A_PATH, B_PATH).collect()
    assert sorted((tuple(r) for r in result), key=repr) == plain(models, rows)


def test_groups_in_writing_and_an_empty_table(spark, models):
    assert found(spark, []) == []
    (row,) = found(spark, [(1, "é漢😀")], with_groups=True)
    expected = plain_groups(models, "é漢😀")
    assert row[-1] == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in expected)


def test_many_links_in_one_group_cost_its_different_ids_only():
    n = 20_000
    linker = alignment.Linker(alignment.Tokenizers(A_PATH, B_PATH))
    a = (np.full(n, 7), np.append(np.arange(n - 1) * 2 + 2, 2 * n + 1))
    b = (np.full(n + 1, 9), np.arange(n + 1) * 2 + 1)
    found = linker._grouped(np.array([2 * n + 1]), a, b, np.array([True]))
    assert found.figures.tolist() == [[n, n + 1, 1, n * (n + 1), 1]]
    assert found.pairs.tolist() == [7 << 24 | 9] and found.times.tolist() == [n * (n + 1)]
    assert found.writing[0].as_py() == ",".join(["7"] * n) + "|" + ",".join(["9"] * (n + 1)) + ";"


def test_spans_are_cuts_where_characters_are_whole():
    """Ends by spans and by decoded bytes agree on every text."""
    models = alignment.Tokenizers(A_PATH, B_PATH)
    for text in TEXTS:
        for segment in models.segments(text):
            for found, decoded in ((models.a_tokens([segment]), models.a_bytes),
                                   (models.b_tokens([segment]), models.b_bytes)):
                raw = [decoded[int(i)].as_py() for i in found.ids]
                assert found.sound.tolist() == [b"".join(raw) == segment.encode()]
                assert not found.sound[0] or found.ends.tolist() == ends(raw)


def test_texts_are_cut_at_runs_of_spaces_behind_other_characters():
    models = alignment.Tokenizers(A_PATH, B_PATH)
    assert models.segments("a  b\n c d\u3000 e\u00a0 f\u2003 g é h  ") == [
        " a", "  b\n c", " d\u3000 e\u00a0 f\u2003 g", " é", " h  "
    ]
