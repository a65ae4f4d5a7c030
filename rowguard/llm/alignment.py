"""Links between the tokens of two tokenizers over the same texts.

A is a byte-level BPE read by ``tokenizers``, B a sentencepiece model. Both encode a space and the text.
Where tokens end is found in two steps. The spans the libraries report are coarse cuts: character
offsets by tokenizers, spans of the immutable proto by sentencepiece. A token that shares a character
with its neighbour (a byte-level token inside a multibyte character, a byte-fallback piece) is then
placed by its own decoded bytes. Byte offsets where tokens of both end cut the text into groups, and
every A token is linked to every B token of its group.

Both models end a token before a run of spaces that follows something else: A's pattern splits there,
and no piece of B has its space mark behind another character (checked when the model is read; if one
had, texts would stay whole). So texts are cut there into segments, and each different segment of a
task is encoded and aligned once.

Links are counted over documents in *portions*, some megabytes of neighbouring rows in one task. A
portion sends each id pair it holds once, with the number of its documents, and gets the corpus-wide
count of that pair back once, so nothing grows with the number of links, and no table of all pairs is
broadcast or collected.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import release_memory, text_or_empty, written

#: Characters of text in a portion; a longer text is a portion by itself.
PORTION = 2 << 20
#: Segments that a worker remembers from one portion to the next.
REMEMBERED = 300_000
#: Segments that are encoded joined, and links of a group from which on it is counted by ids.
JOINED, MANY = 2048, 4096

_MARK = "▁"


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both models, and the decoded bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        with open(a_path, encoding="utf-8") as file:
            special = {t["id"]: t["content"] for t in json.load(file).get("added_tokens") or []}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        spelt = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelt[i] = special[i].encode() if i in special else bytes(alphabet[c] for c in token)
        self.a_bytes = pa.array(spelt, pa.large_binary())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_bytes = pa.array(
            [bytes([int(p[3:5], 16)]) if byte else p.replace(_MARK, " ").encode()
             for p, byte in zip(pieces, self.b_byte)],
            pa.large_binary(),
        )
        self.whole = any(_MARK in p.lstrip(_MARK) for p in pieces)
        # Spans are in bytes in newer versions, in characters in older ones.
        self.b_in_bytes = self._proto(["é"])[0].pieces[-1].end == 2

    def _proto(self, texts: list[str]) -> list:
        try:
            return self.b.encode(texts, return_type="proto", num_threads=1)
        except TypeError:
            return self.b.encode(texts, out_type="immutable_proto", num_threads=1)

    def segments(self, text: str) -> list[str]:
        """Space and text, cut where tokens of both models end."""
        raw = np.frombuffer((" " + text).encode(), dtype=np.uint8)
        cuts = [*_cuts(raw, np.array([0])), len(raw)] if not self.whole else [0, len(raw)]
        return [raw[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])]

    def a_tokens(self, texts: list[str]) -> "Tokens":
        """A's tokens of texts that begin with a space."""
        found = self.a.encode_batch(texts, add_special_tokens=False)
        ids = [x.ids for x in found]
        offsets = chain.from_iterable(chain.from_iterable(x.offsets for x in found))
        spans = np.fromiter(offsets, dtype=np.int64).reshape(-1, 2)
        return _placed(texts, ids, spans, self.a_bytes, False)

    def b_tokens(self, texts: list[str]) -> "Tokens":
        """B's tokens of texts that begin with a space, which B adds itself."""
        found = [x.pieces for x in self._proto([t[1:] for t in texts])]
        ids = [[p.id for p in pieces] for pieces in found]
        ends = np.array([p.end for pieces in found for p in pieces], dtype=np.int64) + 1
        # Pieces follow each other, so a span begins where the one before it ends.
        spans = np.stack([np.append(0, ends[:-1])[: len(ends)], ends], axis=1)
        return _placed(texts, ids, spans, self.b_bytes, self.b_in_bytes, self.b_byte)


class Tokens(NamedTuple):
    """Tokens of several texts one after the other, and where in the bytes of all texts they end.

    ``sound`` says of each text whether its tokens spell it; of others the ends mean nothing."""

    ids: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray
    sound: np.ndarray


def _cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where segments begin in the bytes of texts that begin at ``starts``: there, and at each run of
    spaces that neither follows white space nor ends its text."""
    space = raw == 32
    run = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    run = run[~_among(run, starts)]
    after = np.append(np.flatnonzero(~space[1:] & space[:-1]) + 1, len(raw))
    ends = np.append(starts[1:], len(raw))
    next_other = after[np.searchsorted(after, run)]
    inside = next_other < ends[np.searchsorted(starts, run, side="right") - 1]
    one, two, three = (raw[np.maximum(run - k, 0)].astype(np.int64) for k in (1, 2, 3))
    # White space: ASCII controls, U+0085, U+00A0, U+1680, U+205F, U+3000, and what begins as U+20xx.
    white = ((one >= 9) & (one <= 13)) | ((one >= 28) & (one <= 31))
    white |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    last = three << 16 | two << 8 | one
    white |= np.isin(last, [0xE19A80, 0xE2819F, 0xE38080]) | (last >> 8 == 0xE280)
    return np.sort(np.concatenate([starts, run[inside & ~white]]))  # texts begin with their own run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted known ones."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _placed(texts, ids, spans, decoded: pa.Array, in_bytes: bool, single: np.ndarray | None = None) -> Tokens:
    """Byte ends of tokens: those of their spans, and by decoded bytes for tokens that share a
    character with a neighbour or are single bytes."""
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(sizes.sum()))
    raw = [t.encode() for t in texts]
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    spelt = decoded.take(pa.array(flat))
    at = np.frombuffer(spelt.buffers()[1], dtype=np.int64)[: len(flat) + 1]
    own = at[np.concatenate(([0], np.cumsum(sizes)))]
    written_out = (spelt.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[: int(at[-1])]
    joined = b"".join(raw)
    if written_out == joined and np.array_equal(np.diff(own), lengths):
        sound = np.ones(len(texts), dtype=bool)
    else:
        sound = np.array([written_out[a:b] == r for a, b, r in zip(own, own[1:], raw)], dtype=bool)
    text = np.repeat(np.arange(len(texts)), sizes)
    begin, end = spans[:, 0], spans[:, 1]
    neighbour = text[1:] == text[:-1]
    shared = np.zeros(len(flat), dtype=bool)
    overlap = neighbour & (begin[1:] < end[:-1])
    shared[:-1] |= overlap
    shared[1:] |= overlap
    if single is not None:
        shared |= single[flat]
    if in_bytes:
        coarse = end + starts[text]
    else:
        chars = np.array([len(t) for t in texts], dtype=np.int64)
        places = _places("".join(texts))
        coarse = places[np.minimum(end + (np.cumsum(chars) - chars)[text], len(places) - 1)]
    # A shared token ends its own bytes behind the last token that is not, or behind its text's start.
    by_bytes = at[1:] - own[:-1][text] + starts[text]
    number = np.arange(len(flat))
    last = np.maximum.accumulate(np.where(shared, -1, number))
    first = (np.cumsum(sizes) - sizes)[text]
    known = last >= first
    last = np.where(known, last, 0)
    moved = np.where(known, coarse[last] - by_bytes[last], 0) if len(flat) else coarse
    return Tokens(flat, np.where(shared, by_bytes + moved, coarse), sizes, sound)


def _places(text: str) -> np.ndarray:
    """The byte offset of each character, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate(([0], np.cumsum(sizes)))


def _spots(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for each run, one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Grouped(NamedTuple):
    """Per segment: figures (n_a, n_b, n_groups, n_links, sound), the groups in writing, each closed by
    a semicolon, and its different id pairs with their number of links."""

    figures: np.ndarray
    writing: pa.Array
    pairs: np.ndarray
    times: np.ndarray
    sizes: np.ndarray


class Linker:
    """Aligns segments. Ids in writing are taken from one list, with what may follow them."""

    def __init__(self, models: Tokenizers) -> None:
        self.models = models
        self.n_a, self.n_b = len(models.a_bytes), len(models.b_bytes)
        self.signs = pa.array(
            [f"{i}{sign}" for n, signs in ((self.n_a, ",|"), (self.n_b, ",;")) for sign in signs for i in range(n)],
            pa.large_string(),
        )

    def align(self, segments: list[str]) -> Grouped:
        """Segments are encoded joined, as they stand in texts; those that end in white space or are
        not spelt by their tokens one by one."""
        alone = [s[-1].isspace() for s in segments]
        parts: list[Grouped] = []
        order = []
        for one_by_one in (False, True):
            numbers = [i for i, x in enumerate(alone) if x == one_by_one]
            for step in range(0, len(numbers), JOINED):
                some = numbers[step : step + JOINED]
                found = self._some([segments[i] for i in some], one_by_one)
                if found is None:
                    for i in some:
                        alone[i] = True
                else:
                    parts.append(found)
                    order.extend(some)
        back = np.argsort(order)
        if not parts:
            return self._grouped(np.zeros(0, np.int64), None, None, np.zeros(0, bool))
        sizes = np.concatenate([x.sizes for x in parts])
        spot = _spots((np.cumsum(sizes) - sizes)[back], sizes[back])
        return Grouped(
            np.concatenate([x.figures for x in parts])[back],
            pa.concat_arrays([x.writing for x in parts]).take(pa.array(back)),
            np.concatenate([x.pairs for x in parts])[spot],
            np.concatenate([x.times for x in parts])[spot],
            sizes[back],
        )

    def _some(self, segments: list[str], one_by_one: bool) -> Grouped | None:
        texts = segments if one_by_one else ["".join(segments)]
        a, b = self.models.a_tokens(texts), self.models.b_tokens(texts)
        sound = a.sound & b.sound
        ends = np.cumsum([len(s.encode()) for s in segments])
        if not one_by_one:
            if not sound[0] or not (_among(ends, a.ends).all() and _among(ends, b.ends).all()):
                return None
            sound = np.ones(len(segments), dtype=bool)
        keep_a, keep_b = (np.repeat(sound if one_by_one else sound[:1], x.sizes) for x in (a, b))
        return self._grouped(ends, (a.ids[keep_a], a.ends[keep_a]), (b.ids[keep_b], b.ends[keep_b]), sound)

    def _grouped(self, ends: np.ndarray, a, b, sound: np.ndarray) -> Grouped:
        if a is None:
            empty = np.zeros(0, np.int64)
            return Grouped(np.zeros((0, 5), np.int64), pa.array([], pa.large_string()), empty, empty, empty)
        (a_ids, a_ends), (b_ids, b_ends) = a, b
        common = a_ends[_among(a_ends, b_ends)]
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        groups, segments = len(common), len(ends)
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        segment = np.searchsorted(ends, common)
        figures = np.zeros((segments, 5), dtype=np.int64)
        for column, weight in enumerate((in_a, in_b, np.ones(groups, np.int64), in_a * in_b)):
            figures[:, column] = np.bincount(segment, weights=weight, minlength=segments)
        figures[:, 4] = sound

        last_a = np.append(a_group[1:] != a_group[:-1], True) if len(a_ids) else np.zeros(0, bool)
        last_b = np.append(b_group[1:] != b_group[:-1], True) if len(b_ids) else np.zeros(0, bool)
        code_a = a_ids + self.n_a * last_a
        code_b = 2 * self.n_a + b_ids + self.n_b * last_b
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        sequence = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        sequence[np.arange(len(a_ids)) + first_b[a_group]] = code_a
        sequence[np.arange(len(b_ids)) + (first_a + in_a)[b_group]] = code_b
        signs = self.signs.take(pa.array(sequence))
        at = np.frombuffer(signs.buffers()[1], dtype=np.int64)[: len(sequence) + 1]
        tokens = figures[:, 0] + figures[:, 1]
        offsets = at[np.concatenate(([0], np.cumsum(tokens)))]
        data = signs.buffers()[2] or pa.py_buffer(b"")
        writing = pa.LargeStringArray.from_buffers(segments, pa.py_buffer(np.ascontiguousarray(offsets)), data)

        # Pairs of a group, by tokens; a group with very many by its different ids.
        many = in_a * in_b > MANY
        times_b = np.where(many[a_group], 0, in_b[a_group])
        left = np.repeat(a_ids, times_b)
        right = b_ids[_spots(first_b[a_group], times_b)]
        of = np.repeat(segment[a_group], times_b)
        key, weight = left << 24 | right, np.ones(len(left), np.int64)
        for g in np.flatnonzero(many):
            x, m = np.unique(a_ids[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            y, n = np.unique(b_ids[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            key = np.append(key, (x[:, None] << 24 | y[None, :]).ravel())
            weight = np.append(weight, (m[:, None] * n[None, :]).ravel())
            of = np.append(of, np.full(len(x) * len(y), segment[g]))
        of, key, weight = _counted(of, key, weight)
        return Grouped(figures, writing, key, weight, np.bincount(of, minlength=segments))


def _counted(of: np.ndarray, key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different (of, key), in that order, with their total weight."""
    bits = int(key.max(initial=0)).bit_length()
    if bits + int(of.max(initial=0)).bit_length() < 64:
        order = np.argsort(of << bits | key)
    else:
        order = np.lexsort((key, of))
    of, key = of[order], key[order]
    new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (key[1:] != key[:-1])))[: len(of)])
    total = np.add.reduceat(weight[order], new) if len(new) else weight
    return of[new], key[new], total


class _Known:
    """What is known of segments met so far. Beyond ``REMEMBERED`` those met in one portion only go."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.models = Tokenizers(a_path, b_path)
        self.linker = Linker(self.models)
        self.number: dict[str, int] = {}
        self.met = np.zeros(0, dtype=np.int64)
        self.all = self.linker.align([])

    def numbers(self, segments: list[str]) -> np.ndarray:
        """The numbers of different segments of a portion, new ones included."""
        if len(self.number) > REMEMBERED:
            self._forget()
        new = [s for s in segments if s not in self.number]
        if new:
            found = self.linker.align(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.all = Grouped(*(
                pa.concat_arrays(x) if isinstance(x[0], pa.Array) else np.concatenate(x)
                for x in zip(self.all, found)
            ))
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        numbers = np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments))
        self.met[numbers] += 1
        return numbers

    def _forget(self) -> None:
        kept = np.flatnonzero(self.met > 1) if (self.met > 1).sum() <= REMEMBERED // 2 else np.zeros(0, np.int64)
        names = np.array(list(self.number), dtype=object)[kept].tolist()
        sizes, whole = self.all.sizes, self.all
        spot = _spots((np.cumsum(sizes) - sizes)[kept], sizes[kept])
        self.all = Grouped(whole.figures[kept], whole.writing.take(pa.array(kept)), whole.pairs[spot],
                           whole.times[spot], sizes[kept])
        self.number, self.met = {s: i for i, s in enumerate(names)}, self.met[kept]


_WORKER: dict[tuple[str, str], _Known] = {}


def _known(a_path: str, b_path: str) -> _Known:
    """Kept from task to task of a worker."""
    if (a_path, b_path) not in _WORKER:
        _WORKER[a_path, b_path] = _Known(a_path, b_path)
    return _WORKER[a_path, b_path]


_ROW = (
    "portion string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, groups string, keys array<bigint>, times array<bigint>"
)


def _arrow_schema(with_groups: bool) -> pa.Schema:
    longs = pa.list_(pa.int64())
    fields = [("portion", pa.string()), ("doc_id", pa.int64())]
    fields += [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    fields += [("groups_sha256", pa.string())] + [("groups", pa.string())] * with_groups
    return pa.schema(fields + [("keys", longs), ("times", longs)])


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, *, with_groups: bool = False) -> DataFrame:
    """Per document its token and link counts, its groups (in writing if ``with_groups``, else their
    SHA-256 only), and its different id pairs (``keys``: A id times 2^24 plus B id) with the number of
    links of each; and per ``portion`` a row without groups_sha256 whose ``times`` say how many of its
    documents hold the pair.
    """
    schema = _arrow_schema(with_groups)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(a_path, b_path)
        task = TaskContext.get()
        for number, (ids, texts) in enumerate(_portions(batches)):
            portion = f"{task.partitionId() if task else 0}-{number}"
            yield pa.RecordBatch.from_pydict(_aligned(known, portion, ids, texts, with_groups), schema=schema)
            release_memory()

    kept = ", ".join(f for f in _ROW.split(", ") if with_groups or f != "groups string")
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(align, kept)


def _aligned(known: _Known, portion: str, ids: list, texts: list[str], with_groups: bool) -> dict:
    """The columns of a portion: a row for each text, and one for the portion."""
    filled = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
    raw = [b" " + texts[i].encode() for i in filled]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    data = b"".join(raw)
    cuts = starts if known.models.whole else _cuts(np.frombuffer(data, dtype=np.uint8), starts)
    offsets = pa.py_buffer(np.append(cuts, len(data)))
    segments = pa.LargeStringArray.from_buffers(len(cuts), offsets, pa.py_buffer(data)).dictionary_encode()
    numbers = known.numbers(segments.dictionary.to_pylist())[segments.indices.to_numpy()]
    text = np.searchsorted(starts, cuts, side="right") - 1
    first = np.searchsorted(text, np.arange(len(filled) + 1))

    figures = known.all.figures[numbers]
    sound = np.ones(len(filled), dtype=bool)
    sound[text[figures[:, 4] == 0]] = False
    totals = np.zeros((len(texts), 4), dtype=np.int64)
    for column in range(4):
        totals[filled, column] = np.bincount(text, weights=figures[:, column], minlength=len(filled))
    totals[filled[~sound]] = 0

    groups = [""] * len(texts)
    hashes = [""] * len(texts)
    for i in np.flatnonzero(sound):
        part = known.all.writing.take(pa.array(numbers[first[i] : first[i + 1]]))
        at = np.frombuffer(part.buffers()[1], dtype=np.int64)[: len(part) + 1]
        written_out = memoryview(part.buffers()[2])[: int(at[-1]) - 1]  # no semicolon at the end
        hashes[filled[i]] = hashlib.sha256(written_out).hexdigest()
        if with_groups:
            groups[filled[i]] = bytes(written_out).decode()

    begin = np.cumsum(known.all.sizes) - known.all.sizes
    used = numbers[sound[text]]
    many = known.all.sizes[used]
    spot = _spots(begin[used], many)
    of, keys, times = _counted(
        np.repeat(filled[text[sound[text]]], many), known.all.pairs[spot], known.all.times[spot]
    )
    at = np.searchsorted(of, np.arange(len(texts) + 1))
    _, all_keys, holding = _counted(np.zeros(len(keys), np.int64), keys, np.ones(len(keys), np.int64))

    def lists(values: np.ndarray, last: np.ndarray) -> pa.Array:
        ends = pa.array(np.append(at, len(values) + len(last)), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([values, last]), pa.int64()))

    columns = {"portion": [portion] * (len(texts) + 1), "doc_id": [*ids, None]}
    for column, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
        columns[name] = [*totals[:, column].tolist(), None]
    columns |= {"groups_sha256": [*hashes, None], "groups": [*groups, None]}
    return columns | {"keys": lists(keys, all_keys), "times": lists(times, holding)}


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= PORTION:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``key``, ``n`` (documents that hold the pair) and ``best`` (no pair of the A id has more)."""
    held = aligned.filter("groups_sha256 IS NULL").select(F.explode(F.arrays_zip("keys", "times")).alias("x"))
    counted = held.groupBy(F.col("x.keys").alias("key")).agg(F.sum("x.times").alias("n"))
    first = Window.partitionBy(F.shiftright("key", 24))
    return counted.withColumn("best", F.col("n") == F.max("n").over(first))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, *, with_groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups).

    ``n_best`` counts the links whose id pair is in as many documents as any pair of its A id,
    ``count_sum`` adds up the documents of all links' pairs. Every row is a document, repeated rows and
    rows with equal or null ids too. Null and empty texts, and those whose tokens do not spell space and
    text in both models, have no tokens: zeros and an empty string. Other columns are not read.
    """
    aligned = written(aligned_documents(docs, a_path, b_path, with_groups=with_groups), "alignment-rows")
    counts = written(pair_counts(aligned), "alignment-pairs")
    asked = aligned.filter("groups_sha256 IS NULL").select(
        F.col("portion").alias("asking"), F.explode("keys").alias("key")
    )
    answers = asked.join(counts, "key").select("asking", "key", "n", "best")
    rows = aligned.filter("groups_sha256 IS NOT NULL")
    out = [f for f in _arrow_schema(with_groups) if f.name not in ("portion", "keys", "times")]
    schema = pa.schema([*out, ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def total(documents: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column("key").to_numpy()
        order = np.argsort(keys)
        keys = keys[order]
        n = known.column("n").to_numpy()[order]
        best = known.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        n_best, count_sum = [], []
        for own, times in zip(documents.column("keys"), documents.column("times")):
            own, times = own.values.to_numpy(), times.values.to_numpy()
            spot = np.searchsorted(keys, own)
            n_best.append(int((best[spot] * times).sum()))
            count_sum.append(int((n[spot] * times).sum()))
        kept = documents.select([f.name for f in out])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64())
        ).cast(schema)

    kinds = ", ".join(f"{f.name} {'string' if pa.types.is_string(f.type) else 'bigint'}" for f in schema)
    return (
        rows.groupBy("portion")
        .cogroup(answers.groupBy("asking"))
        .applyInArrow(total, kinds)
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
                *["groups"] * with_groups)
    )
