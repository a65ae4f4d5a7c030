"""Best-fit packing of token sequences by minimum bin slack.

Per bin, a subset-sum dynamic programme over the lengths still available, held as a bitset, finds
the fullest combination around the longest piece that is left; that combination is removed. Pieces
of one length are interchangeable, so it is removed as many times as the counts allow. There are at
most ``capacity`` lengths, so the plan and the number of steps have a bound that does not depend on
the number of documents; only counts by length reach the driver. Pieces are numbered within their
length in buckets on the executors, and a number decides sequence and offset.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import parts_for, text_or_empty, written



def fullest(counts: np.ndarray, longest: int, capacity: int) -> dict[int, int]:
    """The fullest combination that contains one piece of ``longest``: count by length.

    ``counts[n]`` pieces of length n are available. Longer lengths are tried first, and the search
    ends as soon as the bin can be filled completely, so short pieces are kept for later bins.
    """
    room = capacity - longest
    reach, steps = 1, []
    goal = 1 << room
    for length in np.nonzero(counts[: min(room, longest) + 1])[0][::-1].tolist():
        spare = int(counts[length]) - (length == longest)
        spare = min(spare, room // length)
        step = 1
        while spare > 0 and not reach & goal:
            step = min(step, spare)
            steps.append((length, step, reach))
            reach |= (reach << (length * step)) & ((goal << 1) - 1)
            spare -= step
            step *= 2
        if reach & goal:
            break
    left, chosen = reach.bit_length() - 1, {longest: 1}
    for length, step, before in reversed(steps):
        if not before >> left & 1:
            chosen[length] = chosen.get(length, 0) + step
            left -= length * step
    return chosen


def bin_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how many bins, pieces by length in each) until no piece is left."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        left[length] += n
    plan = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            chosen = fullest(left, longest, capacity)
            times = min(int(left[length]) // n for length, n in chosen.items())
            for length, n in chosen.items():
                left[length] -= n * times
            plan.append((times, chosen))
    return plan


def _lookup(plan: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: where runs of piece numbers begin, the first bin, pieces per bin and offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for times, chosen in plan:
        offset = 0
        for length, n in chosen.items():
            begin = used.get(length, 0)
            runs.setdefault(length, []).append((begin, first, n, offset))
            used[length] = begin + n * times
            offset += n * length
        first += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for length, r in runs.items()}


def _unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores added to those that are taken."""
    taken, free = {c.lower() for c in columns}, []
    for name in names:
        while name in taken:
            name += "_"
        free.append(name)
    return free


def pack(pieces: DataFrame, capacity: int = 2048, *, per_bucket: int = 50_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` must lie in 1..capacity.

    ``pieces`` is read several times and must give the same rows each time (a written table). Needs
    ``doc_id``, ``piece`` and ``length``; other columns are carried along, equal rows are packed
    separately, and an empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    sizes = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lookup = _lookup(bin_plan(sizes, capacity))
    buckets = parts_for(sum(sizes.values()), per_bucket)
    bucket, counted, before, rank, number = _unused(
        pieces.columns, "_bucket", "_n", "_before", "_rank", "_number"
    )
    dealt = pieces.withColumn(
        bucket, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    )
    # Numbers within a length: one bucket's pieces come after those of the buckets before it.
    earlier = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", bucket)
        .agg(F.count("*").alias(counted))
        .withColumn(before, F.sum(counted).over(earlier))
        .select("length", bucket, F.coalesce(before, F.lit(0)).alias(before))
    )
    within = Window.partitionBy(bucket, "length").orderBy("doc_id", "piece")
    numbered = (
        dealt.withColumn(rank, F.row_number().over(within) - 1)
        .join(offsets, ["length", bucket])
        .withColumn(number, F.col(before) + F.col(rank))
        .drop(bucket, rank, before)
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence = np.zeros(len(frame), dtype=np.int64)
            offset = np.zeros(len(frame), dtype=np.int64)
            numbers, lengths = frame[number].to_numpy(), frame["length"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            for rows in np.split(order, np.nonzero(np.diff(lengths[order]))[0] + 1):
                if len(rows):
                    length = int(lengths[rows[0]])
                    begin, first, n, at = lookup[length]
                    run = np.searchsorted(begin, numbers[rows], side="right") - 1
                    past = numbers[rows] - begin[run]
                    sequence[rows] = first[run] + past // n[run]
                    offset[rows] = at[run] + past % n[run] * length
            yield frame.drop(columns=number).assign(sequence_id=sequence, offset=offset)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.select(*[f"`{c}`" for c in pieces.columns], number).mapInPandas(
        place, f"{kept}, sequence_id bigint, offset bigint"
    )


def added_tokens(json_path: str) -> dict[str, int]:
    """Added tokens of a vocabulary's JSON form: what stands for a token of its own, by its string."""
    with open(json_path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    for token in added:
        if token.get("single_word") or token.get("lstrip") or token.get("rstrip"):
            raise ValueError(f"added token {token['content']!r} takes its surroundings into account")
    return {token["content"]: token["id"] for token in added}


def encoder(ranks_path: str, pattern: str, special_tokens: dict[str, int] | None = None):
    """The byte-level BPE of a rank file. Its ids are those of the vocabulary's JSON form: by
    ``encode`` with ``allowed_special="all"`` if ``special_tokens`` are the form's added tokens, by
    ``encode_ordinary`` if their strings are to be ordinary text."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = dict(special_tokens or {})
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the rest."""
    if total <= capacity:
        return [(0, total)] if total else []
    first = total % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def token_pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = 2048,
    *,
    end_id: int = 0,
    keep_ids: bool = False,
    special_tokens: dict[str, int] | None = None,
) -> DataFrame:
    """Each document as token ids, closed by ``end_id``, in pieces of at most ``capacity``.

    A string of ``special_tokens`` in a text is that token, and texts are split at it. Null text is empty and so gives one piece with the closing id. ``keep_ids`` adds the ids
    themselves (``ids array<int>``); without them only lengths and checksums leave the task.
    """

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(ranks_path, pattern, special_tokens)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = np.array([*bpe.encode(text, allowed_special="all"), end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length]
                    row = (doc_id, piece, start, length, zlib.crc32(own.tobytes()))
                    rows.append(row + (own.astype(np.int32),) * keep_ids)
                if len(rows) >= 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(
        encode, schema + ", ids array<int>" * keep_ids
    )


def pack_documents(
    docs: DataFrame,
    ranks_path: str | None = None,
    pattern: str | None = None,
    capacity: int = 2048,
    *,
    keep_ids: bool = False,
    special_tokens: dict[str, int] | None = None,
) -> DataFrame:
    """All of ``docs`` as packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids). Without a path the public 50k byte-level vocabulary is used, with the added
    tokens of its JSON form."""
    if ranks_path is None or pattern is None:
        import public_tokenizers

        if ranks_path is None and special_tokens is None:
            special_tokens = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
        ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    pieces = token_pieces(
        docs, ranks_path, pattern, capacity, keep_ids=keep_ids, special_tokens=special_tokens
    )
    return pack(written(pieces, "packing-pieces"), capacity)
