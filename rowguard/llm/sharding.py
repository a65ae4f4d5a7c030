"""Uniform shuffle into shards of exact size with a hypergeometric communication matrix.

Rows fall into cells by a hash of their key. How many rows each cell sends to each slice of a shard
is drawn exactly as a uniform permutation of all rows would have it (a multivariate hypergeometric
draw per cell, the slice sizes being fixed). Each cell then permutes its rows and deals them out by
those counts; each slice permutes what it received. Every arrangement is equally likely up to the
quality of the hash. The hash includes the place of the row in its table, so rows that are equal in
everything spread over the cells as well; the numbered rows are written before they are counted, so a
task that runs again sees the same places. No task orders a whole shard.

The matrix holds counts only. It has at most ``max_cells`` squared entries, whatever the input; beyond
some 8 million rows cells grow with the rows (a 2048th of them each), which a task sorts and may spill.
"""

from __future__ import annotations

import math
import random
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import parts_for, text_or_empty, written


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items taken from ``good + bad`` are good. Exact inversion outwards from
    the mode, with a number of steps near the standard deviation, for any size."""
    least, most = max(0, drawn - bad), min(good, drawn)
    if least == most:
        return least
    mode = min(most, max(least, (drawn + 1) * (good + 1) // (good + bad + 2)))

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(choose(good, mode) + choose(bad, drawn - mode) - choose(good + bad, drawn))
    left = rng.random() - at_mode
    up = down = mode
    p_up = p_down = at_mode
    while left > 0 and (up < most or down > least):
        if up < most:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > least:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def communication_matrix(cells: list[int], slices: list[int], seed: int) -> list[list[int]]:
    """``[cell][slice]`` counts with the given row and column sums, drawn as a uniform permutation
    of all rows would deal them."""
    rng, free, matrix = random.Random(seed), list(slices), []
    for rows in cells:
        rest, counts = sum(free), []
        for i, room in enumerate(free):
            rest -= room
            taken = hypergeometric(rng, room, rest, rows) if rows else 0
            counts.append(taken)
            rows -= taken
            free[i] -= taken
        matrix.append(counts)
    return matrix


def even_sizes(total: int, parts: int) -> list[int]:
    """``parts`` sizes that sum to ``total`` and differ by one at most."""
    return [total * (i + 1) // parts - total * i // parts for i in range(parts)]


def uniform_shards(
    rows: DataFrame,
    keys: list[str],
    shards: int = 16,
    *,
    seed: int = 17,
    rows_per_slice: int = 4096,
    max_cells: int = 2048,
) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``keys`` and the place of a row in the table tell rows apart, so keys may repeat or be null; the
    same seed gives the same arrangement as long as the table's files are read in the same parts.
    Shard sizes differ by one at most. An empty table gives no rows. Columns called ``shard`` or
    ``slot`` are replaced, any others are carried along.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    # Nothing can clash: whatever the table calls its columns is kept in one struct.
    keyed = F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys], F.monotonically_increasing_id())
    held = written(rows.select(F.struct("*").alias("_row"), keyed.alias("_h")), "sharding-rows")
    total = held.count()
    per_shard = min(max(1, max_cells // shards), parts_for(parts_for(total, shards), rows_per_slice))
    n_cells = min(max_cells, per_shard * shards)
    placed = held.select("_row", "_h", F.pmod(F.col("_h"), F.lit(n_cells)).cast("int").alias("_cell"))
    found = {r["_cell"]: r["count"] for r in placed.groupBy("_cell").count().collect()}
    shard_sizes = even_sizes(total, shards)
    slice_sizes = [n for size in shard_sizes for n in even_sizes(size, per_shard)]
    matrix = communication_matrix([found.get(c, 0) for c in range(n_cells)], slice_sizes, seed)
    starts = [
        start for size in shard_sizes for start in [0, *accumulate(even_sizes(size, per_shard))][:-1]
    ]
    bounds = spark.createDataFrame(
        [(c, list(accumulate(counts))) for c, counts in enumerate(matrix)],
        "_cell int, _ends array<bigint>",
    )
    layout = spark.createDataFrame(
        [(i, i // per_shard, start) for i, start in enumerate(starts)],
        "_slice int, shard int, _start bigint",
    )
    first = Window.partitionBy("_cell").orderBy(F.xxhash64(F.lit(seed + 1), "_h"), "_h", "_row")
    second = Window.partitionBy("_slice").orderBy(F.xxhash64(F.lit(seed + 2), "_h"), "_h", "_row")
    dealt = (
        placed.withColumn("_n", F.row_number().over(first))
        .join(F.broadcast(bounds), "_cell")
        .withColumn("_slice", F.size(F.filter("_ends", lambda end: end < F.col("_n"))))
        .select("_row", "_h", "_slice")
    )
    return (
        dealt.withColumn("_n", F.row_number().over(second) - 1)
        .join(F.broadcast(layout), "_slice")
        .select("_row.*", "shard", (F.col("_start") + F.col("_n")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = 16, *, seed: int = 17) -> DataFrame:
    """Documents dealt into ``shards`` under the law ``rows``: counts differ by one at most.

    Per document: ``doc_id``, ``size`` (bytes of the text plus 1), ``text_crc32``, ``law``,
    ``shard``, ``slot``, ``grown_shard`` (null, as rows are dealt anew for another shard count).
    Null text counts as none. Equal texts are rows of their own; repeated rows each get a place. An
    empty table gives no rows; other columns are not read.
    """
    text = text_or_empty().cast("binary")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return uniform_shards(narrow, ["doc_id", "text_crc32", "size"], shards, seed=seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
