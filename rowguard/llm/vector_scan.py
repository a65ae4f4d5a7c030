"""Approximate nearest neighbours by largest inner product: lists of vectors, scanned by columns.

Vectors are dealt into lists around centroids and, in a list, into blocks of bounded size. A query goes
to the blocks of the lists whose centroids have the largest inner products with it. There, vectors
are rotated at random and scanned in blocks of columns: after each block of columns the partial inner
product estimates the whole one, and a candidate is abandoned once the hypothesis that it reaches the
query's threshold is rejected. What is left after the last column is scored on the original vectors.
A block of columns is scanned for ``BATCH`` queries at once, by one matrix product while many candidates
are left, then pair by pair.

For a candidate of inner product s, the first d of D rotated coordinates have the partial inner product
s d / D on average, with a variance of (|q|^2 |x|^2 + s^2) d (D - d) / (D (D - 1) (D + 2));
``DEVIATIONS`` standard deviations below the value for the threshold it is abandoned. The threshold of
a query starts as its k-th best inner product among ``SEEDS`` vectors, which are scored for every
query, and rises with what the query finds in a block: the final one cannot be lower.

The index is fitted on ``SAMPLE_ROWS`` vectors, fewer if they would take more than ``SAMPLE_BYTES``;
all vectors are indexed. How many lists a query goes to is measured: on ``TRIALS`` queries, compared
with all vectors, the least number that reaches ``reach`` of their true neighbours. On vectors without
structure this is about half of the lists.

Queries and blocks meet in cells of ``BLOCK`` vectors and ``QUERIES`` queries at most. Neither a list
that holds most vectors nor one that all queries go to makes a cell larger; there are only more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import parts_for, release_memory, written

SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 32 << 20
SEEDS, TRIALS = 1024, 256
#: Vectors in a list on average, unless that would be more lists than a 32nd of the sample.
LIST = 2048
BLOCK, QUERIES = 4096, 8192
#: Rows of a block that are scanned before the threshold is raised.
SLICE = 1024
#: Standard deviations by which a partial inner product must fall short.
DEVIATIONS = 2.5
#: Columns are scanned in so many blocks.
STEPS = 4
#: Queries that are scanned for together, and the share of pairs up to which they are taken one by one.
BATCH, SPARSE = 256, 0.125


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is not null or zero, and has neither null nor non-finite components."""
    return vectors.filter(
        F.col(vec).isNotNull()
        & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vec, lambda x: x != 0)
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _means(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids by k-means, from rows spread over the sample; an empty list keeps its centroid."""
    centres = sample[:: max(1, len(sample) // lists)][:lists].copy()
    for _ in range(rounds):
        own = _nearest(sample, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    found = [np.argmax(part @ centres.T - half, axis=1) for part in np.array_split(x, len(x) // 4096 + 1)]
    return np.concatenate(found).astype(np.int32)


def _rotation(width: int) -> np.ndarray:
    square = np.random.default_rng(20240229).standard_normal((width, width))
    q, r = np.linalg.qr(square)
    return q * np.sign(np.diag(r))


def _scores(queries: np.ndarray, vectors: np.ndarray, who: np.ndarray, whom: np.ndarray) -> np.ndarray:
    """Inner products of pairs, added in the order of the columns, so equal vectors score equal. The
    arrays hold a column of all queries or vectors in each row."""
    total = np.zeros(len(who))
    for asked, held in zip(queries, vectors, strict=True):
        total += asked[who] * held[whom]
    return total


@dataclass
class _Index:
    """Centroids, and how far the vectors of a list are spread around each in any one direction."""

    centres: np.ndarray
    spread: np.ndarray

    def order(self, queries: np.ndarray) -> np.ndarray:
        """Lists of each query, best first: by the inner products their upper vectors may have."""
        length = np.linalg.norm(queries, axis=1)
        return np.argsort(-(queries @ self.centres.T + 3 * length[:, None] * self.spread), axis=1, kind="stable")


@dataclass
class _Seeds:
    """Vectors that every query is compared with, by id."""

    rows: np.ndarray
    ids: pa.Array
    vectors: np.ndarray

    def best(self, rows: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """Thresholds (-inf if there are too few seeds), and the k best seeds of each query: numbers of
        queries and seeds, and scores."""
        found = np.zeros((len(queries), len(self.vectors)))
        for column in range(queries.shape[1]):  # as in _scores, so ties are ties
            found += queries[:, column, None] * self.vectors[None, :, column]
        found[rows[:, None] == self.rows[None, :]] = -np.inf
        many = min(k, found.shape[1])
        top = np.argsort(-found, axis=1, kind="stable")[:, :many]
        scores = np.take_along_axis(found, top, axis=1)
        thresholds = scores[:, -1] if many == k else np.full(len(rows), -np.inf)
        who, place = np.nonzero(scores > -np.inf)
        return thresholds, who, top[who, place], scores[who, place]


def scan(
    rotated: np.ndarray, norms: np.ndarray, query: np.ndarray, threshold: float, steps: int = STEPS
) -> np.ndarray:
    """Numbers of the rows of ``rotated`` whose inner product with ``query`` is not found to be
    under ``threshold``."""
    return scan_pairs(rotated, norms, query[None, :], np.array([threshold]), steps)[1]


def scan_pairs(
    rotated: np.ndarray, norms: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, as numbers of ``queries`` and of rows of ``rotated``, whose inner product is not found to
    be under the query's threshold; they are given up as soon as a test on their first columns rejects
    them. While pairs are scanned together, the test is that for the longest row: it gives up no more."""
    width = queries.shape[1]
    lengths = np.linalg.norm(queries, axis=1)
    own, aims = lengths * norms.max(initial=0.0), thresholds
    bounds = sorted({round(width * s / steps) for s in range(1, steps + 1)} - {0})

    def limits(end: int) -> np.ndarray:
        share = end * (width - end) / (width * max(width - 1, 1) * (width + 2.0))
        slack = DEVIATIONS * np.sqrt(share * (own * own + np.where(np.isfinite(aims), aims, 0.0) ** 2))
        return aims * (end / width) - slack - 1e-9 * own

    left = who = whom = None
    partial, begin = np.zeros((len(queries), len(rotated))), 0
    for end in bounds:
        if who is None:
            partial += queries[:, begin:end] @ rotated[:, begin:end].T
            reached = partial >= limits(end)[:, None]
            left = reached if left is None else left & reached
            if end == width or np.count_nonzero(left) <= SPARSE * left.size:
                who, whom = np.nonzero(left)
                partial, own, aims = partial[left], lengths[who] * norms[whom], thresholds[who]
        else:
            partial += np.einsum("ij,ij->i", queries[who, begin:end], rotated[whom, begin:end])
        if who is not None:
            reached = partial >= limits(end)
            who, whom, partial, own, aims = (x[reached] for x in (who, whom, partial, own, aims))
        begin = end
    return who, whom


_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()),
                    ("vec_id", pa.int64()), ("score", pa.float64())])
_FOUND_DDL = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double"


def _cell(table_v: pa.Table, table_q: pa.Table, seeds: np.ndarray, k: int) -> pa.Table:
    """The k best of a block for each query of a cell, without seeds and those under its threshold."""
    vectors, queries = _matrix(table_v.column("vec")), _matrix(table_q.column("vec"))
    if not len(vectors) or not len(queries):
        return _FOUND.empty_table()
    turn = _rotation(vectors.shape[1])
    rotated, turned = vectors @ turn, queries @ turn
    norms = np.linalg.norm(vectors, axis=1)
    rows, asking = table_v.column("row").to_numpy(), table_q.column("row").to_numpy()
    ids = table_v.column("vec_id").to_pandas().astype("float64").fillna(np.inf).to_numpy()
    seeded = np.isin(rows, seeds)
    by_column, asked_by_column = np.ascontiguousarray(vectors.T), np.ascontiguousarray(queries.T)
    limits = table_q.column("threshold").to_numpy().copy()
    found = []
    for first in range(0, len(asking), BATCH):
        batch = slice(first, first + BATCH)
        who, whom, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        for begin in range(0, len(rows), SLICE):
            part = slice(begin, begin + SLICE)
            asker, left = scan_pairs(rotated[part], norms[part], turned[batch], limits[batch])
            asker, left = first + asker, begin + left
            others = (rows[left] != asking[asker]) & ~seeded[left]
            asker, left = asker[others], left[others]
            if not len(left):
                continue
            who, whom = np.concatenate([who, asker]), np.concatenate([whom, left])
            score = np.concatenate([score, _scores(asked_by_column, by_column, asker, left)])
            order = np.lexsort((rows[whom], ids[whom], -score, who))
            who, whom, score = who[order], whom[order], score[order]
            place = np.arange(len(who)) - np.searchsorted(who, who)
            best = place < k
            who, whom, score, place = who[best], whom[best], score[best], place[best]
            last = place == k - 1
            limits[who[last]] = np.maximum(limits[who[last]], score[last])
        near = score >= limits[who]
        found.append((who[near], whom[near], score[near]))
    who, whom, score = ([x[i] for x in found] for i in range(3))
    q, v = pa.array(np.concatenate(who)), pa.array(np.concatenate(whom))
    columns = [table_q.column("row").take(q), table_q.column("vec_id").take(q),
               table_v.column("row").take(v), table_v.column("vec_id").take(v),
               pa.array(np.concatenate(score))]
    release_memory()
    return pa.table(columns, schema=_FOUND)


def fit(vectors: DataFrame, rows: int, width: int) -> _Index:
    """The lists, fitted on a bounded sample of ``vectors`` (vec_id, vec)."""
    size = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    sample = vectors.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(size).select("vec").toArrow()
    matrix = _matrix(sample.column("vec"))
    centres = _means(matrix, max(1, min(parts_for(rows, LIST), len(matrix) // 32)))
    own = _nearest(matrix, centres)
    squares = np.bincount(own, ((matrix - centres[own]) ** 2).sum(axis=1), minlength=len(centres))
    counts = np.maximum(np.bincount(own, minlength=len(centres)), 1)
    return _Index(centres, np.sqrt(squares / counts / width))


def _seeds(dealt: DataFrame) -> _Seeds:
    chosen = dealt.orderBy(F.xxhash64("row"), "row").limit(SEEDS)
    chosen = chosen.orderBy(F.asc_nulls_last("vec_id"), "row").select("row", "vec_id", "vec").toArrow()
    ids = chosen.column("vec_id").combine_chunks()
    return _Seeds(chosen.column("row").to_numpy(), ids, _matrix(chosen.column("vec")))


def _probes(dealt: DataFrame, queries: DataFrame, index: _Index, k: int, reach: float) -> int:
    """The least number of lists in which ``reach`` of the true neighbours of some queries lie."""
    trial = queries.orderBy(F.xxhash64("row", F.lit(1)), "row").limit(TRIALS).toArrow()
    if not len(trial) or len(index.centres) == 1:
        return len(index.centres)
    asked, asking = _matrix(trial.column("vec")), trial.column("row").to_numpy()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = asked @ _matrix(batch.column("vec")).T
            found[asking[:, None] == batch.column("row").to_numpy()[None, :]] = -np.inf
            top = np.argsort(-found, axis=1)[:, :k]
            lists = batch.column("list").to_numpy()[top]
            columns = [np.repeat(np.arange(len(asked)), top.shape[1]), lists.ravel(),
                       np.take_along_axis(found, top, axis=1).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "list", "score"])

    order = Window.partitionBy("q").orderBy(F.desc("score"))
    near = (
        dealt.select("row", "list", "vec").mapInArrow(best, "q bigint, list int, score double")
        .filter(F.col("score") > float("-inf"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
        .select("q", "list")
        .toArrow()
    )
    places = np.argsort(index.order(asked), axis=1)
    needed = np.sort(places[near.column("q").to_numpy(), near.column("list").to_numpy()]) + 1
    return int(needed[int(np.ceil(reach * len(needed))) - 1]) if len(needed) else len(index.centres)


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    id_column: str = "vec_id",
    vec_column: str = "embedding",
    reach: float = 0.97,
) -> DataFrame:
    """The ``k`` nearest vectors found for each row where ``is_query`` holds: query_id, rank, vec_id,
    score (the inner product of the original vectors in double precision).

    A query's own row is no candidate; ties go to the smaller id, null ids last. If there are fewer
    candidates than ``k``, all are returned. Vectors that are null, zero, or hold a null or non-finite
    component take no part; nor do those whose length is not the most frequent one (of equally
    frequent ones the largest). Repeated rows and ids are vectors of their own, and each queries by
    itself. An empty table gives no rows. Other columns are used by ``is_query`` only.
    """
    spark = vectors.sparkSession
    some = usable(vectors, vec_column).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vec_column).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    widths = some.groupBy(F.size("vec").alias("width")).agg(F.count("*").alias("n"))
    most = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width, rows = most["width"], most["n"]
    some = some.filter(F.size("vec") == width)
    index = fit(some, rows, width)
    held = spark.sparkContext.broadcast(index)

    def into_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                lists = pa.array(_nearest(_matrix(batch.column("vec")), held.value.centres), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "list"])

    kind = dict(some.dtypes)["vec"]
    base = f"row bigint, vec_id bigint, vec {kind}, asks boolean"
    dealt = written(
        some.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec", "asks").mapInArrow(
            into_lists, f"{base}, list int"
        ),
        "scan-lists",
    )
    asking = dealt.filter("asks").drop("asks")
    sizes = {r["list"]: r["n"] for r in dealt.groupBy("list").agg(F.count("*").alias("n")).collect()}
    blocks = np.array([parts_for(sizes.get(i, 0), BLOCK) for i in range(len(index.centres))])
    parts = parts_for(asking.count(), QUERIES)
    probes = _probes(dealt, asking, index, k, reach)
    seeds = _seeds(dealt)
    seeded = spark.sparkContext.broadcast(seeds)

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            queries, rows = _matrix(batch.column("vec")), batch.column("row").to_numpy()
            threshold = pa.array(seeded.value.best(rows, queries, k)[0])
            lists = held.value.order(queries)[:, :probes]
            for number in np.unique(lists):
                whose = pa.array(np.flatnonzero((lists == number).any(axis=1)))
                for block in range(blocks[number]):
                    place = [pa.array(np.full(len(whose), x, np.int32)) for x in (number, block)]
                    columns = [batch.column(c).take(whose) for c in ("row", "vec_id", "vec", "part")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, threshold.take(whose), *place],
                        ["row", "vec_id", "vec", "part", "threshold", "list", "block"],
                    )

    def best_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                rows, known = batch.column("row").to_numpy(), seeded.value
                _, who, whom, scores = known.best(rows, _matrix(batch.column("vec")), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[who]), batch.column("vec_id").take(pa.array(who)),
                     pa.array(known.rows[whom]), known.ids.take(pa.array(whom)), pa.array(scores)],
                    schema=_FOUND,
                )

    def by_hash(n: Column) -> Column:
        return F.pmod(F.xxhash64("row"), n).cast("int")

    per_list = F.array(*[F.lit(int(b)) for b in blocks]) if len(set(blocks.tolist())) > 1 else None
    n_blocks = F.lit(int(blocks[0])) if per_list is None else F.element_at(per_list, F.col("list") + 1)
    sought = asking.withColumn("part", by_hash(F.lit(parts))).select("row", "vec_id", "vec", "part")
    sought = sought.mapInArrow(
        to_blocks, f"row bigint, vec_id bigint, vec {kind}, part int, threshold double, list int, block int"
    )
    offered = dealt.withColumn("block", by_hash(n_blocks)).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    found = (
        offered.select("row", "vec_id", "vec", "list", "block", "part")
        .groupBy("list", "block", "part")
        .cogroup(sought.groupBy("list", "block", "part"))
        .applyInArrow(
            lambda v, q: _cell(v, q, seeded.value.rows, k), _FOUND_DDL
        )
        .unionByName(asking.select("row", "vec_id", "vec").mapInArrow(best_seeds, _FOUND_DDL))
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
