"""Repeated passages by a depth-limited radix sort of suffixes, most significant digit first.

Suffixes are ordered only through their first ``size`` bytes; those equal that far are the repeated
windows. A byte goes if it lies in a window that also starts in a document with a smaller id.

* **Digit 1, the anchor.** Each window is dealt to a bucket by the anchor inside it (see
  ``bytewindows``): equal windows have equal anchors, and neighbours that share one travel as one
  record. Groups found in one document only end here, which are most.
* **Digit 2, the run.** Within an anchor's group, records are ordered by 48 bits of a hash of the
  whole run of windows. A run that a smaller document has too is covered. If a group has a single run
  nothing else can match; the other groups' first runs go on.
* **Digit 3, the window.** Their windows are ordered by 64 bits of a hash, each window for itself.

So digits are bits of hashes, not the bytes themselves; two different windows count as equal only if
they collide in all of them.

Each digit deals records of a fixed size into buckets of bounded size. What is frequent is merged in
each task before it is dealt: of equal runs or windows in a batch only the one with the least id is
sent, and an anchor with many runs in a batch sends one record while its runs go to digit 3 at once
(the same result with fewer records in one place). So a passage in a third of all documents sends one record per task, not per document. Texts
are dealt to groups, compressed, twice: for the windows of digit 3 and for the result.

Rows travel in blocks (arrays in a binary column), sorted and grouped with numpy in the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm import bytewindows as bw
from rowguard.llm.common import parts_for, release_memory, text_bytes, written

BLOCKS = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])
_BLOCKS_DDL = "key bigint, kind int, ids binary, data binary"
RUNS, WINDOWS, FOUND, TEXTS = 1, 2, 3, 4

#: A document (or the part of a long one that begins at ``base``) that records refer to.
DOC = np.dtype([("doc_id", "<i8"), ("text", "<u8"), ("base", "<i8")])
RUN = np.dtype(
    [("anchor", "<u4"), ("run", "<u4"), ("run_low", "<u2"), ("doc", "<u2"), ("at", "<u2"),
     ("at_high", "u1"), ("windows", "u1"), ("mixed", "u1")]
)
WINDOW = np.dtype([("hash", "<u8"), ("doc", "<u2"), ("at", "<u2"), ("at_high", "u1")])
#: Windows ``start`` to ``start + windows`` of a document are covered, or have yet to be looked at.
SPAN = np.dtype(
    [("doc_id", "<i8"), ("text", "<u8"), ("start", "<i8"), ("windows", "<i4"), ("open", "u1")]
)
MAX_DOCS, MAX_BYTES = 50_000, 2 << 20
#: With more runs than this in one batch, an anchor is frequent: its runs skip digit 2.
MANY_RUNS = 8
_LAST = np.iinfo(np.int64).max


def _group(doc_ids: np.ndarray, groups: int) -> np.ndarray:
    return (bw.mixed(doc_ids.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, type=f.type) for x, f in zip(zip(*rows) if rows else [()] * 4, BLOCKS)],
        schema=BLOCKS,
    )


def _parts(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values of sorted ``keys``."""
    cuts = np.concatenate([[0], np.nonzero(np.diff(keys))[0] + 1, [len(keys)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield int(keys[a]), slice(a, b)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _spans(docs: np.ndarray, doc: np.ndarray, start: np.ndarray, windows, is_open) -> np.ndarray:
    out = np.empty(len(doc), dtype=SPAN)
    out["doc_id"], out["text"] = docs["doc_id"][doc], docs["text"][doc]
    out["start"], out["windows"], out["open"] = start + docs["base"][doc], windows, is_open
    return out


def _found(spans: np.ndarray, groups: int) -> list[tuple]:
    """Blocks of spans by the group of their document; neighbours that are covered are joined."""
    if not len(spans):
        return []
    spans = spans[np.lexsort((spans["start"], spans["open"], spans["text"], spans["doc_id"]))]
    ends = spans["start"] + spans["windows"]
    new = _starts(spans["doc_id"], spans["text"], spans["open"])
    new[1:] |= spans["start"][1:] != ends[:-1]
    new |= spans["open"] == 1
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(spans)) - 1
    spans = spans[first].copy()
    spans["windows"] = ends[last] - spans["start"]
    group = _group(spans["doc_id"], groups)
    order = np.argsort(group, kind="stable")
    spans, squeeze = spans[order], zstandard.ZstdCompressor(level=1)
    return [
        (key, FOUND, b"", squeeze.compress(b"".join(spans[part][n].tobytes() for n in SPAN.names)))
        for key, part in _parts(group[order])
    ]


def _read_spans(data: bytes) -> np.ndarray:
    raw, at = zstandard.ZstdDecompressor().decompress(data), 0
    out = np.empty(len(raw) // SPAN.itemsize, dtype=SPAN)
    for name in SPAN.names:
        kind = SPAN[name]
        out[name] = np.frombuffer(raw, dtype=kind, count=len(out), offset=at)
        at += kind.itemsize * len(out)
    return out


def _dealt(keys: np.ndarray, kind: int, docs: np.ndarray, records: np.ndarray) -> list[tuple]:
    """Blocks by key, each with the documents its records refer to."""
    order = np.argsort(keys, kind="stable")
    keys, records, rows = keys[order], records[order], []
    for key, part in _parts(keys):
        own = records[part].copy()
        used, own["doc"] = np.unique(own["doc"], return_inverse=True)
        rows.append((key, kind, docs[used].tobytes(), own.tobytes()))
    return rows


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str | None]]:
    for at in range(0, len(batch), 200):
        part = batch.slice(at, 200)
        yield from zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())


def _pieces(rows: Iterator[tuple[int | None, str | None]], size: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Documents in portions; long ones in overlapping parts, so that every window is in one."""
    docs, parts, held = [], [], 0
    for doc_id, text in rows:
        raw = (text or "").encode()
        if len(raw) < size:
            continue
        name = xxhash.xxh64_intdigest(raw)
        for base in range(0, len(raw) - size + 1, bw.BLOCK):
            part = raw[base : base + bw.BLOCK + size - 1]
            docs.append((_LAST if doc_id is None else doc_id, name, base))
            parts.append(part)
            held += len(part)
            if len(docs) >= MAX_DOCS or held >= MAX_BYTES:
                yield np.array(docs, dtype=DOC), parts
                docs, parts, held = [], [], 0
    if docs:
        yield np.array(docs, dtype=DOC), parts


def _runs(docs: np.ndarray, parts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """Document, first window, windows, anchor and hash of the bytes, of every run."""
    found, at = [], 0
    while at < len(parts):
        end, held = at, 0
        while end < len(parts) and (end == at or held + len(parts[end]) <= bw.BLOCK):
            held += len(parts[end])
            end += 1
        data = np.frombuffer(b"".join(parts[at:end]), dtype=np.uint8)
        starts = np.cumsum([0] + [len(x) for x in parts[at:end]])
        doc, first, windows, anchor = bw.segments(data, starts, size)
        whole = bw.rolling(data, size)
        run = whole[first] * np.uint64(0x9E3779B97F4A7C15) + whole[first + windows - 1]
        run = bw.mixed(run + windows.astype(np.uint64))
        # Anchors have small hashes, being the least of their windows; mixed again they spread evenly.
        anchor = bw.mixed(anchor + np.uint64(0x9E3779B97F4A7C15))
        found.append((doc + at, first - starts[doc], windows, anchor, run))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def _deal_runs(size: int, buckets: int, groups: int):
    """Digit 1 before the shuffle: runs by anchor, and what is decided within the batch."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, parts in _pieces(_rows(batch), size):
                doc, first, windows, anchor, run = _runs(docs, parts, size)
                order = np.lexsort((docs["doc_id"][doc], run, anchor))
                doc, first, windows, anchor, run = (
                    x[order] for x in (doc, first, windows, anchor, run)
                )
                doc_id = docs["doc_id"][doc]
                new_run, new_anchor = _starts(anchor, run), _starts(anchor)
                least = doc_id[np.nonzero(new_run)[0]][np.cumsum(new_run) - 1]
                covered = doc_id > least
                several = np.add.reduceat(new_run.astype(np.int64), np.nonzero(new_anchor)[0]) > MANY_RUNS
                several = several[np.cumsum(new_anchor) - 1]
                again = several & ~covered
                known = covered | again
                rows = _found(_spans(docs, doc[known], first[known], windows[known], again[known]), groups)
                send = np.nonzero((~covered & ~several) | (several & new_anchor))[0]
                records = np.zeros(len(send), dtype=RUN)
                records["anchor"] = anchor[send] & np.uint64(0xFFFFFFFF)
                records["run"] = run[send] >> np.uint64(32)
                records["run_low"] = run[send] & np.uint64(0xFFFF)
                records["doc"], records["mixed"] = doc[send], several[send]
                records["at"], records["at_high"] = first[send] & 0xFFFF, first[send] >> 16
                records["windows"] = windows[send]
                bucket = ((anchor[send] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                rows += _dealt(bucket.astype(np.int64), RUNS, docs, records)
                # Buckets and groups share the shuffle; the keys of groups are negative.
                yield _blocks([(-1 - k if kind == FOUND else k, kind, i, d) for k, kind, i, d in rows])
                del doc, first, windows, anchor, run, doc_id, order, records, rows
                release_memory()

    return deal


def _gather(table: pa.Table, kind: int, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Documents and records of all blocks of a bucket, in the same terms."""
    docs, records, held = [], [], 0
    for row_kind, ids, data in zip(*(table.column(n).to_pylist() for n in ("kind", "ids", "data"))):
        if row_kind == kind:
            docs.append(np.frombuffer(ids, dtype=DOC))
            own = np.frombuffer(data, dtype=dtype)
            records.append((own, own["doc"].astype(np.int64) + held))
            held += len(docs[-1])
    own = np.concatenate([x for x, _ in records])
    return np.concatenate(docs)[np.concatenate([d for _, d in records])], own


def _passed_on(table: pa.Table) -> pa.Table:
    keys = np.array(table.column("key").to_pylist(), dtype=np.int64)
    return pa.Table.from_arrays(
        [pa.array(-1 - keys), *(table.column(n) for n in ("kind", "ids", "data"))], schema=BLOCKS
    )


def _order_runs(groups: int):
    """Digits 1 and 2 of one bucket."""

    def order(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() == FOUND:
            return _passed_on(table)
        docs, own = _gather(table, RUNS, RUN)
        run = (own["run"].astype(np.uint64) << np.uint64(16)) | own["run_low"]
        rank = np.lexsort((docs["doc_id"], run, own["anchor"]))
        docs, own, run = docs[rank], own[rank], run[rank]
        new_anchor, new_run = _starts(own["anchor"]), _starts(own["anchor"], run)
        heads, which = np.nonzero(new_anchor)[0], np.cumsum(new_anchor) - 1
        least = docs["doc_id"][np.nonzero(new_run)[0]][np.cumsum(new_run) - 1]
        covered = docs["doc_id"] > least
        lowest = np.minimum.reduceat(docs["doc_id"], heads)
        highest = np.maximum.reduceat(docs["doc_id"], heads)
        several = np.add.reduceat(new_run.astype(np.int64), heads) > 1
        marked = np.maximum.reduceat(own["mixed"], heads) > 0
        again = (marked | (several & (lowest < highest)))[which] & ~covered & (own["mixed"] == 0)
        known = covered & (own["mixed"] == 0) | again
        start = own["at"].astype(np.int64) | own["at_high"].astype(np.int64) << 16
        at = np.nonzero(known)[0]
        spans = _spans(docs, at, start[at], own["windows"][at], again[at])
        return pa.Table.from_batches([_blocks(_found(spans, groups))], schema=BLOCKS)

    return order


def _squeeze(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _deal_texts(groups: int):
    """Whole rows, compressed, by the group of their document."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                ids = batch.column("doc_id").to_pylist()
                group = _group(np.array([_LAST if i is None else i for i in ids], dtype=np.int64), groups)
                order = np.argsort(group, kind="stable")
                batch = batch.take(pa.array(order))
                yield _blocks(
                    [
                        (key, TEXTS, b"", _squeeze(batch.slice(part.start, part.stop - part.start)))
                        for key, part in _parts(group[order])
                    ]
                )

    return deal


def _split(table: pa.Table) -> tuple[dict[tuple[int, int], np.ndarray], list[bytes]]:
    """Spans by document, and blocks of texts."""
    kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
    spans = [_read_spans(d) for k, d in zip(kinds, data) if k == FOUND]
    spans = np.concatenate(spans) if spans else np.zeros(0, dtype=SPAN)
    spans = spans[np.lexsort((spans["text"], spans["doc_id"]))]
    heads = np.nonzero(_starts(spans["doc_id"], spans["text"]))[0]
    by_doc = {
        (int(spans["doc_id"][a]), int(spans["text"][a])): spans[a:b]
        for a, b in zip(heads, np.append(heads[1:], len(spans)))
    }
    return by_doc, [d for k, d in zip(kinds, data) if k == TEXTS]


def _deal_windows(size: int, buckets: int, groups: int):
    """Digit 3 before the shuffle: the windows of open runs, and what is decided in the group."""

    def deal(table: pa.Table) -> pa.Table:
        by_doc, texts = _split(table)
        docs, doc, at, one, two = [], [], [], [], []
        for block in texts:
            batch = pa.ipc.open_stream(block).read_all()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = (text or "").encode()
                key = (_LAST if doc_id is None else doc_id, xxhash.xxh64_intdigest(raw))
                if (spans := by_doc.pop(key, None)) is None:
                    continue
                n = spans["windows"].astype(np.int64)
                first = np.repeat(spans["start"] - np.cumsum(n) + n, n) + np.arange(n.sum())
                first = np.unique(first)
                hashes = bw.window_hashes(np.frombuffer(raw, dtype=np.uint8), first, size)
                one.append(hashes[0])
                two.append(hashes[1])
                for base in range(0, len(raw), 1 << 23):
                    part = first[(first >= base) & (first < base + (1 << 23))] - base
                    if len(part):
                        doc.append(np.full(len(part), len(docs)))
                        at.append(part)
                        docs.append((*key, base))
        if not docs:
            return BLOCKS.empty_table()
        docs = np.array(docs, dtype=DOC)
        doc, at, one, two = (np.concatenate(x) for x in (doc, at, one, two))
        order = np.lexsort((docs["doc_id"][doc], two, one))
        doc, at, one, two = (x[order] for x in (doc, at, one, two))
        doc_id = docs["doc_id"][doc]
        new = _starts(one, two)
        covered = doc_id > doc_id[np.nonzero(new)[0]][np.cumsum(new) - 1]
        here = np.nonzero(covered)[0]
        rows = [
            (-1 - key, kind, ids, data)
            for key, kind, ids, data in _found(_spans(docs, doc[here], at[here], 1, 0), groups)
        ]
        bucket = ((two >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        for low in range(0, len(docs), MAX_DOCS):
            send = np.nonzero(~covered & (doc >= low) & (doc < low + MAX_DOCS))[0]
            records = np.zeros(len(send), dtype=WINDOW)
            records["hash"], records["doc"] = one[send], doc[send] - low
            records["at"], records["at_high"] = at[send] & 0xFFFF, at[send] >> 16
            rows += _dealt(bucket[send].astype(np.int64), WINDOWS, docs[low : low + MAX_DOCS], records)
        return pa.Table.from_batches([_blocks(rows)], schema=BLOCKS)

    return deal


def _order_windows(groups: int):
    """Digit 3 of one bucket."""

    def order(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() == FOUND:
            return _passed_on(table)
        docs, own = _gather(table, WINDOWS, WINDOW)
        rank = np.lexsort((docs["doc_id"], own["hash"]))
        docs, own = docs[rank], own[rank]
        new = _starts(own["hash"])
        covered = docs["doc_id"] > docs["doc_id"][np.nonzero(new)[0]][np.cumsum(new) - 1]
        start = own["at"].astype(np.int64) | own["at_high"].astype(np.int64) << 16
        at = np.nonzero(covered)[0]
        spans = _spans(docs, at, start[at], 1, 0)
        return pa.Table.from_batches([_blocks(_found(spans, groups))], schema=BLOCKS)

    return order


def covered_bytes(length: int, spans: np.ndarray | None, size: int) -> np.ndarray:
    """Which bytes of a document lie in a covered window."""
    depth = np.zeros(length + 1, dtype=np.int32)
    if spans is not None:
        np.add.at(depth, spans["start"], 1)
        np.add.at(depth, spans["start"] + spans["windows"] + size - 1, -1)
    return np.cumsum(depth)[:length] > 0


def _kept_text(raw: bytes, gone: np.ndarray) -> str:
    """What is left, in whole characters: a character stays if any byte of it stays."""
    data = np.frombuffer(raw, dtype=np.uint8)
    heads = np.nonzero((data & 0xC0) != 0x80)[0]
    if len(heads) == 0:
        return ""
    whole = np.minimum.reduceat(gone, heads)
    keep = ~np.repeat(whole, np.diff(np.append(heads, len(data))))
    return data[keep].tobytes().decode()


def _finish(size: int, schema: pa.Schema, with_text: bool):
    def finish(table: pa.Table) -> pa.Table:
        by_doc, texts = _split(table)
        out = []
        for block in texts:
            batch = pa.ipc.open_stream(block).read_all()
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = (text or "").encode()
                key = (_LAST if doc_id is None else doc_id, xxhash.xxh64_intdigest(raw))
                gone = covered_bytes(len(raw), by_doc.get(key), size)
                n_spans = int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=np.int8(0)) == 1))
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes() if n_spans else raw
                row = (doc_id, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
                rows.append(row + (_kept_text(raw, gone) if n_spans else text,) * with_text)
            columns = dict(zip(schema.names, zip(*rows))) if rows else {}
            for name in batch.column_names:
                if with_text and name not in columns:
                    columns[name] = batch.column(name).to_pylist()
            out.append(pa.table([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return finish


def _report(docs: DataFrame, size: int, with_text: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    if not 8 <= size <= 400:
        raise ValueError("size must be from 8 to 400 bytes")
    total = text_bytes(docs)
    groups = run_buckets = window_buckets = parts_for(total, 6 << 20)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dealt = narrow.mapInArrow(_deal_runs(size, run_buckets, groups), _BLOCKS_DDL)
    by_run = written(
        _by_key(dealt, run_buckets + groups).applyInArrow(_order_runs(groups), _BLOCKS_DDL), "suffix-runs"
    )
    open_runs = by_run.mapInArrow(_only(is_open=True), _BLOCKS_DDL)
    texts = narrow.mapInArrow(_deal_texts(groups), _BLOCKS_DDL)
    windows = _by_key(open_runs.unionByName(texts), groups).applyInArrow(
        _deal_windows(size, window_buckets, groups), _BLOCKS_DDL
    )
    # Written, so that digit 3's shuffles are gone before texts are dealt once more for the result.
    by_window = written(
        _by_key(windows, window_buckets + groups).applyInArrow(_order_windows(groups), _BLOCKS_DDL),
        "suffix-windows",
    )
    covered = by_run.mapInArrow(_only(is_open=False), _BLOCKS_DDL).unionByName(by_window)
    result = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        others = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *others)
        taken = {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}
        if clash := taken & {c.strip("`") for c in others}:
            rows = rows.drop(*clash)
        texts = rows.mapInArrow(_deal_texts(groups), _BLOCKS_DDL)
        kept = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("doc_id", "text")
        )
        result += ", text string" + (f", {kept}" if kept else "")
    empty = docs.sparkSession.createDataFrame([], result)
    schema = to_arrow_schema(empty.schema)
    return _by_key(covered.unionByName(texts), groups).applyInArrow(_finish(size, schema, with_text), result)


class _Grouped:
    """Grouped blocks; memory is given back after each group."""

    def __init__(self, blocks: DataFrame, keys: int) -> None:
        self.groups = blocks.repartition(keys, "key").groupBy("key")

    def applyInArrow(self, function, schema: str) -> DataFrame:  # noqa: N802 - Spark's name
        def apply(table: pa.Table) -> pa.Table:
            out = function(table)
            release_memory()
            return out

        return self.groups.applyInArrow(apply, schema)


def _by_key(blocks: DataFrame, keys: int) -> _Grouped:
    """Blocks grouped by key, about one key in a task, so that tasks stay small."""
    return _Grouped(blocks, keys)


def _only(is_open: bool):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            for key, data in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist()):
                spans = _read_spans(data)
                spans = spans[(spans["open"] == 1) == is_open]
                if len(spans):
                    packed = b"".join(spans[n].tobytes() for n in SPAN.names)
                    rows.append((key, FOUND, b"", squeeze.compress(packed)))
            if rows:
                yield _blocks(rows)

    return pick


def repeated_bytes(docs: DataFrame, size: int = 50) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null text is empty; texts under ``size`` bytes lose nothing. Of equal texts the one with the
    smallest id stays whole; rows with the same id do not touch each other. A null id counts as
    larger than any other. Other columns are not read. An empty table gives no rows.
    """
    return _report(docs, size, with_text=False)


def without_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``, and n_removed.

    Cuts respect characters: one stays if any of its bytes does. The columns of ``docs`` come back
    in their order; of the result's own names only ``n_removed`` is added (replacing a column of
    that name). Null texts stay null.
    """
    # Columns with the names of results travel under other names.
    taken = {c: f"_own_{c}" for c in ("n_bytes", "n_spans", "kept_sha256") if c in docs.columns}
    held = docs.drop("n_removed").withColumnsRenamed(taken)
    out = _report(held, size, with_text=True)
    names = [c for c in docs.columns if c != "n_removed"]
    return out.select(*[F.col(f"`{taken.get(c, c)}`").alias(c) for c in names], "n_removed")
