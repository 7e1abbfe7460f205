"""Suffix-array dedup: bytes of long strings that occur more than once, by refining buckets of suffix starts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored, text_or_empty

#: Bits of ``packed`` for the number of starts and for the offset of the pointer.
_FIELD = 16
#: Starts in the parts that runs are taken apart into.
_WIDTHS = (16, 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _signed(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def pointers(data: bytes, span: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts (first, last) of strings of ``length`` bytes that have the same pointer, and the pointers.

    The pointer of a start is the position, among the next ``span``, where a
    hash of the next 8 bytes is lowest (the first such). It depends on nothing
    outside the string, so equal strings have it at the same offset wherever
    they occur, and about one position in ``span / 2`` is a pointer at all.
    """
    n = len(data)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    grams = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (n - length + span,), (1,))
    order = (grams * _ODD) & np.uint64(0xFFFFFFFF00000000)
    order ^= (grams >> np.uint64(32)) * _ODD & np.uint64(0xFFFFFFFF00000000)
    order |= np.arange(len(order), dtype=np.uint64)  # the position in the low half breaks ties
    width = 1
    while width * 2 <= span:
        order = np.minimum(order[:-width], order[width:])
        width *= 2
    if width < span:
        order = np.minimum(order[: n - length + 1], order[span - width :])
    at = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return first, last, at[first]


class Buckets:
    """The classes of a document's starts, for strings of ``length`` bytes."""

    def __init__(self, length: int):
        if not 32 <= length < 1 << _FIELD:
            raise ValueError("length must be 32 to 65,535 bytes")
        self.length, self.span = length, length * 2 // 3

    def row(self, view: memoryview, first: int, number: int, offset: int, width: int) -> tuple[int, ...]:
        """(bucket, high, low, first, packed) of starts ``first`` and on, whose pointer is ``offset`` after the first.

        The offsets of all starts lie in one interval of ``width``. The bucket is
        a digest of the bytes that every string with an offset in that interval
        has around its pointer; high and low are one of all bytes of these very
        strings and of where the pointer is.
        """
        pointer, low = first + offset, offset // width * width
        top = min(low + width, self.span) - 1
        packed = number << _FIELD | offset
        bucket = xxhash.xxh3_64_intdigest(view[pointer - low : pointer + self.length - top], low) - (1 << 63)
        return bucket, *_signed(xxhash.xxh3_128_digest(view[first : first + number - 1 + self.length], packed)), first, packed

    def rows(self, data: bytes) -> tuple[list[tuple], list[tuple]]:
        """The rows of a document, and (first, packed) of runs known to be repeated.

        A class that occurs twice in this document is repeated; one row then
        stands for its runs.
        """
        out, known, seen = [], [], {}
        if len(data) < self.length:
            return out, known
        view = memoryview(data)
        for a, b, p in zip(*(x.tolist() for x in pointers(data, self.span, self.length))):
            row = self.row(view, a, b - a + 1, p - a, self.span)
            if row[1:3] in seen:
                known += seen[row[1:3]]
                seen[row[1:3]] = []
                known.append(row[3:])
                continue
            seen[row[1:3]] = [row[3:]]
            out.append(row)
        return out, known

    def parts(self, data: bytes, runs: list[dict], width: int) -> list[tuple]:
        """The rows of the parts of some runs whose offsets lie in one interval of ``width``."""
        out, view = [], memoryview(data)
        for run in runs:
            first, number, offset = run["first"], run["packed"] >> _FIELD, run["packed"] & (1 << _FIELD) - 1
            while number > 0:
                some = min(number, offset % width + 1)
                out.append(self.row(view, first, some, offset, width))
                first, number, offset = first + some, number - some, offset - some
        return out


_ROWS = "id_hash bigint, text_hash bigint, bucket bigint, high bigint, low bigint, first bigint, packed bigint"
_KEY = ["id_hash", "text_hash"]


def _table(batch: pa.RecordBatch, index: list[int], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 5
    keys, taken = {k: batch.column(k) for k in _KEY}, pa.array(index, pa.int64())
    return pa.table({**{k: v.take(taken) for k, v in keys.items()},
                     **{k: pa.array(c, pa.int64()) for k, c in zip(("bucket", "high", "low", "first", "packed"), columns)}})


def _pressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, the two hashes that name a row, and the compressed text, in which form texts are shuffled."""

    def press(batch: pa.RecordBatch) -> pa.RecordBatch:
        compress = zstandard.ZstdCompressor(level=1).compress
        texts = pa.array([compress(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(k) for k in _KEY), texts], ["doc_id", *_KEY, "pressed"])

    rows = _doc_rows(docs, id_col, text_col)
    return map_batches(rows, press, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, id_hash bigint, text_hash bigint, pressed binary")


def _doc_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col).cast("string")).alias("id_hash"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _refined(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(repeated runs, runs to take apart) of one level.

    Buckets of one run are done. Runs whose class is shared are repeated. Where a
    bucket has several classes, one run of each has to be taken apart. Counts are
    partial sums, and one run stands for all of its class.
    """
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    active = stored(rows.join(shared, "bucket"), f"repeat-active-{label}")
    classes = stored(active.groupBy("bucket", "high", "low").agg(
        F.count("*").alias("runs"), F.min(F.struct(*_KEY, "first", "packed")).alias("one")), f"repeat-classes-{label}")
    whole = active.join(classes.where("runs > 1").select("bucket", "high", "low"), ["bucket", "high", "low"]).select(*_KEY, "first", "packed")
    mixed = classes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return whole, classes.join(mixed, "bucket").select("one.*")


def repeated_runs(docs: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_hash, text_hash, first, packed): runs of starts of strings of ``length`` bytes that start anywhere else too.

    Bucket-pointer refinement with Spark's shuffles as the sort. Starts of a
    document with the same pointer form a run, which enters the initial bucket of
    the q-gram around its pointer. Buckets of one run drop out, shared classes
    are repeated, and what is left is refined by later offsets from the pointer:
    runs are cut into parts of 16 and of one start, whose buckets reach ever
    further to both sides until they are the strings themselves.
    """
    make = Buckets(length)

    def scan(batch: pa.RecordBatch) -> pa.Table:
        index, rows, known_index, known = [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            found, twice = make.rows(text.encode("utf-8", "surrogatepass"))
            index += [i] * len(found)
            rows += found
            known_index += [i] * len(twice)
            known += [(None, None, None, *k) for k in twice]
        return _table(batch, index + known_index, rows + known)

    runs = stored(map_batches(_doc_rows(docs, id_col, text_col).select(*_KEY, "text"), scan, _ROWS), "repeat-runs")
    found = [runs.where("bucket is null").select(*_KEY, "first", "packed")]
    whole, apart = _refined(runs.where("bucket is not null"), "long")
    found.append(whole)
    for width in _WIDTHS:
        def take_apart(batch: pa.RecordBatch, width: int = width) -> pa.Table:
            index, rows = [], []
            expand = zstandard.ZstdDecompressor().decompress
            for i, (text, some) in enumerate(zip(batch.column("pressed").to_pylist(), batch.column("runs").to_pylist())):
                part = make.parts(expand(text), some, width)
                index += [i] * len(part)
                rows += part
            return _table(batch, index, rows)

        wanted = apart.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "packed")).alias("runs"))
        # Rows equal in id and text hold the same strings, and those are repeated already.
        holders = _pressed(docs, id_col, text_col).drop("doc_id").join(wanted, _KEY)
        whole, apart = _refined(stored(map_batches(holders, take_apart, _ROWS), f"repeat-parts-{width}"), str(width))
        found.append(whole)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _removed(data: bytes, runs: list[dict], length: int) -> tuple[bytes, int, list[tuple[int, int]]]:
    """What is kept, the number of bytes removed, and the removed spans."""
    spans = []
    for run in sorted(runs, key=lambda r: r["first"]):
        a, b = run["first"], run["first"] + (run["packed"] >> _FIELD) - 1 + length
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept), sum(b - a for a, b in spans), [tuple(s) for s in spans]


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept`` for every row.

    Every byte covered by a string of ``length`` bytes that also starts anywhere
    else, the same document included, is removed. Strings are those of the
    texts in UTF-8 and never cross documents; a null text is empty; rows equal in
    id and text are each other's repeats. ``kept`` is binary, as a cut may split a
    character. An empty table gives no rows; other columns are not read.
    """
    runs = repeated_runs(docs, length, id_col, text_col)
    per_doc = runs.groupBy(*_KEY).agg(F.collect_set(F.struct("first", "packed")).alias("runs"))
    joined = _pressed(docs, id_col, text_col).join(per_doc, _KEY, "left").drop(*_KEY)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        expand = zstandard.ZstdDecompressor().decompress
        for text, some in zip(batch.column("pressed").to_pylist(), batch.column("runs").to_pylist()):
            data = expand(text)
            kept, gone, spans = _removed(data, some or [], length)
            out.append((len(data), gone, len(spans), [{"start": a, "end": b} for a, b in spans], hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
        columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])

    kind = joined.schema["doc_id"].dataType.simpleString()
    return map_batches(joined, clean, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string, kept binary")
