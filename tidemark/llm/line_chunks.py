"""Line dedup: rolling hashes over the lines choose the ends of chunks, and repeated chunks go; an exact pass takes the lines beside them.

Chunks between content-defined ends can't give whole results alone: where a
passage of a few lines stands between foreign ones, its first and last chunk
take in foreign lines, and often no chunk lies inside it. So several independent
rolling hashes cut every text, and pairs of neighbouring lines, which may begin
at every line, take what of a repeated passage lies in none of its chunks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, map_batches, numbered, row_key, stored, text_or_empty

#: A chunk ends after a line where the rolling hash over this many line hashes is divisible by ENDS.
WINDOW, ENDS = 2, 3
#: Independent rolling hashes that cut each text for repeated runs.
CUTS = 2
#: Blanks, as ``bytes.strip`` takes them from a unit; any other character is ink, white space beyond ASCII too.
BLANKS = " \t\n\v\f\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(lines: list[bytes], cut: int = 0) -> list[int]:
    """Where chunks end, as numbers of lines from the start.

    The rolling hash at a line covers it and the line before it, so an end
    depends on those two lines alone: inserted or removed lines move no other end. ``cut`` numbers independent hashes.
    """
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(line, cut) for line in lines), np.uint64, len(lines))
    rolling = hashes.copy()
    for k in range(1, min(WINDOW, len(lines))):
        rolling[k:] += hashes[:-k] * np.uint64((int(_MIX) * (2 * k + 1)) % (1 << 64))
    rolling ^= rolling >> np.uint64(31)
    rolling *= _MIX
    ends = (np.flatnonzero((rolling >> np.uint64(20)) % np.uint64(ENDS) == 0) + 1).tolist()
    return ends if ends and ends[-1] == len(lines) else [*ends, len(lines)]


def chunks(text: str, cut: int = 0) -> list[tuple[int, bytes, int]]:
    """(first line, bytes, number of lines) of each chunk; lines are what stands between line feeds."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    out, start = [], 0
    for end in chunk_ends(lines, cut):
        out.append((start, b"\n".join(lines[start:end]), end - start))
        start = end
    return out


def pairs(text: str) -> list[tuple[int, bytes, int]]:
    """(first line, bytes, 2) of every two neighbouring lines; they overlap, so a run of any length is made of pairs."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    return [(i, lines[i] + b"\n" + lines[i + 1], 2) for i in range(len(lines) - 1)]


def runs(text: str) -> list[tuple[int, bytes, int]]:
    """The chunks of all cuts, those of two lines aside, and the pairs; each stretch of lines once."""
    found = {(at, size): body for cut in range(CUTS) for at, body, size in chunks(text, cut) if size > 2}
    return [(at, body, size) for (at, size), body in found.items()] + pairs(text)


def _key(id_col: str, text_col: str) -> Column:
    """The row key in 16 bytes, as there are about as many rows as lines."""
    return F.unhex(row_key(id_col, text_col))


def _unit_rows(docs: DataFrame, id_col: str, text_col: str, units: Callable) -> DataFrame:
    """One row per unit of two lines or more that has some ink: row key, id, first line, number of lines, digest."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        rows, number, sizes, high, low = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            if "\n" not in text:
                continue
            for at, body, size in units(text):
                if size > 1 and body.strip():
                    digest = xxhash.xxh3_128_digest(body)
                    rows.append(i)
                    number.append(at)
                    sizes.append(size)
                    high.append(int.from_bytes(digest[:8], "big", signed=True))
                    low.append(int.from_bytes(digest[8:], "big", signed=True))
        taken = pa.array(rows, pa.int64())
        return pa.table({
            "row_key": batch.column("row_key").take(taken), "doc_id": batch.column("doc_id").take(taken),
            "line": pa.array(number, pa.int64()), "size": pa.array(sizes, pa.int32()), "high": pa.array(high, pa.int64()), "low": pa.array(low, pa.int64())})

    rows = docs.select(_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"row_key binary, doc_id {kind}, line bigint, size int, high bigint, low bigint")


def _uncovered(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Of the repeated stretches of a text the larger chunks, and the pairs that lie in none of them."""
    out = []
    for units in batch.column("units").to_pylist():
        inside = bytearray(max(u["line"] + u["size"] for u in units))
        for u in units:
            if u["size"] > 2:  # a pair begins at all of its lines but the last
                inside[u["line"] : u["line"] + u["size"] - 1] = b"\1" * (u["size"] - 1)
        out.append([u for u in units if u["size"] > 2 or not inside[u["line"]]])
    return batch.set_column(1, "units", pa.array(out, batch.schema.field("units").type))


def _without(text: str, doomed: list[dict], units: Callable) -> tuple[str, int, int]:
    """The text without the lines of doomed units whose bytes are those of the first occurrence; lines, lines removed."""
    wanted = {(d["line"], d["size"]): d["body"] for d in doomed}
    lines = text.split("\n")
    gone = bytearray(len(lines))
    for at, body, size in units(text):
        if wanted.get((at, size)) != body:
            continue
        if units is chunks:
            gone[at : at + size] = b"\1" * size
            continue
        for k in range(at, at + size - 1):
            if lines[k].strip(BLANKS) or lines[k + 1].strip(BLANKS):
                gone[k : k + 2] = b"\1\1"
    return "\n".join(line for line, out in zip(lines, gone) if not out), len(lines), sum(gone)


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks of lines taken out of the texts, and columns ``n_lines`` and ``n_removed``.

    Of every chunk of two lines or more that occurs again anywhere, the same
    document included, the first occurrence stays: smallest id (null last), then
    smallest row key, then first line. Digests find the repeats; before a chunk
    goes its bytes are compared with those of the first occurrence. Chunks of
    one line or of blanks stay. A null text stays null with no lines; all rows
    stay, even if their text becomes empty; rows equal in id and text count as
    one. Columns named like the two new ones are replaced.

    ``drop_repeated_runs`` also finds the repeats that share no whole chunk.
    """
    return _drop(docs, id_col, text_col, chunks)


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated runs of two lines or more taken out of the texts, and columns ``n_lines`` and ``n_removed``.

    Rolling hashes cut the texts into chunks in ``CUTS`` independent ways, and
    every chunk that occurs again anywhere, the same document included, goes but
    for its first occurrence: smallest id (null last), then smallest row key,
    then first line. An exact pass then takes what of a repeated run lies in
    none of its chunks: each pair of neighbouring lines, one of them with ink,
    that occurs again. Pairs overlap, so of a later run exactly the lines go that
    stand in it with a neighbour, wherever it begins and ends; the first
    occurrence of any line stays. A line that is repeated without a neighbour stays, as does a blank
    line between blank lines. Bytes are compared before lines go. Null texts,
    rows and columns are treated as by ``drop_repeated_chunks``.
    """
    return _drop(docs, id_col, text_col, runs)


def _drop(docs: DataFrame, id_col: str, text_col: str, units: Callable) -> DataFrame:
    """``docs`` without the lines of all but the first of equal units.

    Counts per digest are partial sums, so a unit in every document gathers
    nowhere. Pairs inside a chunk that goes are dropped first, so the text of
    a repeated unit travels once per distinct unit and once per removal that
    is left. Documents are shuffled once, to be cut and to meet their removals.
    """
    docs = docs.select(*(c for c in docs.columns if c not in ("n_lines", "n_removed")))
    names = docs.columns
    docs, id_col, text_col = numbered(docs, id_col, text_col)
    rows = stored(_unit_rows(docs, id_col, text_col, units), "chunk-rows")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_key", "line")
    repeated = rows.groupBy("high", "low").agg(F.min(place).alias("first"), F.max("size").alias("size"), F.count("*").alias("n")).where("n > 1")
    repeated = stored(repeated.select("high", "low", "size", F.col("first.row_key").alias("first_key"), F.col("first.line").alias("first_line")), "chunk-repeats")

    # Never null, and all columns on both ways, so that both joins read one shuffle.
    keyed = docs.withColumn(ROW, F.coalesce(_key(id_col, text_col), F.lit(b"")))
    plain = docs.columns
    text_at = plain.index(text_col)

    def cut(batch: pa.RecordBatch) -> pa.Table:
        out, digests = [], []
        for text, lines in zip(batch.column(text_at).to_pylist(), batch.column("lines").to_pylist()):
            wanted = {(u["first_line"], u["size"]) for u in lines}
            for at, body, size in units(text or ""):
                if (at, size) in wanted:
                    out.append(body)
                    digests.append(xxhash.xxh3_128_digest(body))
        return pa.table({"high": pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                         "low": pa.array([int.from_bytes(d[8:], "big", signed=True) for d in digests], pa.int64()), "body": pa.array(out, pa.binary())})

    firsts = repeated.groupBy(F.col("first_key").alias(ROW)).agg(F.collect_set(F.struct("first_line", "size")).alias("lines"))
    bodies = map_batches(keyed.join(firsts, ROW).select(*plain, "lines"), cut, "high bigint, low bigint, body binary").dropDuplicates(["high", "low"])
    doomed = rows.join(repeated.drop("size"), ["high", "low"]).where((F.col("row_key") != F.col("first_key")) | (F.col("line") != F.col("first_line")))
    doomed = doomed.groupBy("row_key").agg(F.collect_list(F.struct("line", "size", "high", "low")).alias("units"))
    doomed = map_batches(doomed, _uncovered, "row_key binary, units array<struct<line: bigint, size: int, high: bigint, low: bigint>>").select("row_key", F.inline("units"))
    removals = doomed.join(bodies, ["high", "low"]).groupBy(F.col("row_key").alias(ROW)).agg(F.collect_list(F.struct("line", "size", "body")).alias("__doomed"))

    joined = keyed.join(removals, ROW, "left").select(*plain, "__doomed")

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [(None, 0, 0) if t is None else _without(t, d, units) if d else (t, t.count("\n") + 1, 0)
                for t, d in zip(batch.column(text_at).to_pylist(), batch.column(len(plain)).to_pylist())]
        columns = [batch.column(i) if i != text_at else pa.array([d[0] for d in done], pa.string()) for i in range(len(plain))]
        columns += [pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]
        return pa.RecordBatch.from_arrays(columns, [*plain, "n_lines", "n_removed"])

    kinds = ", ".join(f"`{f.name}` {'string' if f.name == text_col else f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    return map_batches(joined, clean, f"{kinds}, n_lines bigint, n_removed bigint").toDF(*names, "n_lines", "n_removed")
