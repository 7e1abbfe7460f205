"""SimHash near-duplicates: fingerprints of word shingles, joined on shared blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, map_batches, numbered, row_key, stored, text_or_empty, with_row_key
from tidemark.llm.components import connected_components

BITS, BLOCK_BITS = 64, 16
#: Fingerprints that share a key are compared pair by pair up to this number.
PAIRED = 256
#: Shingles hashed before their bits are added up.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64 bits; a bit is 1 if set in over half the hashes of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(first), CHUNK):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(first[at : at + CHUNK], last[at : at + CHUNK])], np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, print`` (the fingerprint as a signed long) for every row; a null text has no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(prints)], ["doc_id", "row_key", "print"])

    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, row_key string, print bigint")


def _block(print_: Column, i: int) -> Column:
    return F.shiftrightunsigned(print_, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _bit(i: int) -> Column:
    return F.lit((1 << i) - ((1 << BITS) if i == BITS - 1 else 0)).cast("long")


def close_links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column ``print``) at ``distance`` (0 to 2) or fewer differing bits.

    Pigeonhole: of four 16-bit blocks at least ``4 - distance`` are equal in a
    close pair, so every choice of that many blocks is a key, and prints that
    share a key are compared. Where more than 256 share one they are not paired:
    each is sent to itself and to every value with one of its free bits flipped.
    Two prints at two bits meet at such a value and all that meet there are that
    close, so each is linked to the smallest; a print at one bit is itself met.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")
    blocks = range(BITS // BLOCK_BITS)
    chosen = list(combinations(blocks, len(blocks) - distance))
    keys = [F.struct(F.lit(n).alias("n"), F.array(*(_block(F.col("print"), i) for i in some)).alias("blocks")) for n, some in enumerate(chosen)]
    keyed = prints.select("print").distinct().select("print", F.explode(F.array(*keys)).alias("key")).select(
        "print", F.xxhash64("key").alias("key"), F.col("key.n").alias("n"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("sharing")).where("sharing > 1")
    keyed = stored(keyed.join(counts, "key"), "simhash-keys")
    few, many = keyed.where(F.col("sharing") <= PAIRED), keyed.where(F.col("sharing") > PAIRED)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = few.select("key", F.col("print").alias("a")).join(few.select("key", F.col("print").alias("b")), "key").where(
        (F.col("a") < F.col("b")) & near).select("a", "b")
    flips = F.array(*(F.array(F.lit(0).cast("long"), *(_bit(i) for i in range(BITS) if i // BLOCK_BITS not in some)) for some in chosen))
    met = many.select("print", F.explode(F.get(flips, F.col("n"))).alias("flip")).select(
        "print", F.col("print").bitwiseXOR(F.col("flip")).alias("value")).distinct()
    if distance == 2:
        lowest = met.groupBy("value").agg(F.min("print").alias("a"), F.max("print").alias("top")).where("a < top").select("value", "a")
    else:
        lowest = prints.select(F.col("print").alias("value"), F.col("print").alias("a")).distinct()
    starred = met.join(lowest, "value").where("a <> print").select("a", F.col("print").alias("b")).where(near)
    return pairs.union(starred).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, fingerprint, component_id, group_print`` for every row.

    ``component_id`` is the smallest ``doc_id`` reachable by links, null if no
    row of the component has one; ``group_print`` names the component. Documents
    without words, null texts among them, have fingerprint zero and are linked
    like others. Equal fingerprints are one node, so copies are never paired.
    Other columns are not read; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle, seed, id_col, text_col), "simhash-prints")
    nodes = rows.groupBy("print").agg(F.min("doc_id").alias("lowest"))
    linked = connected_components(close_links(nodes, distance)).select(F.col("node").alias("print"), "root")
    groups = nodes.join(linked, "print", "left").select("print", "lowest", F.coalesce("root", "print").alias("root"))
    heads = groups.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = groups.join(heads, "root").select("print", "root", "component_id")
    return rows.join(named, "print").select(
        "doc_id", "row_key", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id", F.col("root").alias("group_print"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the smallest id, then the smallest row key.

    A row without an id stays only if its whole group has none. Of rows equal in
    id and text one stays.
    """
    names = docs.columns
    docs, id_col, text_col = numbered(docs, id_col, text_col)
    found = near_duplicates(docs, shingle, distance, seed, id_col, text_col)
    first = found.groupBy("group_print").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("f")).select(F.col("f.row_key").alias(ROW))
    kept = with_row_key(docs, id_col, text_col).join(first, ROW)
    one = Window.partitionBy(ROW).orderBy(F.lit(1))
    return kept.withColumn("__nth", F.row_number().over(one)).where("__nth = 1").select(*docs.columns).toDF(*names)
