"""Token counts by byte-pair merging with a heap over a linked list of symbols."""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, text_or_empty

#: Fixed value: the split of byte-level vocabularies, in the syntax of Java; white space is Unicode's.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
#: Counts of words kept by one Python worker, and the longest word kept; beyond that they are counted again.
KEPT_WORDS, KEPT_LENGTH = 1_000_000, 32
#: Bits of a heap entry that hold the position.
SHIFT = 40
MASK = (1 << SHIFT) - 1
#: A vocabulary file larger than this is not sent to the workers.
MAX_VOCABULARY_BYTES = 64_000_000


def _symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Merges(dict):
    """Token counts of words, filled on demand from the merge ranks of a byte-level vocabulary file."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        data = json.loads(vocabulary)
        model, split = data["model"], data.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or data.get("normalizer") or not plain:
            raise ValueError("only plain byte-level BPE vocabularies are counted here")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        symbols, number = _symbols(), {}
        for name in symbols + [a + b for a, b in pairs]:
            number.setdefault(name, len(number))
        # Symbols are small numbers while a word is merged: byte b is number b at first.
        self.width = len(number)
        self.ranks = {}
        for rank, (a, b) in enumerate(pairs):
            if a in number and b in number:
                self.ranks.setdefault(number[a] * self.width + number[b], (rank << SHIFT, number[a + b]))
        special = [t for t in data.get("added_tokens", [])]
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") and data.get("normalizer") for t in special):
            raise ValueError("added tokens that take white space along are not handled")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = "|".join(map(re.escape, names))

    def merged(self, word: str) -> int:
        """Initial symbols minus merges: pop the lowest-ranked adjacent pair, leftmost first, until none is left.

        The heap holds rank and position of a pair in one number; a popped pair
        that was changed meanwhile no longer has the rank it was pushed with.
        """
        symbol = list(word.encode("utf-8", "surrogatepass"))
        n = count = len(symbol)
        if n < 2:
            return n
        width, pair_of = self.width, self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if pair := pair_of(symbol[i] * width + symbol[i + 1]):
                heap.append(pair[0] | i)
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & MASK
            j = after[i]
            if j >= n or symbol[i] < 0:
                continue
            pair = pair_of(symbol[i] * width + symbol[j])
            if not pair or pair[0] | i != top:
                continue
            symbol[i], symbol[j] = merged, _ = pair[1], -1
            after[i] = k = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if pair := pair_of(merged * width + symbol[k]):
                    heappush(heap, pair[0] | i)
            h = before[i]
            if h >= 0 and (pair := pair_of(symbol[h] * width + merged)):
                heappush(heap, pair[0] | h)
        return count

    def __missing__(self, word: str) -> int:
        count = self.merged(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = count
        return count

    def counts(self, words: pa.ListArray) -> np.ndarray:
        """The tokens of each list of words; every distinct word of the batch is looked up once."""
        coded = words.flatten().dictionary_encode()
        each = np.fromiter(map(self.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        sums = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
        ends = np.cumsum(words.value_lengths().to_numpy())
        return sums[ends] - sums[ends - words.value_lengths().to_numpy()]


_LOADED: dict[int, Merges] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; a null text counts as empty.

    The vocabulary file (``vocabulary`` is its path on the driver, at most 64 MB)
    is sent to the workers once. The JVM cuts texts at special strings and into
    words; workers merge the bytes of words and keep a bounded table of those
    they have counted. Nothing is shuffled, repeated rows are counted one by
    one, an empty table gives no rows, and other columns are not read.
    """
    with open(vocabulary, "rb") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is too large to be sent to every worker")
    special = Merges(content).special  # an unsupported vocabulary fails here
    shared, key = docs.sparkSession.sparkContext.broadcast(content), hash(content)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = Merges(shared.value)
        tokens = _LOADED[key].counts(batch.column("words")) + batch.column("n_special").to_numpy()
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)

    def cut(piece):
        return F.regexp_extract_all(piece, F.lit(SPLIT), F.lit(0))

    words, n_special = cut(text), F.lit(0)
    if special:
        pieces = F.split(text, special)
        has = text.rlike(special)
        words = F.when(has, F.flatten(F.transform(pieces, cut))).otherwise(words)
        n_special = F.when(has, F.size(pieces) - 1).otherwise(n_special)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), n_special.cast("long").alias("n_special"), words.alias("words"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
