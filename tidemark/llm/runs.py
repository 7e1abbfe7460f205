"""Periodic runs of words: Lyndon arrays from Baier's grouping of suffixes, extended by longest common extensions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import INK, map_batches, text_or_empty

#: Words of a batch that are worked on at once; a longer document is worked on alone.
WORDS_AT_ONCE = 1_000_000
#: Two primes below 2**31 and a base for each; products of residues fit 64 bits.
_FIELDS = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_664_525_013))


def words_of(text: str | Column) -> Column:
    """The words of a text, none for a null."""
    return F.regexp_extract_all(text_or_empty(text), F.lit(INK), F.lit(0))


def lyndon_lengths(ranks: list[int], n_ranks: int) -> list[int]:
    """The length of the longest Lyndon word that starts at each position; an end of text is the lowest letter.

    This is the first phase of Baier's suffix sorter. Suffixes start out grouped
    by their first letter, groups are taken from the highest down, and each
    member ``i`` of the group at hand looks for the nearest suffix to its left in
    a lower group. A suffix that is found ``k`` times is followed by ``k`` copies of
    the group's context, so it moves up into a new group whose context is its own
    with these copies behind. When all groups were taken, the context of a
    suffix's group is its longest Lyndon prefix. Every position is taken once.
    """
    n = len(ranks)
    group, width = list(ranks), [1] * n_ranks
    members: list[list[int]] = [[] for _ in range(n_ranks)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    below, above = list(range(-1, n_ranks - 1)), list(range(1, n_ranks + 1))
    if n_ranks:
        above[-1] = -1
    left, taken = list(range(-1, n - 1)), bytearray(n)
    g = n_ranks - 1
    while g >= 0:
        now = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in now:
            taken[i] = 1
        found: dict[int, int] = {}
        for i in now:
            j = left[i]
            while j >= 0 and taken[j]:
                j = left[j]
            while left[i] != j:  # the taken ones between lead here at once from now on
                left[i], i = j, left[i]
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, k in found.items():
            moves.setdefault((group[j], k), []).append(j)
        size = width[g]
        for h, k in sorted(moves, reverse=True):  # each new group goes right above h: the one with most copies first
            new, over = len(width), above[h]
            width.append(width[h] + k * size)
            members.append(moves[h, k])
            below.append(h)
            above.append(over)
            above[h] = new
            if over >= 0:
                below[over] = new
            for j in moves[h, k]:
                group[j] = new
        g = below[g]
    return [width[x] for x in group]


class Extensions:
    """Longest common extensions in a row of integers, by hashes of its prefixes in two fields."""

    def __init__(self, codes: np.ndarray, longest: int):
        n = len(codes)
        self.n, self.top = n, 1 << max(longest, 1).bit_length()
        self.sums, self.powers = [], []
        for prime, base in _FIELDS:
            powers = np.ones(n + 1, np.uint64)
            k = 1
            while k <= n:
                step = powers[k - 1] * np.uint64(base) % np.uint64(prime)
                powers[k : 2 * k] = powers[: min(k, n + 1 - k)] * step % np.uint64(prime)
                k *= 2
            terms = (codes.astype(np.uint64) + np.uint64(1)) * powers[:n] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]) % np.uint64(prime))
            self.powers.append(powers)

    def _equal(self, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
        """Whether ``length`` items from i and from j > i are equal, as far as the hashes tell."""
        out = np.ones(len(i), bool)
        for (prime, _), sums, powers in zip(_FIELDS, self.sums, self.powers):
            p = np.uint64(prime)
            first, second = (sums[i + length] + p - sums[i]) % p, (sums[j + length] + p - sums[j]) % p
            out &= first * powers[j - i] % p == second
        return out

    def both(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many items are equal from i and j on, and how many before them."""
        ahead, behind = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        step = self.top
        while step:
            fits = np.flatnonzero(j + ahead + step <= self.n)
            ahead[fits[self._equal(i[fits] + ahead[fits], j[fits] + ahead[fits], step)]] += step
            fits = np.flatnonzero(i - behind - step >= 0)
            behind[fits[self._equal(i[fits] - behind[fits] - step, j[fits] - behind[fits] - step, step)]] += step
            step //= 2
        return ahead, behind


def _is_run(codes: np.ndarray, start: int, length: int, period: int) -> bool:
    end = start + length
    return (np.array_equal(codes[start : end - period], codes[start + period : end])
            and (start == 0 or codes[start - 1] != codes[start + period - 1]) and (end == len(codes) or codes[end] != codes[end - period]))


def _grown(codes: np.ndarray, i: int, period: int) -> tuple[int, int]:
    """Start and length around i by plain comparison."""
    end, start = i, i
    while end + period < len(codes) and codes[end] == codes[end + period]:
        end += 1
    while start > 0 and codes[start - 1] == codes[start + period - 1]:
        start -= 1
    return start, end + period - start


def runs(codes: np.ndarray, least: int = 24, times: int = 3, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal run of ``least`` items and ``times`` periods, twice or more.

    For one of the two orders of the letters, every Lyndon root of a run is the
    longest Lyndon word where it starts; so roots are read off the Lyndon arrays
    of both orders and extended to both sides. Equality by hashes is checked item
    by item for the runs found. ``longest`` bounds the length of any run.
    """
    n = len(codes)
    values, ranks = np.unique(codes, return_inverse=True)
    ends, found = Extensions(ranks, longest or n), {}
    at = np.arange(n)
    for order in (ranks, len(values) - 1 - ranks):
        period = np.array(lyndon_lengths(order.tolist(), len(values)), np.int64)
        after = at + period
        same = np.zeros(n, bool)
        inside = after < n
        same[inside] = ranks[at[inside]] == ranks[after[inside]]
        same[1:] |= ranks[: n - 1] == ranks[after[1:] - 1]
        i, p = at[same], period[same]
        ahead, behind = ends.both(i, i + p)
        wanted = (ahead + behind >= (times - 1) * p) & (ahead + behind + p >= least)
        for root, start, length, q in zip(*(x[wanted].tolist() for x in (i, i - behind, ahead + behind + p, p))):
            found.setdefault((start, length, q), root)
    out = set()
    for (start, length, q), root in found.items():
        if not _is_run(ranks, start, length, q):
            start, length = _grown(ranks, root, q)
        if length >= max(least, times * q):
            out.add((start, length, q))
    return sorted(out)


def _stretches(codes: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Which items lie in a row of ``size`` items that the same document has twice; a superset where hashes meet."""
    n = len(codes) - size + 1
    covered = np.zeros(len(codes), bool)
    if n < 2:
        return covered
    odd, key = np.uint64(0x9E3779B97F4A7C15), (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    grams, have = key ^ (key >> np.uint64(29)), 1
    while have < size:
        step = min(have, size - have)
        grams = grams[:-step] * odd + (grams[step:] ^ (grams[step:] >> np.uint64(31)))
        have += step
    whole = doc[:n] == doc[size - 1 :]
    starts = np.flatnonzero(whole)
    key = grams[starts] * odd + doc[starts].astype(np.uint64)
    order = np.argsort(key)
    twice = key[order[1:]] == key[order[:-1]]
    hits = np.zeros(len(starts), bool)
    hits[order[1:][twice]] = hits[order[:-1][twice]] = True
    edges = np.zeros(len(codes) + 1, np.int32)
    edges[starts[hits]] += 1
    edges[starts[hits] + size] -= 1
    return np.cumsum(edges[:-1]) > 0


def _runs_by_document(codes: np.ndarray, offsets: np.ndarray, least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each document of a batch, whose items are ``codes[offsets[k] : offsets[k + 1]]``.

    A run has ``length - period`` items that come again one period on: at least
    ``least - least // times`` in a row for short periods and more for longer ones.
    Stretches of such rows therefore hold every run whole with its neighbours
    known, and only they are grouped; stretches are joined by items of their own.
    """
    n_docs = len(offsets) - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n_docs)]
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    covered = _stretches(codes, doc, least - least // times)
    if not covered.any():
        return out
    # A stretch begins where the item before is not covered or belongs to another document.
    begins = np.flatnonzero(covered & np.concatenate([[True], ~covered[:-1] | (doc[1:] != doc[:-1])]))
    stops = np.flatnonzero(covered & np.concatenate([~covered[1:] | (doc[1:] != doc[:-1]), [True]])) + 1
    lengths = stops - begins
    places = np.concatenate([[0], np.cumsum(lengths + 1)])
    joined = np.empty(places[-1], np.int64)
    top = int(codes.max()) + 1
    for k, (a, b) in enumerate(zip(begins, stops)):
        joined[places[k] : places[k + 1] - 1] = codes[a:b]
        joined[places[k + 1] - 1] = top + k
    for start, length, period in runs(joined, least, times, int(lengths.max())):
        k = int(np.searchsorted(places, start, "right")) - 1
        place = int(begins[k]) + start - int(places[k])
        out[doc[place]].append((place - int(offsets[doc[place]]), length, period))
    return out


def _slices(ends: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` words, or of one row."""
    out, a = [], 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        out.append((a, b))
        a = b
    return out


def periodic_runs(docs: DataFrame, words: Column | None = None, least: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` for every row: its periodic runs of words, and its words without the repetitions.

    A run is a stretch of words with smallest period q, of at least ``least`` words
    and ``times`` (two or more) periods, that no neighbouring word extends. ``runs``
    holds structs of ``start, length, period`` by start and period; ``collapsed``
    joins by one space the words that no run holds after its first period.
    ``words`` is an array column, by default the words of ``text_col``; null arrays
    and texts have no words and null words are empty ones. Whole texts are used;
    runs never cross rows; repeated rows are treated one by one; an empty table
    gives no rows; other columns are not read. Nothing is shuffled: a document is
    worked on where it lies, in time that grows with its length.
    """
    if times < 2 or least < 2 * times:
        raise ValueError("runs need two periods or more, and at least two words a period")
    column = F.coalesce(words_of(text_col) if words is None else words, F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.transform(column, lambda w: F.coalesce(w, F.lit(""))).alias("words") if words is not None else column.alias("words"))

    def find(batch: pa.RecordBatch) -> pa.Table:
        lists = batch.column("words")
        flat = lists.flatten()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        found, texts = [], []
        for a, b in _slices(ends, WORDS_AT_ONCE):
            some = flat.slice(ends[a], ends[b] - ends[a])
            offsets = ends[a : b + 1] - ends[a]
            codes = some.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(some) else np.zeros(0, np.int32)
            each = _runs_by_document(codes, offsets, least, times)
            edges = np.zeros(len(some) + 1, np.int32)
            for k, its in enumerate(each):
                for start, length, period in its:
                    edges[offsets[k] + start + period] += 1
                    edges[offsets[k] + start + length] -= 1
            keep = np.cumsum(edges[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(keep)])[offsets]
            kept = pa.ListArray.from_arrays(pa.array(left, pa.int32()), some.filter(pa.array(keep)))
            texts.append(pc.binary_join(kept, " "))
            found += [[{"start": s, "length": n, "period": q} for s, n, q in sorted(its, key=lambda r: (r[0], r[2]))] for its in each]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.table({"doc_id": batch.column("doc_id"), "runs": pa.array(found, kind), "collapsed": pa.chunked_array(texts, pa.string())})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, find, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def best_run(column: Column) -> Column:
    """The run of greatest length by period, compared exactly; ties by start, then period; null if there is none."""

    def before(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (x > y) | (x == y) & ((a["start"] < b["start"]) | (a["start"] == b["start"]) & (a["period"] < b["period"]))
        return F.when(earlier, F.lit(-1)).otherwise(F.lit(1))

    return F.get(F.array_sort(column, before), F.lit(0))
