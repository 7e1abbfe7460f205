"""Benchmark decontamination: windows of test items looked up in a broadcast table while documents are scanned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, lower_ascii, numbered, row_key, text_or_empty, with_row_key

#: What separates words once A-Z are in lower case: ASCII without digits and small letters.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The windows are broadcast up to this number and this many characters, else joined by a shuffle.
BROADCAST_WINDOWS, BROADCAST_CHARS = 500_000, 64_000_000


def words_of(text: Column) -> Column:
    """The words of a text in lower case; none for null."""
    return F.array_remove(F.split(lower_ascii(text_or_empty(text)), BREAK), "")


def _at(array: str, start: Column, length: int) -> list[Column]:
    return [F.get(F.col(array), start + k) for k in range(length)]


def item_windows(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(length, window, gram, items): every distinct window with the sorted ids of the items that hold it.

    An item of fewer than ``n`` words is one window, one without words is none.
    Items without an id give windows, but no name.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - n, F.lit(0)))
    windows = items.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start") + 1, n).alias("window"))
    return windows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        F.size("window").alias("length"), F.array_join("window", " ").alias("window"),
        F.xxhash64(F.transform("window", lambda w: F.xxhash64(w))).alias("gram"), "items", F.xxhash64("items").alias("item_set"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What each document shares with the benchmark, one row per document.

    Columns: ``doc_id``, ``row_key`` (digest of id and text), ``n_words``, ``spans``
    (start and end of each window found, in words), ``n_hit`` (words inside any
    of them), ``item_ids`` (sorted as strings), ``n_items``, ``contaminated``
    (some word is hit, and at least one in ``one_in`` of all).

    Words are hashed once; a scan over the starts of each document combines the
    hashes of a window, looks them up in the broadcast windows and compares the
    words themselves. Only found windows and one row per document are shuffled.
    Of more windows than may be broadcast the hashes are joined instead. A null text has no words; an empty benchmark hits nothing; rows equal in id
    and text get equal results; other columns are not read.
    """
    windows = item_windows(benchmark, n).select(*(F.col(c).alias(f"w_{c}") for c in ("length", "window", "gram", "items", "item_set")))
    lengths, count, chars = windows.agg(
        F.array_sort(F.collect_set("w_length")), F.count("*"), F.coalesce(F.sum(F.length("w_window")), F.lit(0))).first()
    small = count <= BROADCAST_WINDOWS and chars <= BROADCAST_CHARS
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), words_of(F.col(text_col)).alias("words")).select(
        "doc_id", "row_key", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"), F.size("words").alias("n_words"))
    lengths = lengths or [n]
    found = _scanned(rows, windows, lengths) if small else _joined(rows, windows, lengths)
    return found.select(
        "doc_id", "row_key", "n_words", "spans", "n_hit", "item_ids", F.size("item_ids").cast("long").alias("n_items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated"))


def _covered(spans: str) -> Column:
    """The number of words in sorted spans that may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("hit"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        F.greatest(a["reach"], s["end"]).alias("reach"),
        (a["hit"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(a["reach"], s["start"]))).alias("hit")))["hit"]


def _with_grams(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """A row per start and window length, with the ``gram`` of the words there; null where the document is too short.

    One start more than there are words: the last one stands for the document itself.
    """
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n_words"))).alias("start"))
    start = F.col("start")

    def gram(length: int) -> Column:
        return F.when(start + length <= F.col("n_words"), F.xxhash64(*_at("hashes", start, length)))

    if len(lengths) == 1:
        return rows.withColumn("length", F.lit(lengths[0])).withColumn("gram", gram(lengths[0]))
    return rows.select("*", F.explode(F.array(*(F.struct(F.lit(k).alias("length"), gram(k).alias("gram")) for k in lengths))).alias("g")).select(
        *rows.columns, "g.length", "g.gram")


def _joined(rows: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """What ``_scanned`` finds, for any number of windows.

    Starts travel as row key, place and hash, without a word; where a hash is
    that of a window, the document is met again and its words are compared.
    """
    at = _with_grams(rows, lengths).where(F.col("gram").isNotNull()).select("row_key", "start", "length", "gram")
    met = at.join(windows.select("w_length", "w_gram", "w_window", "w_item_set"), (F.col("gram") == F.col("w_gram")) & (F.col("length") == F.col("w_length")))
    maybe = met.groupBy("row_key").agg(F.collect_set(F.struct("start", "length", "w_window", "w_item_set")).alias("maybe"))

    def same(m: Column) -> Column:
        return F.array_join(F.slice(F.col("words"), m["start"] + 1, m["length"]), " ") == m["w_window"]

    def verified(how: str) -> DataFrame:
        return rows.select("doc_id", "row_key", "words", F.col("n_words").cast("long").alias("n_words")).join(maybe, "row_key", how).withColumn(
            "hits", F.filter(F.coalesce("maybe", F.array()), same))

    span = F.transform("hits", lambda m: F.struct(m["start"].cast("long").alias("start"), (m["start"] + m["length"]).cast("long").alias("end")))
    named = verified("inner").select("row_key", F.explode(F.transform("hits", lambda m: m["w_item_set"])).alias("w_item_set")).distinct()
    named = named.join(windows.select("w_item_set", "w_items").dropDuplicates(["w_item_set"]), "w_item_set").groupBy("row_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("w_items")))).alias("item_ids"))
    each = verified("left").select("doc_id", "row_key", "n_words", F.array_sort(F.array_distinct(span)).alias("spans"))
    return each.join(named, "row_key", "left").select(
        "doc_id", "row_key", "n_words", "spans", _covered("spans").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def _scanned(rows: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits by a scan with the windows at hand; only hits and one row per document are shuffled."""
    rows, start = _with_grams(rows, lengths), F.col("start")
    # get() gives null past the last word, which concat_ws skips; the length is compared too.
    same = F.concat_ws(" ", *(F.when(F.lit(k) < F.col("length"), F.get("words", start + k)) for k in range(max(lengths))))
    last = start == F.col("n_words")
    found = rows.join(
        F.broadcast(windows.select("w_length", "w_window", "w_gram", "w_item_set")),
        (F.col("gram") == F.col("w_gram")) & (F.col("length") == F.col("w_length")) & (F.col("w_window") == same), "left",
    ).where(F.col("w_gram").isNotNull() | last)
    span = F.when(F.col("w_gram").isNotNull(), F.struct(start.cast("long").alias("start"), (start + F.col("length")).cast("long").alias("end")))
    per_doc = found.groupBy("doc_id", "row_key").agg(
        F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_set(span)).alias("spans"),
        F.collect_set("w_item_set").alias("sets"),
        F.sum(F.when(last & (F.col("length") == lengths[0]), 1).otherwise(0)).alias("n_rows"))
    sets = windows.select("w_item_set", "w_items").dropDuplicates(["w_item_set"])
    per_doc = per_doc.select("doc_id", "row_key", "n_words", "n_rows", "spans", _covered("spans").alias("n_hit"), F.explode_outer("sets").alias("w_item_set")).join(
        F.broadcast(sets), "w_item_set", "left").groupBy("doc_id", "row_key").agg(
        *(F.first(c).alias(c) for c in ("n_words", "n_rows", "spans", "n_hit")),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("w_items")))).alias("item_ids"))
    return per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text", remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or with ``remove="spans"`` without the words of found windows.

    Span removal rewrites only the texts with a hit: their remaining words, in
    lower case, joined by spaces. Columns and their order stay.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    names = docs.columns
    docs, id_col, text_col = numbered(docs, id_col, text_col)
    report = contamination(docs, benchmark, n, one_in, id_col, text_col)
    hit = report.where("contaminated" if remove == "documents" else "n_hit > 0").select(
        F.col("row_key").alias(ROW), F.col("spans").alias("__spans")).dropDuplicates([ROW])
    keyed = with_row_key(docs, id_col, text_col)
    if remove == "documents":
        return keyed.join(hit.select(ROW), ROW, "left_anti").select(*docs.columns).toDF(*names)
    joined = keyed.join(hit, ROW, "left")
    kept = F.filter(words_of(F.col(text_col)), lambda w, i: ~F.exists("__spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    cleaned = F.when(F.col("__spans").isNotNull(), F.array_join(kept, " ")).otherwise(F.col(text_col))
    return joined.select(*(cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns)).toDF(*names)
