"""The operators applied to whole test tables, and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_chunks, mixing, pages, quality, repeats, runs, simhash, token_files, tokens, toxicity, vectors, whitening
from tidemark.llm.labelled import remainder

#: Labels with this remainder of the crc32 of their id are never learned from: (parts, held out).
QUALITY_FOLD, TOXIC_FOLD = (4, 2), (3, 1)
WEIGHTS = [5.0, 2.0, 1.0]
VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    names = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", names.alias("items_sha256"), "contaminated")


def op2_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicate_vectors(_table(spark, folder, "embeddings"))


def _scored(scores: DataFrame, fold: tuple[int, int]) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", fold[0]) == fold[1], F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ranking = quality.fit_ranking(docs, _table(spark, folder, "labels"), remainder("doc_id", QUALITY_FOLD[0]) != QUALITY_FOLD[1])
    return _scored(quality.quality_scores(docs, ranking), QUALITY_FOLD)


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_report(_table(spark, folder, "documents"), WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(_table(spark, folder, "pages"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    detector = toxicity.fit_detector(docs, _table(spark, folder, "labels"), remainder("doc_id", TOXIC_FOLD[0]) != TOXIC_FOLD[1])
    return _scored(toxicity.toxicity_scores(docs.select("doc_id", "text"), detector), TOXIC_FOLD)


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, folder, "documents"))
    # What is left, to be read as well; a character that a cut goes through is shown as U+FFFD.
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", text)


def op9_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_chunks.drop_repeated_runs(_table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def _folded(docs: DataFrame) -> Column:
    """The words of each document, periodic from some word on where the crc32 of the id is a multiple of ten."""
    words, n = F.col("words"), F.size("words")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = (h - h % 10) / 10
    a = (g % F.when(n > 0, n)).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turned = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))
    return F.when((h % 10 == 0) & (n > 0), turned).otherwise(words)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", runs.words_of("text").alias("words"))
    found = runs.periodic_runs(docs, _folded(docs))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", runs.best_run(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_file_index(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(_table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontamination, op2_near_vectors, op3_quality, op4_simhash, op5_mixing, op6_main_text,
        op7_toxicity, op8_repeats, op9_line_chunks, op10_token_counts,
        op11_periodic_runs, op12_token_files, op13_whitening, pipeline)
}

ORACLES: dict[str, str] = {
    "op1_decontamination": r"""
        WITH d AS (
            SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM documents
        ), b AS (
            SELECT item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM benchmark
        ), starts AS (
            SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM b WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s : s + 12], ' ') AS gram FROM starts
        ), sizes AS (SELECT DISTINCT size FROM windows
        ), places AS (
            SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d CROSS JOIN sizes WHERE len(w) >= size
        ), hits AS (
            SELECT doc_id, item_id, s, places.size AS size FROM places JOIN windows
            ON places.size = windows.size AND array_to_string(w[s : s + places.size - 1], ' ') = gram
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op2_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT vec_id, vec_id AS other FROM v
            UNION
            SELECT reach.vec_id, links.b AS other FROM reach JOIN links ON reach.other = links.a
        ), components AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
        ), counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM components LEFT JOIN counts USING (vec_id)
    """,
}
