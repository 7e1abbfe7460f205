"""Reviews played by documents, and by events where a score and a date are needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import most_frequent
from tidemark.plans import reviews as r
from tidemark.plans.census import with_age_group
from tidemark.registry import Tables, query

# The characters that cleaning drops, as a class that DuckDB's regular expressions take.
PATTERN_SQL = (
    r"[^a-zA-Zа-яА-ЯёЁ0-9\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,!?;:()\"''-]"
)


def _reviews(t: Tables) -> DataFrame:
    """Documents with a gap where the language is not English, to be filled."""
    return t.documents.select(
        "doc_id", F.when(F.col("lang") == "en", F.col("source")).alias("at"), F.col("text").alias("content")
    )


@query("Q39_clean_reviews", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN lang = 'en' THEN source ELSE '-' END AS "at",
       regexp_replace(coalesce(text, '-'), '{PATTERN_SQL}', '', 'g') AS content
FROM documents ORDER BY 2
""")
def q39(t):
    return r.clean(_reviews(t))


@query("Q40_frequent_contents", """
SELECT text, count(*) AS "count" FROM documents GROUP BY text ORDER BY count(*) DESC, min(doc_id) LIMIT 5
""")
def q40(t):
    return most_frequent(t.documents, "text", "doc_id", 5)


@query("Q41_short_contents", "SELECT doc_id, text AS content FROM documents WHERE length(coalesce(text, '')) < 20")
def q41(t):
    return r.short_contents(t.documents.select("doc_id", F.col("text").alias("content")), 20)


@query("Q41_short_count", "SELECT count(*) AS n FROM documents WHERE length(coalesce(text, '')) < 20")
def q41_count(t):
    return r.short_contents(t.documents, 20, "text").agg(F.count(F.lit(1)).alias("n"))


@query("Q42_score_by_day", """
SELECT strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 6) AS avg_score FROM events GROUP BY 1 ORDER BY 1
""")
def q42(t):
    return r.score_by_day(t.events, "ts", "value").select("day", F.round("avg_score", 6).alias("avg_score"))


@query("G09_text_and_band", f"""
SELECT doc_id, regexp_replace(source || '#' || lang, '{PATTERN_SQL}', '', 'g') AS clean,
       CASE WHEN n_chars BETWEEN 16 AND 35 THEN 'young' WHEN n_chars > 35 AND n_chars <= 70 THEN 'adult'
            WHEN n_chars > 70 AND n_chars <= 100 THEN 'retiree' ELSE 'unknown' END AS "AgeGroup"
FROM documents
""")
def g09(t):
    marked = t.documents.select("doc_id", F.concat("source", F.lit("#"), "lang").alias("content"), "n_chars")
    return with_age_group(r.stripped(marked), "n_chars").select("doc_id", F.col("content").alias("clean"), "AgeGroup")
