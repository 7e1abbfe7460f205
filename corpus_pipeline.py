"""From raw documents to a training mix: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, stored
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.labelled import remainder
from tidemark.llm.line_chunks import drop_repeated_runs
from tidemark.llm.mixing import mix
from tidemark.llm.quality import fit_ranking, keep_good
from tidemark.llm.queries import QUALITY_FOLD, WEIGHTS
from tidemark.llm.simhash import drop_near_duplicates


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject; it is fitted on labelled rows of these documents.

    A null text counts as an empty one and is scored like any other; equal texts
    get equal scores, so repeated rows stay or go together; a score at the cut
    stays. An empty table gives an empty one. All columns stay, whatever their
    names.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    ranking = fit_ranking(docs, labels, remainder("doc_id", QUALITY_FOLD[0]) != QUALITY_FOLD[1])
    return keep_good(docs, ranking)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with repeated runs of lines left only where they occur first; ``n_chars`` follows a shortened text.

    First is the smallest id, null last, of equal ids the smallest digest of id and
    text; rows equal in both count as one and keep their lines. Null texts stay
    null and empty ones empty, also texts that lose all lines. Whole texts are
    read, of any length. A table without ``n_chars`` gets none; all other columns
    stay as they are, whatever their names.
    """
    plain, id_col, text_col = numbered(docs, "doc_id", "text")
    cleaned = drop_repeated_runs(plain, id_col, text_col)
    shorter = F.when(F.col("n_removed") > 0, F.char_length(text_col).cast("long"))
    return cleaned.select(*(
        (F.coalesce(shorter, F.col(c)) if name == "n_chars" else F.col(c)).alias(name) for name, c in zip(docs.columns, plain.columns)))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, two bits.

    The smallest id of a group stays, null last; of repeated rows one. Texts
    without words, null ones among them, share the fingerprint zero and are one
    group. All columns stay, whatever their names.
    """
    return drop_near_duplicates(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text.

    Null and empty texts have no words and stay; repeated rows stay or go
    together; an empty benchmark takes nothing. All columns stay, whatever their
    names.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies``: how often each is taken.

    Documents without words have size 0 and bring no source nearer to its target;
    a null source is one of its own; rows equal in source, id and text share one
    decision. A column ``copies`` of the documents is replaced; the other columns
    stay, whatever their names.
    """
    return mix(docs, WEIGHTS)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", distinct_lines),
    ("simhash near-dedup", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("mixing to weights", mixed_documents),
]

#: No SQL: the ranking, the rolling hashes, XXH64 and the cube method have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage-{number + 1}")
    return docs
