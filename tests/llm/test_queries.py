"""The registered corpus queries on the smallest test tables."""

import collections
import pathlib
import random

import numpy as np
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from tests.llm.test_operators import brute_contamination, brute_runs, plain_fingerprint, plain_targets, texts
from tests.oracle import compare, connect
from tidemark.llm import decontaminate, quality, queries, repeats, runs, simhash, token_files, tokens, toxicity, vectors
from tidemark.llm.labelled import remainder

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name) is None


def test_all_are_registered():
    assert queries.QUERIES.keys() <= registered.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))


def test_pipeline_keeps_columns_and_takes_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == names, name
    docs = corpus_pipeline.stored(docs, "test-stage")
    assert 0 < docs.count() < before
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert mixed.columns == [*names, "copies"] and mixed.where("copies < 1 or copies > 3").count() == 0


COLUMNS = "doc_id long, text string, source string, lang string, n_chars long, n_lines string, n_removed string, score string, spans string"


def small_corpus():
    """Good and bad documents with repeated runs of lines, near copies, benchmark passages, nulls, empties and repeats."""
    draw = random.Random(41)
    good, shared = texts(31, 120, vocabulary=400, longest=60), texts(32, 6, vocabulary=300, longest=9)
    items = [(i, " ".join(f"item{i}word{k}" for k in range(15))) for i in range(3)]
    rows = []
    for i, t in enumerate(good):
        if i % 4 == 0:
            t = " | ".join(f"{w}%%%" for w in (t or "a").split()) + " | a%%%"
        if i % 7 == 1:
            a = draw.randint(0, 3)
            t += "\n" + "\n".join(f"line {x}" for x in shared[a : a + 3]) + f"\nown end {i}"
        if i % 11 == 2:
            t += " " + items[i % 3][1]
        rows.append((i, t, f"s{i % 3}" if i % 13 else None))
    long = " ".join(texts(33, 20, vocabulary=400, longest=60))
    rows += [(200, long, "s0"), (201, long + " end", "s1"), (202, long, "s1"), (203, None, "s0"), (204, "", None), (205, "x " * 8000, "s2"), (3, rows[3][1], "s0"), (None, rows[5][1], "s2")]
    labels = [(i, int(i % 4 != 0), 0) for i in range(120) if i % 3]
    return rows, items, labels


def folder_of(spark, path, rows, items, labels):
    spark.createDataFrame([(i, t, s, "en", len(t or ""), "x", "y", "z", "w") for i, t, s in rows], COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def plain_groups(rows):
    """The rows that stay of each group of near copies."""
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    a, b = zip(*[(i, j) for i in range(len(rows)) for j in range(len(rows)) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    return vectors._roots(np.array(a), np.array(b), len(rows)).tolist()


def test_pipeline_against_plain_stages(spark, tmp_path):
    rows, items, labels = small_corpus()
    folder = folder_of(spark, tmp_path, rows, items, labels)
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    def taken(name, docs):
        out = corpus_pipeline.stored(stages[name](spark, docs, folder), "test-stage")
        return out, [(r.doc_id, r.text, r.source) for r in out.collect()]

    good, kept = taken("quality classifier", docs)
    assert not collections.Counter(kept) - collections.Counter(rows) and good.columns == docs.columns
    held_out = {i for i in range(120) if i % 4 and i not in (203, 204)}
    assert len(held_out & {i for i, _, _ in kept}) > 0.9 * len(held_out) and sum(i is not None and i < 120 and i % 4 == 0 for i, _, _ in kept) <= 3

    lines, cleaned = taken("line dedup", good)
    distinct = {(i, t): None for i, t, _ in kept if t is not None}
    shortened = brute_runs(list(distinct))
    by_key = {(i, t): shortened[i][0] for i, t in distinct}
    assert collections.Counter(cleaned) == collections.Counter((i, by_key.get((i, t)) if t is not None else None, s) for i, t, s in kept)
    assert lines.columns == docs.columns and all(r.n_chars == len(r.text or "") and (r.n_lines, r.n_removed) == ("x", "y") for r in lines.collect())

    single, first = taken("simhash near-dedup", lines)
    roots = plain_groups(cleaned)
    smallest = {}
    for (i, _, _), root in zip(cleaned, roots):
        smallest[root] = min(smallest.get(root, 10**9), 10**9 if i is None else i)
    assert collections.Counter(i for i, _, _ in first) == collections.Counter(None if v == 10**9 else v for v in smallest.values())

    clean, pure = taken("benchmark decontamination", single)
    assert collections.Counter(pure) == collections.Counter(r for r in first if not brute_contamination(r[1], items)[3]) and len(pure) < len(first)

    mixed = stages["mixing to weights"](spark, clean, folder).collect()
    size, got = collections.Counter(), collections.Counter()
    for _, t, s in pure:
        size[s] += len((t or "").split())
    for r in mixed:
        got[r.source] += r.copies * len((r.text or "").split())
        assert 1 <= r.copies <= 3 and (r.doc_id, r.text, r.source) in pure
    targets = plain_targets(dict(size))
    largest = max(len((t or "").split()) for _, t, _ in pure)
    assert all(abs(got[s] - targets[s]) <= largest for s in size)
    again = corpus_pipeline.run(spark, folder)
    assert collections.Counter((r.doc_id, r.text, r.copies) for r in again.collect()) == collections.Counter((r.doc_id, r.text, r.copies) for r in mixed)


def test_stages_and_operators_on_an_empty_table(spark, tmp_path):
    folder = folder_of(spark, tmp_path, [], [(1, "a b c")], [(1, 1, 0), (2, 0, 1)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and set(docs.columns) <= set(out.columns), name
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert quality.quality_scores(docs, quality.fit_ranking(docs, labels, remainder("doc_id", 4) != 2)).count() == 0
    assert toxicity.toxicity_scores(docs, toxicity.fit_detector(docs, labels, remainder("doc_id", 3) != 1)).count() == 0
    for found in (decontaminate.contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")), simhash.near_duplicates(docs), repeats.remove_repeats(docs), runs.periodic_runs(docs)):
        assert found.count() == 0
    public = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    assert tokens.token_counts(docs, public).count() == token_files.token_file_index(docs, public).count() == 0


def test_line_stage_without_a_column_of_lengths(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a\nb\nc", "k"), (2, "a\nb\nd", "k")], "doc_id long, text string, n_removed string")
    out = corpus_pipeline.distinct_lines(spark, docs, "")
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == [(1, "a\nb\nc", "k"), (2, "d", "k")]


def test_repeated_rows_get_equal_scores(spark, tmp_path):
    rows, items, labels = small_corpus()
    docs = spark.createDataFrame(rows + rows[:40], "doc_id long, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality.quality_scores(docs, quality.fit_ranking(docs, marks, remainder("doc_id", 4) != 2)).collect()
    found = collections.defaultdict(set)
    for r in scored:
        found[r.text].add(r.score)
    assert len(scored) == len(rows) + 40 and all(len(s) == 1 for s in found.values())
