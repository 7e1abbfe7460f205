"""The operators against brute force on small tables with nulls, ties, repeats, long texts and clashing columns."""

import collections
import gc
import hashlib
import pathlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import decontaminate, line_chunks, mixing, pages, quality, queries, repeats, simhash, tokens, toxicity, vectors
from tidemark.llm.components import connected_components
from tidemark.llm.labelled import remainder
from tidemark.session import job_folder

DOCS = "doc_id long, text string, source string, lang string, n_chars long, __spans string, score double, n_removed long, copies long"


def make_docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, None, None, "x", 0.1, 5, 9) for i, t, s in rows], DOCS).repartition(3)


def texts(seed, n, vocabulary=60, longest=120):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé ñ".replace(" ", "")) for _ in range(draw.randint(1, 6))) for _ in range(vocabulary)]
    return [" ".join(draw.choice(words) for _ in range(draw.randint(0, longest))) for _ in range(n)]


def corpus(seed=1):
    base = texts(seed, 30)
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100, None, None), (101, "", "s0"), (102, "  \n\t ", "s0"), (None, base[3], "s1"), (5, base[5], "s2"), (5, base[6], "s2"), (103, "word " * 5000, "s1"), (104, base[7], None)]
    return rows


# 1 ---------------------------------------------------------------------------------------------------------------

def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_contamination(text, items, n=13):
    words, hit, found = plain_words(text), set(), set()
    for item, body in items:
        body = plain_words(body)
        for s in range(max(len(body) - n, 0) + 1) if body else ():
            window = body[s : s + n]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("with_items, most", [(True, 500_000), (False, 500_000), (True, -1), (False, -1)])
def test_contamination_equals_brute_force(spark, monkeypatch, with_items, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    base = texts(4, 4, longest=40)
    items = [(1, base[0]), (20, base[0]), (3, base[1]), (4, "Short, item!"), (5, None), (6, " .. "), (None, base[2])] if with_items else []
    rows = corpus() + [(200, f"x {base[0]} y SHORT item z", "s0"), (201, base[1], "s0"), (202, " q ".join(texts(5, 9)) + " short-item " + " r " * 300, "s0"), (203, base[2], "s0")]
    docs, bench = make_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    want = collections.Counter((i, *brute_contamination(t, items)[:2], tuple(brute_contamination(t, items)[2]), brute_contamination(t, items)[3]) for i, t, _ in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got) == want
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter((i, t) for i, t, _ in rows if not brute_contamination(t, items)[3])
    spans = {(r.doc_id, r.text) for r in decontaminate.decontaminate(docs, bench, remove="spans").collect()}
    assert len(spans) == len({(i, t) for i, t, _ in rows}) or with_items
    assert not with_items or (201, "") in spans


def test_many_windows_meet_no_words_in_an_exchange(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", -1)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts(4, 20, longest=60))], "item_id long, text string")
    docs = make_docs(spark, [(i, t * (1 + i % 2), "s") for i, t in enumerate(texts(4, 20, longest=60))] + [(99, "word " * 20_000, "s")])
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    found = decontaminate.contamination(docs, items)
    assert {r.doc_id: r.n_items for r in found.collect()}[99] == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    starts = [line for line in plan.splitlines() if "Generate explode(sequence(0" in line]
    assert starts and decontaminate.contamination(docs.limit(0), items).count() == 0
    physical = found._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [physical[k + 1] for k, line in enumerate(physical) if "Exchange hashpartitioning(gram" in line]
    assert dealt and all("words" not in line.split("Project")[-1] for line in dealt if "Project" in line)


# 2 ---------------------------------------------------------------------------------------------------------------

def test_near_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 12))
    rows = [(i, (centres[i % 40] + draw.normal(scale=0.05 if i % 3 else 0.6, size=12)).tolist(), 1) for i in range(400)]
    rows += [(500 + i, rows[7][1], 1) for i in range(30)]
    odd = [(900, None), (901, []), (902, [0.0] * 12), (903, [float("nan")] * 12), (904, [None] + [1.0] * 11), (905, [float("inf")] + [1.0] * 11), (906, [1.0, 2.0])]
    rows += [(i, v, 1) for i, v in odd]
    got = {r.vec_id: r for r in vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int").repartition(4)).collect()}
    sound = [(i, np.array(v)) for i, v, _ in rows if i < 900]
    x = np.array([v / np.linalg.norm(v) for _, v in sound])
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    roots = vectors._roots(*np.nonzero(near), len(sound))
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(sound):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[k].sum(), sound[roots[k]][0], i == sound[roots[k]][0])
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)
    assert vectors.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def planted_vectors(n, seed):
    """Pairs, chains and groups whose cosines lie close to both sides of the threshold, among random vectors."""
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)

    def turned(v, cosine):
        other = draw.normal(size=32)
        other -= (other @ v) * v
        return cosine * v + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)

    out = list(base)
    for k, cosine in enumerate([0.9501, 0.9499, 0.951, 0.949, 0.97, 0.93, 0.99, 0.95001] * (n // 40)):
        out.append(turned(base[k], cosine))
    chain = base[-1]
    for _ in range(60):
        out.append(chain := turned(chain, 0.955))
    out += [turned(base[-2], 0.985) for _ in range(100)]
    return [out[i].tolist() for i in draw.permutation(len(out))]


@pytest.mark.parametrize("shard_rows, asking, shards", [(700, 600, 4)])
def test_planted_pairs_near_the_threshold(spark, monkeypatch, shard_rows, asking, shards):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(vectors, "ASKING", asking)
    monkeypatch.setattr(vectors, "SHARDS", shards)
    rows = list(enumerate(planted_vectors(2000, 11)))
    got = {r.vec_id: r for r in vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    roots = vectors._roots(*np.nonzero(near), len(rows))
    assert near.sum() > 500
    assert [(got[i].n_links, got[i].component_id) for i, _ in rows] == [(near[i].sum(), roots[i]) for i, _ in rows]


def test_no_row_holds_a_shard_and_large_components_are_whole(spark, monkeypatch):
    """Shards and blocks travel as names of files: rows with whole shards, copied for every block, cost an executor its memory."""
    for name, value in (("SHARD_BYTES", 10_000), ("ASKING", 64), ("COUNTED", 40), ("LINKS_AT_ONCE", 500), ("TILE", 100), ("TASKS", 7)):
        monkeypatch.setattr(vectors, name, value)
    draw = np.random.default_rng(8)
    x = np.concatenate([draw.normal(size=(600, 16)), draw.normal(size=16) + draw.normal(scale=0.1, size=(300, 16))]).astype(np.float32)
    x[1:900:9], x[2] = 2 * x[::9], -0.0 * x[2]
    x[2, 0] = 1.0
    rows = [(str(i), v.tolist()) for i, v in enumerate(x)] + [("a", x[700].tolist()), ("b", x[700].tolist()), ("c", None), ("d", [0.0] * 16), (None, x[701].tolist()), ("e", [1.0]), ("f", [2.0])]
    with job_folder(spark, "vectors") as folder:
        got = vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id string, embedding array<float>").repartition(3)).collect()
        tables = [spark.read.parquet(str(t)) for t in pathlib.Path(folder).iterdir() if any(t.glob("*.parquet"))]
        files = [f for name in ("vector-shards", "vector-blocks") for f in pathlib.Path(folder).glob(f"{name}*/*") if not f.name.startswith(".")]
    assert len(tables) >= 4 and all(f.dataType.typeName() not in ("binary", "array") for t in tables for f in t.schema)
    assert len(files) > 16
    sound = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and any(v)]
    wide = [k for k, (_, v) in enumerate(sound) if len(v) == 16]
    u = np.array([sound[k][1] / np.linalg.norm(sound[k][1]) for k in wide])
    near = np.zeros((len(sound), len(sound)), bool)
    near[np.ix_(wide, wide)] = u @ u.T >= 0.95
    near[-2:, -2:] = True  # one component each, in the same direction
    np.fill_diagonal(near, False)
    roots = vectors._roots(*np.nonzero(near), len(sound))
    heads = [min((i for (i, _), r in zip(sound, roots) if r == root and i is not None)) for root in roots]
    want = collections.Counter((i, int(n), head, i == head) for (i, _), n, head in zip(sound, near.sum(axis=1), heads))
    want.update([("c", 0, "c", True), ("d", 0, "d", True)])
    assert near.sum(axis=1).max() > 250
    assert collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want


def test_different_vectors_with_one_hash(spark, monkeypatch):
    whole = vectors._node
    monkeypatch.setattr(vectors, "_node", lambda v, seed: whole(v, seed) if seed else pages.F.lit(7).cast("long"))
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, [1.0, 0.01])]
    got = vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 2, 1), (2, 0, 2), (3, 2, 1), (4, 2, 1)]
    monkeypatch.setattr(vectors, "_node", lambda v, seed: pages.F.lit(7).cast("long"))
    with pytest.raises(RuntimeError):
        vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))


def test_graph_finds_what_a_full_scan_finds():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(6000, 24))
    x[3000:] = x[:3000] + draw.normal(scale=0.1, size=(3000, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True))[draw.permutation(6000)].astype(np.float32)
    graph = vectors.Graph(x)
    found = graph.audited_links(x[:512], 0.95)
    exact = [set(np.flatnonzero(row).tolist()) for row in x[:512] @ x.T >= 0.95]
    assert sum(len(e & set(f.tolist())) for e, f in zip(exact, found)) >= 0.99 * sum(map(len, exact))


def test_audit_takes_no_missed_link(monkeypatch):
    draw = np.random.default_rng(6)
    x = np.repeat(draw.normal(size=(200, 24)), 10, axis=0) + draw.normal(scale=0.01, size=(2000, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph, whole = vectors.Graph(x), vectors.Graph.links_of
    beams = []

    def narrow(self, queries, cosine, beam):
        beams.append(beam)
        found = whole(self, queries, cosine, 4 * len(x))
        return [f[:-1] if beam < 128 and k == 0 else f for k, f in enumerate(found)]

    monkeypatch.setattr(vectors.Graph, "links_of", narrow)
    graph.audited_links(x, 0.95)
    assert beams[-1] == 128
    beams.clear()
    alone = np.linalg.qr(draw.normal(size=(24, 24)))[0].astype(np.float32)
    found = vectors.Graph(alone).audited_links(alone, 0.95, np.arange(24))
    assert not beams and [f.tolist() for f in found] == [[i] for i in range(24)]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (7, 5), (None, 3), (50, 49)] + [(i, i + 1) for i in range(100, 140)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 4, 49: 49, 50: 49} | {i: 100 for i in range(100, 141)}
    assert connected_components(edges.limit(0)).count() == 0


# 3 and 7 ---------------------------------------------------------------------------------------------------------

def scored_corpus(spark, bad):
    draw = random.Random(3)
    good = texts(8, 300, vocabulary=400, longest=80)
    rows = [(i, bad(t, draw) if i % 4 == 0 else t, "s") for i, t in enumerate(good)] + [(1000, None, None), (1001, "", None)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(300)] + [(7777, 1, 1), (None, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    return rows, make_docs(spark, rows), labels


def test_quality_on_held_out_rows(spark):
    rows, docs, labels = scored_corpus(spark, lambda t, draw: " | ".join(f"{w}%%%" for w in (t or "a").split()) + " | a%%%")
    model = quality.fit_ranking(docs, labels, remainder("doc_id", 4) != 2)
    scores = quality.quality_scores(docs, model)
    assert set(scores.columns) == set(docs.columns)
    held = [r for r in scores.withColumn("held", remainder("doc_id", 4) == 2).collect() if r.held and r.doc_id < 300 and r.text]
    assert len(held) > 40 and sum((r.score >= 0.7) == (r.doc_id % 4 != 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in scores.collect()) and scores.count() == len(rows)
    kept = {r.doc_id for r in quality.keep_good(docs, model).collect()}
    assert kept == {r.doc_id for r in scores.collect() if r.score >= 0.7}
    assert quality.fit_ranking(docs, labels.limit(0), remainder("doc_id", 4) != 2) is None
    assert quality.keep_good(docs, None).count() == len(rows)


def test_toxicity_on_held_out_rows_and_unseen_spellings(spark):
    def insult(t, draw):
        return f"{t} {draw.choice(['krumple', 'krumplex', 'krumpled', 'Krumple!'])} {draw.choice(['zobbit', 'zobbits'])} b"
    rows, docs, labels = scored_corpus(spark, insult)
    model = toxicity.fit_detector(docs, labels, remainder("doc_id", 3) != 1)
    scores = toxicity.toxicity_scores(docs, model)
    held = [r for r in scores.withColumn("held", remainder("doc_id", 3) == 1).collect() if r.held and r.doc_id < 300]
    assert len(held) > 60 and sum((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in scores.collect()) and scores.count() == len(rows)
    long = " ".join(texts(9, 40, vocabulary=400, longest=80))
    unseen = toxicity.toxicity_scores(make_docs(spark, [(1, f"{long} krumplexx zobbitt {long}", ""), (2, long, "")]), model).collect()
    assert {r.doc_id: r.score >= 0.7 for r in unseen} == {1: True, 2: False}
    assert {r.score for r in toxicity.toxicity_scores(docs, None).collect()} == {0.5}


# 4 ---------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("paired", [256, 2])
def test_simhash_equals_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rows = corpus() + [(300 + k, " ".join(w for i, w in enumerate(texts(11, 1, longest=900)[0].split()) if i != 7 * k), "s") for k in range(12)]
    got = simhash.near_duplicates(make_docs(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    a, b = zip(*[(i, j) for i in range(len(rows)) for j in range(len(rows)) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    roots = vectors._roots(np.array(a), np.array(b), len(rows)).tolist()
    lowest = {}
    for (i, _, _), root in zip(rows, roots):
        if i is not None:
            lowest[root] = min(i, lowest.get(root, i))
    want = collections.Counter((i, f"{p:016x}", lowest.get(root)) for (i, _, _), p, root in zip(rows, prints, roots))
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.drop_near_duplicates(make_docs(spark, rows))
    assert kept.columns == make_docs(spark, rows).columns and kept.count() == len(set(roots))


# 5 ---------------------------------------------------------------------------------------------------------------

def plain_targets(sizes, weights=(5.0, 2.0, 1.0), most=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
        open_ -= over
        left = float(sum(sizes.values())) - sum(target.values())
    return target


@pytest.mark.parametrize("block", [4096, 16])
def test_mix_comes_near_its_targets(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 100_000 if block > 1_000 else 0)
    rows = [(i, t, f"s{min(i % 7, 3)}" if i % 11 else None) for i, t in enumerate(texts(21, 600))] + [(7000, None, "none"), (3, texts(21, 600)[3], "s3"), (7001, "a b", "rare")]
    got = mixing.mix_report(make_docs(spark, rows), [5.0, 2.0, 1.0]).collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    targets = plain_targets(dict(size))
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == size[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
    assert len(got) == len(rows)
    assert all(abs(taken[s] - targets[s]) <= max(12, 0.01 * targets[s]) for s in size)
    again = mixing.mix_report(make_docs(spark, rows[::-1]).repartition(7), [5.0, 2.0, 1.0]).collect()
    assert collections.Counter((r.doc_id, r.source, r.taken) for r in got) == collections.Counter((r.doc_id, r.source, r.taken) for r in again)
    mixed = mixing.mix(make_docs(spark, rows), [5.0, 2.0, 1.0])
    assert sum(r.copies for r in mixed.collect()) == sum(r.copies for r in got)
    assert mixing.mix_report(make_docs(spark, rows).limit(0), [1.0]).count() == 0


# 6 ---------------------------------------------------------------------------------------------------------------

def page(i, article):
    return (f'<!DOCTYPE html><html><head><title>T{i}</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li>Home<li>News {i}</ul></nav>'
            f'<div class="cookie-notice">We use cookies</div><div class="ad">Buy {i}!</div>{article}<aside>See also {i}</aside><form><input><button>Go</button></form>'
            f'<section id="comments"><p>nice {i}</p></section><footer>&copy; x {i}</footer></body></html>')


def test_main_text(spark):
    rows = [(i, f"http://a.example/{i}", page(i, f"<article><h1>Head &amp; {i}</h1><p><b>One\n  two{i}<br><p>A&#233;&nbsp;b</p><div class='share'>Share</div><p>Last {i}</article>")) for i in range(9)]
    rows += [(20, "http://b.example/1", page(20, "<div class=story><p>Alone one.</p><p>Alone <i>two</i> here.</div>")), (21, None, None), (22, "http://c", ""), (23, "http://c", "<p>open <b"), (None, "x", "<p>a<p>b")]
    rows += [rows[0]]
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", pages.F.lit(1)).repartition(4)).collect())
    want = [(i, f"Head & {i}\nOne two{i}\nAé b\nLast {i}") for i in range(9)] + [(20, "Alone one.\nAlone two here."), (21, ""), (22, ""), (None, "a\nb"), (0, "Head & 0\nOne two0\nAé b\nLast 0")]
    assert collections.Counter({k: v for k, v in got.items() if k[0] != 23}) == collections.Counter((i, t, len(t)) for i, t in want)
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_is_what_most_pages_share():
    story = "<div><div><p>Text number {0} of the page, long enough.</p><p>More {0} of it here.</p></div><div><p>Always the same slogan</p></div></div>"
    trees = [pages.parse(f"<body>{story.format(i)}</body>") for i in range(6)]
    templates = pages.induce(trees)
    assert [pages.extract(t, some) for t, some in zip(trees, templates)] == [f"Text number {i} of the page, long enough.\nMore {i} of it here." for i in range(6)]


def main_texts(bodies):
    trees = [pages.parse(f"<body>{b}</body>") for b in bodies]
    return [pages.extract(t, some) for t, some in zip(trees, pages.induce(trees))]


def test_content_is_what_varies_not_what_is_called_article():
    cards = "<article><p>Card {0}</p></article><article><p>Other card {0}</p></article>"
    got = main_texts([f"<div class=story><p>Story {i} as long as it is.</p><p>Our slogan</p></div>{cards.format(i)}<p>Always here</p>" for i in range(6)])
    assert got == [f"Story {i} as long as it is.\nCard {i}\nOther card {i}" for i in range(6)]
    assert main_texts(["<div>Welcome</div><main><p>Long enough to be the page.</p></main>"]) == ["Long enough to be the page."]
    got = main_texts([f"<article><h1>Head {i}</h1><p>Text {i}</p><p>Quoted by all</p><p>More {i}</p><p>Read us daily</p></article>" for i in range(5)])
    assert got == [f"Head {i}\nText {i}\nQuoted by all\nMore {i}" for i in range(5)]
    got = main_texts([f"<article><h1>Copied</h1><p>The same long text on all pages of the host.</p><p>Edit {i}</p></article>" for i in range(5)])
    assert got == [f"Copied\nThe same long text on all pages of the host.\nEdit {i}" for i in range(5)]


def test_small_slots_are_content_too():
    lead = "<div class=post><div class=lead><p>Lead {0}.</p></div><div class=body><p>Body {0} " + "of some length " * 20 + "</p></div></div>"
    for n in (1, 2, 3, 6):
        assert all(t.startswith(f"Lead {i}.\nBody {i} of") for i, t in enumerate(main_texts([lead.format(i) for i in range(n)])))


def test_two_pages_show_a_template():
    for n in (2, 3):
        assert main_texts([f"<div><p>Own {i}</p></div><div><p>Said everywhere</p></div>" for i in range(n)]) == [f"Own {i}" for i in range(n)]


def test_long_rows_of_blocks_are_aligned_to_their_end():
    def flat(i, n):
        return "".join(f"<h2>Head {i} {k}</h2><p>Text {i} {k}</p>" + "<div>Advice for all</div>" * (k % 50 == 7) for k in range(n)) + "<p>Closing words</p><div>All rights reserved</div>"
    for i, text in enumerate(main_texts([flat(i, 90 + 10 * i) for i in range(5)])):
        assert text == "\n".join(f"Head {i} {k}\nText {i} {k}" for k in range(90 + 10 * i))


def test_copies_leave_a_host_its_template(spark):
    def html(i):
        return f"<body><div><p>Own text {i} of the page.</p></div><div><p>Said on every page</p></div></body>"
    rows = [(i, f"http://a.example/{i}", html(i)) for i in range(12)] + [(100 + i, f"http://a.example/c{i}", html(0)) for i in range(500)]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert len(got) == len(rows) and {(r.page_id, r.text) for r in got} == {(i, f"Own text {0 if i >= 100 else i} of the page.") for i, _, _ in rows}


HOSTILE = {
    "deep": "<div>" * 5000 + "Down here." + "</div>" * 5000 + "<p>After</p>",
    "deep paragraphs": "<div>" * 300 + "".join(f"<p>Line {k}</p>" for k in range(5)) + "<nav><div>Menu</div></nav>tail" + "</div>" * 300,
    "unclosed spans": "<p>" + "<span>" * 3000 + "In spans" + "<p>Next",
    "no ends": "<p>Start " + "a <b " * 200_000,
    "odd quotes": "<p>Start</p>" + "<a \"" * 100_001 + ">",
    "half quotes": "<p class='x>Start</p>" + "<i title=\">" * 50_001,
    "open titles": "<p>Start</p>" + "<title>x" * 100_000,
    "declarations": "<p>Start</p>" + "<!x " * 200_000,
    "comments": "<p>Start</p>" + "<!-- x" * 100_000,
    "raw ends": "<p>Start</p><textarea>" + "</textarea " * 100_000,
    "many open": "<p>Start</p>" + "<section><b>" * 20_000 + "</i></u>" * 20_000,
}


@pytest.mark.parametrize("kind", sorted(HOSTILE))
def test_hostile_pages_take_one_pass(kind):
    began = time.process_time()
    tree = pages.parse(HOSTILE[kind])
    text = pages._extract_group(pd.DataFrame([(1, "u", "h", b"d", False, zlib.compress(HOSTILE[kind].encode()))], columns=["page_id", "url", "host", "digest", "copied", "html"]))["text"][0]
    assert time.process_time() - began < 4
    want = {"deep": "Down here.\nAfter", "deep paragraphs": "Line 0\nLine 1\nLine 2\nLine 3\nLine 4\ntail", "unclosed spans": "In spans\nNext"}
    assert text == want[kind] if kind in want else text.startswith("Start") and tree.children


def test_trees_are_built_without_collections():
    gc.collect()
    seen = []
    gc.callbacks.append(lambda phase, info: seen.append(phase))
    try:
        tree = pages.parse("<p>Start</p>" + "<title>x" * 10_000)
        assert seen.count("start") <= 1 and gc.isenabled() and len(tree.children) > 10_000  # one when it goes on again
        with pytest.raises(AttributeError):
            pages.parse(None)
        assert gc.isenabled()
    finally:
        gc.callbacks.pop()


def test_hostile_pages_leave_the_others_alone(spark):
    rows = [(i, f"http://a.example/{i}", page(i, f"<article><h1>Head {i}</h1><p>Text {i}</article>")) for i in range(5)]
    rows += [(100 + i, f"http://a.example/h{i}", html) for i, html in enumerate(HOSTILE.values())]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and all(got[i] == f"Head {i}\nText {i}" for i in range(5)) and "Down here." in got[100]


def test_names_only_break_ties():
    """Constant menus go by alignment; what varies and is called noise goes by name, unless nothing else were left."""
    import collections

    def bodies(n):
        return [f"<nav><ul><li><a>Home</a><li><a>About</a></ul></nav><div class='{{}}'><p>Story {i} of the page.</p><p>More {i}.</p></div><div class=ad>Buy {i}!</div>" for i in range(n)]
    for n in (2, 3, 6):
        assert main_texts([b.format("text") for b in bodies(n)]) == [f"Story {i} of the page.\nMore {i}." for i in range(n)]
    for n in (3, 6):  # the story's own box has a noisy name, and without it no text would be left
        got = main_texts([b.format("related-widget") for b in bodies(n)])
        assert got == [f"Story {i} of the page.\nMore {i}." for i in range(n)]
    trees = [pages.parse(f"<body>{b.format('text')}</body>") for b in bodies(6)]
    decided = collections.Counter()
    pages.induce(trees, decided)
    assert decided["constant"] == 6 * len("HomeAbout") and decided["by names"] == 6 * len("Buy 0!") and decided["aligned pages"] == 6


def test_lists_of_links_go_by_their_slot():
    links = "<div class=box>" + "".join("<p><a href=x>Other page {0} " + str(k) + "</a></p>" for k in range(4)) + "</div>"
    story = "<div><p>Story {0} " + "goes on and on " * 20 + "</p><p>See <a>this {0}</a> too.</p></div>"
    got = main_texts([(story + links).format(i) for i in range(6)])
    assert got == [f"Story {i} {'goes on and on ' * 20}".strip() + f"\nSee this {i} too." for i in range(6)]
    only = main_texts([links.format(i) for i in range(6)])
    assert all(t.startswith(f"Other page {i} 0") for i, t in enumerate(only))  # a page of links keeps them


def plain_matching(a, b):
    """Simple tree matching by its definition, on label and children alone."""
    if a.label != b.label:
        return 0
    m, n = len(a.children), len(b.children)
    table = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m):
        for j in range(n):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + plain_matching(a.children[i], b.children[j]))
    return 1 + table[m][n]


def test_alignment_against_plain_tree_matching():
    """Order and labels are kept, and of trees without equal texts as many nodes are matched as can be."""
    draw = random.Random(29)

    def tree(depth):
        if not depth or draw.random() < 0.3:
            return f"<p>t{draw.random()}</p>"
        return "".join(f"<div class={draw.choice('ab')}>{tree(depth - 1)}</div>" for _ in range(draw.randint(1, 3)))

    for _ in range(200):
        a, b = (pages.Shape(pages.parse(tree(3))) for _ in range(2))
        assert pages._weight(a, b) == plain_matching(a, b)
        pairs = pages.align(a, a)
        assert all(x is y for x, y in pairs) and len(pairs) == sum(1 for _ in walk(a))


def walk(shape):
    yield shape
    for child in shape.children:
        yield from walk(child)


def test_quotes_and_signs_in_tags():
    assert main_texts(["<p title='a > b'>One</p><p title=\"it's > that\">Two 1 < 2 <3</p><p class=x'>Three</p>"]) == ["One\nTwo 1 < 2 <3\nThree"]


# 8 ---------------------------------------------------------------------------------------------------------------

def brute_repeats(rows, n):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = collections.Counter(d[a : a + n] for _, d in data for a in range(len(d) - n + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for a in range(len(d) - n + 1):
            if counts[d[a : a + n]] > 1:
                gone[a : a + n] = b"\1" * n
        spans = sum(1 for j in range(len(d)) if gone[j] and not (j and gone[j - 1]))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(d, gone) if not y)).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("length", [32, 101])
def test_repeats_equal_brute_force(spark, length):
    draw = random.Random(13)
    base = "".join(draw.choice("abcé ") for _ in range(2500))
    rows = []
    for i in range(50):
        a, b = draw.randint(0, 2000), draw.randint(0, 2400)
        rows.append((i, base[a : a + draw.randint(0, 350)] + draw.choice(["", "x" * draw.randint(0, 200), "ab" * 90, "é" * 70]) + base[b : b + draw.randint(0, 200)]))
    rows += [(100, None), (101, ""), (102, "a" * 3000), (103, rows[3][1]), (4, rows[4][1]), (None, rows[9][1])]
    got = repeats.remove_repeats(make_docs(spark, [(i, t, None) for i, t in rows]), length).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, length)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_planted_passages_go_from_400_bytes_on(spark, tmp_path):
    draw = random.Random(29)

    def words(n, letters="abcdefgh"):
        return " ".join("".join(draw.choice(letters) for _ in range(5)) for _ in range(n))

    short, long, signs = words(60), words(80), words(52, "äöüßéñ")  # 359, 479 and 571 bytes, each of over 50 words
    at_limit, below = words(70)[:398], words(70)[:397]  # with the spaces beside them 400 and 399 bytes
    planted = {"short": short, "long": long, "signs": signs, "at limit": at_limit, "below": below}
    rows, held = [(i, words(draw.randint(0, 200))) for i in range(20)], {}
    for kind, passage in planted.items():
        for k in range(3):
            held[len(rows)] = kind
            rows.append((len(rows), f"{words(30 * k)}{k} {passage} {k}{words(40)}"))
    make_docs(spark, [(i, t, "s") for i, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_repeats(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 400)
    before = dict(rows)
    for r in got:
        goes = held.get(r.doc_id) in ("long", "signs", "at limit")
        assert r.n_bytes == len(before[r.doc_id].encode()) and (r.n_removed > 0) == goes
        assert r.text == (before[r.doc_id].replace(f" {planted[held[r.doc_id]]} ", "") if goes else before[r.doc_id])


# 9 ---------------------------------------------------------------------------------------------------------------

def test_line_chunks_equal_a_walk_in_order(spark):
    draw = random.Random(17)
    lines = [f"line {k} {draw.random()}" for k in range(40)] + ["", " "]
    rows = [(i, "\n".join(lines[(a + k) % 42] if draw.random() < 0.9 else f"new {draw.random()}" for k in range(draw.randint(0, 30))), "s") for i in range(40) for a in [draw.randint(0, 41)]]
    rows += [(90, None, None), (91, "", None), (92, rows[0][1], None), (93, "\n".join(["same", "words"] * 400), None)]
    got = {r.doc_id: r for r in line_chunks.drop_repeated_chunks(make_docs(spark, rows)).collect()}
    seen = set()
    for i, text, _ in sorted(rows):
        if text is None:
            assert got[i].text is None
            continue
        kept = []
        for _, body, size in line_chunks.chunks(text):
            if size > 1 and body.strip() and body in seen:
                continue
            seen.add(body)
            kept.append(body)
        assert got[i].text == b"\n".join(kept).decode() and got[i].n_lines == text.count("\n") + 1
    assert len(got) == len(rows) and line_chunks.drop_repeated_chunks(make_docs(spark, rows).limit(0)).count() == 0


def test_an_inserted_line_moves_no_other_end():
    lines = [f"{k} words".encode() for k in range(200)]
    ends = {lines[e - 1] for e in line_chunks.chunk_ends(lines)}
    more = {(lines[:50] + [b"new"] + lines[50:])[e - 1] for e in line_chunks.chunk_ends(lines[:50] + [b"new"] + lines[50:])}
    assert len(ends ^ more) <= 3


def brute_runs(rows):
    """Texts without the lines of later occurrences: at every line the longest run that began the same at an earlier place."""
    lines = [(i, t.split("\n")) for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0]))]
    out, places = {}, []
    for d, (i, mine) in enumerate(lines):
        gone = set()
        for a in range(len(mine)):
            for other, b in places + [(d, b) for b in range(a)]:
                theirs, n = lines[other][1], 0
                while a + n < len(mine) and b + n < len(theirs) and mine[a + n] == theirs[b + n]:
                    n += 1
                if n > 1:
                    gone.update(range(a, a + n))
        places += [(d, b) for b in range(len(mine))]
        out[i] = "\n".join(x for k, x in enumerate(mine) if k not in gone), len(gone)
    return out


def test_line_runs_equal_brute_force(spark):
    draw = random.Random(23)
    lines = [f"line {k} {draw.random()}" for k in range(60)] + [""]
    rows = []
    for i in range(50):
        body = [f"own {draw.random()}" for _ in range(draw.randint(0, 6))]
        for _ in range(draw.randint(0, 3)):  # passages of 1 to 9 lines between foreign lines, cut anywhere
            a = draw.randint(0, 58)
            body += lines[a : a + draw.randint(1, 9)] + [f"own {draw.random()}" for _ in range(draw.randint(1, 4))]
        rows.append((i, "\n".join(body)))
    rows += [(90, ""), (92, rows[0][1]), (93, "\n".join(["same", "words"] * 30)), (94, "same"), (None, rows[4][1])]
    want = brute_runs(rows)
    rows += [(95, None), rows[1]]
    got = line_chunks.drop_repeated_runs(make_docs(spark, [(i, t, "s") for i, t in rows])).collect()
    assert collections.Counter((r.doc_id, r.text, r.n_removed) for r in got) == collections.Counter((i, *(want[i] if t is not None else (None, 0))) for i, t in rows)


def test_runs_of_lines_with_white_space_beyond_ascii_go(spark):
    """Such lines are found as ink, so they have to go as ink; only blanks of ASCII beside blanks stay."""
    odd = ["\u00a0", "\u2003", "\x1f", "\x85", "\u2028"]
    rows = [(1, "\n".join(["a", *odd, "b"])), (2, "\n".join(["c", *odd, "d"])), (3, "\n".join(["e", *odd * 3])), (4, "f\n \n\t\n\r\ng"), (5, "h\n \n\t\n\r\ni"), (None, "\n".join(odd[1:3]))]
    want = brute_runs([r for r in rows if r[0] not in (4, 5)])
    assert want[2] == ("c\nd", 5) and want[None] == ("", 2)
    want |= {i: (t, 0) for i, t in rows if i in (4, 5)}
    got = line_chunks.drop_repeated_runs(make_docs(spark, [(i, t, "s") for i, t in rows])).collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in got} == want


def test_main_text_is_the_same_beyond_the_broadcast(spark, monkeypatch):
    """The number of hosts and copies chooses how tables are joined, never the texts."""
    def page(host, k):
        return f"<html><body><div class=top>Site {host} and its menu</div><div><p>Story {host} {k} of many words</p><p>{'more ' * (k % 5)}text {k}</p></div><div>Contact</div></body></html>"

    rows = [(100 * h + k, f"https://h{h}.org/{k}", page(h, k)) for h in range(4) for k in range((1, 3, 70, 9)[h])]
    rows += [(900 + k, f"https://h2.org/copy{k}", page(2, 5)) for k in range(5)] + [(990, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    some = collections.Counter(map(tuple, pages.main_text(df).collect()))
    monkeypatch.setattr(pages, "BROADCAST_ROWS", 0)
    assert collections.Counter(map(tuple, pages.main_text(df).collect())) == some and some.total() == len(rows)


def test_line_runs_go_by_chunks_and_pairs_take_the_rest(spark):
    """Chunks of independent cuts are what goes of a long passage; only pairs in none of them are taken beside."""
    draw = random.Random(29)
    passage = [f"line {k} {draw.random()}" for k in range(200)] + ["", "", "end"]
    texts = ["\n".join([f"own {i}", *passage, f"last {i}"]) for i in range(3)]
    first, second = ({at for at, _, _ in line_chunks.chunks(texts[0], cut)} for cut in (0, 1))
    assert len(first ^ second) > len(first & second)
    units = line_chunks.runs(texts[0])
    assert len({(at, size) for at, _, size in units}) == len(units) and {size for _, _, size in units} > {2, 3, 4}
    doomed = [{"line": at, "size": size, "high": 0, "low": 0} for at, _, size in units if 0 < at and at + size < 205]
    kind = pa.list_(pa.struct([("line", pa.int64()), ("size", pa.int32()), ("high", pa.int64()), ("low", pa.int64())]))
    left = line_chunks._uncovered(pa.record_batch([pa.array([b"k"]), pa.array([doomed], kind)], ["row_key", "units"])).column("units")[0].as_py()
    assert sum(u["size"] == 2 for u in left) < 60 and {(u["line"], u["size"]) for u in left if u["size"] > 2} == {(u["line"], u["size"]) for u in doomed if u["size"] > 2}
    covered = {k for u in left for k in range(u["line"], u["line"] + u["size"])}
    assert covered == set(range(1, 204))
    found = line_chunks.drop_repeated_runs(make_docs(spark, [(i, t, "s") for i, t in enumerate(texts)]))
    assert {r.doc_id: (r.text, r.n_removed) for r in found.collect()} == {0: (texts[0], 0), 1: ("own 1\nlast 1", 203), 2: ("own 2\nlast 2", 203)}


# 10 --------------------------------------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    draw = random.Random(1)
    letters = [chr(c) for c in range(0x250)] + ["　", " ", "\x85", "\x1c", "日", "🙂", "<|endoftext|>", "'s", "'ll", "  ", "\r\n", "٣", "½", "é"]
    rows = [(i, "".join(draw.choice(letters) for _ in range(draw.randint(0, 40))), None) for i in range(800)] + corpus() + [(900, "a" * 20000, None), (901, " " * 999, None)]
    got = tokens.token_counts(make_docs(spark, rows), public.path("byte_bpe_50k.json")).collect()
    want = collections.Counter((i, len((t or "").encode()), n, n > 1024) for i, t, _ in rows for n in [len(library.encode(t or "", add_special_tokens=False).ids)])
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
