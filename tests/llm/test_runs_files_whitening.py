"""Periodic runs, token files and whitening against brute force, the tokenizer's library and plain linear algebra."""

import collections
import hashlib
import io
import math
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tests.llm.test_operators import corpus, make_docs, texts
from tidemark.llm import queries, runs, token_files, whitening

# 11 --------------------------------------------------------------------------------------------------------------


def brute_runs(words, least=24, times=3):
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            a = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            some = words[a : i + q]
            if len(some) >= max(least, times * q) and not any(some[: len(some) - r] == some[r:] for r in range(1, q)):
                out.append((a, len(some), q))
            i += i == a
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, its):
    gone = {i for s, n, q in its for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def folded(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def contract_row(doc_id, text):
    words = folded(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    its = brute_runs(words)
    best = None
    for r in its:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in its)
    return (doc_id, len(its), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, its).encode()).hexdigest())


def periodic(draw, letters, longest):
    out = []
    while len(out) < longest:
        block = [f"w{draw.randrange(letters)}" for _ in range(draw.randint(1, 9))]
        out += block * (draw.randint(1, 9) if draw.random() < 0.5 else 1)
    return out[:longest]


def test_lyndon_lengths_by_definition():
    draw = random.Random(1)
    for _ in range(3000):
        s = [draw.randrange(3) for _ in range(draw.randint(0, 16))]
        values = sorted(set(s))
        want = [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]
        assert runs.lyndon_lengths([values.index(x) for x in s], len(values)) == want


@pytest.mark.parametrize("least, times", [(24, 3), (4, 2), (10, 3), (13, 4)])
def test_runs_equal_brute_force(least, times):
    draw = random.Random(2)
    for k in range(300):
        words = periodic(draw, 1 + k % 4, draw.randint(0, 90))
        codes = np.array([int(w[1:]) for w in words], np.int64)
        assert sorted(runs.runs(codes, least, times), key=lambda r: (r[0], r[2])) == brute_runs(words, least, times)


def test_wrong_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(runs.Extensions, "_equal", lambda self, i, j, length: np.ones(len(i), bool))
    words = ["x"] * 3 + ["a", "b"] * 20 + ["y"]
    got = runs.runs(np.unique(words, return_inverse=True)[1], 24, 3)
    assert got == [(3, 40, 2)]


def test_long_row_of_words_in_linear_time():
    codes = np.tile(np.arange(3000), 100)
    assert runs.runs(codes) == [(0, 300_000, 3000)]


def test_periodic_runs_of_documents(spark):
    draw = random.Random(3)
    rows = corpus() + [(200 + i, " ".join(periodic(draw, 1 + i % 5, draw.randint(0, 150))), "s") for i in range(40)]
    rows += [(300, " a b  " * 40, "s"), (301, "a\tb\n" * 12, "s"), (302, "a\tb\n" * 11 + "a", "s"), (303, "x " * 23, "s"), (304, "x " * 24, "s")]
    got = runs.periodic_runs(make_docs(spark, rows)).collect()

    def want(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        its = brute_runs(words)
        return i, tuple(its), collapsed(words, its)

    assert collections.Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == collections.Counter(want(i, t) for i, t, _ in rows)
    assert runs.periodic_runs(make_docs(spark, rows).limit(0)).count() == 0


def test_periodic_runs_of_given_words(spark):
    docs = spark.createDataFrame([(1, ["a", None] * 12, 1), (2, None, 1), (3, [], 1)], "k long, w array<string>, runs int")
    got = {r.doc_id: r for r in runs.periodic_runs(docs, F.col("w"), id_col="k").collect()}
    assert got[1].runs == [(0, 24, 2)] and got[1].collapsed == "a " and got[2].runs == got[3].runs == [] and got[2].collapsed == ""
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, F.col("w"), times=1, id_col="k")


def test_best_run_takes_exact_ratio_then_start(spark):
    kind = "r array<struct<start: bigint, length: bigint, period: bigint>>"
    df = spark.createDataFrame([([(9, 30, 3), (4, 60, 6), (4, 10, 1), (2, 100, 10)],), ([],)], kind)
    assert [r[0] for r in df.select(runs.best_run(F.col("r"))).collect()] == [(2, 100, 10), None]


def test_op11_by_its_contract(spark, tmp_path):
    draw = random.Random(4)
    rows = [(i, " ".join(f"w{draw.randrange(50)}" for _ in range(draw.randint(0, 200)))) for i in range(150)]
    rows += [(150, None), (151, ""), (None, "a " * 30), (7, "a b " * 30), (7, "a b " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert dict(got.dtypes)["n_runs"] == dict(got.dtypes)["exponent_milli"] == dict(got.dtypes)["start"] == "bigint"
    # A null id has no checksum, so its words stay as they are.
    want = collections.Counter(contract_row(i, t) if i is not None else (None, *contract_row(1, t)[1:]) for i, t in rows)
    assert zlib.crc32(b"1") % 10 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150))
    assert collections.Counter(map(tuple, got.collect())) == want


# 12 --------------------------------------------------------------------------------------------------------------

HOSTILE = ["a<|endoftext|>b", "a <|endoftext|> b", "x \n y", "x  y", "a\x1cb \x1c c", "!\x1c\x1d ?", "  lead", "trail  ", "\n\n\n", "a  b　\tc", "it's 'll 've",
           "é" * 50, "日本語 テキスト", "\U0001f600 \U0001f600\U0001f600", "a" * 3000, "1234 5678", "\x85\x85 \x0b\x0cx", "​ ​", "tab\tsep\r\nline"]


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def test_pieces_give_the_ids_of_whole_texts(tokenizer, library, monkeypatch):
    draw = random.Random(5)
    some = HOSTILE + ["".join(draw.choice("ab 1.'\n\t \x1c é!<|>s") for _ in range(draw.randint(0, 60))) for _ in range(2000)]
    some += ["".join(draw.choice(HOSTILE) for _ in range(200)) for _ in range(10)] + [""] + [t.replace("\x00", "") for t in texts(6, 50)]
    some += [" ".join(draw.choice(["word", "Été", "l'été,", "x.y", "don't", "a1", "straße...", "日本", "a\0b", "<|endoftext|>", "ok<|endoftext|>ok", "\n"]) for _ in range(draw.randint(0, 30))) for _ in range(500)]
    for at_once, together, kept in ((10**6, 10**6, 500_000), (50, 100, 40)):
        monkeypatch.setattr(token_files, "CUT_AT_ONCE", at_once)
        monkeypatch.setattr(token_files, "TEXT_AT_ONCE", together)
        monkeypatch.setattr(token_files, "KEPT_PIECES", kept)
        encoder = token_files.Encoder(open(tokenizer, "rb").read())
        assert encoder.by_pieces
        want = [library.encode(text, add_special_tokens=False).ids for text in some]
        for text, ids, many in zip(some, want, encoder.all_ids(pa.array(some))):
            assert np.frombuffer(b"".join(encoder.ids(text)), "<u4").tolist() == ids, repr(text)
            assert np.frombuffer(b"".join(many), "<u4").tolist() == ids, repr(text)


def test_other_tokenizers_get_whole_texts():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    encoder = token_files.Encoder(open(path, "rb").read())
    assert not encoder.by_pieces
    assert np.frombuffer(b"".join(encoder.ids("Some Text  here")), "<u4").tolist() == Tokenizer.from_file(path).encode("Some Text  here", add_special_tokens=False).ids


def brute_index(rows, library, end=0):
    """Ids by document in ascending order, nulls last."""
    out, start = [], 0
    digests = {t: i for i, t in enumerate(sorted({t or "" for _, t in rows}))}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, digests[r[1] or ""])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, *([] if end is None else [end])]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_give_back_all_ids(spark, tokenizer, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    rows = [(i, t) for i, t, _ in corpus() if i is not None and i != 5] + [(1000 - i, t) for i, t in enumerate(HOSTILE)] + [(None, "null id")]
    files = token_files.write_token_files(make_docs(spark, [(i, t, "s") for i, t in rows]), tokenizer, f"file://{tmp_path}/ids", file_bytes=2_000)
    listed = files.collect()
    assert len(listed) > 1 and sum(r.n_docs for r in listed) == len(rows)
    got = [tuple(r) for r in token_files.read_index(files).collect()]
    assert collections.Counter(got) == collections.Counter(brute_index(rows, library))
    wanted = token_files.read_documents(files, [103, 999, -1]).collect()
    assert {r.doc_id: r.ids for r in wanted} == {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows if i in (103, 999)}
    nothing = token_files.write_token_files(make_docs(spark, []), tokenizer, f"{tmp_path}/none")
    assert nothing.count() == 0 and token_files.read_index(nothing).count() == 0


def test_repeated_ids_and_rows(spark, tokenizer, library):
    rows = [(1, "b b"), (1, "a"), (1, "b b"), (2, None), (2, None), (3, "")]
    got = token_files.token_file_index(spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, start int"), tokenizer).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, 1, 1, 2, 2, 3]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter((i, n, c) for i, _, n, c in brute_index(rows, library))
    without = token_files.token_file_index(spark.createDataFrame([(4, "")], "doc_id long, text string"), tokenizer, end_id=None).collect()
    assert [tuple(r) for r in without] == [(4, 0, 0, 0)]


def test_file_is_plain_zstandard_and_damage_is_noticed():
    sink, compress = io.BytesIO(), zstandard.ZstdCompressor().compress
    file = token_files.FrameFile(sink)
    docs = [(5, [b"abcd" * 10, b"efgh"]), (None, [b""]), (7, [b"wxyz" * 1000])]
    for doc_id, parts in docs:
        file.add(doc_id, token_files.frames(parts, compress))
    file.finish()
    data = sink.getvalue()
    # The frames and the skippable ones behind them are one valid stream for any decoder.
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(p for _, parts in docs for p in parts)
    number, flags, magic = struct.unpack("<IBI", data[-9:])
    assert (number, flags, magic) == (4, 0x80, 0x8F92EAB1)
    first = struct.unpack("<III", data[-9 - 12 * number :][:12])
    assert first[1:] == (44, xxhash.xxh64_intdigest(b"abcd" * 10 + b"efgh") & 0xFFFFFFFF)

    class Counted(io.BytesIO):
        read_at = []

        def read(self, size=-1):
            self.read_at.append((self.tell(), size))
            return super().read(size)

    reader = token_files.FrameReader(Counted(data))
    assert reader.ids == [5, None, 7] and [reader.tokens(k) for k in range(3)] == [11, 0, 1000]
    Counted.read_at.clear()
    assert b"".join(reader.parts(2)) == b"wxyz" * 1000
    assert Counted.read_at == [(int(reader.starts[2]), int(reader.starts[3] - reader.starts[2]))]
    broken = bytearray(data)
    broken[6] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.FrameReader(io.BytesIO(bytes(broken))).parts(0))
    with pytest.raises(ValueError):
        token_files.FrameReader(io.BytesIO(data[:-1]))


# 13 --------------------------------------------------------------------------------------------------------------


def plain_whitening(rows, most=4):
    x = {i: np.array([int(np.floor(256 * float(c))) for c in v], object) for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, total = len(fit), fit.sum(axis=0)
    centred = (fit * n - total).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    out = {}
    for i, v in x.items():
        u = v * n - total
        for c, k in enumerate(order):
            out[i, c + 1] = (n, int((u * u).sum()), abs((u.astype(float) / n) @ vectors[:, k]) / np.sqrt(values[k]), values[k] / values.sum())
    return out


def check_whitening(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, deviation, size, explained = want[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(size, rel=1e-8, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_equals_plain_algebra(spark):
    draw = np.random.default_rng(7)
    base = draw.normal(size=(300, 10)) @ np.diag(np.linspace(2, 0.2, 10)) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(400 + i, base[3].tolist()) for i in range(50)]
    odd = [(900, None), (901, []), (902, [float("nan")] * 10), (903, [None] + [1.0] * 9), (904, [float("-inf")] + [1.0] * 9), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd], "vec_id long, embedding array<double>, n int, x int").repartition(5)
    got = whitening.whiten(df)
    check_whitening(got.collect(), plain_whitening(rows))
    again = whitening.whiten(df.repartition(3)).collect()
    assert sorted(again) == sorted(got.collect())
    signs = collections.defaultdict(set)
    for r in got.where("vec_id = 3 or vec_id >= 400").collect():
        signs[r.component].add(r.whitened)
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("top", [900, 1 << 52])
def test_rows_are_whitened_alike_in_any_batch(top):
    draw = np.random.default_rng(3)
    for d in (10, 37):
        x = draw.integers(-900, 900, (501, d))
        x[7] = draw.integers(-top, top, d)
        total, units = x.sum(axis=0).tolist(), np.linalg.qr(draw.normal(size=(d, 4)))[0].T
        whitener = whitening.Whitener(501, total, units, np.array([9.0, 7.0, 5.0, 3.0]), np.ones(4))
        whole = whitener.whitened(whitener.numerators(x))
        for step in (1, 3, 100):
            assert all(np.array_equal(whitener.whitened(whitener.numerators(x[a : a + step])), whole[a : a + step]) for a in range(0, 501, step))


def test_identity_error_is_summed_in_any_order():
    draw = np.random.default_rng(4)
    p = np.concatenate([draw.normal(size=(400, 3)), 1e9 * draw.normal(size=(3, 3)), 1e-15 * draw.normal(size=(400, 3))])
    once, parts = whitening._units(p), [whitening._units(x) for x in np.array_split(p[draw.permutation(len(p))], 7)]
    assert once == [sum(x) for x in zip(*parts)]
    assert all(abs(u / 2**60 - math.fsum(c)) < 1e-12 for u, c in zip(once, p.T.tolist()))


def test_whitening_in_floats_and_with_negative_zero(spark):
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=6).astype(np.float32).tolist()) for i in range(80)] + [(80, [-0.0] * 6), (81, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_whitening(whitening.whiten(df).collect(), plain_whitening(rows))


def test_whitening_of_few_or_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0  # no variance, no component
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(5)], kind)).collect()
    assert {r.component for r in line} == {1} and all(r.explained == pytest.approx(1) for r in line)
    two = whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [2.0, 3.0]), (None, [5.0, 9.0]), (3, [4.0])], kind)).collect()
    assert {r.vec_id for r in two} == {2, None}
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * 3000)], kind))


def test_whitening_of_huge_entries(spark):
    rows = [(i, [1e16 * (i % 7) + i, 3e13 * i * i, float(i % 5)]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1.0).collect()
    fit = np.array([[int(c) for c in v] for _, v in rows], object)
    total = fit.sum(axis=0)
    for r in got:
        u = fit[r.vec_id] * 40 - total
        assert int(r.deviation) == int((u * u).sum())
        assert r.identity_error < 1e-6
    beyond = whitening.whiten(spark.createDataFrame([(i, [1e300 if i % 2 else -1e300, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")).collect()
    assert len(beyond) in (4, 8) and all(r.identity_error < 1e-6 and r.deviation is None for r in beyond)


def test_cholesky_and_jacobi():
    draw = np.random.default_rng(9)
    for d, r in ((1, 1), (5, 5), (17, 17), (12, 4), (6, 0)):
        a = draw.normal(size=(d, r)) @ np.diag(10.0 ** -np.arange(r)) if r else np.zeros((d, 0))
        matrix = a @ a.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] == r if r < 10 else factor.shape[1] <= r
        assert np.allclose(factor @ factor.T, matrix, rtol=0, atol=1e-13 * max(np.abs(matrix).max(initial=0), 1))
        turned = whitening.one_sided_jacobi(factor)
        gram = turned.T @ turned
        values = np.sort(np.linalg.eigvalsh(matrix))[::-1][: gram.shape[0]]
        assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-13 * max(1, np.abs(gram).max(initial=0)))
        assert np.allclose(np.diag(gram), values, rtol=1e-9, atol=1e-13 * max(1, np.abs(matrix).max()))
