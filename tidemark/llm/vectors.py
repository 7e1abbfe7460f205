"""Embedding near-duplicates: a navigable small-world graph per shard, asked by every vector.

Shards and blocks of large components are files in the shared folder. Tasks get
pairs of their names and read what they compare, so that no vector is copied
for the many it is compared with, and a task holds two files at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidemark.llm.common import opened, stored
from tidemark.llm.components import connected_components
from tidemark.session import new_folder

#: Shards at least, vectors in a shard at most (about) and their bytes in double precision, and vectors that ask a shard together.
SHARDS, SHARD_ROWS, SHARD_BYTES, ASKING = 4, 65_536, 1 << 25, 8_192
#: Tasks at most that share the pairs of shards or blocks.
TASKS = 8_192
#: Rows of a shard that are compared with some queries at once, and links that are reduced to a forest together.
TILE, LINKS_AT_ONCE = 4_096, 1 << 20
#: A beam as wide, and of at least one row of the shard in so many, costs more than looking at all rows.
WIDE, SHARE = 128, 2_048
#: Neighbours of a node, beam while building, first beam while asking, vectors handled together.
LINKS, BUILD_BEAM, BEAM, TOGETHER = 12, 24, 32, 256
#: One vector in so many enters each higher layer; the highest is searched whole.
RATIO = 24
#: One asking vector in so many is checked against the whole shard, and more of them where those have fewer links than EVIDENCE.
AUDIT, EVIDENCE = 16, 512
#: Nodes of a component that are compared in one block; small components share groups of about as many.
COUNTED = 2_048
_SLACK = 1e-4


def search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first walks of all queries at once: (ids, cosines), the ``beam`` best met, best first, -1 where none."""
    n, b = len(vectors), len(queries)
    beam = max(beam, entries.shape[1])
    ids = np.full((b, beam), -1, np.int64)
    sims = np.full((b, beam), -2.0, np.float32)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # stands for "no neighbour"
    e = entries.shape[1]
    ids[:, :e] = entries
    sims[:, :e] = np.einsum("bed,bd->be", vectors[entries], queries)
    np.put_along_axis(seen, entries, True, axis=1)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    open_ = ids >= 0
    active = np.arange(b)
    while True:
        active = active[open_[active].any(axis=1)]
        if not len(active):
            return ids, sims
        best = open_[active].argmax(axis=1)
        at = ids[active, best]
        open_[active, best] = False
        near = links[at]
        near = np.where(seen[active[:, None], near], n, near)
        seen[active[:, None], near] = True
        fresh = near < n
        some = fresh.any(axis=1)
        if not some.any():
            continue
        rows, near, fresh = active[some], near[some], fresh[some]
        sim = np.einsum("bed,bd->be", vectors[np.minimum(near, n - 1)], queries[rows])
        sim = np.where(fresh, sim, -2.0)
        all_ids = np.concatenate([ids[rows], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[rows], sim.astype(np.float32)], axis=1)
        all_open = np.concatenate([open_[rows], fresh], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[rows], sims[rows] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_sims, order, 1)
        open_[rows] = np.take_along_axis(all_open, order, 1)


class Graph:
    """Hierarchical navigable small world over the rows of ``vectors`` (of length one, in random order)."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        self.sizes = self.sizes_of(n)
        self.layers = [self._build(size) for size in self.sizes[:-1]]
        self.layers.append(None)
        if n and self.layers[0] is None:
            self.layers[0] = np.full((n, LINKS), n, np.int32)

    @staticmethod
    def sizes_of(n: int) -> list[int]:
        """Rows come in random order, so a prefix is a random sample: layer k holds the first n / RATIO^k rows."""
        sizes = [n]
        while sizes[-1] > 20 * RATIO:
            sizes.append(-(-sizes[-1] // RATIO))
        return sizes

    def _build(self, n: int) -> np.ndarray:
        """Links of one layer: batches enter a growing graph and are linked to what a walk and their own batch offer."""
        vectors, links = self.vectors[:n], np.full((n, LINKS * 2), n, np.int32)
        done = min(n, 4 * LINKS)
        sims = vectors[:done] @ vectors[:done].T
        np.fill_diagonal(sims, -2)
        links[:done, :LINKS] = np.argsort(-sims, axis=1, kind="stable")[:, :LINKS] if done > LINKS else n
        while done < n:
            new = np.arange(done, min(n, done + min(TOGETHER, max(16, done // 2))))
            starts = self._starts(self.vectors[new], done)
            graph = np.where(links[:done] < done, links[:done], done)
            ids, sims = search(vectors[:done], graph, vectors[new], starts, BUILD_BEAM)
            among = vectors[new] @ vectors[new].T
            np.fill_diagonal(among, -2)
            keep = np.argsort(-among, axis=1, kind="stable")[:, :LINKS]
            ids = np.concatenate([ids, new[keep]], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(among, keep, 1)], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            for row, candidates, near in zip(new.tolist(), ids, sims):
                chosen = self._spread(candidates[near > -2], near[near > -2])
                links[row, : len(chosen)] = chosen
                for other in chosen.tolist():
                    self._link_back(vectors, links, other, row, n)
            done = int(new[-1]) + 1
        return links

    def _starts(self, queries: np.ndarray, known: int) -> np.ndarray:
        """The nearest of the top rows, of which all are looked at."""
        top = min(known, max(self.sizes[-1], 1))
        k = min(4, top)
        sims = queries @ self.vectors[:top].T
        return np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < top else np.tile(np.arange(top), (len(queries), 1))[:, :k]

    def _spread(self, candidates: np.ndarray, sims: np.ndarray) -> np.ndarray:
        """The nearest candidates, those first that are nearer to the node than to one chosen before."""
        if len(candidates) <= LINKS:
            return candidates
        some = candidates[: 2 * LINKS]
        among = self.vectors[some] @ self.vectors[some].T
        chosen = [0]
        for i in range(1, len(some)):
            if len(chosen) < LINKS and sims[i] > among[i, chosen].max():
                chosen.append(i)
        rest = [i for i in range(len(some)) if i not in chosen]
        return some[(chosen + rest)[:LINKS]]

    def _link_back(self, vectors: np.ndarray, links: np.ndarray, node: int, new: int, none: int) -> None:
        row = links[node]
        free = np.flatnonzero(row == none)
        if len(free):
            row[free[0]] = new
            return
        both = np.append(row, new)
        sims = vectors[both] @ vectors[node]
        order = np.argsort(-sims, kind="stable")
        row[:] = none
        chosen = self._spread(both[order], sims[order])
        row[: len(chosen)] = chosen

    def too_wide(self, beam: int) -> bool:
        n = len(self.vectors)
        return beam * 4 >= n or beam >= max(WIDE, n // SHARE)

    def whole_links(self, queries: np.ndarray, cosine: float) -> list[np.ndarray]:
        """For each query the rows at about ``cosine`` or nearer, by looking at all rows."""
        n, out = len(self.vectors), []
        for at in range(0, len(queries), TOGETHER):
            some, who, whom = queries[at : at + TOGETHER], [], []
            for tile in range(0, n, TILE):
                near = np.flatnonzero(some @ self.vectors[tile : tile + TILE].T >= cosine - _SLACK)
                if len(near):
                    width = min(TILE, n - tile)
                    who.append((near // width).astype(np.int32))
                    whom.append((near % width + tile).astype(np.int32))
            if not who:
                out += [np.empty(0, np.int32)] * len(some)
                continue
            who, whom = np.concatenate(who), np.concatenate(whom)
            order = np.argsort(who, kind="stable")
            out += np.split(whom[order], np.searchsorted(who[order], np.arange(1, len(some))))
        return out

    def links_of(self, queries: np.ndarray, cosine: float, beam: int) -> list[np.ndarray]:
        """For each query the rows at about ``cosine`` or nearer; a beam that is full of them is widened to the whole shard."""
        n, out = len(self.vectors), [np.empty(0, np.int32)] * len(queries)
        for at in range(0, len(queries), TOGETHER):
            asked = np.arange(at, min(len(queries), at + TOGETHER))
            width = beam
            while len(asked):
                if self.too_wide(width):  # look at all rows
                    for q, found in zip(asked.tolist(), self.whole_links(queries[asked], cosine)):
                        out[q] = found
                    break
                entries = self._starts(queries[asked], n)
                for layer, size in list(zip(self.layers, self.sizes))[-2:0:-1]:
                    ids, _ = search(self.vectors[:size], layer, queries[asked], entries, 8)
                    entries = ids[:, :4]
                ids, sims = search(self.vectors, self.layers[0], queries[asked], entries, width)
                full = (sims[:, -1] >= cosine - _SLACK) & (ids[:, -1] >= 0)
                for q, some, near, wide in zip(asked.tolist(), ids, sims, full):
                    if not wide:
                        out[q] = some[(near >= cosine - _SLACK) & (some >= 0)].astype(np.int32)
                asked, width = asked[full], n
        return out

    def audited_beam(self, queries: np.ndarray, cosine: float, own: np.ndarray) -> int | None:
        """A beam that is widened until it finds all links of the audited queries; None where they are too few, so that all rows are to be looked at."""

        def audited() -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
            for at in range(0, len(queries), step * TOGETHER):
                some = np.arange(at, min(len(queries), at + step * TOGETHER), step)
                yield some, [e[e != o] for e, o in zip(self.whole_links(queries[some], cosine), own[some])]

        step = AUDIT
        while sum(len(e) for _, links in audited() for e in links) < EVIDENCE:
            step //= 4
            if step == 1:
                return None
        beam = BEAM
        for some, links in audited():
            while not self.too_wide(beam) and not all(np.isin(e, f).all() for e, f in zip(links, self.links_of(queries[some], cosine, beam))):
                beam *= 2
        return beam

    def audited_links(self, queries: np.ndarray, cosine: float, own: np.ndarray | None = None) -> list[np.ndarray]:
        """``links_of`` with the audited beam, or all rows looked at; ``own`` is the row of each query itself, or -1."""
        beam = self.audited_beam(queries, cosine, np.full(len(queries), -1) if own is None else own)
        return self.whole_links(queries, cosine) if beam is None else self.links_of(queries, cosine, beam)


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between nodes a spanning forest: one link per node to the smallest that it reaches."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = _roots(place[: len(a)], place[len(a) :], len(names))
    joined = np.flatnonzero(root != np.arange(len(names)))
    return names[joined], names[root[joined]]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision; the largest component is scaled to one before, against overflow."""
    exact = vectors.astype(np.float64)
    exact /= np.abs(exact).max(axis=1, keepdims=True)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    return exact


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Lists of one length as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


class Block:
    """A file of ``n`` rows: whole numbers in columns (the nodes first), then vectors, then the layers of their graph if there is one."""

    def __init__(self, path: str, n: int, dim: int, kind: str, columns: int = 1):
        self.path, self.n, self.dim, self.kind, self.columns = path, n, dim, kind, columns

    @staticmethod
    def write(folder: str, *arrays: np.ndarray) -> str:
        """The path of a new file; a task that runs twice writes two, of which only one is named in its result."""
        system, place = opened(folder)
        system.create_dir(place, recursive=True)
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{place}/{name}") as file:
            for array in arrays:
                file.write(np.ascontiguousarray(array))
        return f"{folder}/{name}"

    def _read(self, *parts: tuple[int, int]) -> list[bytes]:
        system, place = opened(self.path)
        with system.open_input_file(place) as file:
            return [file.read_at(size, at) for at, size in parts]

    def rows(self, start: int, stop: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The whole numbers and vectors of some rows."""
        wide = self.dim * np.dtype(self.kind).itemsize
        parts = [(8 * (k * self.n + start), 8 * (stop - start)) for k in range(self.columns)]
        *numbers, vectors = self._read(*parts, (8 * self.columns * self.n + start * wide, (stop - start) * wide))
        return [np.frombuffer(x, np.int64) for x in numbers], np.frombuffer(vectors, self.kind).reshape(-1, self.dim)

    def graph(self) -> tuple[np.ndarray, np.ndarray, Graph]:
        """Nodes, their vectors of length one, and the graph over them."""
        (nodes,), vectors = self.rows(0, self.n)
        exact = _unit(vectors)
        graph = Graph.__new__(Graph)
        graph.vectors, graph.sizes = exact.astype(np.float32), Graph.sizes_of(self.n)
        sizes, width = (graph.sizes[:-1], 2 * LINKS) if len(graph.sizes) > 1 else (graph.sizes, LINKS)
        at = self.n * (8 + self.dim * np.dtype(self.kind).itemsize)
        (links,) = self._read((at, 4 * width * sum(sizes)))
        cuts = np.cumsum([0, *sizes]) * width
        links = np.frombuffer(links, np.int32)
        graph.layers = [links[a:b].reshape(-1, width) for a, b in zip(cuts, cuts[1:])] + [None]
        return nodes, exact, graph


def _index(folder: str):
    def index(rows: pa.Table) -> pa.Table:
        """Writes the graph of a shard to a file, and names the file and its row for every node."""
        rows = rows.sort_by("node")
        vectors = _matrix(rows["vector"].combine_chunks())
        graph = Graph(_unit(vectors).astype(np.float32))
        path = Block.write(folder, rows["node"].to_numpy(), vectors, *(x.astype(np.int32) for x in graph.layers if x is not None))
        named = rows.select(["dim", "node", "copies", "lowest"])
        for name, column in (("path", [path] * len(rows)), ("place", np.arange(len(rows))), ("n", np.full(len(rows), len(rows)))):
            named = named.append_column(name, pa.array(column))
        return named

    return index


def _ask(cosine: float):
    def ask(mine: Block, start: int, stop: int, nodes: np.ndarray, exact: np.ndarray, graph: Graph) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links of some rows of a file with a shard; never the pairs of a group."""
        (me,), asked = mine.rows(start, stop)
        asked = _unit(asked)
        queries = asked.astype(np.float32)
        place = np.minimum(np.searchsorted(nodes, me), len(nodes) - 1)
        beam = graph.audited_beam(queries, cosine, np.where(nodes[place] == me, place, -1))
        forest = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(me), TOGETHER):
            some = queries[at : at + TOGETHER]
            found = graph.whole_links(some, cosine) if beam is None else graph.links_of(some, cosine, beam)
            ends = np.cumsum([len(f) for f in found])
            low = 0
            while low < len(found):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + LINKS_AT_ONCE, "right")))
                who = np.repeat(np.arange(at + low, at + high), [len(f) for f in found[low:high]])
                whom = np.concatenate(found[low:high]).astype(np.int64)
                low = high
                linked = me[who] != nodes[whom]
                for k in range(0, len(who), 1 << 14):  # verified in double precision
                    part = slice(k, k + (1 << 14))
                    linked[part] &= np.einsum("id,id->i", asked[who[part]], exact[whom[part]]) >= cosine
                if linked.any():
                    forest = _forest(np.concatenate([forest[0], me[who[linked]]]), np.concatenate([forest[1], nodes[whom[linked]]]))
        return forest

    return ask


class Pairs:
    """Numbered pairs of a stretch of one file and a whole file, both of the same group; those with the same whole file follow each other."""

    def __init__(self, files: list[tuple[object, Block]], most: int):
        self.files, self.stretches = [b for _, b in files], []
        groups: dict = {}
        for k, (key, _) in enumerate(files):
            groups.setdefault(key, []).append(k)
        self.groups, bounds = list(groups.values()), [0]
        for members in self.groups:
            cuts = []
            for k in members:
                n = self.files[k].n
                parts = -(-n // most)
                cuts += [(k, n * i // parts, n * (i + 1) // parts) for i in range(parts)]
            self.stretches.append(cuts)
            bounds.append(bounds[-1] + len(members) * len(cuts))
        self.bounds = np.array(bounds)

    def __len__(self) -> int:
        return int(self.bounds[-1])

    def __getitem__(self, number: int) -> tuple[int, tuple[int, int, int]]:
        group = int(np.searchsorted(self.bounds, number, "right")) - 1
        whole, stretch = divmod(number - int(self.bounds[group]), len(self.stretches[group]))
        return self.groups[group][whole], self.stretches[group][stretch]


def _paired(spark: SparkSession, pairs: Pairs, load: Callable, compare: Callable, schema: str) -> DataFrame:
    """What ``compare`` gives for all pairs, in two columns of whole numbers; the whole file is loaded once for pairs that follow each other."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, loaded = None, None
        for batch in batches:
            for number in batch.column(0).to_pylist():
                whole, (other, start, stop) = pairs[number]
                if whole != held:
                    loaded = None  # not two at a time
                    held, loaded = whole, load(pairs.files[whole])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in compare(pairs.files[other], start, stop, *loaded)], names)

    return spark.range(0, len(pairs), 1, max(1, min(len(pairs), TASKS))).mapInArrow(run, schema)


def _links_among(left: np.ndarray, nodes: np.ndarray, right: np.ndarray, others: np.ndarray, copies: np.ndarray, cosine: float) -> np.ndarray:
    """How many vectors each left row links with among the right rows of its component."""
    n_links = np.zeros(len(left), np.int64)
    for at in range(0, len(left), 512):
        near = left[at : at + 512] @ right.T >= cosine
        near &= nodes[at : at + 512, None] != others[None, :]
        n_links[at : at + 512] = near @ copies
    return n_links


#: Hashes that are tried until no two different vectors share one.
HASHES = 8


def _node(vector: Column, seed: int) -> Column:
    """The number that stands for a vector."""
    return F.xxhash64(vector) if seed == 0 else F.xxhash64(vector, F.lit(seed))


def _fetched(kind: str):
    def fetch(rows: pa.Table) -> pa.Table:
        """Members of components out of one file, with their vectors."""
        dim, n, path = (rows[c][0].as_py() for c in ("dim", "n", "path"))
        _, vectors = Block(path, n, dim, kind).rows(0, n)
        taken = vectors[rows["place"].to_numpy()]
        offsets = pa.array(np.arange(len(taken) + 1) * dim, pa.int32())
        return rows.select(["large", "pack", "block", "root", "node", "copies"]).append_column("vector", pa.ListArray.from_arrays(offsets, pa.array(taken.reshape(-1))))

    return fetch


def _packed(folder: str, cosine: float):
    def pack(rows: pa.Table) -> pa.Table:
        """The links of small components, each counted whole; a block of a large one goes to a file, which is named."""
        rows = rows.sort_by([("root", "ascending"), ("node", "ascending")]).combine_chunks()
        root, nodes, copies = (rows[c].to_numpy() for c in ("root", "node", "copies"))
        vectors = rows["vector"].combine_chunks()
        if rows["large"][0].as_py():
            matrix = _matrix(vectors)
            path = Block.write(folder, nodes, copies, matrix)
            return pa.table({"node": pa.array([None], pa.int64()), "n_links": pa.array([None], pa.int64()), "pack": pa.array([root[0]]),
                             "path": pa.array([path]), "n": pa.array([len(nodes)], pa.int64()), "dim": pa.array([matrix.shape[1]], pa.int32())})
        n_links = np.zeros(len(nodes), np.int64)
        cuts = [*np.flatnonzero(np.r_[True, root[1:] != root[:-1]]).tolist(), len(root)]
        for a, b in zip(cuts, cuts[1:]):
            unit = _unit(_matrix(vectors[a:b]))
            n_links[a:b] = _links_among(unit, nodes[a:b], unit, nodes[a:b], copies[a:b], cosine)
        none = [pa.nulls(len(nodes), t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int32())]
        return pa.table([pa.array(nodes), pa.array(n_links), *none], ["node", "n_links", "pack", "path", "n", "dim"])

    return pack


def _counted(members: DataFrame, n: int, cosine: float, kind: str) -> DataFrame:
    """(node, outside) for the nodes of components of two or more: every link lies inside a component.

    Small components share groups of a few thousand rows; a large one is cut
    into blocks, which lie in files, and every pair of its blocks is compared.
    """
    spark = members.sparkSession
    sizes = members.groupBy("root").agg(F.count("*").alias("size")).where("size > 1")
    rows = members.join(sizes, "root").withColumn("large", F.col("size") > COUNTED)
    block = F.pmod(F.xxhash64("node", F.lit(3)), F.when(F.col("large"), F.ceil(F.col("size") / COUNTED).cast("long")).otherwise(1))
    packed = F.when(F.col("large"), F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(n // COUNTED + 1)))
    rows = rows.select("dim", "n", "path", "place", "large", packed.alias("pack"), block.alias("block"), "root", "node", "copies")
    element = "float" if kind == "<f4" else "double"
    rows = rows.groupBy("path").applyInArrow(_fetched(kind), f"large boolean, pack bigint, block bigint, root bigint, node bigint, copies bigint, vector array<{element}>")
    parts = stored(rows.groupBy("large", "pack", "block").applyInArrow(
        _packed(new_folder(spark, "vector-blocks"), cosine), "node bigint, n_links bigint, pack bigint, path string, n bigint, dim int"), "vector-counts")
    # Names of files, one for about COUNTED rows of a large component.
    files = parts.where("path IS NOT NULL").select("pack", "path", "n", "dim").sort("pack", "path").collect()
    pairs = Pairs([(f.pack, Block(f.path, f.n, f.dim, kind, columns=2)) for f in files], COUNTED * 4)

    def load(block: Block) -> tuple:
        (nodes, _), vectors = block.rows(0, block.n)
        return nodes, _unit(vectors)

    def compare(other: Block, start: int, stop: int, nodes: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        (others, copies), vectors = other.rows(start, stop)
        return nodes, _links_among(unit, nodes, _unit(vectors), others, copies, cosine)

    whole = _paired(spark, pairs, load, compare, "node bigint, n_links bigint")
    return parts.where("path IS NULL").select("node", "n_links").union(whole).groupBy("node").agg(F.sum("n_links").alias("outside"))


def near_duplicate_vectors(table: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors are one node, so copies are never paired; nodes are named by a
    64-bit hash, and by another one where two different vectors share it. Nodes are dealt to
    shards by a hash; a task builds the graph of each shard and writes it to a
    file, and every 8,192 nodes of a shard ask every shard. Shards are bounded in
    rows and bytes, and links are reduced to a forest as they are found, so no
    task's memory grows with the table, the dimension or a group. The beam widens until it finds all links of
    one asking vector in 16, known from looking at all of the shard, or of more
    vectors where those have few links; a beam full of links is widened to the
    whole shard. A link of vectors that are not audited may still be missed. Links are verified in
    double precision. Tasks return a spanning forest of their links, never the
    pairs of a group. When components are known, the links of each vector are
    counted exactly inside its component.

    Vectors that are null, empty, zero or hold null or non-finite components have
    no links and are their own component; vectors of different length have no
    link. Rows with the same id count as several vectors. A row without an id
    counts as a link of others; ``component_id`` is the smallest id reachable,
    null if there is none, and ``kept`` is false where an id is null.
    """
    spark = table.sparkSession
    single = table.schema[vector_col].dataType in (ArrayType(FloatType()), ArrayType(FloatType(), False))
    element, kind = ("float", "<f4") if single else ("double", "<f8")
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(f"array<{element}>").alias("vector"))
    sound = F.coalesce((F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists("vector", lambda x: x != 0), F.lit(False))
    # Adding zero makes -0.0 and 0.0 one value; the largest component of a double is scaled to one, against overflow.
    rows = rows.select("vec_id", "vector", sound.alias("sound"), F.greatest(F.array_max("vector"), -F.array_min("vector")).alias("peak"))
    scaled = F.transform("vector", lambda x: (x if single else x / F.col("peak")) + F.lit(0.0).cast(element))
    scaled_rows = rows.select("vec_id", "sound", F.when(F.col("sound"), scaled).alias("vector"))
    # About how many; only the size of the shards hangs on it.
    about, long = scaled_rows.where("sound").agg(F.approx_count_distinct(F.xxhash64("vector")), F.coalesce(F.avg(F.size("vector")), F.lit(0.0))).first()
    shards = max(SHARDS, -(-about // SHARD_ROWS), -(-int(about * long * 8) // SHARD_BYTES))
    lowest = scaled_rows.schema["vec_id"].dataType.simpleString()
    for seed in range(HASHES):
        rows = scaled_rows.withColumn("node", F.when(F.col("sound"), _node(F.col("vector"), seed)))
        nodes = rows.where("sound").groupBy("node", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("lowest"))
        dealt = nodes.withColumns({"dim": F.size("vector"), "shard": F.pmod(F.xxhash64("node", F.lit(1)), F.lit(shards))})
        nodes = stored(dealt.groupBy("dim", "shard").applyInArrow(
            _index(new_folder(spark, "vector-shards")), f"dim int, node bigint, copies bigint, lowest {lowest}, path string, place bigint, n bigint"), "vector-nodes")
        n, names = nodes.agg(F.count("*"), F.count_distinct("node")).first()
        if n == names:
            break
    else:
        raise RuntimeError(f"different vectors share a 64-bit hash, under each of {HASHES} hashes")
    files = nodes.groupBy("dim", "path").agg(F.first("n").alias("n")).sort("dim", "path").collect()
    pairs = Pairs([(f.dim, Block(f.path, f.n, f.dim, kind)) for f in files], ASKING)
    found = stored(_paired(spark, pairs, Block.graph, _ask(float(cosine)), "node bigint, other bigint"), "vector-links")
    components = stored(connected_components(found), "vector-components")
    groups = nodes.select("node", "copies", "lowest").join(components, "node", "left").join(
        _counted(nodes.join(components, "node"), n, float(cosine), kind), "node", "left").select(
        "node", "lowest", (F.coalesce("outside", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    heads = groups.groupBy("root").agg(F.min("lowest").alias("head"))
    named = groups.join(heads, "root").select("node", "n_links", "head")
    linked = rows.where("sound").select("vec_id", "node").join(named, "node").select("vec_id", "n_links", F.col("head").alias("component_id"))
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
