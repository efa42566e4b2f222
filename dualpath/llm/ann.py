"""Approximate nearest neighbours by cosine, over balanced posting lists.

Fit: a bounded sample (SAMPLE vectors) is halved again and again along its two-means axis at the median, so all leaves
have the same size; their means are the centroids. The centroids' neighbour graph is kept in memory and searched best
first; it is the only thing sent to all tasks, and is bounded by CENTROIDS.

Index: every row goes to the list of its nearest centroid, and rows near a boundary also to the next ones within
(1 + BOUNDARY) of that distance, unless a list already chosen is nearer to that centroid than the row is. Lists longer
than PART are dealt to parts by a hash, so a vector that a third of all rows share is many tasks.

Search: a query reads the lists whose centroid is within (1 + RATIO) of its nearest one, and more until they hold ENOUGH
rows. The graph search widens until it has gone past that ratio, so no limit cuts lists off. Scores are computed from the
original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common, vectors

SAMPLE = 20_000
CENTROIDS = 4096
LIST_ROWS = 100
DEGREE = 24
BOUNDARY = 0.1
REPLICAS = 4
RATIO = 0.25
ENOUGH = 200
PART = 4096
BIN_ROWS = 16_384  # rows of lists in a task, about
WIDTH = 32  # of the first graph search
MARGIN = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def halves(rows: np.ndarray, leaves: int, seed: int = 7) -> np.ndarray:
    """Unit means of `leaves` (a power of two) equal parts of rows."""
    draw = np.random.default_rng(seed)
    parts = [rows]
    while len(parts) < leaves:
        split = []
        for part in parts:
            a, b = part[draw.choice(len(part), 2, replace=False)] if len(part) > 1 else (part[0], part[0])
            for _ in range(4):
                near = ((part - a) ** 2).sum(1) <= ((part - b) ** 2).sum(1)
                a = part[near].mean(0) if near.any() else a
                b = part[~near].mean(0) if not near.all() else b
            order = np.argsort(part @ (b - a), kind="stable")
            split += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
        parts = [p for p in split if len(p)]
        if len(parts) == len(rows):
            break
    means = np.array([p.mean(0) for p in parts])
    norms = np.sqrt((means * means).sum(1))
    return np.unique(unit(means[norms > 1e-9]), axis=0) if (norms > 1e-9).any() else unit(rows[:1])


class Graph:
    """Centroids and their nearest neighbours, both ways, searched best first for many vectors at a time."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.centroids = centroids
        n = len(centroids)
        degree = min(degree, n - 1)
        near = np.zeros((n, degree), np.int64)
        for at in range(0, n, 1024):
            close = centroids[at : at + 1024] @ centroids.T
            close[np.arange(len(close)), np.arange(at, at + len(close))] = -np.inf
            near[at : at + 1024] = np.argsort(-close, axis=1, kind="stable")[:, :degree]
        back: list[set[int]] = [set() for _ in range(n)]
        for i, row in enumerate(near.tolist()):
            back[i].update(row)
            for j in row:
                if len(back[j]) < 2 * degree:
                    back[j].add(i)
        width = max(map(len, back), default=0)
        self.links = np.array([sorted(b) + [i] * (width - len(b)) for i, b in enumerate(back)], np.int64).reshape(n, width)
        self.entries = np.unique(np.linspace(0, n - 1, max(1, int(n**0.5)), dtype=np.int64))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest centroids found for each unit row, nearest first, and their distances."""
        n, width = len(self.centroids), min(width, len(self.centroids))
        if width == n or len(self.entries) >= n:
            close = x @ self.centroids.T
            order = np.argsort(-close, axis=1, kind="stable")[:, :width]
            return order, distance(np.take_along_axis(close, order, 1))
        rows = np.arange(len(x))[:, None]
        seen = np.zeros((len(x), n), bool)
        start = np.broadcast_to(self.entries, (len(x), len(self.entries)))
        seen[rows, start] = True
        beam, score = start.copy(), x @ self.centroids[self.entries].T
        grown = np.zeros(beam.shape, bool)
        while True:
            order = np.argsort(-score, axis=1, kind="stable")[:, :width]
            beam, score, grown = (np.take_along_axis(v, order, 1) for v in (beam, score, grown))
            todo = np.flatnonzero(~grown.all(1))
            if not len(todo):
                break
            step = np.argmin(grown[todo], axis=1)  # the best that was not yet grown
            grown[todo, step] = True
            links = self.links[beam[todo, step]]
            fresh = ~seen[todo[:, None], links]
            seen[todo[:, None], links] = True
            value = np.full((len(x), links.shape[1]), -np.inf)
            value[todo] = np.where(fresh, np.einsum("ijk,ik->ij", self.centroids[links], x[todo]), -np.inf)
            node = np.zeros(value.shape, np.int64)
            node[todo] = links
            beam, score = np.concatenate((beam, node), 1), np.concatenate((score, value), 1)
            grown = np.concatenate((grown, np.isinf(value)), 1)
        return beam, distance(score)

    def within(self, x: np.ndarray, ratio: float, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each unit row the centroids within (1 + ratio) of its nearest, nearest first, and the first beyond."""
        out: list = [None] * len(x)
        todo = np.arange(len(x))
        while len(todo):
            found, far = self.search(x[todo], width)
            beyond = far > far[:, :1] * (1 + ratio) + 1e-12
            done = beyond.any(1) | (found.shape[1] == len(self.centroids))
            for i in np.flatnonzero(done):
                fits = np.isfinite(far[i])
                out[todo[i]] = found[i][fits], far[i][fits]
            todo, width = todo[~done], width * 2
        return iter(out)


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def lists_of(graph: Graph, x: np.ndarray, boundary: float, replicas: int) -> list[list[int]]:
    """The lists each unit row belongs to, its home first."""
    out = []
    for nodes, far in graph.within(x, boundary):
        chosen = [int(nodes[0])]
        for node, d in zip(nodes[1:].tolist(), far[1:].tolist()):
            if len(chosen) == replicas or d > far[0] * (1 + boundary):
                break
            spread = distance(graph.centroids[chosen] @ graph.centroids[node])
            if (spread >= d).all():
                chosen.append(node)
        out.append(chosen)
    return out


def fit(rows: DataFrame, n: int, sample: int = SAMPLE, centroids: int = CENTROIDS, list_rows: int = LIST_ROWS) -> Graph | None:
    """From at most `sample` rows, the same ones for the same table; None without rows."""
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    if not len(some):
        return None
    x = np.unique(unit(vectors.matrix(some.column("vector"))), axis=0)
    most = min(centroids, max(1, n // list_rows), max(1, len(x) // 8))
    return Graph(halves(x, 1 << (most.bit_length() - 1)))


def neighbours(
    df: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector: str = "embedding",
    ratio: float = RATIO,
    boundary: float = BOUNDARY,
    replicas: int = REPLICAS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (double): the k nearest found for each query, by cosine.

    Queries are the rows whose id is divisible by 50, candidates all rows but a query's own id. Ties go to the smaller id;
    with fewer candidates all are returned. Rows whose id is null, or whose vector is null, zero, empty or holds null, NaN
    or infinite components, take no part; an id that repeats counts once, with its least vector; shorter vectors are
    padded with zeros. An empty table gives an empty result. Other columns are not read.
    """
    spark = common.tune(df.sparkSession)
    nonzero = F.exists("vector", lambda x: x != 0)
    rows = common.written(vectors.usable(df, id_col, vector).filter(nonzero), "vectors")
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    graph = fit(rows, n)
    if graph is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if graph.centroids.shape[1] < width:  # the sample had shorter vectors only
        graph = Graph(np.pad(graph.centroids, ((0, 0), (0, width - graph.centroids.shape[1]))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = lists_of(graph, unit(vectors.matrix(batch.column("vector"), width)), boundary, replicas)
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            home = np.concatenate([np.arange(len(f)) == 0 for f in found]) if found else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for f in found for c in f], pa.int64()), pa.array(home), batch.column("vec_id").take(pa.array(at)), batch.column("vector").take(pa.array(at))],
                names=["list", "home", "vec_id", "vector"],
            )

    index = common.written(rows.mapInArrow(assign, "list long, home boolean, vec_id long, vector array<double>"), "postings")
    sizes = index.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("long")).alias("homes")).collect()  # one row a centroid
    homes = np.zeros(len(graph.centroids), np.int64)
    parts = np.ones(len(graph.centroids), np.int64)
    for row in sizes:
        homes[row["list"]], parts[row["list"]] = row["homes"], -(-row["n"] // PART)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(vectors.matrix(batch.column("vector"), width))
            at, lists, part = [], [], []
            for i, (nodes, far) in enumerate(graph.within(x, ratio)):
                use = int((far <= far[0] * (1 + ratio) + 1e-12).sum())
                if homes[nodes[:use]].sum() < min(ENOUGH, n):  # rare, so all centroids are looked at
                    nodes = np.argsort(-(graph.centroids @ x[i]), kind="stable")
                    use = max(use, int(np.searchsorted(np.cumsum(homes[nodes]), min(ENOUGH, n))) + 1)
                use = nodes[:use][homes[nodes[:use]] >= 0]
                for node in use.tolist():
                    for p in range(parts[node]):
                        at.append(i)
                        lists.append(node)
                        part.append(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.int64()), pa.array(part, pa.int64()), batch.column("query_id").take(pa.array(at, pa.int64())), batch.column("vector").take(pa.array(at, pa.int64()))],
                names=["list", "part", "query_id", "vector"],
            )

    split = F.pmod(F.xxhash64("vec_id"), F.element_at(F.array(*[F.lit(int(p)) for p in parts]), (F.col("list") + 1).cast("int")))
    # Several parts of lists share a task, which merges what its queries find in them.
    bins = common.pieces(sum(row["n"] for row in sizes), BIN_ROWS)
    bin_of = F.pmod(F.xxhash64("list", "part"), F.lit(bins)).alias("bin")
    left = index.select("list", split.cast("long").alias("part"), "vec_id", "vector").select(bin_of, "*")
    right = vectors.queries_of(rows).mapInArrow(probe, "list long, part long, query_id long, vector array<double>").select(bin_of, "*")

    def score(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(candidates) and len(asked):
            ids, owners = candidates.column("vec_id").to_numpy(), asked.column("query_id").to_numpy()
            x, q = vectors.matrix(candidates.column("vector"), width), vectors.matrix(asked.column("vector"), width)
            of, wanted = (_by_part(t) for t in (candidates, asked))
            for part in of.keys() & wanted.keys():
                found += _search(ids[of[part]], x[of[part]], owners[wanted[part]], q[wanted[part]], k)
        own, ids, scores = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids, -scores, own))
        own, ids, scores = own[order], ids[order], scores[order]
        first = np.ones(len(own), bool)
        first[1:] = (own[1:] != own[:-1]) | (ids[1:] != ids[:-1])  # a row of two lists has one score, so it is next to itself
        own, ids, scores = own[first], ids[first], scores[first]
        best = np.arange(len(own)) - np.searchsorted(own, own) < k
        return pa.table({"query_id": pa.array(own[best]), "vec_id": pa.array(ids[best]), "score": pa.array(scores[best])})

    scored = left.groupBy("bin").cogroup(right.groupBy("bin")).applyInArrow(score, "query_id long, vec_id long, score double")
    return vectors.best(scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)


def _by_part(rows: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """Which rows each part of a list has."""
    lists, parts = rows.column("list").to_numpy(), rows.column("part").to_numpy()
    order = np.lexsort((parts, lists))
    lists, parts = lists[order], parts[order]
    edges = np.flatnonzero((np.diff(lists) != 0) | (np.diff(parts) != 0)) + 1
    groups = np.split(order, edges)
    return {(int(lists[a]), int(parts[a])): g for a, g in zip([0, *edges.tolist()], groups)}


def _search(ids: np.ndarray, x: np.ndarray, owners: np.ndarray, q: np.ndarray, k: int) -> list[tuple]:
    """For each query its id, and the ids and scores of the k nearest rows of x."""
    norms, rough, out = np.sqrt(np.einsum("ij,ij->i", x, x)), unit(q) @ unit(x).T, []
    for own, vector, close in zip(owners, q, rough):
        close[ids == own] = -np.inf
        floor = np.partition(close, -k)[-k] if len(close) > k else -np.inf
        some = np.flatnonzero((close >= floor - MARGIN) & (close > -np.inf))
        # Row by row in the same order, so equal vectors get equal scores.
        exact = np.einsum("ij,j->i", x[some], vector) / (norms[some] * np.sqrt(np.einsum("i,i->", vector, vector)))
        top = np.lexsort((ids[some], -exact))[:k]
        out.append((np.full(len(top), own), ids[some][top], exact[top]))
    return out
