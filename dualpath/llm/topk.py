"""Exact top-k inner products with MaxScore.

A query's terms are its dimensions; a term's postings are the candidates' components in it. In a shard each term adds at
least its least impact, so scores are that base plus impacts from 0 up to the term's bound. Terms are ordered by bound.
Those of the smallest bounds whose sum can't lift a candidate to the query's k-th best score so far are non-essential:
only the essential postings are traversed, and the others are probed, largest bound first, for candidates that can still
compete. The threshold rises from block to block of a shard; the shards' best are merged.

Candidates are dealt to shards by a hash of their id, queries to blocks; each pair of a shard and a block is a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common, vectors

SCALE = 256
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
STEP = 2048  # candidates between two rises of the threshold
PROBE = 8  # terms probed between two looks at what is still competitive
# Sums up to here are exact in doubles, and in 64-bit integers; beyond, Python's own integers take over.
EXACT, WIDE = float(1 << 53), float(1 << 63)
LONG = np.iinfo(np.int64)


class Shard:
    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high = self.rows.min(0), self.rows.max(0)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard's best k ids and scores for one query, its own id left out."""
        ends = query * self.low, query * self.high
        base, bound = np.minimum(*ends), np.abs(ends[1] - ends[0])
        terms = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)  # what the terms from here on can add
        floor = base.sum()
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)
        for at in range(0, len(self.ids), STEP):
            rows, here = self.rows[at : at + STEP], np.arange(at, min(at + STEP, len(self.ids)))
            full = len(scores) == k
            least = scores[k - 1] if full else floor  # no score is below the floor
            essential = int(np.searchsorted(-rest, floor - least, side="right")) if full else len(terms)
            # Terms from `essential` on sum to less than what is needed: no candidate gets in by them alone.
            essential = min(max(essential, 1), len(terms))
            use = terms[:essential]
            got = rows[:, use] @ query[use] - base[use].sum() + floor
            keep = self.ids[here] != own
            keep &= got + rest[essential] >= least
            here, got, rows = here[keep], got[keep], rows[keep]
            while essential < len(terms) and len(here):
                more = terms[essential : essential + PROBE]
                essential += len(more)
                got = got + rows[:, more] @ query[more] - base[more].sum()
                keep = got + rest[essential] >= least
                here, got, rows = here[keep], got[keep], rows[keep]
            ids, scores = np.concatenate((ids, self.ids[here])), np.concatenate((scores, got))
            top = _order(ids, scores)[:k]
            ids, scores = ids[top], scores[top]
        return ids, scores


def _order(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Highest scores first, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), np.int64)
    return np.lexsort((ids, -scores))


def _exact(x: np.ndarray, q: np.ndarray) -> type:
    """A type in which partial sums of the products, which start at the base, are exact."""
    most = 4 * max(1, x.shape[1]) * np.abs(x).max(initial=0) * np.abs(q).max(initial=0)
    return np.float64 if most < EXACT else np.int64 if most < WIDE else object


def _as(rows: np.ndarray, kind: type) -> np.ndarray:
    """Whole doubles in another type."""
    if kind is object:
        return np.array([int(x) for x in rows.ravel().tolist()], object).reshape(rows.shape)
    return rows.astype(kind, copy=False)


def top_k(df: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (long): the k highest integer inner products of each query.

    Components are floor(scale * x). Queries are the rows whose id is divisible by 50, candidates all rows but a query's
    own id. Ties go to the smaller id; with fewer candidates all are returned. Rows whose id is null, or whose vector is
    null or holds null, NaN or infinite components, take no part; an id that repeats counts once, with its least vector;
    shorter vectors are padded with zeros, so an empty one scores 0. Scores are exact, whatever the components (scaled ones
    beyond the largest double count as that); a score that a long can't hold is given as the largest or smallest long. An empty
    table gives an empty result. Other columns are not read.
    """
    common.tune(df.sparkSession)
    # Doubles from 2^53 on are whole already, and floor() would cut them to a long.
    top = F.lit(float(np.finfo(float).max))
    whole = F.transform("vector", lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(F.least(F.greatest(x * scale, -top), top)))
    rows = common.written(vectors.usable(df, id_col, vector).select("vec_id", whole.alias("vector")), "quantized")
    queries = vectors.queries_of(rows)
    n, asked = rows.count(), queries.count()
    shards, blocks = common.pieces(n, SHARD_ROWS), common.pieces(asked, BLOCK_QUERIES)
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", each(blocks))
    right = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("shard", each(shards))

    def run(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(candidates) and len(asked):
            x, q = vectors.matrix(candidates.column("vector")), vectors.matrix(asked.column("vector"))
            width = max(x.shape[1], q.shape[1])
            x, q = vectors.matrix(candidates.column("vector"), width), vectors.matrix(asked.column("vector"), width)
            kind = _exact(x, q)
            shard = Shard(candidates.column("vec_id").to_numpy(), _as(x, kind))
            for own, query in zip(asked.column("query_id").to_pylist(), _as(q, kind)):
                ids, scores = shard.search(query, own, k)
                found["query_id"] += [own] * len(ids)
                found["vec_id"] += ids.tolist()
                found["score"] += [min(max(int(s), LONG.min), LONG.max) for s in scores.tolist()]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    scored = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score long")
    return vectors.best(scored, k)
