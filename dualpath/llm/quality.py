"""Quality by Bradley-Terry pairwise ranking.

A text is a row of features: shares of its words and characters of some kind, repetition, line lengths. The model is one
weight a feature: the probability that one document is better than another is the logistic function of the weighted
difference of their features. It is learned from preference pairs, a labelled good document before a labelled poor one, by
Newton steps whose sums Spark forms over all buckets of labelled rows; a row is in as many pairs as PAIRS, so pairs grow with
the rows and not with their square. The quantile of the ranking scores that leaves the labelled share of poor documents
below it is put at the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

THRESHOLD = 0.3
PAIRS = 4
BUCKET = 2048  # labelled rows a bucket, about
BLOCK = 100  # words among which repeats are counted
CACHE_WORDS = 500_000
RIDGE = 1e-3  # a pair
ROUNDS = 25
CLOSE = 1e-6

PLAIN = frozenset(".,;:!?'\"-()’“”«»")
TAIL = ".,;:!?*#%$&@~^_=+-|/\\"
LENGTHS = 16


def word_kind(word: str) -> tuple:
    """What one word adds to the shares."""
    letters = len(word) if word.isalpha() else sum(map(str.isalpha, word))
    odd = 0 if letters == len(word) else sum(not c.isalnum() and c not in PLAIN for c in word)
    tail = len(word) - len(word.rstrip(TAIL))
    return (
        letters == 0, letters > 1 and word.isupper(), word[:1].isupper(), odd > 0, tail > 1, any(map(str.isdigit, word)), len(word) == 1,
        len(word), 0 if word.islower() else sum(map(str.isupper, word)), letters, odd, word.count("!"),
    )


KINDS = 12
SHARES = KINDS + 6
FEATURES = 2 * SHARES + 2


class Words(dict):
    """Numbers of words, and their kinds."""

    def __init__(self):
        super().__init__()
        self.kinds = np.zeros((1 << 12, KINDS), np.float32)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        if number == len(self.kinds):
            self.kinds = np.concatenate([self.kinds, np.zeros_like(self.kinds)])
        self.kinds[number] = word_kind(word)
        return number

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def distinct_share(numbers: np.ndarray) -> float:
    """Distinct words among BLOCK at a time, so that it does not depend on the text's length."""
    full = len(numbers) // BLOCK * BLOCK
    seen = 0
    if full:
        blocks = np.sort(numbers[:full].reshape(-1, BLOCK), axis=1)
        seen = int((np.diff(blocks, axis=1) != 0).sum()) + len(blocks)
    rest = len(np.unique(numbers[full:]))
    return (seen + rest) / len(numbers)


def features(text: str, words: Words) -> np.ndarray:
    """FEATURES numbers; zeros for a text without words."""
    if len(words) > CACHE_WORDS:
        words.clear()
    own = text.split()
    n = len(own)
    if not n:
        return np.zeros(FEATURES)
    numbers = words.of(own)
    kept, counts = np.unique(numbers, return_counts=True)
    kinds = counts @ words.kinds[kept].astype(float)
    chars = max(1.0, kinds[7])
    shares = np.empty(SHARES)
    shares[:7] = kinds[:7] / n
    shares[7] = kinds[7] / n / LENGTHS
    shares[8] = kinds[8] / max(1.0, kinds[9])
    shares[9:12] = kinds[9:12] / chars
    lines = [s for s in text.split("\n") if s.strip()]
    shares[12] = (numbers[1:] == numbers[:-1]).sum() / n
    shares[13] = 1 - distinct_share(numbers)
    shares[14] = 1 - len(set(lines)) / len(lines)
    shares[15] = len(lines) / n
    shares[16] = counts.max() / n
    shares[17] = sum(s.count(s.strip()[-1]) > 4 for s in lines) / len(lines)
    return np.concatenate([shares, np.sqrt(np.maximum(shares, 0)), [np.log1p(n) / 10, min(n, BLOCK) / BLOCK]])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float  # put on the ranking score: its logistic is the score

    def scores(self, rows: np.ndarray) -> np.ndarray:
        raw = (rows - self.mean) / self.scale @ self.weights
        return 1 / (1 + np.exp(-np.clip(raw + self.shift, -30, 30)))


def held_out(id_col: Column) -> Column:
    """Rows whose labels must not be learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def featured(docs: DataFrame, keep: list[str], text: str = "text") -> tuple[DataFrame, common.Carried]:
    """The kept columns under inner names and f, the features of each whole text; written."""
    common.tune(docs.sparkSession)
    carried = common.Carried(docs, keep)

    def make():
        words = Words()
        return lambda texts: {"f": [features(t or "", words) for t in texts]}

    out = common.map_texts(carried.take(docs, _text=F.col(f"`{text}`")), carried, "f array<double>", make)
    return common.written(out, "features"), carried


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, FEATURES))


def _bucket(rows: pa.Table) -> pa.Table:
    """A bucket's good and poor rows as two matrices."""
    rows = rows.combine_chunks()
    f = np.vstack([matrix(c) for c in rows.column("f").chunks]) if len(rows) else np.zeros((0, FEATURES))
    good = rows.column("good").to_numpy() == 1
    order = np.argsort(rows.column("h").to_numpy(), kind="stable")
    f, good = f[order], good[order]
    return pa.table({"good": pa.array([f[good].tobytes()], pa.binary()), "poor": pa.array([f[~good].tobytes()], pa.binary())})


def pairs(good: np.ndarray, poor: np.ndarray) -> np.ndarray:
    """Differences of PAIRS pairs for each row of the larger class."""
    if not len(good) or not len(poor):
        return np.zeros((0, FEATURES))
    n = max(len(good), len(poor))
    at = np.arange(n * PAIRS)
    # Round after round the smaller class moves on by one, so that pairs differ.
    one, other = at % n, (at % n + at // n) % min(len(good), len(poor))
    return good[one] - poor[other] if len(good) >= len(poor) else good[other] - poor[one]


def _sums(weights: np.ndarray, scale: np.ndarray):
    """Loss, gradient and Hessian over a partition's pairs, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, gradient, hessian = 0, 0.0, np.zeros(FEATURES), np.zeros((FEATURES, FEATURES))
        for batch in batches:
            for row in batch.to_pylist():
                x = pairs(*(np.frombuffer(row[c]).reshape(-1, FEATURES) for c in ("good", "poor"))) / scale
                z = x @ weights
                p = 1 / (1 + np.exp(np.clip(z, -500, 500)))
                n, loss = n + len(x), loss + np.logaddexp(0, -z).sum()
                gradient += x.T @ p
                hessian += (x * (p * (1 - p))[:, None]).T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([loss], pa.float64()), pa.array([gradient.tobytes()]), pa.array([hessian.tobytes()])],
            names=["n", "loss", "gradient", "hessian"],
        )

    return run


def _total(buckets: DataFrame, weights: np.ndarray, scale: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
    # One row of fixed size a partition of the buckets.
    rows = buckets.mapInArrow(_sums(weights, scale), "n long, loss double, gradient binary, hessian binary").collect()
    rows.sort(key=lambda r: (r["n"], r["loss"], r["gradient"]))
    gradient = sum((np.frombuffer(r["gradient"]) for r in rows), np.zeros(FEATURES))
    hessian = sum((np.frombuffer(r["hessian"]).reshape(FEATURES, FEATURES) for r in rows), np.zeros((FEATURES, FEATURES)))
    return sum(r["n"] for r in rows), sum(r["loss"] for r in rows), gradient, hessian


def fit(rows: DataFrame, labels: DataFrame, id_col: str, threshold: float = THRESHOLD) -> Model:
    """A model from featured rows and all usable labels (doc_id, quality): none held out, null, or at odds for one id."""
    spark = rows.sparkSession
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("most")).filter("good = most")
    own = rows.select(F.col(id_col).alias("doc_id"), "f").dropDuplicates(["doc_id", "f"])
    known = common.written(own.join(agreed, "doc_id").select("good", "f", F.xxhash64("doc_id", "f").alias("h")), "labelled")
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("good"), F.lit(0))).first()
    start = np.log(threshold / (1 - threshold))
    if not 0 < good < n:  # nothing to tell apart
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0 if not n else 5.0 if good else -5.0)
    spread = known.agg(*[f(F.get("f", F.lit(i))) for f in (F.avg, F.stddev_pop) for i in range(FEATURES)]).first()
    mean, scale = np.array(spread[:FEATURES]), np.array(spread[FEATURES:])
    scale = np.where(scale > 1e-9, scale, 1.0)
    dealt = known.withColumn("bucket", F.pmod("h", F.lit(common.pieces(n, BUCKET))))
    buckets = common.written(dealt.groupBy("bucket").applyInArrow(_bucket, "good binary, poor binary"), "buckets")

    weights = np.zeros(FEATURES)
    count, loss, gradient, hessian = _total(buckets, weights, scale)
    for _ in range(ROUNDS if count else 0):
        penalty = RIDGE * count
        step = np.linalg.solve(hessian + penalty * np.eye(FEATURES), gradient - penalty * weights)
        before = loss + penalty * weights @ weights / 2
        while True:
            _, loss, gradient, hessian = _total(buckets, weights + step, scale)
            if loss + penalty * (weights + step) @ (weights + step) / 2 <= before or np.abs(step).max() < CLOSE:
                break
            step = step / 2
        weights = weights + step
        if np.abs(step).max() < CLOSE * 100:
            break
    raw = sum((F.get("f", F.lit(i)) - float(mean[i])) * float(weights[i] / scale[i]) for i in range(FEATURES))
    at = known.agg(F.percentile_approx(raw, (n - good) / n, 100_000)).first()[0]
    return Model(mean, scale, weights, float(start - at))


def score(rows: DataFrame, carried: common.Carried, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The carried columns, score (0 to 1) and predicted (1 from `threshold` on), one row per featured row."""
    names = carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(matrix(batch.column("f")))
            columns = [batch.column(n) for n in names] + [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score", "predicted"])

    return rows.mapInArrow(run, carried.schema("score double, predicted int")).select(*carried.back(), "score", "predicted")


def rank(docs: DataFrame, labels: DataFrame, keep: list[str], id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns `keep`, score and predicted, one row per row of docs, by a model learned from all labels not held out.

    Only the text is an input of a score. Null and empty texts have zero for every feature and get the score of that row. Rows
    with a null id teach nothing; rows that repeat teach once. Without labels every score is 0.5, with labels of one class all
    scores are on its side. An empty table gives an empty result; columns of any name may be kept.
    """
    rows, carried = featured(docs, list(dict.fromkeys([*keep, id_col])), text)
    model = fit(rows, labels, carried.inner[carried.names.index(id_col)], threshold)
    out = score(rows, carried, model, threshold)
    if id_col in keep:
        return out
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in [*keep, "score", "predicted"]])
