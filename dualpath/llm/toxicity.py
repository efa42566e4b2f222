"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic text. A window of a text (a word, or WINDOW bytes
of a longer one, set in a fixed ordinary carrier so that it is long enough to be compressed at all) is compressed with
either; the bytes that the toxic dictionary saves are its distance. A text's score comes from how many windows reach each
of LEVELS, through a logistic calibration fitted on labelled texts that the dictionaries have not seen.

Most of a toxic text is ordinary prose, so a dictionary trained on all of it would be prose too. The toxic dictionary is
trained on the spans of toxic texts whose grams are in far more toxic than ordinary texts, and then follows the ordinary one, so
that prose costs the same with both. Both serve as content: a window is too short for the entropy tables to pay.

The fit is bounded: at most SAMPLE labelled texts of a class, of at most LONGEST characters, near copies left out. They meet in
one task, which alone sees them; the driver gets the model, under 100 kB. All texts are scored whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

SAMPLE = {1: 2500, 0: 6000}
LONGEST = 20_000
FIT_SHARE = 0.6  # of the sample to train on; the rest calibrates
GRAMS = (7, 9)  # bytes, the blank before or after a word among them
RATIO = 12.0
LEAST_SHARE, LEAST = 0.01, 4
ORDINARY_BYTES = 32 << 10
TOXIC_BYTES = 4 << 10
SEGMENT, MATCH = 24, 6  # of the toxic dictionary's training
CARRIER = 32
WINDOW = 64
OVERLAP = 16
ZSTD_LEVEL = 19
LEVELS = (2, 3, 4, 6)
CACHE_WORDS = 600_000
THRESHOLD = 0.3


def words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str) -> list[bytes]:
    out = words(text)
    if max(map(len, out), default=0) > WINDOW:
        out = [w[i : i + WINDOW] for w in out for i in range(0, max(1, len(w) - OVERLAP), WINDOW - OVERLAP)]
    return out


MODEL = "ordinary binary, toxic binary, mean array<double>, scale array<double>, weights array<double>"


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model in use; remembers the distances of up to CACHE_WORDS windows."""

    def __init__(self, model: Model):
        self.model = model
        self.carrier = model.ordinary[-2 * CARRIER : -CARRIER]
        self.sizes = [_compressor(b) for b in (model.ordinary, model.ordinary + model.toxic)]
        self.known: dict[bytes, int] = {}

    def distances(self, text: str) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        parts, known = windows(text), self.known
        ordinary, toxic = self.sizes
        for part in set(parts).difference(known):
            window = b"%b %b " % (self.carrier, part)
            known[part] = len(ordinary(window)) - len(toxic(window))
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))

    def features(self, text: str) -> np.ndarray:
        found = self.distances(text)
        counts = np.array([(found >= level).sum() for level in LEVELS], float)
        return np.concatenate(([min(found.max(initial=0), 8)], np.log1p(counts), counts / max(1, len(found)) ** 0.5))

    def score(self, texts: list[str]) -> np.ndarray:
        rows = np.array([self.features(t) for t in texts]).reshape(len(texts), len(self.model.mean))
        return logistic((rows - self.model.mean) / self.model.scale, self.model.weights)


def logistic(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows @ weights[1:] + weights[0], -50, 50)))


def _compressor(content: bytes):
    raw = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=ZSTD_LEVEL)
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    return zstandard.ZstdCompressor(level=ZSTD_LEVEL, dict_data=raw, **options).compress


def _without_copies(texts: list[str]) -> list[str]:
    """One of those that share their least hash of eight words."""
    seen: dict[int, str] = {}
    for text in texts:
        own = words(text)
        seen.setdefault(min(zlib.crc32(b" ".join(own[i : i + 8])) for i in range(max(1, len(own) - 7))), text)
    return list(seen.values())


def _grams(word: bytes) -> list[bytes]:
    word = b" " + word + b" "
    return [word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1)]


def _telling_spans(toxic: list[str], ordinary: list[str]) -> Counter:
    """Spans of toxic words that are made of telling grams, and in how many texts' words they stand."""

    def texts_with(texts: list[str]) -> Counter:
        return Counter(g for t in texts for g in {g for w in set(words(t)) for g in _grams(w)})

    inside, outside = texts_with(toxic), texts_with(ordinary)
    least = max(LEAST, LEAST_SHARE * len(toxic))
    telling = {
        g for g, n in inside.items() if n >= least and n / len(toxic) >= RATIO * (outside[g] + 1) / max(1, len(ordinary))
    }
    spans: Counter = Counter()
    for text in toxic:
        for word in set(words(text)):
            padded = b" " + word + b" "
            mark = np.zeros(len(padded), bool)
            for n in GRAMS:
                for i in range(len(padded) - n + 1):
                    if padded[i : i + n] in telling:
                        mark[i : i + n] = True
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mark, [False])).astype(np.int8)))
            for a, b in zip(edges[::2], edges[1::2]):
                spans[padded[a:b]] += 1
    return spans


def _toxic_content(toxic: list[str], ordinary: list[str]) -> bytes:
    """A dictionary trained on the telling spans, each as often as it stands there."""
    spans = _telling_spans(toxic, ordinary)
    mixed = sorted((zlib.crc32(b"%d %b" % (i, s)), s) for s, n in spans.items() for i in range(n))
    samples = [b" " + s + b" " for _, s in mixed]
    try:
        return zstandard.train_dictionary(TOXIC_BYTES, samples, k=SEGMENT, d=MATCH).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to train on: the spans themselves, the commonest last
        return b"".join(sorted(spans, key=lambda s: (spans[s], s)))[-TOXIC_BYTES:]


def _ordinary_content(texts: list[str]) -> bytes:
    samples = [b" " + b" ".join(words(t)) for t in texts]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(samples)[-ORDINARY_BYTES:]


def train(toxic: list[str], ordinary: list[str], totals: dict[int, int]) -> Model:
    """From samples of either class; totals are the classes' sizes, which the calibration restores."""
    toxic, ordinary = _without_copies(toxic), _without_copies(ordinary)
    cut = [-int(-FIT_SHARE * len(x)) for x in (toxic, ordinary)]
    model = Model(_ordinary_content(ordinary[: cut[1]]), _toxic_content(toxic[: cut[0]], ordinary[: cut[1]]), np.zeros(1), np.ones(1), np.zeros(1))
    held = [(t, 1) for t in toxic[cut[0] :]] + [(t, 0) for t in ordinary[cut[1] :]]
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    scorer = model.scorer()
    size = 1 + 2 * len(LEVELS)
    rows = np.array([scorer.features(t) for t, _ in held]).reshape(len(held), size)
    labels = np.array([label for _, label in held], float)
    if not 0 < labels.sum() < len(labels):  # nothing to tell apart: the class share is all there is
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(model.ordinary, model.toxic, np.zeros(size), np.ones(size), np.concatenate(([odds], np.zeros(size))))
    each = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    weights = _fit(np.c_[np.ones(len(rows)), (rows - mean) / scale], labels, each)
    return Model(model.ordinary, model.toxic, mean, scale, weights)


def _fit(x: np.ndarray, y: np.ndarray, each: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps of a penalized logistic regression, halved while the loss would rise."""
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6

    def loss(w):
        z = x @ w
        return (each * (np.logaddexp(0, z) - y * z)).sum() + w @ penalty @ w / 2

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = logistic(x[:, 1:], w)
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (each * (y - p)) - penalty @ w)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: Column) -> Column:
    """Rows whose labels must not be learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic), rows held out by held_out() left aside.

    Null ids, texts and labels teach nothing. The sample is the same for the same labels, however they are partitioned.
    """
    common.tune(docs.sparkSession)
    sample = sample or SAMPLE
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in usable.filter("toxic in (0, 1)").groupBy("toxic").count().collect()}
    chosen = None
    for kind, most in sample.items():
        some = usable.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most the sample's ids are broadcast, and only its texts are shuffled.
    short = docs.select("doc_id", "text").filter(F.length("text") <= LONGEST)
    rows = short.join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, list[str]] = {0: [], 1: []}
        for batch in batches:
            for text, kind in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                texts[kind].append(text)
        for own in texts.values():
            own.sort(key=lambda t: (zlib.crc32(t.encode()), t))
        model = train(texts[1], texts[0], totals)
        values = model.ordinary, model.toxic, model.mean, model.scale, model.weights
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, common.arrow_types(MODEL).values())], names=list(common.arrow_types(MODEL)))

    found = rows.repartition(1).mapInArrow(trained, MODEL).collect()
    if not found:  # no rows, no task
        return train([], [], totals)
    ordinary, toxic, *numbers = found[0]
    return Model(bytes(ordinary), bytes(toxic), *map(np.array, numbers))


def score(docs: DataFrame, keep: list[str], model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns `keep`, score (0 to 1) and predicted (1 from `threshold` on), one row per row.

    Only the text is an input. Null and empty texts have no windows and get the score of a text without toxic windows.
    Carried columns may be null or repeat; an empty table gives an empty result.
    """
    common.tune(docs.sparkSession)
    carried = common.Carried(docs, keep)

    def make():
        scorer = model.scorer()

        def work(texts: list) -> dict:
            scores = scorer.score([t or "" for t in texts])
            return {"score": scores, "predicted": (scores >= threshold).astype(np.int32)}

        return work

    out = common.map_texts(carried.take(docs, _text=F.col(f"`{text}`")), carried, "score double, predicted int", make)
    return out.select(*carried.back(), "score", "predicted")
