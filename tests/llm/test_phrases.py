"""Phrases against a plain count, with small chunks, summaries that must give counters up, and a full bit map."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dualpath.llm import phrases

SCHEMA = "doc_id long, text string, lang string, f long, phrase string, size int"


def texts():
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "x y", "Zed"]
    out = []
    for i in range(160):
        ws = [draw.choice(vocabulary[: 10 if draw.random() < 0.4 else 43]) for _ in range(draw.randint(1, 260))]
        text = "".join(w + draw.choice([" ", " ", " ", "\t", ", ", ".\n", "\x0b", "!?"]) for w in ws)
        out.append((i, text, ("en", "de", None, "und")[i % 4]))
    hot = "New York City is new york city; " * 40
    return [*out, (200, hot, "en"), (200, hot, "en"), (201, None, "en"), (202, "", "fr"), (203, " .,; \r", None), (None, "a a a a a a a a a a a a a", "fr"), (204, "lone words here", "it")]


def plain(rows, least, top, covered=50):
    counts = defaultdict(Counter)
    n = Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    out = set()
    for lang, f in counts.items():
        longer = Counter()
        for g, a in f.items():
            if len(g) == 3 and a >= least:
                for part in (g[:2], g[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for g, a in f.items():
            if len(g) > 1 and a >= least and not (longer[g] and 100 * longer[g] >= covered * a):
                score, _, l, r = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, name, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, name.decode(), -a, l, r, n[lang], -score))
    return out


@pytest.mark.parametrize("bits, top", [(28, 2000), (19, 7)])
def test_phrases(spark, bits, top):
    df = spark.createDataFrame([(i, t, lang, 1, "p", 2) for i, t, lang in texts()], SCHEMA).repartition(3)
    got = phrases.phrases(df, top=top, map_bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in got.collect()]
    want = plain(texts(), 10, top)
    assert len(rows) == len(want) and set(rows) == want and len(want) > 20


@pytest.mark.parametrize("chunk, codes", [(1 << 20, 21), (7, 21), (30, 6), (100, 8)])
def test_counts_in_small_chunks(monkeypatch, chunk, codes):
    """Texts longer than a chunk, and word numbers that run out, against a plain count; tasks call these functions."""
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "CODE_BITS", codes)
    rows = [r for r in texts() if r[1]][:60] + texts()[-9:]
    rows = [(i, " ".join(t.split(" ")[:40]) if codes < 21 and t else t, lang) for i, t, lang in rows]
    batches = [pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows[i : i + 10]], "text": [r[1] for r in rows[i : i + 10]]}) for i in range(0, len(rows), 10)]
    batches = [b.set_column(1, "text", b.column("text").cast(pa.string())) for b in batches]
    want, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            want.update((lang or "und", " ".join(ws[i : i + k])) for k in (1, 2, 3) for i in range(len(ws) - k + 1))

    class All:
        value = np.full(8, 255, np.uint8)

    packed = sorted(b for batch in phrases.exact_counts(3, 5, All)(iter(batches)) for b in (tuple(r.values()) for r in batch.to_pylist()))
    names = ["bucket", "lang", "n", "phrases", "counts"]
    found = phrases.summed(1)(iter([pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in packed])]))
    got, words = Counter(), Counter()
    for r in (r for b in found for r in b.to_pylist()):
        (got if r["size"] else words)[(r["lang"], r["phrase"]) if r["size"] else r["lang"]] += r["f"]
    assert got == want and {k: v for k, v in words.items() if v} == {k: v for k, v in n.items() if v}
    hashed = Counter()
    for b in phrases.summaries(3)(iter(batches)):
        for r in b.to_pylist():
            hashes, counts = phrases.unpacked(r["data"], r["n"])
            assert r["mass"] == counts.sum()
            hashed.update({(r["part"], h): c for h, c in zip(hashes.tolist(), counts.tolist())})
    assert sorted(hashed.values()) == sorted(want.values())


def test_phrases_of_no_rows(spark):
    assert phrases.phrases(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.phrases(spark.createDataFrame([(1, None, None, 1, "p", 2)], SCHEMA)).count() == 0


@pytest.mark.parametrize("steps", [1, 7, 50])
def test_summaries_keep_what_is_frequent(steps):
    draw = np.random.default_rng(steps)
    stream = np.concatenate([draw.integers(0, 5000, 20_000), np.repeat(draw.integers(10_000, 10_040, 40), draw.integers(20, 400, 40))]).astype(np.uint64)
    draw.shuffle(stream)
    least = 200
    own = phrases.Summary(len(stream) // least + 1)
    for part in np.array_split(stream, steps):
        own.add(*np.unique(part, return_counts=True))
        own.merge()
    found, counts = np.unique(stream, return_counts=True)
    assert own.less < least and len(own.hashes) <= own.most
    assert set(found[counts >= least].tolist()) <= set(own.frequent(least).tolist())
    exact = dict(zip(found.tolist(), counts.tolist()))
    assert all(0 <= exact[h] - c <= own.less for h, c in zip(own.hashes.tolist(), own.counts.tolist()))


def test_packed_hashes():
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 999).astype(np.uint64))
    counts = np.arange(len(hashes)) * 1000
    back, n = phrases.unpacked(phrases.packed(hashes, counts), len(hashes))
    assert back.tolist() == hashes.tolist() and n.tolist() == counts.tolist()
    assert phrases.unpacked(phrases.packed(hashes), len(hashes))[0].tolist() == hashes.tolist()
    assert len(phrases.unpacked(phrases.packed(hashes[:0]), 0)[0]) == 0
