"""Each operator against a plain version, on a small table with odd rows and on an empty one."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

import corpus_pipeline
from dualpath.llm import ann, bpe, components, mixing, near_copies, simhash, substring, token_counts, tokenfile, topk, toxicity, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
# Extra columns with names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, `_c0` int, n_words string, fp long"


def rows():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    out = []
    for i in range(1, 60):
        text = " ".join(word() for _ in range(draw.randint(1, 90)))
        if i % 7 == 0:
            text += " \t\n" + passage + " x\x0b" + word()
        out.append((i, text, "en", f"s{i % 4}" if i % 9 else None))
    base = " ".join(word() for _ in range(400))
    out += [(100, base, "en", "s1"), (101, base, None, "s2"), (102, base + " end", "en", "s0"), (102, base + " end", "en", "s0")]
    out += [(110, None, None, None), (111, "", "en", "s0"), (112, " \n ", "en", "s0"), (None, "a lone text", "de", None), (None, base, "de", "s1")]
    out += [(120, "spam " * 5000, "en", "hot"), (121, "x" * 40000, "en", "s0"), (122, "O'Neil's <|endoftext|> é́ \U0001f642\r\n  end  ", "fr", "s0")]
    return [(i, t, lang, s, None if t is None else len(t), "c", 1, "w", 0) for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_cover_aligns_any_two_places():
    differences = {(a - b) % substring.PERIOD for a in substring.COVER.tolist() for b in substring.COVER.tolist()}
    assert differences == set(range(substring.PERIOD))


@pytest.mark.parametrize("chunk_bytes", [1 << 21, 2000])
def test_substring(docs, chunk_bytes):
    seen = Counter(b" ".join(w[i : i + 35]) for r in rows() for w in [words(r[1])] for i in range(len(w) - 34))
    want = Counter()
    for r in rows():
        w = words(r[1])
        gone = {k for i in range(len(w) - 34) if seen[b" ".join(w[i : i + 35])] > 1 for k in range(i, i + 35)}
        want[(r[0], "w", len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())] += 1
    out = substring.dedup(docs, ["doc_id", "n_words"], chunk_bytes=chunk_bytes, bucket_hashes=300).toDF("doc_id", "own", "n_words", "n_removed", "removed", "kept")
    assert bag(out.drop("removed")) == want
    spans = out.select((F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]) == F.col("n_removed")).alias("ok"))
    assert bag(spans) == {(True,): len(rows())}


def plain_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    fps = [plain_fingerprint(r[1]) for r in rows()]
    label = list(range(len(fps)))
    for i, a in enumerate(fps):
        for j, b in enumerate(fps):
            if (a ^ b).bit_count() <= 3 and label[i] != label[j]:
                label = [label[i] if x == label[j] else x for x in label]
    least = {x: min((r[0] for r, y in zip(rows(), label) if y == x and r[0] is not None), default=None) for x in label}
    want = Counter((r[0], fp - (1 << 64) if fp >> 63 else fp, least[x]) for r, fp, x in zip(rows(), fps, label))
    near = simhash.near_dedup(docs)
    assert bag(near.select("doc_id", "fp", "component_id")) == want
    stay = simhash.one_of_each(docs, near)
    assert stay.count() == len(set(label)) and stay.columns == docs.columns


def test_links_of_dense_fingerprints(spark):
    draw = random.Random(3)
    fps = {0}
    for start in (draw.getrandbits(64) for _ in range(20)):
        fps |= {start ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for _ in range(40)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    links = simhash.link(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)).distinct()
    found = {r["node"]: r["label"] for r in components.components(links).collect()}
    label = {f: f for f in signed}
    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert {f: found.get(f, f) for f in signed} == label


def test_components_take_few_rounds(spark, monkeypatch):
    """Rounds are plans that the driver holds: edges that one task sees take none, a path over many tasks a few."""
    made, plain = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: made.append(name) or plain(df, name))
    path = spark.createDataFrame([(i, i + 1) for i in range(-200, 200) if i % 50], "u long, v long")
    hub = path.unionByName(spark.range(1000, 1100).select(F.lit(300).cast("long"), F.col("id")).toDF("u", "v"))
    want = {i: max(-200, i - i % 50 + (1 if i % 50 else -49)) for i in range(-199, 201)} | {i: 300 for i in (300, *range(1000, 1100))}
    for edges, most in ((hub.coalesce(1), 1), (hub.unionByName(hub).repartition(6), 16)):
        made.clear()
        found = components.components(edges.filter("u <> v")).collect()
        assert len(found) == len({r["node"] for r in found}) and {r["node"]: r["label"] for r in found} == want
        assert len(made) <= most
    assert components.components(hub.limit(0)).count() == 0


def edited(draw, text, n):
    """Text with n of its words replaced, each by a word of its own."""
    w = text.split()
    for i in draw.sample(range(len(w)), n):
        w[i] = f"w{draw.getrandbits(40)}"
    return " ".join(w)


def plain_labels(texts):
    sets = []
    for t in texts:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if label[i] != label[j] and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                label = [label[j] if x == label[i] else x for x in label]
    return label


@pytest.mark.parametrize("known", [True, False])
def test_near_copies_of_edited_words(spark, monkeypatch, known):
    if not known:  # what is common decides the order of shingles, not what is found
        monkeypatch.setattr(near_copies, "counted", lambda docs, text: (1, np.full(8, 255, np.uint8), np.zeros(8, np.uint8)))
        monkeypatch.setattr(near_copies, "CELL", 7)
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    texts = [r[1] for r in rows()]
    for _ in range(12):
        base = " ".join(word() for _ in range(draw.randint(60, 500)))
        n = len(base.split())
        texts += [base, *(edited(draw, base, max(1, n * share // 200)) for share in (1, 2, 3, 4, 5, 7, 9))]
    hot = " ".join(word() for _ in range(150))
    texts += [edited(draw, hot, draw.randint(1, 4)) for _ in range(80)]
    passage = " ".join(word() for _ in range(40))
    texts += [passage + " " + " ".join(word() for _ in range(draw.randint(2, 60))) for _ in range(60)]
    want = plain_labels(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["label"] for r in near_copies.near_copies(frame).collect()}
    assert len(got) == len(texts)
    assert len({(got[i], want[i]) for i in got}) == len(set(got.values())) == len(set(want))
    stay = corpus_pipeline.drop_near_copies(spark, frame, "")
    least = {x: min(i for i, y in enumerate(want) if y == x) for x in want}
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(least.values())
    # Planted copies of 0.8 and more that the radius of 3 bits of the thin query does not link.
    thin = {r["doc_id"]: r["label"] for r in simhash.near_dedup(frame).collect()}
    assert len(set(thin.values())) > len(set(want))


def test_pairs_of_cells(monkeypatch):
    """Cells that go over batches and slices, against all pairs of a cell that the bounds leave."""
    draw = np.random.default_rng(8)
    sets = [np.unique(draw.integers(0, 1 << 62, draw.integers(20, 200))) for _ in range(12)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * share)], draw.integers(0, 1 << 62, 5)])) for s in sets for share in (1, 0.95, 0.9, 0.6)]
    rows = []
    for gram in range(9):
        for i in draw.permutation(len(sets))[: draw.integers(2, 50)]:
            rows.append((gram, 0, int(gram == 4), int(i % 2), int(i), int(i % 17), len(sets[i]), int(draw.integers(0, 5)), near_copies.parity(sets[i])))
    rows.sort(key=lambda r: (r[:3], r[6]))
    want = set()
    for a in rows:
        for b in rows:
            n, m, left = a[6], b[6], min(a[6] - a[7], b[6] - b[7])
            if a[:3] == b[:3] and a[4] < b[4] and a[5] != b[5] and (a[1] == a[2] or a[3] != b[3]) and 5 * min(n, m) >= 4 * max(n, m) and 9 * left >= 4 * (n + m):
                differ = near_copies.apart([a[8], b[8]], np.array([0]), np.array([1]))[0]
                true = len(np.setxor1d(sets[a[4]], sets[b[4]]))
                assert differ <= true
                if 9 * differ <= n + m:
                    want.add((a[4], b[4]))
    batches = [pa.RecordBatch.from_pylist([dict(zip(near_copies.CELLS, r)) for r in rows[i : i + 13]]) for i in range(0, len(rows), 13)]
    for size, pairs in ((1 << 18, 1 << 20), (20, 15)):
        monkeypatch.setattr(near_copies, "ROWS", size)
        monkeypatch.setattr(near_copies, "PAIRS", pairs)
        assert {tuple(r.values()) for b in near_copies.cell_pairs(iter(batches)) for r in b.to_pylist()} == want
    assert len(want) > 20


@pytest.mark.parametrize("chunk, overlap", [(1 << 16, 1 << 10), (50, 70)])
def test_token_counts(docs, chunk, overlap):
    model = token_counts.load(BYTES)
    want = Counter()
    for r in rows():
        n = len(model.encode(r[1] or "", add_special_tokens=False).ids)
        want[(r[0], len((r[1] or "").encode()), n, n > 512)] += 1
    assert bag(token_counts.token_counts(docs, ["doc_id"], BYTES, chunk=chunk, overlap=overlap)) == want


@pytest.mark.parametrize("leaf", [1 << 14, 37])
def test_bpe(docs, leaf):
    encoding = bpe.load(RANKS, public_tokenizers.PATTERN)
    encoded = bpe.encode_texts(docs, ["doc_id", "text"], RANKS, public_tokenizers.PATTERN, leaf=leaf)
    got = [(r["doc_id"], r["text"], tuple(r["ids"])) for r in encoded.collect()]
    assert Counter(got) == Counter((r[0], r[1], tuple(encoding.encode_ordinary(r[1] or ""))) for r in rows())
    back = bpe.decode_ids(encoded, ["text"], RANKS, public_tokenizers.PATTERN, leaf=leaf)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back.collect())


@pytest.mark.parametrize("values", [[], [0], [0, 0, 7, 7, 9], list(range(0, 3000, 3)), [5, 2**40, 2**41]])
def test_elias_fano(values):
    sequence = tokenfile.EliasFano.from_bytes(tokenfile.EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert sequence.values().tolist() == values
    assert [sequence.select(i) for i in range(len(values))] == values


def test_token_files(spark, docs, monkeypatch):
    model = tokenfile.load(WORDS)[0]
    manifest, folder = tokenfile.write(docs, WORDS, end_id=1, file_bytes=20_000)
    assert manifest.count() > 2
    got = sorted(tokenfile.read(spark, manifest, folder).collect(), key=lambda r: r["start"])
    encoded = [(r[0], [*model.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in rows()]
    want = sorted(encoded, key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    at = 0
    for row, (doc, ids) in zip(got, want, strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc, at, len(ids))
        assert zlib.crc32(row["ids"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    monkeypatch.setattr(tokenfile.EliasFano, "values", None)  # reading goes by select()
    monkeypatch.setattr(tokenfile, "READ_DOCS", 3)
    monkeypatch.setattr(tokenfile, "READ_IDS", 40)
    name = manifest.orderBy("shard").first()["file"]
    reader = tokenfile.Reader(folder, name)
    blocks = list(reader.rows())
    assert [d for docs, _, _ in blocks for d in docs] == [d for d, _ in want[: len(reader)]] and max(len(b[0]) for b in blocks) <= 3
    assert [i.tolist() for _, _, ids in blocks for i in ids] == [ids for _, ids in want[: len(reader)]]
    assert [reader.doc_id(i) for i in range(len(reader))] == [d for d, _ in want[: len(reader)]]
    assert [reader.ids(i).tolist() for i in range(len(reader))] == [ids for _, ids in want[: len(reader)]]


def test_word_forms():
    """Forms in any case, with punctuation, marks and special tokens, against the tokenizer on whole texts."""
    model, words = tokenfile.load(WORDS)
    draw = random.Random(12)
    stems = ["abc", "ABC", "Abc", "it's", "don't.", "a.b", "x9", "9", "...", "?!", "é", "É", "Été", "J\u030c", "<|endoftext|>", "a<|X|>b", "<|ENDOFTEXT|>", "z" * 70, "Q" * 90, "\U0001f642", "\x1f", "a\x85b"]
    words.clear()
    for n in range(40):
        texts = [" ".join(draw.choice(stems) + draw.choice(["", "", ".", ",", "!?", "...", ";:", "'s", "\u0301"]) for _ in range(draw.randint(0, 30))) for _ in range(5)]
        for text, ids in zip(texts, words.encode(texts)):
            assert ids.tolist() == model.encode(text, add_special_tokens=False).ids, text
    assert not any(len(w) > tokenfile.CACHE_BYTES for w in words.forms) and len(words.sizes) == words.forms.size


def test_token_files_of_decomposed_capitals(spark):
    model = tokenfile.load(WORDS)[0]
    texts = ["J\u030c", "H\u0331 and ABC, x", "T\u0308", "a W\u030a", "Y\u030a", "J\u030c <|endoftext|> J\u030c ABC. <|ENDOFTEXT|>", "ABC, DEF. \u00c9t\u00e9."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in tokenfile.read(spark, *tokenfile.write(frame, WORDS, end_id=1)).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = [*model.encode(text, add_special_tokens=False).ids, 1]
        assert (got[i]["start"], np.frombuffer(got[i]["ids"], "<u4").tolist()) == (at, ids)
        at += len(ids)


def test_mix(docs):
    got = mixing.mix(docs, group=4).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows())
    sizes, largest, taken, target = Counter(), Counter(), Counter(), {}
    of = {(r[0], len(words(r[1]))): r[3] for r in rows()}
    for r in rows():
        sizes[r[3]] += len(words(r[1]))
        largest[r[3]] = max(largest[r[3]], 2 * len(words(r[1])))  # a repeated row is one unit
    for r in got:
        source = of[r["doc_id"], r["size"]]
        taken[source] += r["taken"]
        target[source] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] and r["source_size"] == sizes[source]
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight, full = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        level = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and weight[s] * level > 2 * sizes[s]}
        if not more:
            break
        full |= more
    for s in order:
        assert target[s] == pytest.approx(2 * sizes[s] if s in full else weight[s] * level)
        assert abs(taken[s] - target[s]) < largest[s] + 1e-6
    again = mixing.mix(docs.repartition(3), group=4)
    assert bag(again) == Counter(tuple(r) for r in got)
    assert mixing.take(docs, again).count() == sum(r["copies"] for r in got)


def vectors(spark):
    draw = np.random.default_rng(2)
    same = [float(x) for x in draw.normal(size=8)]
    out = [(i, [float(x) for x in draw.normal(size=8)]) for i in range(300)] + [(i, same) for i in range(300, 420)]
    out += [(500, None), (501, [None] + same[1:]), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (504, [0.0] * 8), (505, []), (None, same), (50, out[50][1]), (506, same[:5])]
    return out, spark.createDataFrame([(*r, 1) for r in out], "vec_id long, embedding array<double>, shard int").repartition(4)


def usable(out, zero):
    plain = {i: v for i, v in out if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    plain = {i: np.array(v + [0.0] * (8 - len(v))) for i, v in plain.items()}
    return {i: v for i, v in plain.items() if zero or v.any()}


def ranked(rows, score):
    out = {}
    for q in (i for i in rows if i % 50 == 0):
        best = sorted(((-score(rows[q], v), i) for i, v in rows.items() if i != q))[:5]
        out.update({(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)})
    return out


def test_top_k(spark):
    out, df = vectors(spark)
    whole = {i: np.floor(256 * v).astype(int) for i, v in usable(out, True).items()}
    want = ranked(whole, lambda a, b: int(a @ b))
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df).collect()} == want
    assert topk.top_k(df.filter("vec_id < 3")).count() == 2
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("large, k", [(0.0, 5), (3e4, 5), (1e12, 5), (1e200, 2)])
def test_top_k_in_small_shards(spark, monkeypatch, large, k):
    """Blocks and shards of a few rows, with components of any size, against all products."""
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_QUERIES", 2)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(5)
    out = [(i, [float(x) for x in draw.normal(size=12) * np.linspace(3, 0.01, 12)]) for i in range(260)]
    out[150] = (150, [large] * 12)
    out[151] = (151, [-large, *out[151][1][1:]])
    whole = {i: [math.floor(x * 256) if abs(x * 256) < 2**53 else int(x * 256) for x in v] for i, v in out}
    limit = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    want = {}
    for q in range(0, 260, 50):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:k]
        want.update({(q, n + 1): (i, limit(-s)) for n, (s, i) in enumerate(best)})
    df = spark.createDataFrame(out, "vec_id long, embedding array<double>").repartition(3)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, k).collect()}
    assert {key: score for key, (_, score) in got.items()} == {key: score for key, (_, score) in want.items()}
    if large < 1e100:  # beyond, scores are cut to a long and tie
        assert got == want


@pytest.mark.parametrize("kind", [np.float64, np.int64, object])
def test_top_k_in_small_steps(monkeypatch, kind):
    """Essential and probed terms in each kind of number, with ties, against all products."""
    monkeypatch.setattr(topk, "STEP", 7)
    monkeypatch.setattr(topk, "PROBE", 2)
    draw = np.random.default_rng(6)
    rows = np.floor(40 * draw.normal(size=(150, 12)) * np.geomspace(4, 0.1, 12))
    rows[30:60] = rows[7]
    shard = topk.Shard(np.arange(150) * 3, topk._as(rows, kind))
    for own in range(0, 150, 11):
        ids, scores = shard.search(topk._as(rows, kind)[own], own * 3, 6)
        every = sorted((-int(rows[i] @ rows[own]), i * 3) for i in range(150) if i != own)[:6]
        assert [(-int(x), int(i)) for i, x in zip(ids, scores)] == every


def test_top_k_passes_over_what_cannot_compete(monkeypatch):
    """Rows that small terms could not lift are dropped after the essential ones, and results stay those of a full scan."""
    monkeypatch.setattr(topk, "STEP", 16)
    draw = np.random.default_rng(1)
    rows = np.floor(256 * draw.normal(size=(400, 20)) * np.geomspace(8, 0.001, 20))
    shard, seen = topk.Shard(np.arange(400), rows), []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(self.size)
            return np.asarray(self) @ np.asarray(other)

    shard.rows = shard.rows.view(Counted)
    for own in range(0, 400, 37):
        ids, scores = shard.search(rows[own], own, 5)
        every = rows @ rows[own]
        every[own] = -np.inf
        best = np.lexsort((np.arange(400), -every))[:5]
        assert ids.tolist() == best.tolist() and scores.tolist() == every[best].tolist()
    assert sum(seen) < 0.5 * 11 * rows.size


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 50)
    monkeypatch.setattr(ann, "LIST_ROWS", 10)
    monkeypatch.setattr(ann, "BIN_ROWS", 100)
    out, df = vectors(spark)
    sound = usable(out, False)
    want = ranked(sound, lambda a, b: round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 12))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.neighbours(df).collect()}
    assert got.keys() == want.keys()
    found = sum(v[0] in {got[q, k][0] for k in range(1, 6)} for (q, _), v in want.items())
    assert found >= 0.9 * len(want)
    for (q, _), (i, score) in got.items():
        a, b = sound[q], sound[i]
        assert score == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-12)
    hot = [got[300, k][0] for k in range(1, 6)]
    assert hot == [301, 302, 303, 304, 305]  # equal vectors: ties to the smaller id
    assert ann.neighbours(df.filter("vec_id < 3")).count() == 2
    assert ann.neighbours(df.limit(0)).count() == 0


PAGES = [
    (1, "http://B.example.com/x?q=1", "<p>one</p>"), (2, "http://a.example.com/", "<p>one</p>"), (3, "http://b.example.com/x?q=1", None),
    (4, None, ""), (5, "no url at all", "café\r\n\r\nx"), (5, "no url at all", "café\r\n\r\nx"), (None, "http://c.org", "<p>one</p>"),
    (-7, "http://c.org:8080/\n y", "z" * 300000), (9, "http://[bad", "<p>one</p>"),
]


@pytest.mark.parametrize("least", [0, 1])
def test_warc(spark, least):
    pages = spark.createDataFrame([(*r, "extra") for r in PAGES], "page_id long, url string, html string, digest string")
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = Counter()
    for i, _, html in PAGES:
        data, base = (html or "").encode(), first[html or ""]
        revisit = i != base and len(data) >= least
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", base if revisit else None)] += 1
    archives = warc.write(pages, least=least, file_bytes=1000, lines=2)
    got = warc.read(spark, archives)
    assert bag(got.select("page_id", "payload_bytes", "payload_digest", "type", "refers_to")) == want
    for url in {r[1] for r in PAGES}:
        asked = spark.createDataFrame([(url,)], "url string")
        assert sorted(str(r["page_id"]) for r in warc.lookup(asked, archives).collect()) == sorted(str(r[0]) for r in PAGES if r[1] == url)
    assert warc.lookup(spark.createDataFrame([("http://nowhere.net",)], "url string"), archives).count() == 0
    assert warc.read(spark, warc.write(pages.limit(0))).count() == 0
    # What a revisit refers to is what the lookup finds: without the index's upper table, nothing.
    revisits = warc.listed(spark, archives, False).filter("type = 'revisit'")
    assert {tuple(r) for r in warc.resolved(revisits, archives).collect()} == {(r[4], r[2]) for r in want if r[4] is not None}
    assert warc.resolved(revisits, warc.Archives(archives.records, archives.index, archives.files.limit(0))).count() == 0
    assert warc.resolved(revisits.withColumn("payload_digest", F.lit("none")), archives).count() == 0


def toxic_tables(spark):
    draw = random.Random(8)
    plain = ["lorem", "ipsum", "dolor", "amet", "consect", "adipis", "elit", "tempor", "labore", "magna", "aliqua", "veniam"]
    out, labels = [], []
    for i in range(600):
        text = [draw.choice(plain) + draw.choice(["", "us", "em", "it"]) for _ in range(60)]
        toxic = i % 4 == 0
        for _ in range(5 * toxic):
            text[draw.randrange(60)] = "zkwrog" + draw.choice(["", "ak", "yn"])
        out.append((i, " ".join(text), None, "s", 1, "c", 1, "w", 0))
        labels.append((i, 1 if toxic else 0))
    odd = [(None, 1), (3, None), (9999, 1)]
    return spark.createDataFrame(out, SCHEMA), spark.createDataFrame(labels + odd, "doc_id long, toxic int"), dict(labels)


def test_toxicity(spark, docs, empty):
    texts, labels, truth = toxic_tables(spark)
    model = toxicity.fit(texts, labels)
    scored = toxicity.score(texts, ["doc_id"], model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in scored if r["held"]]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in scored)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held) and len(held) > 100
    odd = toxicity.score(docs, ["doc_id"], model).collect()
    assert len(odd) == len(rows()) and all(0 <= r["score"] <= 1 for r in odd)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(texts, flipped).weights.tolist() == model.weights.tolist()
    none = toxicity.fit(empty, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, ["doc_id"], none).collect()} == {0}


def test_toxicity_is_not_trained_in_the_driver(spark, monkeypatch):
    texts, labels, _ = toxic_tables(spark)
    plain, want = toxicity.train, toxicity.fit(texts, labels)

    def in_a_task(*samples):
        assert TaskContext.get() is not None
        return plain(*samples)

    monkeypatch.setattr(toxicity, "train", in_a_task)
    model = toxicity.fit(texts.repartition(7), labels)
    assert model.ordinary == want.ordinary and model.toxic == want.toxic and model.weights.tolist() == want.weights.tolist()


def test_empty_tables(spark, empty):
    manifest, folder = tokenfile.write(empty, WORDS, end_id=1)
    for out in (
        substring.dedup(empty, ["doc_id"]), simhash.near_dedup(empty), token_counts.token_counts(empty, ["doc_id"], BYTES),
        bpe.encode_texts(empty, ["doc_id"], RANKS, public_tokenizers.PATTERN), mixing.mix(empty), tokenfile.read(spark, manifest, folder),
    ):
        assert out.count() == 0


ODD = "predicted string, score string, kept_text int, n_words int, n_removed int, copies int, _key int, _id int, _own int, `a.b` int, label int, gram int"


def pipeline_docs(spark, docs):
    """Toxic and plain texts, near copies, and the odd rows, with columns named like the operators' own."""
    texts, labels, truth = toxic_tables(spark)
    odd = [F.lit("1" if " string" in c else 1).alias(c.strip().rsplit(" ", 1)[0].strip("`")) for c in ODD.split(",")]
    plain = ("doc_id", "text", "lang", "source", "n_chars")
    return texts.select(*plain).unionByName(docs.select(*plain)).select("*", *odd), labels, truth


def plain_cut(table):
    """Rows after substring dedup: kept words, by brute force."""
    seen = Counter(b" ".join(w[i : i + 35]) for r in table for w in [words(r[1])] for i in range(len(w) - 34))
    out = Counter()
    for r in table:
        w = words(r[1])
        gone = {k for i in range(len(w) - 34) if seen[b" ".join(w[i : i + 35])] > 1 for k in range(i, i + 35)}
        text = None if r[1] is None else b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out[(r[0], text, *r[2:4], None if text is None else len(text), *r[5:])] += 1
    return out


def test_pipeline_stages(spark, docs, tmp_path):
    frame, labels, truth = pipeline_docs(spark, docs)
    folder = str(tmp_path)
    frame.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    at, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in at.collect()]
        out = stage(spark, at, folder)
        out.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        if name != "byte_bpe":
            assert after.dtypes == at.dtypes
        at = after
        seen.append((before, [tuple(r) for r in at.collect()]))
    toxic, near, passages, mix, encoded = seen

    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    predicted = model.scorer().score([r[1] or "" for r in toxic[0]]) >= toxicity.THRESHOLD
    assert Counter(toxic[1]) == Counter(r for r, p in zip(toxic[0], predicted) if not p)
    gone = Counter(r[0] for r in toxic[0]) - Counter(r[0] for r in toxic[1])
    assert sum(truth.get(i) == 1 for i in gone) >= 0.95 * sum(truth.values()) and sum(truth.get(i) != 1 for i in gone) <= 2

    labels_of = plain_labels([r[1] for r in near[0]])
    least = {}
    for r, x in zip(near[0], labels_of):
        least[x] = min(least.get(x, (True, 0)), (r[0] is None, r[0] or 0))
    assert Counter((r[0] is None, r[0] or 0) for r in near[1]) == Counter(least.values())
    assert not Counter(near[1]) - Counter(near[0])

    assert Counter(passages[1]) == plain_cut(passages[0]) and Counter(r[0] for r in passages[1]) == Counter(r[0] for r in near[1])

    taken = Counter(mix[1])
    copies = {(r["doc_id"], r["size"]): r["copies"] for r in mixing.mix(spark.createDataFrame(mix[0], frame.schema).select("doc_id", "text", "source")).collect()}
    assert taken == Counter({r: n * copies[r[0], len(words(r[1]))] for r, n in Counter(mix[0]).items() if copies[r[0], len(words(r[1]))]})

    encoding = bpe.load(RANKS, public_tokenizers.PATTERN)
    want = Counter()
    for r in encoded[0]:
        ids = encoding.encode_ordinary(r[1] or "")
        want[(r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert Counter(encoded[1]) == want
    assert bag(corpus_pipeline.run(spark, folder)) == want and len(want) > 100


def test_pipeline_of_no_rows(spark, docs, tmp_path):
    frame, labels, _ = pipeline_docs(spark, docs)
    folder = str(tmp_path)
    frame.limit(0).write.parquet(f"{folder}/documents.parquet")
    labels.limit(0).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_drops_near_fingerprints(spark):
    cycle = "one two three " * 100
    texts = [(1, cycle), (2, cycle + "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, "something else altogether, said once"), (4, None)]
    assert plain_fingerprint(texts[0][1]) == plain_fingerprint(texts[1][1]) and plain_labels([t for _, t in texts[:2]]) == [0, 1]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(texts, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]
