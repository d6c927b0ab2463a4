"""Multi-index hashing, importance resampling and the filter audit against plain re-computations."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from helpers import SF_SMALL

from tickframe.llm import filteraudit, multiindex, resample


# ---- multi-index hashing


def _exact(rows, k, every):
    """All candidates of every query, nearest first; rows of one id and vector count once."""
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)))
    out = {}
    for i, v in rows:
        if i % every == 0:
            near = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i and len(w) == len(v))
            out.setdefault(i, []).append([(j, -s) for s, j in near[:k]])
    return out


def _found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in out.items()}


def _clustered(n, d, seed, spread=0.5, length=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 40), d))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(scale=spread, size=(n, d))
    return (x * (rng.uniform(0.2, 3.0, size=(n, 1)) if length else 1)).astype(np.float32)


@pytest.mark.parametrize("d,length", [(64, False), (24, True), (100, False)])
def test_recall_and_scores(spark, d, length):
    x = _clustered(900, d, 3, length=length)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = _found(multiindex.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)))
    want = _exact(rows, 20, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q][0]}) for q in want) >= 0.9 * 20 * len(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len({v for v, _ in found}) == 20 and q not in {v for v, _ in found}
        for v, s in found:
            assert s == pytest.approx(float(x[q].astype(float) @ x[v].astype(float)), rel=1e-12, abs=1e-12)


def test_recall_on_the_tables(spark):
    df = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = _found(multiindex.nearest(df)), _exact(rows, 20, 20)
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q][0]}) for q in want) >= 0.9 * sum(len(w[0]) for w in want.values())


def test_hostile_vectors(spark):
    """Copies of one vector in a third of the rows, ties, too few candidates, unusable vectors, several lengths, columns of clashing names."""
    rng = np.random.default_rng(8)
    same, other = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(i, same) for i in range(60)] + [(i, [float(c) for c in rng.normal(size=3)]) for i in range(60, 120)] + [(i, other) for i in range(120, 150)]
    rows += [(0, same), (20, other), (None, same), (200, None), (220, []), (240, [0.0] * 3), (260, [float("nan"), 1.0, 1.0]), (280, [None, 1.0, 1.0]),
             (300, [float("inf"), 1.0, 1.0]), (400, [1.0, 2.0]), (401, [2.0, 1.0]), (500, [9.0])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, key string, score double").repartition(5)
    got, want = _found(multiindex.nearest(df)), _exact(rows, 20, 20)
    assert set(got) == {q for q, w in want.items() if w[0]}
    hits = [len({round(s, 9) for _, s in got[q]} & {round(s, 9) for _, s in want[q][0]}) / len({round(s, 9) for _, s in want[q][0]}) for q in want if q < 150 and len(want[q]) == 1]
    assert sum(hits) >= 0.9 * len(hits) and got[400] == [(401, 4.0)] and 500 not in got
    copies = _found(multiindex.nearest(df.where("vec_id < 60 OR vec_id IS NULL")))
    assert [v for v, _ in copies[0]] == list(range(1, 21)) and [v for v, _ in copies[40]] == list(range(20))
    assert multiindex.nearest(df.limit(0)).count() == 0
    assert multiindex.nearest(df.where("vec_id % 20 = 1")).count() == 0


@pytest.mark.parametrize("width,radius", [(8, 3), (8, 40), (8, 100), (16, 5), (16, 40), (16, 256)])
def test_pigeonhole_probing_finds_every_code(width, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 256, (20, 32), dtype=np.uint8)
    flips = np.packbits(rng.random((600, 256)) < rng.uniform(0, 0.4, (600, 1)), axis=1)
    codes = base[rng.integers(0, 20, 600)] ^ flips
    index = multiindex.SubstringIndex(codes, width)
    for q in base:
        apart = np.unpackbits(codes ^ q, axis=1).sum(axis=1)
        assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_blocks_and_widening_do_not_change_results(spark, monkeypatch):
    """Many small blocks, and a radius too small at first: queries probe again until they have k rows."""
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(_clustered(300, 16, 5))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    monkeypatch.setattr(multiindex, "BLOCK_ROWS", 7)
    monkeypatch.setattr(multiindex, "QUERY_ROWS", 2)
    monkeypatch.setattr(multiindex, "_calibrated", lambda *a: multiindex.BITS)
    want = _exact(rows, 20, 20)
    assert {q: [v for v, _ in x] for q, x in _found(multiindex.nearest(df)).items()} == {q: [v for v, _ in x[0]] for q, x in want.items()}
    monkeypatch.setattr(multiindex, "_calibrated", lambda *a: 1)
    got = _found(multiindex.nearest(df))
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())


# ---- importance resampling


def _resampled(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = lambda w: [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2) for i in range(len(w) - n + 1)]
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for b in grams(words(text)):
            s[b] += 1
    for text in items:
        for b in grams(words(text)):
            t[b] += 1
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (sum(s) + 10000) / ((float(s[b]) + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for k, (i, text) in enumerate(docs):
        w = words(text)
        g = grams(w)
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(g), weight, score, None, len(w)])
    can = sorted((r for r in rows if r[0] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(can[:25 * len(can) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_resampling(spark):
    rng = random.Random(2)
    vocabulary = ["The", "cat", "dög", "naïve", "e=mc2", "x" * 40, "FOO_bar", "Ünder", "日本語テキスト", "a", "b1", "zz"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(k, text(rng.choice([0, 1, 2, 19, 20, 21, 60]))) for k in range(150)] + [(150, None), (151, ""), (152, "  .. !"), (None, text(30)), (153, "y" * 300_000),
            (154, text(3000)), (155, "same " * 40), (156, "same " * 40), (157, "\x00\x7f ABC"), (158, "wort wort \U0001F600")]
    items = [text(15), None, "", "same dog"]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in docs], "doc_id long, text string, score int, bucket string").repartition(7)
    bench = spark.createDataFrame([(t, 5) for t in items], "text string, n int")
    assert sorted((tuple(r) for r in resample.resample(df, bench).collect()), key=str) == _resampled(docs, items)
    assert sorted((tuple(r) for r in resample.resample(df, bench.limit(0)).collect()), key=str) == _resampled(docs, [])
    assert resample.resample(df.limit(0), bench).count() == 0


def test_repeated_ids_share_a_score_and_not_a_rank(spark):
    rows = [(5, "w " * 25)] * 300 + [(k, "v " * 25) for k in range(100)]
    got = resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("w",)], "text string")).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 101)) and len({r.score for r in got if r.doc_id == 5 and r.n_features == 49}) <= 2


def test_crc_matrices():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts, lengths = rng.integers(0, 4000, 900), rng.integers(1, 30, 900)
    s2, l2 = rng.permutation(starts), rng.permutation(lengths)
    got = resample.crc_of_slices(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts, lengths)]
    both = resample.crc_of_slices(data, starts, lengths, s2, l2)
    assert both.tolist() == [zlib.crc32(data[a:a + n].tobytes() + b" " + data[b:b + m].tobytes()) for a, n, b, m in zip(starts, lengths, s2, l2)]


# ---- filter audit


def _masks(docs, labels):
    out = []
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": any(j is not None and i is not None and j < i and (x or "") == t for j, x, _ in docs)}
        out.append((lang or "", {k for k, v in fails.items() if v}, any(q == 1 for j, q, _ in labels if j == i and i is not None),
                    any(x == 1 for j, _, x in labels if j == i and i is not None)))
    return out


def _audited(docs, labels):
    rows, out = _masks(docs, labels), []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed = {f: 0 for f in "ABCDE"}
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own),
                              sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*s[:-1], removed[s[-1]]) for s in steps]
    return sorted(out)


def _audit_case():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    texts = [" ".join(word() for _ in range(n)) for n in (3, 99, 100, 101, 300)] + ["SHOUT " * 120, "ok #1 " * 60, "", None, "a\x0bb\x0cc\td", "x " * 100_000,
             " ".join(f"w{k}" for k in range(150)), "É" * 30, "Ab" * 5, "|"]
    docs = [(k, rng.choice(texts), rng.choice(["en", "de", "", None])) for k in range(120)]
    rng.shuffle(docs)
    docs += [(500, texts[4], "en")] * 40 + [(None, texts[4], "en"), (None, "alone", "fr"), (3, texts[4], "fr"), (-7, texts[3], None)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 120, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1), (500, 1, 0)]
    return docs, labels


@pytest.mark.parametrize("files,micro,digests,held", [(1, 4, 256, 100_000), (9, 9, 2, 100_000), (9, 3, 1000, 2)])
def test_filter_audit(spark, tmp_path, monkeypatch, files, micro, digests, held):
    """One file or many, smaller ids in later micro-batches, few or many digests per state key: the same counters."""
    monkeypatch.setattr(filteraudit, "DIGESTS", digests)
    monkeypatch.setattr(filteraudit, "_HELD", held)
    docs, labels = _audit_case()
    for k in range(files):
        spark.createDataFrame([(*d, 1, "p") for d in docs[k::files]], "doc_id long, text string, lang string, n int, part string").coalesce(1) \
            .write.mode("append").parquet(f"{tmp_path}/d")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filteraudit.audit(spark, f"file://{tmp_path}/d", table, micro_batches=micro)
    assert sorted(tuple(r) for r in got.collect()) == _audited(docs, labels)


def test_filter_audit_of_an_empty_table(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/e")
    assert filteraudit.audit(spark, f"{tmp_path}/e", labels).count() == 0


def test_smaller_ids_retract_what_was_counted(spark):
    texts, seen = {}, []
    for row in [("d", 9, "en", 1, 0, 1, 2), ("d", 12, "en", 1, 0, 0, 1), ("d", 9, "de", 1, 0, 1, 1), ("d", 4, "de", 1, 1, 0, 1)]:
        seen.append(list(filteraudit.arrived(texts, *row)))
    assert seen[1] == [("en", 17, 0, 0, 1)]
    assert seen[3] == [("en", 1, 0, 1, -2), ("en", 17, 0, 1, 2), ("de", 1, 0, 1, -1), ("de", 17, 0, 1, 1), ("de", 1, 1, 0, 1)]
    assert texts == {"d": [4, 1, 1, 0, {"de": 1}]}
