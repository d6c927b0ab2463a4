"""Embedding near-duplicates and components against plain loops; WARC archives against their input and other writers' files."""

import gzip
import hashlib
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import egojoin, warc
from tickframe.llm.components import components


def _plain(rows, t=0.98):
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = {i: set() for i in range(len(rows))}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and a in ok and b in ok and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= t:
                    links[i].add(j)
    out = []
    for i, a in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        comp = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((a[0], len(links[i]), comp, a[0] == comp))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,leaf", [(256, 64), (8, 3)])
def test_embedding_links(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(egojoin, "LEAST_BLOCK", block)
    monkeypatch.setattr(egojoin, "BLOCK_BYTES", 0)
    monkeypatch.setattr(egojoin, "LEAF", leaf)
    rng = np.random.default_rng(1)
    rows, k = [], 0
    for c in range(12):
        base, label = rng.normal(size=16), int(c % 3)
        for _ in range(rng.integers(1, 9)):
            rows.append((k, [float(x) for x in (base + rng.normal(scale=0.12, size=16)).astype(np.float32)], label))
            k += 1
    rows += [(100, rows[0][1], rows[0][2]), (101, rows[0][1], rows[0][2]), (102, rows[0][1], None), (103, None, 0), (104, [0.0] * 16, 0), (105, [], 0),
             (106, [None] + [1.0] * 15, 0), (107, [float("nan")] + [1.0] * 15, 0), (108, [float("inf")] + [1.0] * 15, 0), (109, [1.0, 0.0], 0), (110, [2.0, 0.0], 0),
             (None, rows[0][1], rows[0][2]), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = sorted([tuple(r) for r in egojoin.near_duplicates(df).collect()], key=str)
    assert got == _plain(rows)
    assert egojoin.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng, n = random.Random(4), 300
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(n), rng.randrange(n)) for _ in range(120)] + [(7, 7), (None, 3), (3, None), (200, 100)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(i, i) == find(i) for i in range(n))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_archive_round_trip(spark, tmp_path):
    big = "ä<p>" * 40
    rows = [(3, "http://a/1", big, "x"), (1, "http://a/2\r\nX: y", big, "x"), (2, None, big, "x"), (4, "u", "small", "x"), (5, "u", "small", "x"), (6, "u", None, "x"),
            (7, "u", "\r\n\r\nWARC/1.1\r\n" * 20, "x"), (1, "http://a/2", big, "x"), (None, "u", big, "x"), (8, "u", "y" * 200_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    path = f"file://{tmp_path}/w"
    warc.archive(df, path)
    got = sorted([tuple(r) for r in warc.page_records(spark, path).collect()], key=str)
    want = []
    for p, _, h, _ in rows:
        b = (h or "").encode()
        again = h == big and p != 1
        want.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=str)
    back = warc.read(spark, path)
    assert back.where("record_type = 'response'").count() == len([w for w in want if w[3] == "response"])
    assert "PushedFilters" in back.where("record_type = 'revisit'")._jdf.queryExecution().toString() or back.where("record_type = 'revisit'").count() == 3
    assert warc.read(spark, path, payload=False).where(F.col("payload").isNotNull()).count() == 0
    assert back.where(F.col("target_uri").startswith("http://a/")).count() == 3


def test_only_wanted_payloads_are_read(tmp_path, monkeypatch):
    path = tmp_path / "x.warc.gz"
    bodies = [bytes(f"{k}", "ascii") * 5000 for k in range(20)]
    path.write_bytes(b"".join(warc.pack([("WARC-Type", "response" if k % 5 else "request"), ("WARC-Record-ID", f"<{k}>")], b) for k, b in enumerate(bodies)))
    got = [(h["warc-record-id"], b) for h, b in warc.records(str(path), lambda h: h["warc-type"] == "request")]
    assert got == [(f"<{k}>", bodies[k]) for k in range(0, 20, 5)]


def test_files_of_other_writers(tmp_path):
    rec = lambda k, b: (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{k}>\r\nX-Folded: a\r\n b\r\nContent-Length: {len(b)}\r\n\r\n").encode() + b + b"\r\n\r\n"
    bodies = [b"", b"a\r\n\r\nb", b"z" * 9000, struct.pack("<I", 7)]
    (tmp_path / "p.warc").write_bytes(b"".join(rec(k, b) for k, b in enumerate(bodies)))
    (tmp_path / "q.warc.gz").write_bytes(b"".join(gzip.compress(rec(k, b)) for k, b in enumerate(bodies)))
    for name in ("p.warc", "q.warc.gz"):
        got = list(warc.records(str(tmp_path / name)))
        assert [b for _, b in got] == bodies and got[1][0]["x-folded"] == "a b"
        assert [h["warc-record-id"] for h, _ in warc.records(str(tmp_path / name), lambda h: h["warc-record-id"] == "<3>", payload=False)] == ["<3>"]


def test_empty_archive(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    warc.archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.page_records(spark, path).count() == 0
