"""The text operators against plain re-computation on small made texts: copies, near copies, shared passages, edges."""

import random
import uuid

import helpers as H
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickframe.llm import decontaminate, ngramjoin, substringdedup, suffixdedup
from tickframe.llm import blocks as B
from tickframe.llm.automaton import SuffixAutomaton
from tickframe.llm.components import components

COLS = "doc_id long, text string, n_words string, id string"


def _rows(seed: int):
    rng = random.Random(seed)
    vocab = ["the", "of", "Ä", "naïve", "x1"] + ["".join(rng.choice("abcdé") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage, line = text(160), text(80), text(11)
    rows = [(k, text(rng.randint(0, 120))) for k in range(0, 20)]
    rows += [(k, base) for k in (25, 21, 30)]  # copies
    for k in range(40, 60):  # near copies
        w = base.split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((k, " ".join(w)))
    rows += [(k, f"{text(30)} {passage}\n{text(20)}") for k in range(60, 70)]
    rows += [(k, f"{text(15)}\n{line}\t{text(25)}") for k in range(70, 90)]
    rows += [(91, None), (92, ""), (93, "   \n"), (94, "one two"), (95, "One TWO"), (None, base), (None, text(50)), (96, "ab" * 700), (97, "a " * 300),
             (98, passage + " " + passage), (99, text(2500)), (21, base)]
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, "q", None) for d, t in rows], COLS).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = _rows(seed)
    got = suffixdedup.deduplicate(_frame(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == H.repeats_of_bytes(rows)


def test_bytes_of_hot_grams_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "SPLIT", 2)
    monkeypatch.setattr(suffixdedup, "BATCH", 7)
    rows = _rows(3)
    got = suffixdedup.deduplicate(_frame(spark, rows), keep_text=True).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == H.repeats_of_bytes(rows)


@pytest.mark.parametrize("seed,split", [(1, None), (2, 2)])
def test_words(spark, monkeypatch, seed, split):
    if split:
        monkeypatch.setattr(substringdedup, "SPLIT", split)
    rows = _rows(seed)
    got = substringdedup.deduplicate(_frame(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == H.repeats_of_words(rows)


@pytest.mark.parametrize("hot", [32, 2])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(ngramjoin, "HOT", hot)
    if hot == 2:
        monkeypatch.setattr(ngramjoin, "SPLIT", 1)
        monkeypatch.setattr(ngramjoin, "MAX_BROADCAST_IDS", 0)
    rows = _rows(5)
    got = ngramjoin.link_components(_frame(spark, rows)).collect()
    want = {}
    for d, n, c in H.jaccard_components([r for r in rows if r[0] is not None]):
        want[d] = (n, c)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 400])
def test_benchmark(spark, block):
    rng, rows = random.Random(4), _rows(4)
    texts = [t for _, t in rows if t]
    items = [(k, " ".join(rng.choice(texts).split()[3:3 + rng.randint(1, 30)])) for k in range(25)] + [(90, "Zwei, wörter!"), (91, None), (92, "..."), (None, texts[0]), (3, texts[1])]
    rows = rows + [(200, "x zwei wörter y ZWEI WöRTER"), (201, "zwei")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(_frame(spark, rows), bench, block_bytes=block).collect()
    assert sorted([tuple(r) for r in got], key=str) == H.benchmark_hits(rows, items)


def test_benchmark_clean_cuts_the_spans_and_keeps_columns(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "clean text, stays!", "a"), (2, f"{'u v ' * 20}{passage}, end.", "b"), (3, passage, "c"), (4, None, "d")],
                                 "doc_id long, text string, _n_hit string")
    got = {r.doc_id: r for r in decontaminate.clean(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).collect()}
    assert sorted(got) == [1, 2, 4] and got[1].text == "clean text, stays!" and got[4].text is None
    assert got[2].text == "u v " * 20 + ", end." and got[2]._n_hit == "b"


def test_empty_tables(spark):
    none = spark.createDataFrame([], COLS)
    assert suffixdedup.deduplicate(none).count() == substringdedup.deduplicate(none).count() == ngramjoin.link_components(none).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(none, bench).count() == 0
    assert [r.n_hit for r in decontaminate.report(spark.createDataFrame([(1, "a b", "", "")], COLS), bench).collect()] == [0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", max_size=14), max_size=5), st.text("abcd", max_size=25))
def test_automaton_statistics(references, text):
    sam = SuffixAutomaton()
    for r in references:
        sam.add(r)
    for at, (state, size) in enumerate(sam.statistics(text), 1):
        best = max((m for m in range(at + 1) if any(text[at - m:at] in r for r in references)), default=0)
        assert size == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.binary(max_size=4).map(lambda b: bytes(x % 3 for x in b)), st.binary(max_size=4).map(lambda b: bytes(x % 3 for x in b))),
                max_size=14))
def test_induced_offsets(rows):
    width = 4
    rows = sorted(rows, key=lambda r: (r[0], r[2].ljust(width, b"\0")))
    least, greatest = suffixdedup.induce(np.array([r[0] for r in rows]), [r[1] for r in rows], [r[2] for r in rows], width) if rows else ([], [])
    for i, (g, f, b) in enumerate(rows):
        fits = [o for o in range(width + 1) if len(f) >= o and len(b) >= width - o and any(
            j != i and g2 == g and f2[:o] == f[:o] and len(f2) >= o and len(b2) >= width - o and b2[:width - o] == b[:width - o] for j, (g2, f2, b2) in enumerate(rows))]
        assert (least[i], greatest[i]) == ((min(fits), max(fits)) if fits else (width + 1, -1)), (rows, i)


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_collide_modulo_powers_of_two(spark, n):
    word, other = _thue_morse(n), _thue_morse(2 * n)[n:]
    assert word != other and len(word) == len(other)
    docs = spark.createDataFrame([(1, word), (2, other)], "doc_id long, text string")
    assert sorted(r.component_id for r in ngramjoin.link_components(docs).collect()) == [1, 2]
    rest = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"{rest} {word}"), (2, f"{rest} {other}")], "doc_id long, text string")
    assert [r.n_removed for r in substringdedup.deduplicate(docs).collect()] == [0, 0]
    got = suffixdedup.deduplicate(spark.createDataFrame([(1, word * 2), (2, other * 2 + "c")], "doc_id long, text string"))
    assert sorted(tuple(r)[:4] for r in got.collect()) == [x[:4] for x in H.repeats_of_bytes([(1, word * 2), (2, other * 2 + "c")])]


def test_slice_hash_of_equal_slices():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3000, dtype=np.uint8)
    both = np.concatenate([data, data[:1000], data])
    sums = B.prefix_sums(B.value_table(5)[both])
    a, n = rng.integers(0, 900, 500), rng.integers(0, 100, 500)
    h = B.slice_hash(sums, a, a + n)
    assert (h == B.slice_hash(sums, a + 3000, a + 3000 + n)).all() and (h == B.slice_hash(sums, a + 4000, a + 4000 + n)).all()
    assert len(set(h.tolist())) == len({data[x:x + m].tobytes() for x, m in zip(a, n)})


def test_rows_without_ids_are_not_smaller_than_each_other(spark):
    common = " ".join(f"c{k}" for k in range(20))
    rows = [(None, f"one {common}"), (None, f"two {common} end"), (None, f"two {common} end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in substringdedup.deduplicate(df).collect()), key=str) == H.repeats_of_words(rows)
    rows += [(7, f"zero {common}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in substringdedup.deduplicate(df).collect()), key=str) == H.repeats_of_words(rows)


def test_a_common_line_does_not_pair_documents(spark):
    """Short documents with one common line and a word of their own: no link, and no pair either."""
    rows = [(i, f"a b c d e f g x{i}") for i in range(400)] + [(1000, "a b c d e f g x1 x1"), (1001, "a b c d e f g x1 x1")]
    seen = []
    cross = ngramjoin._cross
    ngramjoin._cross = lambda members: seen.append(cross(members)) or seen[-1]
    try:
        got = ngramjoin.link_components(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted((tuple(r) for r in got.collect()), key=str) == H.jaccard_components(rows)
        assert seen[0].count() <= 2 * len(rows)
    finally:
        ngramjoin._cross = cross


@pytest.mark.parametrize("seed", range(3))
def test_links_of_sets_of_different_sizes(spark, seed):
    """Near copies with words added, cut or changed, around common lines: links between sets of equal and of different sizes."""
    rng = random.Random(seed)
    lines = [" ".join(f"l{k}w{j}" for j in range(12)) for k in range(4)]
    rows = []
    for g in range(25):
        base = [f"g{g}w{j}" for j in range(rng.randint(6, 40))] + rng.choice(lines).split()
        for _ in range(rng.randint(1, 5)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], ["new"], [w[k], f"add{rng.randrange(9)}"]])
            rows.append((len(rows), " ".join(w + rng.choice([[], rng.choice(lines).split()]))))
    got = ngramjoin.link_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == H.jaccard_components(rows)


def test_components_of_few_links_take_few_tasks(spark):
    """Many shuffle partitions: their tasks cost more than the links of a round, so a round has few stages of them."""
    links = [(k, k + 1) for k in range(30)] + [(100, 105), (105, 100), (101, 105), (7, 7), (None, 3), (200, 201), (200, 201)]
    want = {k: 0 for k in range(31)} | {100: 100, 101: 100, 105: 100, 200: 200, 201: 200}
    confs = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, sc = {k: spark.conf.get(k) for k in confs}, spark.sparkContext
    group, tracker = uuid.uuid4().hex, spark.sparkContext.statusTracker()
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        sc.setJobGroup(group, "components")
        got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i is not None)
    assert 0 < tasks < 2600


def test_sets_are_hashed_in_small_blocks(monkeypatch):
    """A worker that hashes 2 MB of texts holds the arrays of a small part of them, and the powers for it."""
    texts = [" ".join(f"w{i * 7 + j}" for j in range(200)) for i in range(1500)] + ["x " * 200_000]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    seen, real = [], ngramjoin.shingles
    monkeypatch.setattr(B, "_powers", [{"n": 0, "p": None, "q": None} for _ in B._powers])
    monkeypatch.setattr(ngramjoin, "shingles", lambda data, offsets: seen.append(data.size) or real(data, offsets))
    rows = [r for b in ngramjoin._survey([batch.slice(0, 1500)]) for r in b.to_pylist()]
    assert max(seen) <= 1 << 17 < sum(seen) // 8 and all(t["n"] <= (1 << 17) + 1 for t in B._powers)
    rows += [r for b in ngramjoin._survey([batch.slice(1500)]) for r in b.to_pylist()]
    assert seen[-1] == 400_000 and [r["n"] for r in rows if r["chunk"] is None] == [196] * 1500 + [1]
    assert sum(np.frombuffer(r["loads"], np.int32).sum() for r in rows if r["loads"]) == 196 * 1500 + 1
    assert [r["doc_id"] for r in ngramjoin._dicts(batch)] == list(range(len(texts)))
