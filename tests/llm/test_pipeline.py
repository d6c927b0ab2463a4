"""The pipeline stage by stage on the smallest tables, each stage against a plain re-computation on its own input."""

import re

import helpers as H
import pytest
import tiktoken
from helpers import SF_SMALL

import corpus_pipeline as P
from tickframe.llm import bpe, registry
from tickframe.llm.queries import vocabulary


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        stage(spark, out[-1], SF_SMALL).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return [(df.columns, [r.asDict() for r in df.collect()]) for df in out]


def test_columns_and_order(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "secret_scan", "byte_bpe"]
    assert all(columns == stages[0][0] for columns, _ in stages[1:5])


def test_toxic_documents_go(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1][1]}
    wrong = [d for d, y in labels.items() if y is not None and (d in kept) == bool(y)]
    assert len(wrong) <= 0.05 * len(labels)
    before = {r["doc_id"]: r for r in stages[0][1]}
    assert all(r == before[r["doc_id"]] for r in stages[1][1])


def test_one_document_of_each_group_stays(stages):
    comp = {d: c for d, _, c in H.jaccard_components([(r["doc_id"], r["text"]) for r in stages[1][1]])}
    assert {r["doc_id"] for r in stages[2][1]} == set(comp.values())


def test_benchmark_passages_are_cut_and_clean_documents_stay(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    hits = {h[0]: h for h in H.benchmark_hits([(r["doc_id"], r["text"]) for r in stages[2][1]], items)}
    after = {r["doc_id"]: r for r in stages[3][1]}
    for r in stages[2][1]:
        _, n, hit, *_ = hits[r["doc_id"]]
        if not hit:
            assert after[r["doc_id"]] == r
        elif hit > 0.5 * n:
            assert r["doc_id"] not in after
        else:
            assert len(after[r["doc_id"]]["text"]) < len(r["text"])
            assert after[r["doc_id"]]["n_chars"] == r["n_chars"] - len(r["text"]) + len(after[r["doc_id"]]["text"])


def test_secrets_are_masked(stages):
    before = {r["doc_id"]: r for r in stages[3][1]}
    assert len(before) == len(stages[4][1])
    for r in stages[4][1]:
        assert not re.search(r'token = "[0-9a-f]{40}"|password=[0-9a-f]{18}|AKIA[A-Z0-9]{16}', r["text"] or "")
        if "[SECRET]" not in (r["text"] or ""):
            assert r == before[r["doc_id"]]


def test_tokens_equal_the_library(stages):
    import public_tokenizers
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(vocabulary()), special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in stages[4][1]}
    assert len(texts) == len(stages[5][1])
    for r in stages[5][1]:
        assert r["round_trip"] and list(r["token_ids"]) == lib.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["token_ids"])


def test_registered():
    names = list(registry.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline") == list(range(1, 11)) and "pipeline" in names
    assert set(registry.oracle_sql()) <= set(names)
