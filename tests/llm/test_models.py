"""Trained operators: held-out accuracy on made texts, and defined results at the edges."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickframe.llm import blocks as B
from tickframe.llm import codepoints as C
from tickframe.llm import langid, secretscan, toxicity

SYLLABLES = {"aa": ["ka", "lo", "mi", "re"], "bb": ["schu", "eng", "ät", "ver"], "cc": ["ñó", "que", "os", "la"]}


def _word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def test_language_of_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(_word(rng, lang) for _ in range(rng.randint(3, 60))), lang) for k, lang in enumerate(rng.choices(list(SYLLABLES), k=300))]
    train = spark.createDataFrame(rows[:200] + [(900, "Kalo", None), (901, None, "aa"), (902, "", "bb")], "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert model[0] == ["aa", "bb", "cc"]
    test = spark.createDataFrame(rows[200:] + [(903, None, "aa"), (904, "12 !?", "aa"), (905, "", None)], "doc_id long, text string, score string").repartition(3)
    got = {r.doc_id: r for r in langid.predict(test, model).collect()}
    assert np.mean([got[d].lang_pred == lang for d, _, lang in rows[200:]]) > 0.97
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (903, 904, 905))
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_counts_equal_a_plain_count(spark):
    texts = ["Ab, cñ", "", "ab"]
    data, offsets = B.text_bytes(pa.array(texts))
    grams, letters = langid.ngrams(data, offsets, C.Classes())
    assert letters.tolist() == [True, False, True]
    for n, (_, a, b) in zip(langid.ORDERS, grams):
        assert (b - a).tolist() == [max(0, len(t) - n + 1) for t in texts]
    model = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert [r.lang_pred for r in langid.predict(spark.createDataFrame([("abc",)], "text string"), model).collect()] == ["und"]


def _toxic_rows(rng, n, start=0):
    bad = ["grumbel", "snarvik", "drobnax"]
    spell = lambda w: w if rng.random() < 0.6 else w[:-1] + rng.choice("aeiou") + w[-1]
    out = []
    for k in range(start, start + n):
        words = [_word(rng, "aa") for _ in range(rng.randint(20, 150))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * max(1, len(words) // 40)):
            words.insert(rng.randrange(len(words)), spell(rng.choice(bad)))
        out.append((k, " ".join(words), toxic))
    return out


def test_toxicity_of_held_out_texts_and_misspellings(spark):
    rng = random.Random(2)
    rows, test = _toxic_rows(rng, 250), _toxic_rows(rng, 120, 1000)
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.sample(docs, labels).count() == 250
    model = toxicity.fit(docs, labels)
    frame = spark.createDataFrame([(d, t, "x") for d, t, _ in test] + [(5000, None, "x"), (5001, "", "x"), (5002, "kalo grumbbel mire", "x")], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    assert np.mean([got[d].predicted == y for d, _, y in test]) > 0.95
    assert got[5000].predicted == got[5001].predicted == 0
    assert got[5002].score > max(got[d].score for d, _, y in test if not y)  # a spelling never seen
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_subwords_equal_a_plain_listing():
    text = "Abc, déf x"
    data = np.frombuffer(text.encode(), np.uint8)
    f, w, firsts = toxicity.subwords(data, np.array([0, data.size]), C.Classes(), 2)
    assert firsts.tolist() == [0, 2]
    for k, words in enumerate((["abc", "déf"], ["x"])):
        want = sum(1 + sum(max(0, len(x) + 2 - n + 1) for n in toxicity.ORDERS) for x in words)
        assert (w == k).sum() == want


@pytest.mark.parametrize("labels,share", [([], 0.0), ([0, 0], 0.0), ([1, 1], 1.0)])
def test_toxicity_without_two_classes(spark, labels, share):
    model = toxicity.train(["ab cd"] * len(labels), np.array(labels, np.int64))
    got = toxicity.score(spark.createDataFrame([("ab",), (None,)], "text string"), model).collect()
    assert [r.score for r in got] == [share] * 2


def _secret_docs(spark):
    rng = random.Random(3)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, keys = [], {}
    for k in range(120):
        words = [_word(rng, "aa") for _ in range(30)] + ["kalomirekalomireka", "4111111111111111"]
        if k % 3 == 0:
            keys[k] = hexa(32)
            words[10:10] = [rng.choice([f'token = "{keys[k]}"', f"password={keys[k]}", f"api_key: {keys[k]}"])]
        rows.append((k, " ".join(words), rng.choice(["src/a.py", "conf/.env", None]), "x"))
    rows += [(500, None, None, "x"), (501, "", "p", "x"), (3, rows[3][1], rows[3][2], "x"), (None, f"token = \"{hexa(30)}\"", "p", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, secrets string").repartition(3), rows, keys


def test_secrets(spark):
    docs, rows, keys = _secret_docs(spark)
    got = secretscan.report(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_secrets == 1
        else:
            assert r.n_secrets == (1 if r.doc_id in keys else 0), r
    clean = secretscan.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    for r in clean.where("doc_id IS NOT NULL").collect():
        before = next(t for d, t, *_ in rows if d == r.doc_id)
        assert r.text == (before.replace(keys[r.doc_id], "[SECRET]") if r.doc_id in keys else before)
    assert secretscan.report(docs.limit(0)).count() == 0
    plain = secretscan.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plain and "Arrow" not in plain and "Pandas" not in plain


def test_secrets_with_given_findings(spark):
    docs, _, keys = _secret_docs(spark)
    found = secretscan.features(secretscan.candidates(docs), secretscan.dictionary(docs))
    labelled = found.withColumn("label", F.when(F.col("value").rlike("^4"), 1).otherwise(0))
    got = secretscan.scan(docs, findings=labelled)
    assert {r.value for r in got.where("secret").select("value").distinct().collect()} >= {"4111111111111111"}
    assert got.where(F.col("value").isin(list(keys.values())) & F.col("secret") & ~F.col("value").startswith("4")).count() == 0


def test_every_run_of_a_token_is_a_candidate(spark):
    aws, gh, a, b = "AKIA" + "Q7" * 8, "ghp_" + "a1B2" * 9, "0f" * 10, "9e" * 10
    texts = {1: f'{{"aws":"{aws}","gh":"{gh}"}}', 2: f"https://h.io/x?token={a}&session={b}", 3: f"({aws})", 4: f"see `{aws}`, then", 5: f"<token>{gh}</token>",
             6: f"schlüssel→{aws}", 7: f"[{a};{b}]", 8: f"my_api_key_for_tests={a}"}
    docs = spark.createDataFrame([(k, t, "p") for k, t in texts.items()], "doc_id long, text string, source string")
    got = {}
    for r in secretscan.candidates(docs).collect():
        got.setdefault(r.doc_id, {})[r.value] = r
    want = {1: [aws, gh], 2: [a, b], 3: [aws], 4: [aws], 5: [gh], 6: [aws], 7: [a, b], 8: [a]}
    assert all(set(got[k]) >= set(v) for k, v in want.items())
    assert [got[1][v].name for v in (aws, gh)] == ["aws", "gh"] and all(got[1][v].quoted for v in (aws, gh))
    assert [got[2][v].name for v in (a, b)] == ["token", "session"] and got[2][b].address and not got[1][aws].address
    assert got[5][gh].name == "token" and got[8][a].name == "my_api_key_for_tests" and got[4][aws].before == "see" and got[4][aws].after == "then"
    clean = {r.doc_id: r.text for r in secretscan.redact(docs).collect()}
    assert not any(v in clean[k] for k, vs in want.items() for v in vs if v in (aws, gh) or k in (2, 8) and v == a)


def test_values_after_a_name_at_any_length_and_dotted_runs(spark):
    jwt = ".".join(["eyJhbGciOiJIUzI1NiJ9", "eyJzdWIiOiIxMjM0NTY3ODkwIn0", "dBjftJeZ4CVP-mB92K27uhbUJU1p1r_wW1gFWFOEjXk"])
    texts = {1: ("password=hunter2!xyz ok", "hunter2!xyz"), 2: ('{"db_password":"p@55$w.rd~1","x":1}', "p@55$w.rd~1"), 3: (f"Authorization: Bearer {jwt}.", jwt),
             4: (f"session {jwt} end", jwt), 5: ("api_key = 'Ab%9'", "Ab%9"), 6: ("<password>Zy9!k.2m</password>", "Zy9!k.2m"), 7: ("u?token=q1w2e3r4&n=5", "q1w2e3r4")}
    docs = spark.createDataFrame([(k, t, "p") for k, (t, _) in texts.items()] + [(50 + k, f"words kalomirekalomireka{k} kalo lo", "p") for k in range(9)]
                                 + [(80 + k, "kalomirekalomireka mi", "p") for k in range(9)], "doc_id long, text string, source string")
    got = {}
    for r in secretscan.candidates(docs).collect():
        got.setdefault(r.doc_id, []).append(r.value)
    assert all(got[k] == [v] for k, (_, v) in texts.items()), got
    clean = {r.doc_id: r.text for r in secretscan.redact(docs).collect()}
    assert all(clean[k] == texts[k][0].replace(texts[k][1], "[SECRET]") for k in (1, 2, 3, 6, 7)), clean


def test_short_secrets_are_masked_where_they_follow_their_name(spark):
    docs = spark.createDataFrame([(1, "pwd=ab1 cab12 pwd=ab12x", "p")], "doc_id long, text string, source string")
    found = secretscan.features(secretscan.candidates(docs), secretscan.dictionary(docs)).withColumn("label", F.lit(1))
    assert [r.text for r in secretscan.redact(docs, findings=found).collect()] == ["pwd=[SECRET] cab12 pwd=[SECRET]"]


def _words_of(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return int(toxicity.subwords(data, np.array([0, data.size]), C.Classes(), 1)[2][-1])


def test_toxicity_keeps_digits_and_signs_in_words():
    assert [_words_of(t) for t in ("m0ron", "tr@sh!", "$hit a$$le", "it costs $100, ok", "12 !?", "Abc, d\u00e9f x")] == [1, 1, 2, 3, 0, 3]


def test_toxicity_sample_refills_and_keeps_long_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 5)
    monkeypatch.setattr(toxicity, "MAX_NEGATIVE", 5)
    long_text = " ".join(f"w{k}" for k in range(12_000))
    docs = spark.createDataFrame([(k, long_text if k % 2 else "kalo mi") for k in range(10)] + [(k, "") for k in range(10, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.sample(docs, labels).collect()}
    want = {k for k in range(10) if k % 3 == 0}
    assert {d for d, r in got.items() if r.toxic} == want and len(got) == len(want) + 5
    odd = [r.text for d, r in got.items() if d % 2]
    places = [[int(w[1:]) for w in t.split()] for t in odd]
    assert odd and all(0.9 * toxicity.MAX_TRAIN_BYTES < len(t.encode()) <= toxicity.MAX_TRAIN_BYTES + 16 for t in odd)
    assert all(p == sorted(p) and p[0] < 1_500 and p[-1] > 10_000 for p in places)


def test_toxicity_scores_in_small_blocks():
    """The features of a task's texts are held for SCORE_BYTES of text at a time, and scores do not depend on the blocks."""
    rng = np.random.default_rng(3)
    words = np.array(["alpha", "beta", "gamma$", "d3lta", "épsilon", "zeta", "eta", "theta"])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(700)] + [None, "", "..."]

    class Model:
        value = {"weight": rng.normal(size=toxicity.BUCKETS), "bias": 0.1, "constant": None}

    def scores(batch):
        return [s for b in toxicity._score_task(Model, "text", False)(iter([batch])) for s in b.column("score").to_pylist()]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    one_by_one = [scores(batch.slice(k, 1))[0] for k in (0, 350, 699, 700, 701, 702)]
    tracemalloc.start()
    try:
        got = scores(batch)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [got[k] for k in (0, 350, 699, 700, 701, 702)] == one_by_one and len(got) == len(texts)
    assert peak < 64 << 20
