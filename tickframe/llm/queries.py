"""Registered queries opN_<name> and their DuckDB oracles; each wraps the operator module of the same subject."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (bpe, decontaminate, egojoin, filteraudit, langid, multiindex, ngramjoin, resample, secretscan, substringdedup,
                           suffixdedup, toxicity, warc)
from tickframe.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn
    return deco


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    """Where the rank file of the tokeniser lies; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _fold(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = r"regexp_extract_all(" + _LOWER_SQL.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query(f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, list_slice(w, i, i + m - 1) AS g
        FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
              FROM b WHERE len(w) > 0)),
pos AS (SELECT d.doc_id, k.m, p.i, list_slice(d.w, p.i, p.i + k.m - 1) AS g
        FROM d, (SELECT DISTINCT m FROM win) k, LATERAL (SELECT unnest(range(1, len(d.w) - k.m + 2)) AS i) p),
hit AS (SELECT pos.doc_id, pos.i, pos.m, win.item_id FROM pos JOIN win ON pos.m = win.m AND pos.g = win.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.l, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
""")
def op4_decontamination(spark, sf_dir):
    """Words of documents inside benchmark windows of ten words, per document."""
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@_query()
def op2_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of whole texts and the bytes that they decode to, as digests."""
    return bpe.round_trip(_read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


@_query()
def op9_language_id(spark, sf_dir):
    """Naive Bayes language of every document, learned from the documents of folds 0 and 2 of 3."""
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@_query()
def op3_toxicity(spark, sf_dir):
    """Toxicity score of every document, learned from labelled documents of folds 1 to 4 of 5."""
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@_query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY sha256(h)) AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to FROM q
""")
def op10_warc(spark, sf_dir):
    """Archives every page as a WARC record, equal payloads as revisits, and reads the archives back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.archive(_read(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


@_query("""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON r.id = l.a WHERE r.c < l.b),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN m ON v.vec_id = m.id LEFT JOIN n ON v.vec_id = n.a
""")
def op6_embedding_near_dups(spark, sf_dir):
    """Links of cosine 0.98 within a label, and the components that they form."""
    return egojoin.near_duplicates(_read(spark, sf_dir, "embeddings"))


_SHINGLES = r"""
w AS (SELECT doc_id, regexp_extract_all(""" + _LOWER_SQL.format("coalesce(text, '')") + r""", '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)"""


@_query("WITH RECURSIVE " + _SHINGLES + """,
l AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
      JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 75 * (na.n + nb.n - p.c)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON r.id = l.a WHERE r.c < l.b),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d JOIN m ON d.doc_id = m.id LEFT JOIN n ON d.doc_id = n.doc_id
""")
def op7_ngram_jaccard(spark, sf_dir):
    """Components of documents whose sets of five-word shingles have a Jaccard similarity of at least 0.75."""
    return ngramjoin.link_components(_read(spark, sf_dir, "documents"))


@_query()
def op5_secret_scan(spark, sf_dir):
    """Secrets per document, as a random forest over the candidates' features decides."""
    return secretscan.report(_read(spark, sf_dir, "documents"))


@_query()
def op1_suffix_dedup(spark, sf_dir):
    """Bytes of each document left after all repeats of 400 bytes are removed."""
    return suffixdedup.deduplicate(_read(spark, sf_dir, "documents"))


@_query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS f FROM g GROUP BY g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f ON g.g = f.g WHERE f.f < g.doc_id),
k AS (SELECT x.doc_id, string_agg(x.t, ' ' ORDER BY x.p) AS t, count(*) AS n
      FROM (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d) x LEFT JOIN r ON x.doc_id = r.doc_id AND x.p = r.p
      WHERE r.p IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
""")
def op8_substring_dedup(spark, sf_dir):
    """Words of each document left after all repeats of 13 words from smaller documents are removed."""
    return substringdedup.deduplicate(_read(spark, sf_dir, "documents"))


@_query()
def op11_multi_index_hashing(spark, sf_dir):
    """The 20 nearest vectors by inner product of every vector whose id is divisible by 20."""
    return multiindex.nearest(_read(spark, sf_dir, "embeddings"))


_ALL_FEATURES = "unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]))"


@_query(f"""
WITH tab AS (SELECT list(x ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, [0::BIGINT FOR _ IN range(8)]),
  lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS x FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT doc_id, row_number() OVER () AS r, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT {_ITEM_WORDS} AS w FROM benchmark),
dc AS (SELECT r, f, count(*) AS n FROM (SELECT r, {_ALL_FEATURES} AS f FROM d) GROUP BY 1, 2),
bc AS (SELECT f, count(*) AS n FROM (SELECT {_ALL_FEATURES} AS f FROM b) GROUP BY 1),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM dc UNION SELECT f FROM bc)),
k AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || h[2 * i + 1:2 * i + 2])::BIGINT FOR i IN range(len(h) // 2)]),
  lambda c, x: xor(c >> 8, tab.t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS q FROM u, tab),
s AS (SELECT q, sum(n)::DOUBLE AS s FROM dc JOIN k USING (f) GROUP BY q),
t AS (SELECT q, sum(n)::DOUBLE AS t FROM bc JOIN k USING (f) GROUP BY q),
z AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS bs, (SELECT coalesce(sum(t), 0) FROM t) AS bt),
g AS (SELECT s.q, floor(1000 * ln((coalesce(t, 0) + 1) * (bs + 10000) / ((s + 1) * (bt + 10000)))) AS g FROM s LEFT JOIN t ON s.q = t.q, z),
m AS (SELECT r, floor(sum(n * g) / sum(n))::BIGINT AS weight FROM dc JOIN k USING (f) JOIN g USING (q) GROUP BY r),
e AS (SELECT doc_id, len(w) AS words, greatest(2 * len(w) - 1, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM d LEFT JOIN m ON d.r = m.r),
o AS (SELECT *, words >= 20 AND doc_id IS NOT NULL AS can, row_number() OVER (PARTITION BY words >= 20 AND doc_id IS NOT NULL ORDER BY score DESC, doc_id) AS p,
      count(*) FILTER (words >= 20 AND doc_id IS NOT NULL) OVER () AS n FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN can AND p <= 25 * n // 100 THEN p END AS rank FROM o
""")
def op12_importance_resample(spark, sf_dir):
    """Documents weighed by how much more often their words and word pairs occur in the benchmark; a quarter drawn by Gumbel noise."""
    return resample.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@_query(r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM documents),
l AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(min(d.doc_id) OVER (PARTITION BY t) < d.doc_id, false)::INT AS mask
      FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(k, b)),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM x a, x b, x c, x d, x e
      WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
r AS (SELECT part, filter_order, step::INT AS step, bit, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM r
""")
def op13_filter_audit(spark, sf_dir):
    """What five filters remove from each language, in every order."""
    return filteraudit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", _read(spark, sf_dir, "labels"))
