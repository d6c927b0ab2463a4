"""Secret scan: candidates by form, false positives removed by a random forest; DataFrame functions only.

Candidates are the values after a secret's name, of any length and any characters but blanks (to the closing quote; a bare one
to a next pair's divider, without closing brackets and stops), and all other runs of at least MIN_LENGTH key characters, segments
joined by single dots being one run.  The name and neighbours are the words next to the value, in its token or beside it.
Its features: length, shares of
digits and upper case, transitions between character classes, coverage by dictionary words, its path, and the words
around it.  The dictionary holds the words that make at least DICTIONARY_SHARE of all words of all documents (so at
most 1 / DICTIONARY_SHARE words).  The forest is trained on labelled findings: those given, or, without any, the
candidates that the labelling rules of ``label_findings`` decide; of either label at most MAX_FINDINGS by least hash.

Defined results: null or empty texts have no candidates; a null path is an empty path; repeated rows get the same
result each; if no finding is labelled, or all have one label, that label goes for all candidates (none: no secret); an
empty table gives no rows.  Other columns of documents pass through ``redact`` unchanged.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.session import checkpoint_dir

MIN_LENGTH, DICTIONARY_SHARE, MAX_FINDINGS, THRESHOLD = 14, 1e-5, 5000, 0.5
LABEL_LENGTH = 8  # a shorter value after a secret's name has no label by rule; the forest decides
TREES, DEPTH, SEED = 20, 6, 7
MAX_BROADCAST_DOCS = 1_000_000
_KEY = r"[A-Za-z0-9+/_\-]"
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_SPACE = r"[\x20\x09-\x0D]+"
_RUN, _NEAR = r"[A-Za-z0-9+/_\-.]{%d,}" % MIN_LENGTH, 300
_OUTER_DOT = r"\.(?!" + _KEY + ")|(?<!" + _KEY + r")\."  # a dot that joins no two key characters
_DIVIDERS = r"[\"'`<>(){}\[\],;|\\]+"
_NAME = r"([A-Za-z0-9_\-]+)[\"'`\\\])]*\s*(?:[=:]+>?|>)\s*[\"'`\\(\[{]*$"  # at the end of what stands before a value; of its last _NEAR characters
_FIRST_WORD = r"(\p{L}[\p{L}\p{N}_\-]*)"
_LAST_WORD = r"([\p{L}\p{N}_\-]+)[^\p{L}\p{N}]*$"
_NAMES, _SCHEMES = "token|secret|passw|pwd|api_?key|access_?key|auth|credential|private", r"(?:(?:bearer|basic|token)[\x20\x09-\x0D]+)?"
_SECRET_NAMES = "(?i)(" + _NAMES + ")"
# a secret's name, what assigns (=, :, an element's >), and the opening quote: the value follows
_LEAD = ("(?i)(?=[acpst])(?:" + _NAMES + r")[A-Za-z0-9_\-]{0,200}+[\"'`\\\])]{0,4}(?:[\x20\x09-\x0D]*[=:]+>?[\x20\x09-\x0D]*|>)"
         r"(?:[brfu]{0,2}\\?[\"'`])?" + _SCHEMES)
_TAKEN, _OTHER_DOT = "\x01", "\x02"
FEATURES = ["length", "digits", "uppers", "to_digit", "to_letter", "case_turns", "distinct_share", "signs", "coverage", "path_test", "path_config",
            "named", "assigned", "quoted", "mail_or_url", "word_before", "word_after"]


def _get(array: str, at: Column) -> Column:
    return F.coalesce(F.get(array, at), F.lit(""))


def _value(lead: Column, rest: Column) -> Column:
    """The value at the start of rest: to its closing quote, its element's end, or a blank, without what divides it from a next pair or closes a sentence."""
    quote = F.regexp_extract(lead, "([\"'`])" + "(?i)" + _SCHEMES + "$", 1)
    upto = lambda ends: F.regexp_extract(rest, r"^[^\x20\x09-\x0D" + ends + "]+", 0)
    bare = F.regexp_replace(F.regexp_replace(upto("\"'`"), "</.*$", ""), r"[&,;][{\[]*[\w.\-]+[=:].*$", "")
    out = F.when(lead.endswith(">") & ~lead.endswith("=>"), upto("<"))
    for q in "\"'`":
        out = out.when(quote == q, F.rtrim(upto(q), F.lit("\\")))
    return out.otherwise(F.rtrim(bare, F.lit(".,;:&)]}\\")))


def _split_named(docs: DataFrame, path: str, text: str) -> DataFrame:
    """doc_id, mark, path, found (lead, value, rest after it, name of each value that follows a secret's name), start (text before the first)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("mark"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                       F.regexp_extract_all(whole, F.lit(_LEAD), F.lit(0)).alias("leads"), F.split(whole, _LEAD).alias("parts"))
    pair = lambda lead, i: F.struct(lead.alias("lead"), _value(lead, F.get("parts", i + 1)).alias("value"), F.get("parts", i + 1).alias("rest"),
                                    F.concat(F.regexp_extract(F.right(F.get("parts", i), F.lit(_NEAR)), r"[A-Za-z0-9_\-]*$", 0),
                                             F.regexp_extract(lead, r"^[A-Za-z0-9_\-]+", 0)).alias("name"))
    return rows.select("doc_id", "mark", "path", F.transform("leads", pair).alias("found"), F.get("parts", F.lit(0)).alias("start"))


def _named(rows: DataFrame) -> DataFrame:
    """The values after a secret's name, of any length and of any characters but blanks."""
    rows = rows.select("doc_id", "mark", "path", F.posexplode("found").alias("k", "f")).where(F.col("f.value").rlike(r"[\p{L}\p{N}]"))
    value, rest = F.col("f.value"), F.col("f.rest")
    return rows.select("doc_id", "mark", "path", F.array(F.lit(-1), "k", F.lit(0)).alias("at"), value.alias("value"), F.col("f.name").alias("name"),
                       F.col("f.name").alias("before"), F.regexp_extract(F.substr(rest, F.length(value) + 1, F.lit(_NEAR)), _FIRST_WORD, 1).alias("after"),
                       F.col("f.lead").rlike("[\"'`](?i)" + _SCHEMES + "$").alias("quoted"),
                       value.rlike(r"://|^[\w.+\-]+@[\w\-]+(\.[\w\-]+)+$").alias("address"), F.col("f.lead").alias("lead"))


def candidates(docs: DataFrame, path: str = "source", text: str = "text") -> DataFrame:
    """A row per candidate: doc_id, mark (hash of the text), at (token, part and run number, or -1, the number of the name, 0), value, name, before,
    after, quoted, address, lead (the characters from the name to the value; empty for a run), path."""
    rows = _split_named(docs, path, text)
    # a value that may hold others stays in the text, too
    kept = lambda f: F.when(f.value.rlike(r"[,;{}\[\]()|<>]|://"), f.rest).otherwise(
        F.concat(F.when(f.value == "", "").otherwise(_TAKEN), F.substr(f.rest, F.length(f.value) + 1)))
    others = rows.select("doc_id", "mark", "path", F.concat("start", F.array_join(F.transform("found", lambda f: F.concat(f.lead, kept(f))), "")).alias("text"))
    return _named(rows).unionByName(_runs(others)).distinct()


def _runs(rows: DataFrame) -> DataFrame:
    """The runs of key characters in text, dotted ones as one."""
    rows = rows.select("doc_id", "mark", "path", F.split("text", _SPACE).alias("w"))
    hits = lambda a: F.explode(F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: F.get(a, i).rlike(_RUN)))
    rows = rows.withColumn("t", hits("w"))
    t = F.col("t")
    rows = rows.select("doc_id", "mark", "path", "t", F.regexp_replace(_get("w", t), _OUTER_DOT, _OTHER_DOT).alias("token"), _get("w", t - 1).alias("prev"), _get("w", t - 2).alias("prev2"),
                       _get("w", t + 1).alias("next"))
    # a token's parts (one address, word or value each) and what divides them
    rows = rows.select("*", F.split("token", _DIVIDERS).alias("c"), F.regexp_extract_all("token", F.lit(_DIVIDERS), F.lit(0)).alias("d")).drop("token")
    rows = rows.withColumn("p", hits("c"))
    p = F.col("p")
    rows = rows.select(
        "doc_id", "mark", "path", "t", "p", _get("c", p).alias("part"), _get("c", p + 1).alias("part_after"), "next",
        F.concat(_get("c", p - 2), _get("d", p - 2), _get("c", p - 1), _get("d", p - 1)).alias("lead"),
        F.when(p <= 1, F.concat_ws(" ", "prev2", "prev", F.lit(""))).otherwise("").alias("far"),
        F.when(F.col("prev").rlike(r"^[=:]+$"), F.col("prev2")).otherwise(F.col("prev")).alias("word"))
    rows = rows.select("*", F.regexp_extract_all("part", F.lit(_RUN), F.lit(0)).alias("v"), F.split("part", _RUN).alias("g"),
                       F.col("part").rlike(r"://|@|^www\.").alias("address")).drop("part")
    rows = rows.select("*", F.posexplode("v").alias("r", "value"))
    r = F.col("r")
    rows = rows.withColumns({"lead": F.concat(F.when(r == 0, F.col("lead")).otherwise(_get("v", r - 1)), _get("g", r)),
                             "rest": F.concat(_get("g", r + 1), _get("v", r + 1), F.lit(" "), F.when(r + 1 == F.size("v"), F.col("part_after")).otherwise(""))})
    near, letters = F.regexp_extract(F.right("lead", F.lit(_NEAR)), _LAST_WORD, 1), F.regexp_extract("rest", _FIRST_WORD, 1)
    return rows.select(
        "doc_id", "mark", "path", F.array("t", "p", "r").alias("at"), "value",
        F.regexp_extract(F.right(F.when(r == 0, F.concat("far", "lead")).otherwise(F.col("lead")), F.lit(_NEAR)), _NAME, 1).alias("name"),
        F.when(near == "", F.col("word")).otherwise(near).alias("before"),
        F.when(letters == "", F.col("next")).otherwise(letters).alias("after"),
        F.col("lead").rlike("[\"'`]$").alias("quoted"), "address", F.lit("").alias("lead"))


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word): words of three and more letters that make at least DICTIONARY_SHARE of them over all documents."""
    words = docs.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= 3)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.col("n") >= F.col("total") * DICTIONARY_SHARE).select("word")


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """found plus the columns FEATURES."""
    v = F.col("value")
    size = F.length(v).cast("double")
    kinds = F.translate(v, _LOWER + _UPPER + _DIGIT, "l" * 26 + "U" * 26 + "d" * 10)
    share = lambda pattern: F.regexp_count(kinds, F.lit(pattern)) / size
    found = found.checkpoint()
    # letters of the value and the neighbouring words that are dictionary words
    pieces = found.select("value", F.explode(F.array_distinct(F.split(F.lower(v), "[^a-z]+"))).alias("word")).where(F.length("word") >= 3).distinct()
    covered = pieces.join(known, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    out = found.join(covered, "value", "left")
    for side in ("before", "after"):
        near = known.select(F.col("word").alias(f"_{side}"), F.lit(1.0).alias(f"word_{side}"))
        plain = F.regexp_replace(F.lower(side), r"[^\p{L}]+", "")
        out = out.join(near, plain == F.col(f"_{side}"), "left").drop(f"_{side}").fillna(0.0, [f"word_{side}"])
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return out.withColumns({
        "length": size, "digits": share("d"), "uppers": share("U"), "to_digit": share("[lU](?=d)"), "to_letter": share("d(?=[lU])"),
        "case_turns": share("l(?=U)") + share("U(?=l)"), "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / size,
        "signs": share("[^lUd]"), "coverage": F.least(F.lit(1.0), F.coalesce("covered", F.lit(0)) / size), "path_test": yes(F.col("path").rlike("(?i)test|example|sample|mock|fixture")),
        "path_config": yes(F.col("path").rlike(r"(?i)\.env|config|settings|credential|\.ya?ml|\.pem")), "named": yes(F.col("name").rlike(_SECRET_NAMES)),
        "assigned": yes(F.col("name") != ""), "quoted": yes(F.col("quoted")), "mail_or_url": yes(F.col("address"))}).drop("covered")


def label_findings(found: DataFrame) -> DataFrame:
    """found plus label: 1 for provider key forms and mixed values of LABEL_LENGTH assigned to a secret's name; 0 for
    values without digits, of digits alone, in addresses; null where no rule decides."""
    v = F.col("value")
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    keyed = v.rlike(r"(^|\.)(AKIA|ASIA)[A-Z0-9]{16}(\.|$)") | v.rlike(r"(^|\.)gh[pousr]_[A-Za-z0-9]{36}(\.|$)")
    return found.withColumn("label", F.when(keyed | (F.col("name").rlike(_SECRET_NAMES) & mixed & (F.length(v) >= LABEL_LENGTH)), 1)
                            .when(~v.rlike("[0-9]") | v.rlike(r"^[0-9\-/+.]+$") | F.col("address"), 0))


def scan(docs: DataFrame, findings: DataFrame | None = None, path: str = "source", text: str = "text") -> DataFrame:
    """Candidates with score and secret; findings are labelled candidates with the columns of ``features`` and label."""
    checkpoint_dir(docs.sparkSession)
    found = features(candidates(docs, path, text), F.broadcast(dictionary(docs, text).checkpoint())).checkpoint()
    labelled = label_findings(found) if findings is None else findings
    parts = [labelled.where(F.col("label") == k).select("label", *FEATURES).orderBy(F.xxhash64("value", "before", "after", "path"), "value")
             .limit(MAX_FINDINGS) for k in (0, 1)]
    train = parts[0].unionByName(parts[1]).orderBy("label", *FEATURES).coalesce(1).checkpoint()  # at most 2 * MAX_FINDINGS rows
    kinds = [r.label for r in train.select("label").distinct().collect()]
    if len(kinds) < 2:
        return found.withColumn("score", F.lit(float(kinds[0]) if kinds else 0.0)).withColumn("secret", F.col("score") >= THRESHOLD)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(assemble.transform(train))
    scored = model.transform(assemble.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("secret", F.col("score") >= THRESHOLD).drop("_features", "rawPrediction", "probability", "prediction")


def _per_document(scored: DataFrame) -> DataFrame:
    secret = F.when(F.col("secret"), F.col("value"))
    return scored.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("n_candidates"), F.count(secret).alias("n_secrets"),
                                                F.sort_array(F.collect_list(secret)).alias("secrets"))


def _same(a: str, b: str) -> Column:
    return F.col(f"l.{a}").eqNullSafe(F.col(f"r.{b}"))


def report(docs: DataFrame, **options) -> DataFrame:
    """A row per row of docs: doc_id, n_candidates, n_secrets, secrets_sha256 (sorted secret values, comma-joined)."""
    found = _per_document(scan(docs, **options))
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark")).alias("l").join(
        found.alias("r"), _same("doc_id", "doc_id") & (F.col("l.mark") == F.col("r.mark")), "left")
    return rows.select("l.doc_id", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), F.coalesce("n_secrets", F.lit(0)).alias("n_secrets"),
                       F.sha2(F.concat_ws(",", F.coalesce("secrets", F.array().cast("array<string>"))), 256).alias("secrets_sha256"))


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """docs with every secret value in the text replaced by mark, a value of less than MIN_LENGTH only after its name; all rows stay."""
    hit = F.array_distinct(F.collect_list(F.struct((-F.length(F.concat("lead", "value"))).alias("size"), "lead", "value")))
    found = scan(docs, **options).where("secret").groupBy("doc_id", "mark").agg(F.sort_array(hit).alias("secrets")).checkpoint()
    if found.count() <= MAX_BROADCAST_DOCS:  # beyond that the join shuffles
        found = F.broadcast(found)
    # longest first: values where they follow their name, then those of MIN_LENGTH wherever they stand
    named = F.filter("r.secrets", lambda s: s.lead != "")
    alone = F.filter("r.secrets", lambda s: F.length(s.value) >= MIN_LENGTH)
    clean = F.aggregate(named, F.col("l.text"), lambda text, s: F.replace(text, F.concat(s.lead, s.value), F.concat(s.lead, F.lit(mark))))
    clean = F.aggregate(F.array_sort(F.array_distinct(F.transform(alone, lambda s: F.struct((-F.length(s.value)).alias("size"), s.value.alias("value"))))),
                        clean, lambda text, s: F.replace(text, s.value, F.lit(mark)))
    rows = docs.alias("l").join(found.alias("r"), _same("doc_id", "doc_id") & (F.xxhash64("l.text") == F.col("r.mark")), "left")
    return rows.select(*[F.when(F.col("r.secrets").isNull(), F.col("l.text")).otherwise(clean).alias("text") if c == "text" else F.col(f"l.`{c}`")
                         for c in docs.columns])
