"""Secret scans: candidates by pattern, false positives removed by a random forest (DataFrame functions and Spark ML only).

Candidates are runs of 16 or more of [A-Za-z0-9+/_=-] that hold a digit or change three times from a capital or a mark
to a small letter, and any 8 or more characters without white space, quotes, commas, semicolons and angle brackets behind an
identifier that holds a key word and an assignment, with any white space around it. The name isn't part of the value.

Features: length, shares of digits, capitals and hex digits, distinct characters, character transitions (changes of
class, and how usual its pairs of letters are), dictionary coverage (share of its letter triples that are among the
DICTIONARY_SIZE most frequent of the words of all texts), path (slashes in it and a path before it), known issuers'
formats, and neighbouring words within NEAR_BEFORE and NEAR_AFTER characters: key words, assignment and quotes before it,
checksum words before it, plain words behind it.

The forest is fitted on TRAIN_ROWS labelled findings, which bounds it, as the tables hold no labels: planted texts whose
truth is known by how they were made. Secrets are random values in eight forms, half of them next to key words; the rest
are numbers, paths, names, file and release names, checksums, fillers and placeholders, some of them next to key words or
assignments too. Planted words are put together from the letter triples of the table. All texts are scanned and all findings
scored; nothing that the forest removes is dropped from the result.

Null and empty texts have no findings; texts of any length are scanned whole; equal rows give equal findings. An empty
table, or one without findings, gives an empty result. Columns other than doc_id and text aren't read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import shared

_NAMES = "token|secret|password|passwd|passphrase|passcode|pwd|(?:api|access|private)[_-]?key|[a-z0-9][_-]key|credential|auth|bearer"
KEY_WORDS = f"(?i)({_NAMES})"
_RUN = "[A-Za-z0-9+/_=-]"
#: An identifier that holds a key word, an assignment with any white space around it, a quote; an authentication scheme may stand before the value.
_LEAD = rf"(?<![\w.-])(?=[\w.-]++[\"']?\s*+[=:])(?=[\w.-]*?(?i:{_NAMES}))[\w.-]++[\"']?\s*+[=:]{{1,2}}\s*+[\"']?(?:(?i:bearer|basic)\s++)?"
#: A value behind such a lead; a run with a digit, or with three changes to small letters. Each begins with what is cheap to look at.
CANDIDATE = (
    rf"{_LEAD}[^\s\"'<>,;=:][^\s\"'<>,;]{{7,}}"
    rf"|(?<!{_RUN})(?={_RUN}{{16}})(?:(?=[A-Za-z+/_=-]*+[0-9])|(?=[a-z]*+(?:[A-Z+/_=-]+[a-z]+){{3}})){_RUN}{{16,}}"
)
#: The formats of known issuers' keys.
ISSUER = r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{30,}|github_pat_\w{22,}|glpat-[\w-]{20,}|xox[abprs]-[\w-]{10,}|[sr]k_(live|test)_\w{16,}|AIza[\w-]{35}|npm_\w{36}|hf_\w{30,}|SG\.[\w.-]{60,}|eyJ[\w-]{10,}.*)$"
#: A candidate carries its own name, as in password = ...; what stands before the value.
OWN_NAME = rf"^(?:{_LEAD}|[A-Za-z_-]+=+)"
TRAIN_ROWS, DICTIONARY_SIZE = 5000, 1500
TREES, DEPTH, SEED = 30, 8, 7
NEAR_BEFORE, NEAR_AFTER = 80, 40
FEATURES = ("f_length", "f_digits", "f_capitals", "f_hex", "f_distinct", "f_changes", "f_pairs", "f_dictionary", "f_path", "f_issued", "f_word", "f_assigned", "f_quoted", "f_checksum", "f_plain_after")


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, number (from 0 in a text), value, before and after of every candidate."""
    found = docs.select("doc_id", "text").withColumn("_values", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).where("size(_values) > 0")
    found = found.withColumn("_gaps", F.split("text", CANDIDATE, -1))
    rows = found.select("doc_id", "_gaps", F.posexplode("_values").alias("number", "found"))
    rows = rows.select("doc_id", "number", "found", F.right(F.expr("get(_gaps, number)"), F.lit(NEAR_BEFORE)).alias("before"), F.left(F.expr("get(_gaps, number + 1)"), F.lit(NEAR_AFTER)).alias("after"))
    rows = rows.withColumn("name", F.regexp_extract("found", OWN_NAME, 0))
    return rows.select("doc_id", "number", F.right(F.concat("before", "name"), F.lit(NEAR_BEFORE)).alias("before"), "after", F.expr("substr(found, length(name) + 1)").alias("value"))


def letter_triples(docs: DataFrame) -> list[str]:
    """The most frequent letter triples of the words of all texts. There are at most 26**3, counted before the shuffle."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![a-z0-9])[a-z]{3,12}(?![a-z0-9])"), F.lit(0))).alias("w"))
    triples = words.select(F.explode(F.expr("transform(sequence(1, length(w) - 2), i -> substr(w, i, 3))")).alias("t"))
    return [r[0] for r in triples.groupBy("t").count().orderBy(F.desc("count"), "t").limit(DICTIONARY_SIZE).collect()]


#: Values by form, in terms of h and g (64 hex digits each), s (both as letters and digits), w(i) (words of the table).
_SECRETS = (
    "substr(h, 1, 40)",
    "substr(h, 1, 32)",
    "substr(base64(unhex(h)), 1, 40)",
    "concat('AKIA', upper(translate(substr(h, 1, 16), '0189', 'XYZW')))",
    "concat('ghp_', substr(s, 1, 36))",
    "concat('sk_live_', substr(s, 1, 24))",
    "substr(s, 1, 9 + cast(n % 8 as int))",
    "substr(translate(s, '0123456789', 'QwErTyUiOp'), 1, 20 + cast(n % 12 as int))",
)
_OTHERS = (
    "substr(translate(h, 'abcdef', '123456'), 1, 16 + cast(n % 4 as int))",
    "concat(w1, '-', w2, '-', n % 90, '-', w3)",
    "concat(w1, '/', w2, '/', n % 900, '/', w3)",
    "concat(initcap(w1), initcap(w2), initcap(w3), n % 9)",
    "concat(w1, '_', w2, '_', w3, '_v', n % 30)",
    "concat(repeat(substr('0xX-_z19', 1 + cast(n % 8 as int), 1), 15 + cast(n % 20 as int)), n % 10)",
    "concat('2024-', lpad(n % 12, 2, '0'), '-', lpad(n % 28, 2, '0'), '-', w1, '-', n % 1000)",
    "substr(h, 1, case when n % 2 = 0 then 40 else 32 end)",
    "concat(w1, '-', w2, '-here', n % 10)",
)
_CHECKSUM, _PLACEHOLDER = 7, 8
_KEYED = ("token = ", "secret: ", "password=", "api_key = ", "access-key: ", "auth=", "pwd: ")
_NEUTRAL = ("id=", "version: ", "path = ", "name: ", "ref=", "order: ", "file=")
_SUMS = ("commit ", "sha1 ", "md5: ", "checksum=", "digest ", "etag: ")


def _worked_out(df: DataFrame) -> DataFrame:
    """df with its columns worked out before what uses them many times over: the optimizer doesn't merge expressions through an explode."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def planted(spark: SparkSession, triples: list[str], rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, value and label of made-up findings; half are secrets."""
    known = "array(" + ", ".join(f"'{t}'" for t in triples or ["the", "ing", "and"]) + ")"
    pick = lambda items, i: f"element_at(array({', '.join(items)}), 1 + cast(pmod(xxhash64(n, {i}), {len(items)}) as int))"
    quoted = lambda items: [f"'{x}'" for x in items]
    word = lambda i: "concat(" + ", ".join(f"element_at(known, 1 + cast(pmod(xxhash64(n, {10 * i + j}), size(known)) as int))" for j in (1, 2)) + ")"
    df = spark.range(rows).select(F.col("id").alias("doc_id"), F.expr("id div 2").alias("n"), (F.col("id") % 2 == 0).cast("double").alias("label"), F.expr(known).alias("known"))
    df = df.withColumns({"h": F.expr("sha2(concat('h', doc_id), 256)"), "g": F.expr("sha2(concat('g', doc_id), 256)")} | {f"w{i}": F.expr(word(i)) for i in range(1, 8)})
    df = df.withColumn("s", F.expr("translate(base64(unhex(concat(h, g))), '+/=', 'kQ7')"))
    df = _worked_out(df.drop("known"))
    df = df.withColumn("form", F.expr(f"case when label = 1 then pmod(xxhash64(n, 1), {len(_SECRETS)}) else pmod(xxhash64(n, 1), {len(_OTHERS)}) end"))
    forms = lambda items: "case form " + " ".join(f"when {i} then {x}" for i, x in enumerate(items)) + " end"
    df = df.withColumn("value", F.expr(f"case when label = 1 then {forms(_SECRETS)} else {forms(_OTHERS)} end"))
    keyed, neutral, sums = (pick(quoted(x), i) for i, x in enumerate((_KEYED, _NEUTRAL, _SUMS), 4))
    # Short values are found behind key words only; checksums stand behind their words and placeholders behind key words.
    lead = f"""case when label = 1 and (form in (6, 7) or n % 2 = 0) then {keyed} when label = 1 then ''
        when form = {_CHECKSUM} then {sums} when form = {_PLACEHOLDER} then {keyed} when n % 3 = 0 then {neutral} when n % 7 = 0 then {keyed} else '' end"""
    quote = F.expr("case when n % 4 = 1 and not (label = 0 and form = 2) then '\"' else '' end")
    df = _worked_out(df)
    return df.select("doc_id", F.concat("w4", F.lit(" "), "w5", F.lit(" "), F.expr(lead), quote, "value", quote, F.lit(" "), "w6", F.lit(" "), "w7").alias("text"), "value", "label", "form")


def with_features(rows: DataFrame, triples: list[str]) -> DataFrame:
    def share(pattern: str):
        return (F.length("value") - F.length(F.regexp_replace("value", pattern, ""))) / F.greatest(F.length("value"), F.lit(1))

    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "1"), "[^aB1]", "-")
    # Lists of letters only, at most 26**3 and 26**2; Spark looks a list of literals up in a hash set.
    listed = lambda items: ", ".join(f"'{x}'" for x in sorted(items)) or "''"
    known, pairs = listed(triples), listed({t[:2] for t in triples})
    cut = "case when length(value) < {n} then array() else transform(sequence(1, length(value) - {n} + 1), i -> lower(substr(value, i, {n}))) end"
    out = rows.withColumn("_3", F.expr(cut.format(n=3))).withColumn("_2", F.expr(cut.format(n=2)))
    out = out.withColumns(
        {
            "f_length": F.length("value").cast("double"),
            "f_digits": share("[0-9]"),
            "f_capitals": share("[A-Z]"),
            "f_hex": share("[0-9a-fA-F]"),
            "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / F.greatest(F.length("value"), F.lit(1)),
            "f_changes": F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) / F.greatest(F.length("value"), F.lit(1)),
            "f_pairs": F.expr(f"size(filter(_2, x -> x in ({pairs}))) / greatest(size(_2), 1)"),
            "f_dictionary": F.expr(f"size(filter(_3, x -> x in ({known}))) / greatest(size(_3), 1)"),
            "f_path": (F.length("value") - F.length(F.replace(F.col("value"), F.lit("/"), F.lit(""))) + F.when(F.col("before").rlike(r"(://|[\w.-]+/)[^\s]*$"), 3).otherwise(0)).cast("double"),
            "f_issued": F.col("value").rlike(ISSUER).cast("double"),
            "f_checksum": F.col("before").rlike(r"(?i)\b(commit|sha-?\d*|md5|checksum|digest|etag|hash|crc)\b[\s\"'=:]*$").cast("double"),
            "f_word": F.col("before").rlike(KEY_WORDS + r"[\s\"'=:>]*$").cast("double"),
            "f_assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
            "f_quoted": (F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")).cast("double"),
            "f_plain_after": F.col("after").rlike(r"^[\"']?\s+[A-Za-z]+\b").cast("double"),
        }
    )
    return out.drop("_3", "_2")


def forest(spark: SparkSession, triples: list[str]):
    """The forest, fitted on planted findings."""
    truth = planted(spark, triples)
    found = with_features(findings(truth), triples).join(truth.select("doc_id", "value", "label"), ["doc_id", "value"]).select("label", *FEATURES)
    found = shared.written(found.orderBy(*FEATURES).coalesce(1), "planted")  # at most TRAIN_ROWS; each level of the trees reads it again
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(data)


def scored(rows: DataFrame, model) -> DataFrame:
    """rows with probability and secret."""
    out = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    return out.withColumn("probability", vector_to_array("probability")[1]).withColumn("secret", F.col("probability") > 0.5).drop("features", "rawPrediction", "prediction")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, number, value, before, after, features, probability and secret of every finding."""
    triples = letter_triples(docs)
    return scored(with_features(findings(docs), triples), forest(docs.sparkSession, triples))


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(shared.documents(spark, sf_dir))
    return out.select("doc_id", "number", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), F.round("probability", 4).alias("probability"), "secret")


QUERIES = {"op7_secret_forest": op7_secret_forest}
ORACLES: dict[str, str] = {}
