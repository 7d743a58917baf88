"""Document fingerprints by one-permutation MinHash (DataFrame functions only).

A text's words are `[^\\x20\\x09-\\x0D]+`, its shingles five successive words (fewer words: all of them as one). Each shingle
is hashed once; the hash's top bits name one of BINS bins and a bin keeps the least of the rest. An empty bin takes the
value of a filled one by optimal densification: it tries bins in an order that a hash of bin and attempt fixes, the same
for all texts, until one is filled. What the tries leave empty takes the filled bin with the least hash of both bins,
which is the same kind of draw, so no bin stays empty. BITS low-order bits of each bin are packed in 64-bit words.

Likeness of two fingerprints is the share of equal bins p, corrected for what b bits match by chance: (p - 2**-b) /
(1 - 2**-b), at least 0. It estimates the Jaccard similarity of the two sets of shingles.

Null text is empty text. A text without words has no shingles: its fingerprint is '' (null as words), its likeness to
another such text 1 and to any other 0. Equal texts have equal fingerprints. Texts of any length are read whole.
Fingerprints are worked out row by row and nothing is shuffled for them, so ties, repeated rows and null keys play no
part; other columns pass through, but for one named as the column that is added. An empty table gives an empty result.

For edited texts (paired) documents stand in descending order of doc_id, null last, equal doc_ids by a hash of the
text. Rows that share doc_id and text count as one row, and each gets the result. Neighbours are found in buckets of
that order, whose borders come from quantiles; a doc_id or null that many rows share is cut to buckets by the hash. The last row
of each bucket is also dealt to the next one, so no bucket waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.llm import shared

WORDS, BINS, BITS = 5, 256, 4
TRIES = 16
#: Text in a bucket of neighbours, and the most buckets: their borders are one small row.
BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 1 << 14
_BLOCK = 128


def _lane(bits: int) -> str:
    """A 64-bit word with the lowest bit of each field of so many bits set."""
    word = sum(1 << s for s in range(0, 64, bits))
    return f"{word - (1 << 64) if word >> 63 else word}L"


def with_fingerprint(df: DataFrame, text: str, name: str, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """df with name: array<bigint>, the packed fingerprint of a text column, null where it has no words.

    bins is a power of two from 2 and bits one of 1, 2, 4, 8, 16, so that whole fields fill a word; bins * bits is at least 64.
    """
    if bins & (bins - 1) or bins < 2 or bits not in (1, 2, 4, 8, 16) or bins * bits < 64:
        raise ValueError("bins must be a power of two, bits a divisor of 64 up to 16, and both fill a word")
    shift, per = 64 - (bins.bit_length() - 1), 64 // bits
    rest = (1 << shift) - 1
    own = "_fp" + "_" * max(map(len, [*df.columns, ""]))  # longer than any column of df
    h, s, p = (own + x for x in "hsp")
    blank = "".join(map(chr, (0x20, *range(0x09, 0x0E))))
    out = df.withColumn(h, F.trim(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(blank)))
    out = out.withColumn(h, F.expr(f"case when {h} != '' then transform(split({h}, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> xxhash64(x)) end"))
    run = ", ".join(f"get({h}, i + {k})" for k in range(words))
    shingles = f"case when size({h}) >= {words} then transform(sequence(0, size({h}) - {words}), i -> xxhash64({run})) else array(xxhash64({h})) end"
    # One more hash for each bin, the greatest that it can hold: then sorting gives each bin's least, and a bin where that is the added one is empty.
    last = f"transform(sequence(0, {bins - 1}), b -> shiftleft(cast(b as bigint), {shift}) | {rest}L)"
    out = out.withColumn(s, F.expr(f"case when {h} is not null then sort_array(concat({shingles}, {last})) end"))
    least = f"filter({s}, (x, i) -> i = 0 or shiftrightunsigned(x, {shift}) != shiftrightunsigned(get({s}, i - 1), {shift}))"
    values = f"transform({least}, x -> nullif(x & {rest}L, {rest}L))"
    tries = ", ".join(f"get(v, cast(xxhash64(i, {a}) & {bins - 1}L as int))" for a in range(TRIES))
    drawn = f"transform(v, (x, i) -> coalesce(x, {tries}))"
    filled = "filter(transform(w.v, (x, j) -> case when x is not null then named_struct('j', j, 'x', x) end), e -> e is not null)"
    # Bins that no try has filled are null; where there are any, the filled bins are listed.
    left = "transform(z.d, (x, i) -> coalesce(x, array_min(transform(z.f, e -> named_struct('o', xxhash64(i, -1, e.j), 'x', e.x))).x))"
    # An array of one element gives a value a name (v, w, z, d), so that it is worked out once and not for each element of a loop around it.
    whole = f"transform(transform(array({values}), v -> named_struct('v', v, 'd', {drawn})), w -> case when get(sort_array(w.d), 0) is not null then w.d else get(transform(array(named_struct('d', w.d, 'f', {filled})), z -> {left}), 0) end)"
    # A value is hashed with its bin: else the low bits of all copies of one value would match by chance together.
    whole = f"transform({whole}, d -> transform(d, (x, i) -> xxhash64(x, i)))"
    packed = f"transform(sequence(0, {bins // per - 1}), k -> aggregate(slice(d, k * {per} + 1, {per}), 0L, (p, x) -> shiftleft(p, {bits}) | (x & {(1 << bits) - 1}L)))"
    out = out.withColumn(p, F.expr(f"case when {s} is not null then get(transform({whole}, d -> {packed}), 0) end"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col(p).alias(name))


def as_text(packed: Column) -> Column:
    """Sixteen hex digits for each word; '' without words."""
    return F.coalesce(F.array_join(F.transform(packed, lambda w: F.lpad(F.hex(w), 16, "0")), ""), F.lit(""))


def likeness(a: str, b: str, bits: int = BITS) -> Column:
    """Likeness of two packed fingerprint columns, 0 to 1, with the correction for chance matches."""
    differ = "shiftrightunsigned(x ^ y, 0)"
    for k in range(bits.bit_length() - 1):
        differ = f"({differ} | shiftrightunsigned({differ}, {1 << k}))"
    unequal = f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count({differ} & {_lane(bits)})), 0, (n, k) -> n + k)"
    share = f"1D - {unequal} / cast(size({a}) * {64 // bits} as double)"
    chance = 2.0**-bits
    return F.expr(f"case when {a} is null and {b} is null then 1D when {a} is null or {b} is null then 0D else greatest(0D, ({share} - {chance}D) / {1 - chance}D) end")


def fingerprint_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with fingerprint (string)."""
    out = with_fingerprint(docs, "text", "fingerprint", **options)
    return out.withColumn("fingerprint", as_text(F.col("fingerprint")))


def _bucketed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """rows (doc_id, _k: 63-bit hash of the text) with _bucket, which ascends with (doc_id, _k), null first."""
    size = docs.select(F.count("*").alias("n"), F.count("doc_id").alias("known"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = int(min(MOST_BUCKETS, max(1, -(-(size["bytes"] or 0) // BUCKET_BYTES))))
    nulls = -(-(size["n"] - size["known"]) * n // max(size["n"], 1)) or 1
    at = [i / n for i in range(1, n)] or [0.5]
    cuts = docs.agg(F.coalesce(F.percentile_approx(F.col("doc_id").cast("long"), at, 20 * MOST_BUCKETS), F.array().cast("array<long>")).alias("_cuts"))
    cuts = cuts.withColumn("_ends", F.expr(f"transform(filter(sequence(1, size(_cuts) + 1), i -> i % {_BLOCK} = 0 and i <= size(_cuts)), i -> element_at(_cuts, i))"))
    out = rows.crossJoin(F.broadcast(cuts))  # one row of at most MOST_BUCKETS numbers
    for name, sign in (("_under", "<"), ("_upto", "<=")):
        block = f"size(filter(_ends, c -> c {sign} doc_id))"
        out = out.withColumn(name + "b", F.expr(block)).withColumn(name, F.expr(f"{name}b * {_BLOCK} + size(filter(slice(_cuts, {name}b * {_BLOCK} + 1, {_BLOCK}), c -> c {sign} doc_id))"))
    share = "cast(shiftright(shiftright(_k, 32) * {}, 31) as int)"
    bucket = f"case when doc_id is null then {share.format(nulls)} else {nulls} + _under + {share.format('(_upto - _under + 1)')} end"
    return out.withColumn("_bucket", F.expr(bucket)).drop("_cuts", "_ends", "_under", "_underb", "_upto", "_uptob")


def paired(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text, next_text, packed, next_packed) for each row of docs: the next document by descending doc_id, after the last one the first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.shiftrightunsigned(F.xxhash64("text"), 1)
    # Ascending order: a row's next is the one before it, and that of the first is the last one.
    ends = _bucketed(rows.select("doc_id", key.alias("_k")), docs).groupBy("_bucket").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_k")).alias("_last"))
    order = Window.orderBy("_bucket")  # at most 2 * MOST_BUCKETS rows
    first = F.min("_bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select(F.col("_bucket").alias("_of"), "_last", F.coalesce(F.lead("_bucket").over(order), first).alias("_to"))
    once = with_fingerprint(rows.groupBy("doc_id", "text").agg(F.count("*").alias("_n")), "text", "packed", **options).withColumn("_k", key)
    dealt = _bucketed(once, docs).join(F.broadcast(ends), F.col("_bucket") == F.col("_of"))
    own, guest = F.struct(F.col("_bucket").alias("b"), F.lit(1).alias("o")), F.struct(F.col("_to").alias("b"), F.lit(0).alias("o"))
    is_last = F.col("doc_id").eqNullSafe(F.col("_last.doc_id")) & (F.col("_k") == F.col("_last._k"))
    dealt = dealt.withColumn("_at", F.explode(F.when(is_last, F.array(own, guest)).otherwise(F.array(own)))).drop("_last", "_of", "_to", "_bucket")
    dealt = dealt.withColumns({"_b": F.col("_at.b"), "_o": F.col("_at.o")}).drop("_at")
    before = Window.partitionBy("_b").orderBy("_o", F.col("doc_id").asc_nulls_first(), "_k", "text")
    out = dealt.withColumn("next_text", F.lag("text").over(before)).withColumn("next_packed", F.lag("packed").over(before)).where("_o = 1")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select("doc_id", "text", "next_text", "packed", "next_packed")


def edited_documents(docs: DataFrame, **options) -> DataFrame:
    """paired, with n_chars, edited (the last third of the characters replaced by as many of the next text's first, or all) and its edited_packed."""
    out = paired(docs, **options).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)), substring(next_text, 1, cast(n_chars div 3 as int)))")
    return with_fingerprint(out.withColumn("edited", edited), "edited", "edited_packed", **options)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = edited_documents(shared.documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), as_text(F.col("packed")).alias("fingerprint"), as_text(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness("packed", "edited_packed").alias("near_edited"), likeness("packed", "next_packed").alias("near_next"),
    )


QUERIES = {"op11_fingerprints": op11_fingerprints}
ORACLES: dict[str, str] = {}
