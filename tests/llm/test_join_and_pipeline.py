"""Shingle join, components and the pipeline."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chunkwright.llm import shingle_join
from chunkwright.llm.components import components

from .odd import documents, empty, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 4 else frozenset(zip(w, w[1:], w[2:], w[3:], strict=False))


def brute(docs):
    sets, up = [shingles(t) for _, t in docs], list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(sets[i]), low.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def got(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.shingle_components(df, **options).collect()), key=str)


def families(seed, n=350):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(50)]
    first = [[rng.choice(words) for _ in range(rng.randint(1, 150))] for _ in range(9)]
    out = []
    for i in range(n):
        w = list(rng.choice(first))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append((i, rng.choice([" ", "\n", "\t "]).join(w).upper() if i % 3 else " ".join(w)))
    return out


@pytest.mark.parametrize("options", [{"block_bytes": 20_000}, {"group_rows": 30}])
def test_components(spark, options):
    docs = families(3)
    assert got(spark.createDataFrame(docs, "doc_id long, text string"), **options) == brute(docs)


def test_components_of_the_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert got(df) == brute([tuple(r) for r in df.collect()])


def test_join_odd(spark):
    docs = [r[:2] for r in rows()]
    assert got(documents(spark)) == brute(docs)
    assert got(empty(spark)) == []
    kept = shingle_join.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(["None", "None", "1", "4", "5", "6", "7", "9", "10", "20", "21"])


def test_long_words():
    a = shingle_join.shingle_set(b"x" * 5000 + b" b c d e")
    assert len(a) == 2 and len(shingle_join.shingle_set(b"x" * 5001 + b" b c d e")) == 2
    assert set(a) != set(shingle_join.shingle_set(b"x" * 5001 + b" b c d e"))


def test_words_that_fool_polynomials(spark):
    """A Thue-Morse word and its complement have the same polynomial hash modulo 2**64."""
    w = "".join("ab"[i.bit_count() & 1] for i in range(1 << 11))
    a, b = (shingle_join.shingle_set(x.encode()) for x in (f"{w} x y z", f"{w.translate(str.maketrans('ab', 'ba'))} x y z"))
    assert len(a) == len(b) == 1 and a[0] != b[0]
    docs = [(1, w), (2, w.translate(str.maketrans("ab", "ba"))), (3, w.upper())]
    assert got(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_small_and_large_sets(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(4000)]
    big = [rng.choice(words) for _ in range(6000)]
    docs = [(i, " ".join(big[: 6000 - 180 * i])) for i in range(12)] + [(100 + i, " ".join(big[i : i + 3 + i % 5])) for i in range(60)] + [(200 + i, "one two three") for i in range(40)]
    assert got(spark.createDataFrame(docs, "doc_id long, text string"), block_bytes=50_000) == brute(docs)


def test_trees_find_what_pairs_find():
    docs = families(11, 160)
    sets = [shingle_join.shingle_set(t.encode()) for _, t in docs]
    parts, found = shingle_join.Parts(len(sets)), []
    shingle_join.SignatureTree(list(range(len(sets))), sets).join(sets, parts, 85, found)
    want = shingle_join.Parts(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if shingle_join.linked(sets[i], sets[j], 85):
                want.join(i, j)
    groups = lambda p: sorted(tuple(i for i in range(len(sets)) if p.root(i) == r) for r in {p.root(i) for i in range(len(sets))})
    assert groups(parts) == groups(want)
    assert len(found) == len(sets) - len(groups(parts))  # a path, not all pairs
    assert all(shingle_join.linked(sets[i], sets[j], 85) for i, j in found)


def test_long_chains(spark):
    n = 60
    links = [(i, i + 1) for i in range(n)] + [(100, 101), (7, 7), (200, 199), (199, 200)]
    got_ = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got_ == {i: 0 for i in range(1, n + 1)} | {101: 100, 200: 199}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stages_take_odd_rows(spark):
    df = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, "")
        assert out.count() <= df.count()
        if name != "pair_index_bpe":
            assert out.columns == df.columns
        assert stage(spark, empty(spark), "").count() == 0


def test_pipeline_is_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, sf)
    from chunkwright.llm import quality_rules

    good = {r.doc_id for r in quality_rules.quality_scores(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good
    fewer = corpus_pipeline.lines(spark, kept, sf)
    texts = [(r.doc_id, r.text) for r in fewer.collect()]
    # Rows that lose all their words go; a copy of a whole text is one of them.
    from chunkwright.llm import line_dedup

    before, after = ({r.doc_id: r.text for r in x.collect()} for x in (kept, line_dedup.dedup_lines(kept, whole_runs=True)))
    assert dict(texts) == {i: t for i, t in after.items() if t == before[i] or t.strip(" \t\n\v\f\r")}
    assert set(after) == good and all(texts) and len(texts) < len(good)
    one = {d for d, _, c in brute(texts) if d == c}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, fewer, sf).collect()} == one
    final = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in final.collect()} == one and len(corpus_pipeline.STAGES) == 5
    assert final.where(F.size("ids") != F.col("n_tokens")).isEmpty()
    # The order of the mix shows: slots by the operator, places by the files that the last stage read.
    from chunkwright.llm import source_mix

    near = corpus_pipeline.near_duplicates(spark, fewer, sf)
    slots = {r.doc_id: (r.mix_slot, r.mix_place) for r in source_mix.mix(near).collect()}
    in_order = [slots[r.doc_id] for r in final.orderBy("mix_part", "mix_row").collect()]
    assert in_order == sorted(in_order) and final.where("mix_part is null").isEmpty()


def test_near_duplicates_at_80_percent(spark):
    words = [f"w{i}" for i in range(120)]
    docs = spark.createDataFrame([(1, " ".join(words[:100])), (2, " ".join(words)), (3, " ".join([*words[:100], *(f"x{i}" for i in range(30))]))], "doc_id long, text string")
    # Five words: 96 of 116 shingles link 1 and 2, 96 of 126 don't link 1 and 3.
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 3]
    assert shingle_join.keep_one(docs).count() == 3  # four words, 85 %


def test_rows_of_one_id_go_alone(spark):
    """The near copy goes, and not the only copy of another text that has its doc_id."""
    w = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, w), (5, w), (5, "another text that stands nowhere else"), (None, w), (5, None)], "doc_id long, text string").withColumns({c: F.lit("own") for c in ("k1", "_gone")})
    got = sorted(((r.doc_id, r.text) for r in shingle_join.keep_one(docs).collect()), key=str)
    want = [(1, w), (5, "another text that stands nowhere else"), (5, None), (None, w)]
    assert got == sorted(want, key=str) or got == sorted([r for r in want if r != (1, w)] + [(1, w)], key=str)


def test_line_dedup_loses_no_text_of_its_own(spark):
    """Two texts with one long header: what stands below it stays, however short."""
    header = "a header of words that is long\nand has a second line of many more words than what follows it has"
    docs = spark.createDataFrame([(1, f"{header}\nown text one"), (2, f"{header}\nown"), (3, header), (4, ""), (5, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {1: f"{header}\nown text one", 2: "own", 4: "", 5: None}
