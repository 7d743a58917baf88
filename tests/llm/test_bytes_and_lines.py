"""Suffix-array dedup and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from chunkwright.llm import line_dedup, suffix_dedup

from .odd import CLASHING, documents, empty, rows


def brute_bytes(docs, length=50):
    first = {}
    for i, t in docs:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = True
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def got_bytes(df, **options):
    out = suffix_dedup.dedup_bytes(df, **options)
    return sorted((suffix_dedup.NULL_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())


def pieced(seed, n=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    texts = ["".join(x[rng.randint(0, len(x) // 2) :] for x in rng.sample(base, rng.randint(0, 3))) + "z" * rng.choice([0, 30, 49, 50, 51, 120]) + "\0" * rng.choice([0, 60]) for _ in range(n)]
    return [(rng.randint(0, 90), t) for t in texts]


@pytest.mark.parametrize("options", [{"block_bytes": 3000}, {"block_bytes": 7000, "wide": 10}, {"block_bytes": 1 << 20, "wide": 2}, {"block_bytes": 5000, "length": 24}])
def test_bytes(spark, options):
    docs = pieced(3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got_bytes(df, **options) == brute_bytes([(i, t.encode()) for i, t in docs], options.get("length", 50))


def test_bytes_odd(spark):
    want = brute_bytes([(suffix_dedup.NULL_ID if r[0] is None else r[0], (r[1] or "").encode()) for r in rows() if r[0] != 6] + [(6, next(r[1] for r in rows() if r[0] == 6).encode()[:30_000])])
    df = documents(spark).selectExpr("doc_id", "case when doc_id = 6 then substr(text, 1, 30000) else text end as text", "block", "bucket")
    assert got_bytes(df, block_bytes=20_000) == want
    assert got_bytes(empty(spark)) == []
    long = {r.doc_id: r for r in suffix_dedup.dedup_bytes(documents(spark)).collect()}[6]
    assert long.n_bytes > 1_000_000 and long.n_removed == 0  # what repeats within a text stays


def test_kept_bytes_are_the_rest(spark):
    df = spark.createDataFrame([(1, "x" * 10 + PASSAGE + "y"), (2, "some words " + PASSAGE + " more")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup_bytes(df).collect()} == {1: ("x" * 10 + PASSAGE + "y").encode(), 2: b"some words  more"}


PASSAGE = "It was a bright cold day in spring, and none of the clocks agreed on the hour."


def brute_lines(spark, df):
    """The chunks of the operator, then a loop in doc_id order with whole texts as keys."""
    chunked = line_dedup._chunked(line_dedup._keyed(df.select("doc_id", "text")), line_dedup.WINDOW, line_dedup.EVERY).select("doc_id", "text", "_k1", "_k2", "_chunks").collect()
    seen, out = {}, []
    for r in sorted(chunked, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r._k1, r._k2)):
        if r.text is None:
            out.append((r.doc_id, None))
            continue
        lines, kept = r.text.split("\n"), []
        assert sum(c & 0x7FFFFFFF for c in r._chunks) == len(lines)
        for c in r._chunks:
            part = lines[c >> 32 : (c >> 32) + (c & 0x7FFFFFFF)]
            if len(part) > 1 and sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in part) > 1:
                place = (r._k1, r._k2, c)
                if seen.setdefault("\n".join(part), place) != place:
                    continue
            kept.append("\n".join(part))
        out.append((r.doc_id, "\n".join(kept)))
    return sorted(out, key=str)


def test_lines(spark):
    rng = random.Random(1)
    lines = [f"line number {i} with words" for i in range(40)] + ["", " ", "same"]
    texts = []
    for i in range(150):
        at = rng.randint(0, 30)
        texts.append((i, "\n".join(lines[at : at + rng.randint(0, 12)] + [rng.choice(lines) for _ in range(rng.randint(0, 6))]), "en", "s", 0))
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    got = line_dedup.dedup_lines(df)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute_lines(spark, df)
    assert sum(len(r.text) for r in got.collect()) < sum(len(t[1]) for t in texts)
    assert got.where("n_chars <> length(text)").isEmpty()


def test_lines_odd(spark):
    df = documents(spark)
    got = line_dedup.dedup_lines(df)
    assert got.columns == df.columns and got.count() == df.count()
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute_lines(spark, df)
    assert got.select(*CLASHING).distinct().count() == 1
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_borders_resist_shifts(spark):
    lines = [f"line {i} has some words in it" for i in range(60)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["a new first line", *lines]))], "doc_id long, text string")
    kept = {r.doc_id: len(r.text.split("\n")) for r in line_dedup.dedup_lines(df).collect()}
    assert kept[1] == 60 and kept[2] < 40


WORDED = re.compile(r"[^\x20\x09-\x0D]")


def brute_runs(docs):
    """Numbers of the lines that lie in a run of two or more lines with words, with blank ones between, which an earlier place has."""
    seen, out = set(), {}
    for i, t in docs:
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if WORDED.search(x)]
        lost = set()
        for a, b in zip(at, at[1:], strict=False):
            run = "\n".join(lines[a : b + 1])
            if run in seen:
                lost |= set(range(a, b + 1))
            seen.add(run)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in lost)
    return out


def passages(seed, n=120):
    """Each text has lines of its own around one to three passages, of two to five lines of 25 words each, that others have too."""
    rng = random.Random(seed)
    line = lambda tag: " ".join(f"{tag}{rng.randint(0, 10**9)}" for _ in range(25))
    shared_ = [[line("p") if k % 3 != 2 else "" for k in range(rng.randint(2, 5))] for _ in range(25)]
    texts = []
    for i in range(n):
        parts = [line("own") for _ in range(rng.randint(0, 3))]
        for p in rng.sample(shared_, rng.randint(1, 3)):
            parts += [*p, line("own")]
        texts.append((i, "\n".join(parts)))
    return texts


def test_whole_runs_go(spark):
    docs = passages(5)
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), whole_runs=True)
    assert {r.doc_id: r.text for r in got.collect()} == brute_runs(docs)


def test_whole_runs_of_the_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id is not null and text is not null").dropDuplicates(["doc_id"]).localCheckpoint()
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, whole_runs=True).collect()}
    assert got == brute_runs(sorted(tuple(r) for r in df.collect()))


def test_whole_runs_odd(spark):
    df = documents(spark)
    out = line_dedup.remove_repeats(df, whole_runs=True)
    got = {r.doc_id: r for r in out.where("doc_id is not null").collect()}
    assert out.count() == df.count() and out.select(*CLASHING).distinct().count() == 1
    assert got[7].text.count("\n") == 2 and (got[8].text, got[8]._n_lines, got[8]._n_removed) == ("an end", 4, 3)
    assert got[4].text is None and got[5].text == "" and got[9].text == " \t\n" and got[6]._n_removed == 0
    assert line_dedup.remove_repeats(empty(spark), whole_runs=True).count() == 0


def test_rows_that_keep_little_go(spark):
    text = "one line with words\nand another one\nand a third"
    docs = [(1, text), (2, text), (3, text + "\nthis one has more to say than the first three lines do together, by far"), (4, text + "\nshort"), (5, ""), (6, None), (7, "alone")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, 0.5, whole_runs=True).collect()}
    assert got == {1: text, 3: docs[2][1].rsplit("\n", 1)[1], 5: "", 6: None, 7: "alone"}
    assert line_dedup.dedup_lines(df, whole_runs=True).count() == 7
