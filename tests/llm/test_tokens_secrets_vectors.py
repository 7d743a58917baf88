"""BPE, packed tokens, secrets and top-k."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chunkwright.llm import impact_topk, pair_index_bpe, secret_forest, token_pack

from .odd import documents, empty, rows

ODD = ["", " ", "Hello  WORLD's it'll 123 4<|endoftext|>x<|startoftext|> y", "İstanbul ΣΑΣ Ⅷ é a b\x1cq \x85z", "aaaaaaaaaaaaaaaa thethethe", "日本語 한국어 ñandú ½ ²x", "<|endoftext", "à ̀b ﬁ", "😀😀!!??"]
ODD += ["  a  b ", "x\n\n\ny \n z\t", "a\n b\n\nc \t d", "x \x1cb c", "tail ", "  a ​ b", "one, two. three,four.\nFive\nsix, \nseven", "end.\n", "a.\nb,\nc", "<|endoftext|> a<|endoftext|>, b", "　x 　 y", "9, 8. é, ß.\nÉ"]


@pytest.fixture(scope="module")
def bpe():
    return pair_index_bpe.PairIndexBpe(pair_index_bpe.vocabulary_path())


@pytest.fixture(scope="module")
def runs():
    return token_pack.RunEncoder(token_pack.vocabulary_path())


def same_as_library(bpe, texts):
    for t, ids in zip(texts, bpe.encode([t.encode() for t in texts]), strict=True):
        want = bpe.lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert bpe.decode(ids) == bpe.lib.decode(want, skip_special_tokens=False)


def test_bpe_tables(bpe, spark, sf):
    same_as_library(bpe, ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abcdefgh thein'.,\n\t0123ÀéΣσςİ́<|>"), st.characters(blacklist_categories=["Cs"])), max_size=40), max_size=4))
def test_bpe_any_text(bpe, texts):
    same_as_library(bpe, texts)


def test_lower_rank_goes_first(tmp_path):
    """th+e and t+he make the same token, so a merge can bring up a pair of lower rank."""
    chars = pair_index_bpe._byte_chars()
    vocab = {c: i for i, c in enumerate(chars)} | {c + "</w>": 256 + i for i, c in enumerate(chars)}
    merges = [("a", "b"), ("ab", "c"), ("abc", "x"), ("b", "c"), ("a", "bc"), ("abc", "abc")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    import json

    base = json.load(open(pair_index_bpe.vocabulary_path()))
    base["model"] |= {"vocab": vocab, "merges": [list(m) for m in merges[1:3] + merges[3:] + merges[:1]]}
    base["added_tokens"] = [{**t, "id": len(vocab) + i} for i, t in enumerate(base["added_tokens"])]
    path = tmp_path / "t.json"
    path.write_text(json.dumps(base))
    own = pair_index_bpe.PairIndexBpe(str(path))
    same_as_library(own, ["abcx", "abcabcx", "abcabcabc", "xabcx abcxabc bcabcx", "abababcxabcx"])


def test_bpe_odd(spark, bpe):
    df = documents(spark)
    got = pair_index_bpe.encode_documents(df, pair_index_bpe.vocabulary_path(), keep_ids=True).collect()
    assert len(got) == df.count()
    ids = bpe.encode([(r[1] or "").encode() for r in rows()])
    want = sorted((str(r[0]), hashlib.sha256(x).hexdigest(), hashlib.sha256(bpe.decode(x).encode()).hexdigest()) for r, x in zip(rows(), ids, strict=True))
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert pair_index_bpe.encode_documents(empty(spark), pair_index_bpe.vocabulary_path()).count() == 0


def byte_level(runs, texts):
    for t, ids in zip(texts, runs.encode(texts), strict=True):
        assert ids.tolist() == runs.lib.encode(t, add_special_tokens=False).ids


def test_runs_tables(runs, spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    byte_level(runs, ODD + texts)
    byte_level(runs, ODD[::-1])  # what is known already changes nothing


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab thein'.,\n\t 01 Àé　\x1c"), st.characters(blacklist_categories=["Cs"])), max_size=40), min_size=1, max_size=4))
def test_runs_any_text(runs, texts):
    byte_level(runs, texts)


def test_full_memory_changes_nothing(runs, monkeypatch):
    monkeypatch.setattr(token_pack, "REMEMBERED", 5)
    for _ in range(3):
        byte_level(runs, ODD)


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17, 20, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 3001)
    data = token_pack.pack(ids, bits)
    assert len(data) == -(-3001 * bits // 8)
    for s, e in ((0, 3001), (77, 1501), (5, 5), (3000, 3001)):
        assert (token_pack.unpack(data, bits, s, e) == ids[s:e]).all()
    assert token_pack.bits_for(50257) == 16 and token_pack.bits_for(65537) == 17


def test_random_access():
    docs = [np.arange(n, dtype=np.uint32) * 7 % 50_000 for n in (3, 0, 41, 1)]
    block = token_pack.Block(token_pack.make_block([9, 8, -7, 6], docs, 16))
    assert [block.document(k).tolist() for k in (2, 0, 3, 1)] == [docs[k].tolist() for k in (2, 0, 3, 1)]
    assert block.doc_ids.tolist() == [9, 8, -7, 6]
    with pytest.raises(ValueError):
        token_pack.Block(b"nope" + bytes(40))


@pytest.mark.parametrize("block_ids", [50, 1 << 20])
def test_packed_files(spark, sf, runs, block_ids):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = token_pack.read_documents(token_pack.write_packed(docs, token_pack.vocabulary_path(), 2, block_ids, 100_000)).orderBy("doc_id").collect()
    start = 0
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    assert len(got) == len(texts)
    for r, (i, t) in zip(got, texts, strict=True):
        ids = np.append(runs.encode([t])[0], np.uint32(2)).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_packed_odd(spark):
    got = token_pack.read_documents(token_pack.write_packed(documents(spark), token_pack.vocabulary_path(), 2)).orderBy("start").collect()
    assert len(got) == len(rows()) and got[0].doc_id is None
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert {r.n_tokens for r in got if r.doc_id in (4, 5)} == {1}
    assert token_pack.read_documents(token_pack.write_packed(empty(spark), token_pack.vocabulary_path(), 2)).count() == 0


def test_fetch_by_id(spark, runs):
    least = -(1 << 63)
    docs = spark.createDataFrame([(least, "a b"), (None, "c d e"), (None, ""), (7, "x"), (7, "yy zz"), (9, None)], "doc_id long, text string")
    blocks = token_pack.write_packed(docs, token_pack.vocabulary_path(), 2, block_ids=3, part_bytes=4)
    got = token_pack.read_documents(blocks).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, least, 7, 7, 9]
    ids = lambda t: [*runs.encode([t])[0].tolist(), 2]
    assert sorted(x.tolist() for x in token_pack.fetch(blocks, 7)) == sorted([ids("x"), ids("yy zz")])
    assert [x.tolist() for x in token_pack.fetch(blocks, least)] == [ids("a b")]
    assert [x.tolist() for x in token_pack.fetch(blocks, 9)] == [[2]] and token_pack.fetch(blocks, 8) == []


def secret_texts():
    """(doc_id, text, value, is a secret), of forms that the planted findings don't have."""
    import random

    rng = random.Random(2)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    out = []
    for i in range(400):
        kind = i % 6
        if kind == 0:
            v, t = hexes(48), 'words here client_secret = "{}" and more words'
        elif kind == 1:
            v, t = "ASIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), "the key was {} as said"
        elif kind == 2:
            v, t = "-".join(hexes(8) for _ in range(4)), "Authorization: Bearer {} and so on"
        elif kind == 3:
            v, t = str(rng.randint(10**15, 10**16 - 1)), "card {} was used"
        elif kind == 4:
            v, t = f"{rng.choice(['release', 'version'])}-notes-{rng.randint(10, 99)}-final", "see https://host/path/{} for it"
        else:
            v, t = f"{rng.choice(['chapter', 'section'])}_number_{rng.randint(1, 99)}_of_the_book", "in {} we say"
        out.append((i, t.format(v), v, kind < 3))
    return out


def test_secrets(spark, sf):
    """The forest is fitted on planted findings only and judges forms that these don't have."""
    made = secret_texts()
    rows_ = spark.createDataFrame([x[:2] for x in made], "doc_id long, text string")
    triples = secret_forest.letter_triples(spark.read.parquet(f"{sf}/documents.parquet").select("text").unionByName(rows_.select("text")))
    got = secret_forest.scored(secret_forest.with_features(secret_forest.findings(rows_), triples), secret_forest.forest(spark, triples)).select("doc_id", "value", "secret").collect()
    found = {(r.doc_id, r.value): r.secret for r in got}
    right = [any(found.get((i, x)) == want for x in (v, f"path/{v}", f"/host/path/{v}", f"//host/path/{v}")) for i, _, v, want in made]
    assert sum(right) >= 0.97 * len(made), [made[i] for i, r in enumerate(right) if not r][:5]


def test_planted_truth(spark):
    """Both labels, every form found; held out by rows, the forest knows them."""
    triples = ["the", "ing", "ent", "ion", "ter", "and", "est", "all"]
    truth = secret_forest.planted(spark, triples, 1200)
    rows_ = secret_forest.with_features(secret_forest.findings(truth), triples).join(truth.select("doc_id", "value", "label", "form"), ["doc_id", "value"]).cache()
    assert rows_.count() == 1200
    assert {(r.label, r.form) for r in rows_.select("label", "form").distinct().collect()} == {(1.0, i) for i in range(8)} | {(0.0, i) for i in range(9)}
    out = secret_forest.scored(rows_, secret_forest.forest(spark, triples)).select("label", "secret").collect()
    assert sum(r.secret == (r.label == 1) for r in out) >= 0.97 * len(out)
    # Not a rule over key words: many findings next to one are none, and many secrets have none.
    assert rows_.where("label = 0 and f_word = 1").count() > 50 and rows_.where("label = 1 and f_word = 0").count() > 50


CANDIDATES = [
    "a" * 210 + "1" + "b" * 30,
    'password = "a1b2c3d4e5" x',
    'token = "correcthorsebatterystaple"',
    "api_key: 'p@ss-w0rd!x' z",
    "abcdefghijklmnopqrstuvwxyz and aBcDeFgHiJkLmNoPqRsT",
    "short1 12345678901234567 x=1 secret=abcdefgh9, auth==zzzzzzzz",
    "a-b_c/d+e=f1" + "g" * 9 + " \n" + "1" * 16 + "\t" + "2" * 15,
    "passwords are long and secret things, token: none",
    "é1234567890abcdefghij é",
]


def test_candidates_by_brute_force(spark, sf):
    """The pattern, run by another engine."""
    import regex

    texts = CANDIDATES + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    pattern = regex.compile(secret_forest.CANDIDATE, regex.ASCII)
    name = regex.compile(secret_forest.OWN_NAME)
    want = sorted((i, n, name.sub("", m.group())) for i, t in enumerate(texts) for n, m in enumerate(pattern.finditer(t)))
    got = secret_forest.findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "number", "value").collect()
    assert sorted(tuple(r) for r in got) == want
    first = {i: [v for j, _, v in want if j == i] for i in range(len(CANDIDATES))}
    assert first[0] == [CANDIDATES[0]] and first[1] == ["a1b2c3d4e5"] and first[2] == ["correcthorsebatterystaple"] and first[3] == ["p@ss-w0rd!x"]
    assert first[4] == ["aBcDeFgHiJkLmNoPqRsT"] and first[5] == ["12345678901234567", "abcdefgh9", "zzzzzzzz"] and first[7] == []


@pytest.mark.parametrize(("text", "value"), [
    ('password    = "correcthorse"', "correcthorse"), ('secret_key = "hunter2hunter"', "hunter2hunter"), ("private_key: abcd1234efgh", "abcd1234efgh"), ('"passphrase": "abcd1234efgh"', "abcd1234efgh"),
    ("DB_PASSWORD\n\t=\n'hunter2hunter'", "hunter2hunter"), ("my.signing-key=abcdefgh", "abcdefgh"), ("Authorization: Bearer abcdefgh.ijkl", "abcdefgh.ijkl"), ("authToken:abcdefgh", "abcdefgh"), ("monkey: abcdefgh", None), ("password: short", None),
])
def test_any_identifier_and_any_space(spark, text, value):
    got = secret_forest.findings(spark.createDataFrame([(1, f"see {text} there")], "doc_id long, text string")).collect()
    assert [r.value for r in got] == ([value] if value else [])
    assert all(r.before.startswith("see ") and r.after.endswith(" there") for r in got)


def test_secrets_odd(spark):
    df = documents(spark)
    got = secret_forest.scan(df).select("doc_id", "number", "value", "secret").collect()
    assert not any(r.secret for r in got)
    one = spark.createDataFrame([(None, "password=a1b2c3d4e5f6a7b8c9 x"), (1, None), (2, ""), (3, "password=a1b2c3d4e5f6a7b8c9 x")], "doc_id long, text string")
    assert [(r.value, r.secret) for r in secret_forest.scan(one).collect()] == [("a1b2c3d4e5f6a7b8c9", True)] * 2
    assert secret_forest.scan(empty(spark)).count() == 0


def brute_top(vectors, k=5, every=50):
    out = []
    for q, v in vectors.items():
        if q % every == 0:
            scores = sorted((-int(v @ w), i) for i, w in vectors.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows_", [8192, 40])
def test_top_k(spark, monkeypatch, rows_):
    monkeypatch.setattr(impact_topk, "BLOCK_ROWS", rows_)
    rng = np.random.default_rng(4)
    raw = {i: rng.normal(0, 0.2, 12).astype(np.float32) for i in range(0, 600)}
    for i in range(100, 160):
        raw[i] = raw[50]  # ties
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in raw.items()], "vec_id long, embedding array<float>")
    want = brute_top({i: np.floor(256 * v.astype(float)).astype(np.int64) for i, v in raw.items()})
    assert sorted(tuple(r) for r in impact_topk.top_k(df).collect()) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 9), st.integers(0, 10**6), st.sampled_from([3, 200, 5000]))
def test_nothing_possible_is_lost(n, k, seed, span):
    rng = np.random.default_rng(seed)
    rows_, q = rng.integers(-span, span, (n, 6)), rng.integers(-span, span, 6)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(impact_topk, "CHECK_EVERY", 3)
        m.setattr(impact_topk, "RESCORED", 0)
        found, score = impact_topk.ImpactIndex(rows_, 8).best(q, np.arange(n), k)
    order = np.lexsort((np.arange(n), -(rows_ @ q)))[:k]
    assert found.tolist() == order.tolist() and score.tolist() == (rows_ @ q)[order].tolist()


def test_fewer_rows_are_rescored_than_there_are(spark, sf):
    """At 500 rows, and whatever the vectors: the proof leaves a part of them."""
    raw = np.random.default_rng(6).normal(0, 0.2, (500, 64))
    index = impact_topk.ImpactIndex(np.floor(256 * raw).astype(np.int64))
    left = [len(index.possible(index.rows[q], 6)) for q in range(0, 500, 50)]
    assert max(left) < 500 and np.mean(left) < 350


def test_repeated_ids_are_rows(spark):
    data = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (7, [0.5, 0.0]), (7, [0.5, 0.0]), (7, [0.25, 0.0]), (8, [0.125, 1.0])]
    got = [tuple(r) for r in impact_topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<float>")).orderBy("rank").collect()]
    assert got == [(50, 1, 7, 32768), (50, 2, 7, 32768), (50, 3, 7, 16384), (50, 4, 8, 8192)]


def test_top_k_odd(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.5], "x"), (0, [1.0, 0.5], "x"), (1, [0.5], "x"), (2, None, "x"), (3, [1.0, None], "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"), (None, [1.0, 1.0], "x"), (6, [], "x"), (50, [0.25, 0.25], "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string")
    got = sorted(tuple(r) for r in impact_topk.top_k(df).collect())
    vectors = {0: np.array([256, 128]), 1: np.array([128, 0]), 6: np.array([0, 0]), 50: np.array([64, 64])}
    # The row with id 0 stands there twice: one query, and two candidates for another query.
    assert got == [r for r in brute_top(vectors) if r[0] == 0] + [(50, 1, 0, 24576), (50, 2, 0, 24576), (50, 3, 1, 8192), (50, 4, 6, 0)]
    assert impact_topk.top_k(df.limit(0)).count() == 0


def test_bpe_forgets(bpe):
    """Runs and pieces that go from memory, stay in the old generation or come back have the same ids."""
    own = pair_index_bpe.PairIndexBpe(pair_index_bpe.vocabulary_path())
    own.runs, own.pieces = pair_index_bpe.Remembered(6), pair_index_bpe.Remembered(4)
    words = "the cat's end.of 12ab <|endoftext|>x naïve Σας the, cats don't".split()
    for i in range(60):
        same_as_library(own, [" ".join(words[(i * k) % len(words)] for k in range(1, 4)), words[i % 3]])
        assert len(own.runs.young) <= 3 + 4
    same_as_library(own, ODD)


def test_no_python_in_secret_scans(spark, sf):
    plan = secret_forest.op7_secret_forest(spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))
