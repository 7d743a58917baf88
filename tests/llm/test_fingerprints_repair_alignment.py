"""Fingerprints, conversation repair and token alignment against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from chunkwright.llm import conversation_repair, fingerprints, token_alignment
from tests.llm import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_documents(spark, sf):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.op11_fingerprints(spark, sf).collect()}
    assert len(got) == len(docs)
    errors, seen = [], {}
    for k, (doc_id, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        third = len(text) // 3
        edited, r = text[: len(text) - third] + after[:third], got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint and len(r.fingerprint) in (0, 256)
        errors.append(r.near_edited - jaccard(shingles(text), shingles(edited)))
        assert 0 <= r.near_next <= 1 and abs(r.near_next - jaccard(shingles(text), shingles(after))) < 0.2
    assert max(map(abs, errors)) < 0.2 and abs(sum(errors) / len(errors)) < 0.02


@pytest.mark.parametrize(("bins", "bits"), [(256, 4), (128, 8), (512, 1), (64, 16)])
def test_likeness_is_the_jaccard_similarity(spark, bins, bits):
    """Short texts, whose bins are mostly copies, and long ones."""
    rng, rows = random.Random(bins), []
    for i, (n, own) in enumerate([(3, 0), (3, 3), (8, 2), (12, 6), (60, 10), (60, 30), (900, 100), (900, 450), (2000, 2000)]):
        both = [f"w{rng.randrange(10**9)}" for _ in range(n - own)]
        a, b = (both + [f"{x}{rng.randrange(10**9)}" for _ in range(own)] for x in "ab")
        rows.append((i, " ".join(a), " \n".join(b)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "fa", bins=bins, bits=bits), "b", "fb", bins=bins, bits=bits)
    got = df.select("a", "b", F.size("fa").alias("n"), fingerprints.likeness("fa", "fb", bits).alias("x")).collect()
    for r in got:
        want = jaccard(shingles(r.a), shingles(r.b))
        assert r.n == bins * bits // 64 and abs(r.x - want) < 4.5 * (0.6 / bins) ** 0.5 * (2 if bits == 1 else 1)
        assert want < 1 or r.x == 1


def test_fingerprints_of_odd_rows(spark):
    docs = odd.documents(spark)
    got = fingerprints.fingerprint_documents(docs.withColumn("fingerprint", F.lit("own")))
    assert sorted(got.columns) == sorted([*docs.columns, "fingerprint"]) and got.count() == docs.count()
    by_text = {}
    for r in got.select("text", "fingerprint").collect():
        assert by_text.setdefault(r.text or "", r.fingerprint) == r.fingerprint
        assert bool(r.fingerprint) == bool(WORD.search(r.text or ""))
    assert fingerprints.fingerprint_documents(odd.empty(spark)).count() == 0


def test_neighbours_of_odd_rows(spark, monkeypatch):
    """Ids that are null or repeat, and so many buckets that one doc_id fills several."""
    monkeypatch.setattr(fingerprints, "BUCKET_BYTES", 1)
    rows = [(None, f"n{i}") for i in range(40)] + [(7, f"s{i}") for i in range(60)] + [(i, f"t{i}") for i in range(8, 40)] + [(3, None), (3, ""), (9, "t9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("packed", F.lit(1))
    got = fingerprints.paired(docs).select("doc_id", "text", "next_text").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t or "") for i, t in rows)
    after = {}
    for r in got:
        assert after.setdefault((r.doc_id, r.text), r.next_text) == r.next_text  # repeated rows have the same next
    texts, own = {(i, t or "") for i, t in rows}, {}
    for i, t in texts:
        own.setdefault(t, set()).add(i)
    seen, at = [], max((i, t) for i, t in texts if i is not None)
    for _ in texts:  # one ring through all rows, ids descending, null last
        seen.append(at)
        candidates = own[after[at]]
        at = next((i, after[at]) for i in candidates)
    ids = [-1 if i is None else i for i, _ in seen]
    assert len(set(seen)) == len(texts)
    turn = ids.index(max(ids))
    assert ids[turn:] + ids[:turn] == sorted(ids, reverse=True)
    assert [tuple(r) for r in fingerprints.paired(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).select("text", "next_text").collect()] == [("a b", "a b")]
    assert fingerprints.edited_documents(odd.empty(spark)).count() == 0


def test_no_python_in_fingerprints(spark, sf):
    plan = fingerprints.op11_fingerprints(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


FOLLOWS, NAME = {0: 2, 1: 2, 3: 2, 2: 3}, {2: "user", 3: "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def repaired(rows):
    """Every choice of edits of one conversation, with up to two inserts at a place."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, q, inserts):
        found = [(0, "", ())] if i == len(rows) and q in (0, 3) else []
        add = lambda x, cost, edit, row: x and found.append((x[0] + cost, edit + x[1], row + x[2]))
        to = FOLLOWS[q]
        if inserts < 2:
            add(best(i, to, inserts + 1), 5, "I", ((NAME[to], ""),))
        if i < len(rows):
            _, _, role, text = rows[i]
            add(best(i + 1, q, 0), 2, "D", ())
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if role[:1] == "s" and q == 0:
                    add(best(i + 1, 1, 0), more, "K", ((role, text),))
                if role[:1] == NAME[to][0]:
                    add(best(i + 1, to, 0), more, "K", ((role, text),))
                add(best(i + 1, to, 0), 1 + more, "R", ((NAME[to], text),))
        return min(found, default=None)

    cost, audit, out = best(0, 0, 0)
    turns, initials = [t for _, t, _, _ in rows if t is not None], [r[:1] for _, _, r, _ in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def check_conversations(got, rows):
    found = {c: [] for c, *_ in rows}
    for r in damage(rows):
        found[r[0]].append(r)
    want = {c: repaired(sorted(v, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))) for c, v in found.items()}
    assert {r.conv_id: tuple(r[n] for n in "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()) for r in got} == want
    assert len(got) == len(want)


def test_conversations_of_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check_conversations(conversation_repair.op12_conversation_repair(spark, sf).collect(), rows)


@pytest.mark.parametrize(("segment", "unrolled"), [(256, 64), (2, 2)])
def test_conversations_with_odd_rows(spark, segment, unrolled):
    """Nulls everywhere, equal turns, repeated rows, other roles; segments of two rows and runs that are halved."""
    rng, rows = random.Random(segment), []
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", None], ["a.", "b", "c!", "", " \n", "d? ", "e. x", None, "q."]
    for conv in range(200):
        for turn in range(rng.choice([1, 2, 5, 9, 14])):
            rows.append((conv or None, rng.choice([None, turn, turn, turn]), rng.choice(roles), rng.choice(texts)))
    rows += [(1000, t, "user", f"alone {t}.") for t in range(150)] + [(1001, 5, "user", "same.")] * 30 + [(1002, t, "assistant", "no end") for t in range(9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("own") for c in ("n", "blank", "first", "kind", "part", "audit")})
    check_conversations(conversation_repair.repair_conversations(conversation_repair.damaged(df), segment, unrolled).collect(), rows)
    assert conversation_repair.repair_conversations(conversation_repair.damaged(df.limit(0))).count() == 0


def test_long_runs_by_powers():
    """A run of a million costs what the same rows one by one do."""
    repair = conversation_repair.Repair()
    for symbol in conversation_repair.SYMBOLS.values():
        one = repair.END
        for _ in range(1000):
            one = repair.before(symbol, 1, one)
        assert repair.before(symbol, 1000, repair.END) == one
    runs = conversation_repair.Runs()
    runs.add(conversation_repair.SYMBOLS[("u", 0)], 1_000_001)
    cost, audit, ends = conversation_repair.best_edits(runs, repair)
    assert (cost, audit, ends.tolist()) == (1_000_001 // 2 + 2, "D" + "KR" * 500_000, [1_000_001])


def test_many_runs():
    """Costs between marks are worked out again."""
    rng, repair, runs, own = random.Random(4), conversation_repair.Repair(), conversation_repair.Runs(), []
    for i in range(3000):
        own.append(rng.choice([k for k in conversation_repair.SYMBOLS.values() if not own or k != own[-1]]))
        runs.add(own[-1], rng.choice([1, 1, 2, 5]))
    cost, audit, ends = conversation_repair.best_edits(runs, repair)
    assert len(ends) == 3000 and len(audit) - audit.count("I") == sum(runs.counts)
    cut = {k for (i, k) in conversation_repair.SYMBOLS.items() if i[1:] == (1,)}
    rows = [(k in cut) for k, n in zip(runs.symbols, runs.counts, strict=True) for _ in range(n)]
    price = {"K": 0, "R": 1, "D": 2}
    done = [e for e in audit if e != "I"]
    assert cost == sum(price[e] + 5 * (c and e != "D") for e, c in zip(done, rows, strict=True)) + 5 * audit.count("I")


def aligned(docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    chars = token_alignment._byte_level()
    rows, total = [], Counter()
    for doc_id, text in docs:
        a, b = (a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text, num_threads=1)) if text else ([], [])
        a_raw = [bytes(chars[c] for c in a_lib.id_to_token(i)) for i in a]
        b_raw = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b_lib.id_to_piece, b)]
        if not text or not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
            rows.append((doc_id, 0, 0, [], []))
            continue
        spans = []
        for raw in (a_raw, b_raw):
            ends = list(accumulate(map(len, raw)))
            spans.append(list(zip([0, *ends[:-1]], ends, strict=True)))
        links, j0 = [], 0
        for i, (s, e) in zip(a, spans[0], strict=True):
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(b) and spans[1][j][0] < e:
                links.append((i, b[j]))
                j += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for lo, hi in zip([0, *ends[:-1]], ends, strict=True):
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, span, strict=True) if lo <= s and e <= hi) for ids, span in ((a, spans[0]), (b, spans[1]))) if len(a) < 2000 else "")
        total.update(links)
        rows.append((doc_id, len(a), len(b), groups, links))
    best = {}
    for (_, b), n in total.items():
        best[b] = max(n, best.get(b, 0))
    return [(d, a, b, len(g), len(k), sum(total[x] == best[x[1]] for x in k), sum(total[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if a and a < 2000 else None if a else "") for d, a, b, g, k in rows]


def check_alignment(df, docs):
    got = sorted((tuple(r[n] for n in "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()) for r in df.collect()), key=repr)
    want = sorted(aligned(docs), key=repr)
    assert [g if w[-1] is not None else (*g[:-1], None) for g, w in zip(got, want, strict=True)] == want


def test_alignment_of_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check_alignment(token_alignment.op13_token_alignment(spark, sf), docs)


TEXTS = ["", None, " ", "  ", "a ", " a", "a  b", "x\n\ny \t z", "a b c", "日本語 テキスト", "▁ x", "<s> </s> <|endoftext|> <0x41>", "é" * 50 + " " + "é", "a　 b", "\U0001f642 \U0001f642", "don't we'll 123 4567", "\r\n a\r\n", "tab\t end ", "ﬁ ½ Ａ", "a\x00b c\x7f", "x" * 3000, "foo ​ bar", "  lead and trail  ", "\n", ". . .  ...", "a b", "a b"]


@pytest.mark.parametrize("block", [24 << 20, 1])
def test_alignment_of_odd_texts(spark, monkeypatch, block):
    import public_tokenizers

    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    docs = [(i // 2 if i > 3 else None, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("block", "kind", "code", "runs", "n_a")})
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    check_alignment(token_alignment.align_documents(df, *paths), docs)
    assert token_alignment.align_documents(df.limit(0), *paths).count() == 0


def test_products_of_incidence_matrices():
    rng = random.Random(1)
    for _ in range(30):
        n = rng.randint(1, 40)
        sizes = []
        for _ in range(2):
            ends = sorted({n, *(rng.randint(1, n) for _ in range(rng.randint(0, 12)))})
            sizes.append([e - s for s, e in zip([0, *ends[:-1]], ends, strict=True)])
        at = lambda own: [set(range(sum(own[:i]), sum(own[: i + 1]))) for i in range(len(own))]
        want = [(i, j, len(x & y)) for i, x in enumerate(at(sizes[0])) for j, y in enumerate(at(sizes[1])) if x & y]
        assert token_alignment.links(*sizes) == want
