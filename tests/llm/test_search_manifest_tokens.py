"""Ranked search, Merkle proofs and byte-level BPE against plain versions, with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import lexical, merkle
from tidemark.llm.lexical import rank_documents
from tidemark.llm.merkle import leaf, manifest, proofs, verify_tampered
from tidemark.llm.prefix_bpe import EncodedText, Vocabulary, decode, digests, edit, encode
from tidemark.llm.queries import tokenizer_path

PATH, PATTERN = tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, n long, at long, hash string, block long, term string, query long"


def docs_of(spark, rows):
    """Documents (doc_id, source, text), with columns that operators use for names of their own."""
    return spark.createDataFrame([(i, s, None, None if t is None else len(t), t, 1, 2, "h", 3, "t", 4) for i, s, t in rows], SCHEMA).repartition(3)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def rank_brute(docs, items, k):
    held = [(i, collections.Counter(terms(t))) for i, _, t in docs]
    df = collections.Counter(t for _, c in held for t in c)
    n, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    for item, text in items:
        scores = []
        for place, (doc, c) in enumerate(held):
            m = 100 - 25 + 25 * sum(c.values()) * n // max(total, 1)
            weight = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, place, doc))
        for rank, (s, _, _, _, doc) in enumerate(sorted(scores)[:k], 1):
            yield item, rank, doc, -s


@pytest.mark.parametrize("broadcast", [1 << 23, 0])
def test_ranking(spark, monkeypatch, broadcast):
    for name, value in (("BLOCK_ROWS", 40), ("RANGE", 16), ("TOGETHER", 300), ("BROADCAST", broadcast), ("KEPT", 2)):
        monkeypatch.setattr(lexical, name, value)
    rnd = random.Random(3)
    vocabulary = [f"w{n}" for n in range(60)] + ["the", "The", "ÉTÉ", "été", "x_y", "日本"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    text = lambda n: " ".join(rnd.choices(vocabulary, weights, k=n))
    rows = [(i, "s", text(rnd.randint(0, 60))) for i in range(300)] + [(None, "s", text(30)), (None, "s", text(30)), (5, "s", text(9)), (301, "s", None), (302, "s", " ?! ")]
    rows += [(400 + i, "s", "w1 w2 w3") for i in range(50)] + [(500, "s", text(20000)), (501, "s", "q" * 100000)]
    items = [(i, text(rnd.randint(1, 30))) for i in range(12)] + [(12, None), (13, "nowhere"), (14, "w1 w1 w2"), (15, "the")]
    found = rank_documents(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"), 20)
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=str)
    assert got == sorted(rank_brute(rows, items, 20), key=str)
    nothing = docs_of(spark, []).limit(0)
    assert rank_documents(nothing, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert rank_documents(docs_of(spark, rows[:5]), spark.createDataFrame([], "item_id long, text string")).count() == 0


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_brute(i, s, t):
    n = None if t is None else len(t)
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, s, None, n, t)))


def tree_brute(nodes):
    """The root, and for each node the list of (left, right) siblings from below."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, a in enumerate(at):
            run = a - a % 3
            paths[k].append(("".join(level[run:a]), "".join(level[a + 1 : run + 3])))
            at[k] = a // 3
        level = [H(*level[a : a + 3]) for a in range(0, len(level), 3)]
    return level[0], paths


def merkle_brute(rows):
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted(((i is not None, i or 0, leaf_brute(i, s, t), i, t) for i, x, t in rows if x == s), key=lambda x: x[:3])
        trees[s] = own, *tree_brute([x[2] for x in own])
    root, above = tree_brute([trees[s][1] for s in sources])
    for s, further in zip(sources, above, strict=True):
        own, subroot, paths = trees[s]
        for (_, _, digest, i, t), path in zip(own, paths, strict=True):
            path = path + further
            changed = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (t or "")
            folded = H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, s, None, len(t), t.replace("\n", "")))) if changed else digest
            for left, right in path:
                folded = H(left, folded, right)
            yield i, digest, subroot, root, H(*(a + b for a, b in path)), folded, folded == root


def test_merkle(spark):
    rnd = random.Random(4)
    sizes = {"a": 1, "b": 2, "é": 3, "c/d": 4, "hot": 2300, None: 244, "": 243, "=": 10}
    rows = [(k, s, "line\n" * rnd.randint(0, 2) + f"é{rnd.random()}") for s, n in sizes.items() for k in range(n)]
    rows += [(None, "hot", "x"), (None, None, None), (7, "hot", "other\n"), (7, "hot", "other\n"), (3, "a", None), (4, "a", "")]
    docs = docs_of(spark, rows)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r[n] for n in names) for r in verify_tampered(docs).collect()]
    want = list(merkle_brute(rows))
    assert collections.Counter(got) == collections.Counter(want)
    assert {(r.subroot, r.root) for r in manifest(docs).collect()} == {(w[2], w[3]) for w in want}
    assert {r.source for r in manifest(docs).collect()} == set(sizes)
    for rows in ([], [(1, None, None)], [(1, "a", "x\n")], [(n, str(n % 400), "x") for n in range(800)]):
        got = [tuple(r[n] for n in names) for r in verify_tampered(docs_of(spark, rows)).collect()]
        assert collections.Counter(got) == collections.Counter(merkle_brute(rows) if rows else [])
    kept = proofs(docs_of(spark, [(1, "a", "x"), (2, "a", "y")]))
    folded = kept.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"))
    assert folded.count() == 2 and docs_of(spark, [(1, "a", "x")]).select(leaf().alias("x")).first().x == leaf_brute(1, "a", "x")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.of(PATH, PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_tokens_of_random_texts_and_edits(vocabulary, reference, data):
    texts = st.one_of(st.text(max_size=80), st.text("aabbe the  \n\t'srve.!?12éß中к🙂", max_size=80))
    t = EncodedText(vocabulary, data.draw(texts))
    assert t.ids() == reference.encode_ordinary(t.text)
    for _ in range(3):
        start = data.draw(st.integers(0, len(t.text)))
        end, more = min(len(t.text), start + data.draw(st.integers(0, 9))), data.draw(texts)
        want = t.text[:start] + more + t.text[end:]
        t.edit(start, end, more)
        assert t.text == want and t.ids() == reference.encode_ordinary(want)
        fresh = EncodedText(vocabulary, want)
        assert (t.ends, t.last) == (fresh.ends, fresh.last)


def test_an_edit_is_worked_out_nearby(vocabulary, reference):
    rnd = random.Random(5)
    t = EncodedText(vocabulary, "".join(rnd.choice("abcde") for _ in range(50000)) + " and " + " ".join(["word"] * 1000))
    assert t.edit(25000, 25003, "zz") < 200 and t.append("s of it") < 40 and t.edit(50100, 50104, "mot") < 40
    assert t.ids() == reference.encode_ordinary(t.text)


def test_tokens_of_a_table(spark, reference):
    rnd = random.Random(6)
    texts = [None, "", " ", "a\n\n b", "x" * 5000, " " * 3000 + "y", "it's 1234 don't", "日本語 кот 🙂", *("".join(rnd.choice("ab cd\n.é") for _ in range(200)) for _ in range(40))]
    texts += ["same words here"] * 5 + ["long text, " * 300000]
    rows = [(i if i != 9 else None, "s", t) for i, t in enumerate(texts)]
    docs = docs_of(spark, rows)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(docs, PATH, PATTERN).collect()}
    want = set()
    for i, _, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.add((i, len(ids), H(",".join(map(str, ids))), H(t or "")))
    assert got == want
    assert digests(docs.limit(0), PATH, PATTERN).count() == 0
    short = docs.where("length(text) < 10000 and doc_id is not null")
    encoded = encode(short, PATH, PATTERN)
    edits = spark.createDataFrame([(3, 1, 2, "ZZ"), (6, None, None, " and more"), (1, 0, 0, "new"), (9999, 0, 0, "x"), (None, 0, 0, "x")], "doc_id long, start long, end long, replacement string")
    changed = edit(encoded, edits, PATH, PATTERN)
    text_of = {i: t or "" for i, _, t in rows if i is not None}
    text_of |= {3: "aZZ\n b", 6: texts[6] + " and more", 1: "new"}
    got = {r.doc_id: r for r in changed.collect()}
    assert len(got) == short.count() and all(r.text == text_of[i] and r.ids == reference.encode_ordinary(r.text) for i, r in got.items())
    assert {r.doc_id: bytes(r.data) for r in decode(changed, PATH, PATTERN).collect()} == {i: r.text.encode() for i, r in got.items()}
    with pytest.raises(Exception, match="several edits"):
        edit(encoded, edits.union(edits), PATH, PATTERN).collect()
