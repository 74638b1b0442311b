"""Vector search and web archives against brute force, and the registered queries and stages on the small tables."""

import hashlib
import io
import math
import os
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
import zstandard

import corpus_pipeline
from tidemark.llm import topk
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.topk import search_bucket, top_products
from tidemark.llm.warc import (
    ArchiveWriter, WarcError, archive_pages, parse_record, plan_records, read_archives, read_records, record_bytes,
    write_archives,
)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def top_brute(rows, asked, k):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(1024 * x) for x in v]
    out = []
    for q in asked:
        if q in whole:
            scores = [(-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("lengths", ["alike", "spread"])
def test_top_products(spark, lengths):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        v = rng.normal(size=8) * (1 if lengths == "alike" else rng.exponential(3))
        if lengths == "alike":
            v /= np.linalg.norm(v)
        rows.append((i, [float(x) for x in v]))
    rows += [(400, None), (401, []), (402, [1.0, None] * 4), (403, [float("nan")] * 8), (404, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [(600, [0.0] * 8), (700, [1.0, 2.0]), (800, [-0.5, 2.0]), rows[3]]
    vectors = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, label int, length double")
    asked = [i for i, _ in rows if i is not None and i % 10 == 0]
    queries = vectors.filter("vec_id % 10 = 0")
    got = sorted(map(tuple, top_products(vectors, queries, 10, bucket_rows=64).collect()))
    assert got == top_brute(rows, sorted(set(asked)), 10)
    assert top_products(vectors.limit(0), queries, 10).count() == 0
    assert top_products(vectors, queries.limit(0), 10).count() == 0


def test_both_prunings_are_exact():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-500, 500, (300, 16))
    vectors = vectors[np.argsort(-(vectors**2).sum(axis=1))]
    queries = vectors[::30] + rng.integers(-5, 5, (10, 16))
    scores = queries @ vectors.T
    floors = np.sort(scores, axis=1)[:, -3].astype(float)
    assert (floors > 0).all()
    for limit in (0.0, 2.0):
        topk.COORDINATE_FROM, before = limit, topk.COORDINATE_FROM
        found = search_bucket(np.arange(1000, 1010), queries, floors, np.arange(300), vectors, 3)
        topk.COORDINATE_FROM = before
        assert sorted(found) == sorted((1000 + q, int(v), int(scores[q, v])) for q in range(10) for v in np.argsort(-scores[q])[:3])


def test_very_large_components():
    big = np.array([[1 << 40, 1 << 40]])
    assert topk._products(big, big).tolist() == [[(1 << 63) - 1]]
    assert topk._products(big // 1024, big // 1024).tolist() == [[1 << 61]]


def test_archives(spark, tmp_path):
    rnd = random.Random(3)
    page = lambda n: "".join(rnd.choice("<p>é\r\n ") for _ in range(n))
    long_one, just = page(5000), "x" * 1000
    html = [None, "", "short", "short", long_one, long_one, long_one, just, just, "y" * 999, "y" * 999, page(200_000)]
    html += [page(rnd.randint(1, 3000)) for _ in range(60)]
    ids = [None if i == 6 else i for i in range(len(html))]
    rows = [(i, None if i == 2 else f"http://h/{i} a\nb", h, "r", 9) for i, h in zip(ids, html, strict=True)]
    rows.append(rows[5])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, records long").repartition(3)
    want = []
    for i, _, h, _, _ in rows:
        same = [j for j, _, g, _, _ in rows if (g or "") == (h or "") and j is not None]
        last = max(same) if same and len((h or "").encode()) >= 1000 else None
        repeats = last is not None and (i is None or i < last)
        data = (h or "").encode()
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if repeats else "response", str(last if repeats else None)))
    got = archive_pages(pages, f"file://{tmp_path}/a")
    assert sorted((str(r.page_id), *r[2:5], str(r.refers_to)) for r in got.collect()) == sorted(want)
    assert archive_pages(pages.limit(0), f"file://{tmp_path}/b").count() == 0
    written = write_archives(plan_records(pages), f"file://{tmp_path}/c")
    back = read_archives(written, f"file://{tmp_path}/c", payloads=True).filter("record_type = 'response'").collect()
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in back)


def archive(records):
    sink = io.BytesIO()
    writer = ArchiveWriter(sink)
    for r in records:
        writer.add(r)
    writer.close()
    return sink.getvalue()


def test_broken_archives():
    good = record_bytes(1, "http://h", b"payload", None, hashlib.sha1(b"payload").hexdigest())
    data = archive([good] * 3)
    assert list(read_records(io.BytesIO(data))) == [good] * 3
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    with pytest.raises(WarcError):
        list(read_records(io.BytesIO(data[:-3])))
    for broken in (
        good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"payload", b"pay"), good[:-4], good.replace(b"WARC-Date", b"X-Date"),
        good.replace(b"payload", b"PAYLOAD"), good.replace(b"sha1:", b"md5:"), b"", good.replace(b"WARC-Type: response", b"WARC-Type response"),
    ):
        with pytest.raises(WarcError):
            parse_record(broken)
    plain = zstandard.ZstdCompressor().compress(good)  # without a dictionary
    assert list(read_records(io.BytesIO(plain * 2))) == [good] * 2
    assert list(read_records(io.BytesIO(b""))) == []


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda of: sorted(str(tuple(None if pd.isna(v) else v for v in r)) for r in of)
    assert rows(tuple(r[c] for c in columns) for r in got.collect()) == rows(want[columns].itertuples(index=False, name=None))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    last = set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= last and len(ids) > 0.7 * len(texts), name
        last = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == last
    result = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in result.collect()} == last
