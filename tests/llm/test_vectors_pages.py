"""Searches over vectors, and WARC archives, against brute force and round trips."""

import hashlib
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import ann, mtree, warc
from cohortlens.llm.search_blocks import Best


def is_query():
    return F.col("vec_id") % 5 == 0


def vectors(llm, rng, n=400, dim=12):
    x = rng.normal(size=(n, dim)) * rng.uniform(0.2, 2, (n, 1))
    x[50:120] = x[50]  # a common vector
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(1000, None, "x"), (1005, [float("nan")] * dim, "x"), (1010, [0.0] * dim, "x"), (1015, [None] + [1.0] * (dim - 1), "x"), (None, x[0].tolist(), "x"), (1020, [], "x"), (7, x[7].tolist(), "x"), (1025, [float("inf")] * dim, "x")]
    return x, llm.createDataFrame(rows, "vec_id long, embedding array<double>, score string")


def brute(rows, queries, k, score):
    """rows: (id, vector); queries: places of rows that ask. Answers by id, in order of place."""
    out = {}
    for n in queries:
        i, v = rows[n]
        s = sorted((-score(v, w), j, m) for m, (j, w) in enumerate(rows) if m != n and len(v) == len(w))[:k]
        out.setdefault(i, []).append([(r + 1, j, -x) for r, (x, j, _) in enumerate(s)])
    return {i: sorted(x for a in answers for x in a) for i, answers in out.items()}


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {i: sorted(x) for i, x in got.items()}


def test_exact_search_equals_brute_force(llm, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 90)
    x, df = vectors(llm, np.random.default_rng(0))
    ints = [(i, np.floor(64 * v).astype(int)) for i, v in enumerate(x)] + [(1010, np.zeros(x.shape[1], int)), (7, np.floor(64 * x[7]).astype(int))]
    ints += [(20, np.floor(-64 * x[20]).astype(int)), (1020, np.zeros(0, int)), (1022, np.zeros(0, int)), (1025, np.zeros(0, int))]
    df = df.unionAll(llm.createDataFrame([(20, (-x[20]).tolist(), "x"), (1022, [], "x"), (1025, [], "x")], df.schema))
    want = brute(ints, [n for n, (i, _) in enumerate(ints) if i % 5 == 0], 20, lambda a, b: int(a @ b))
    assert len(want[20]) == 40 and [r[1] for r in want[1020]] == [1022, 1025]
    assert answers(mtree.exact_top_k(df, is_query())) == want


def test_large_components_take_part_exactly(llm, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(200, 6)) * 100)
    x[::7] *= 2.0**12  # beyond 2**22 once scaled
    x[::15] *= 2.0**4
    x[40:60] = x[45] + rng.integers(0, 2, (20, 6))  # products that differ in few of many bits
    df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    ints = [(i, [math.floor(64 * c) for c in v]) for i, v in enumerate(x.tolist())]
    want = brute(ints, range(0, 200, 5), 20, lambda a, b: sum(c * d for c, d in zip(a, b, strict=True)))
    assert answers(mtree.exact_top_k(df, is_query())) == want and max(s for w in want.values() for _, _, s in w) > 2**53
    wide = llm.createDataFrame([(i, [2.0**50 * (1 - 2 * (i == 1)), 2.0**20]) for i in range(3)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        mtree.exact_top_k(wide, is_query()).collect()


def test_products_of_any_size():
    rng = np.random.default_rng(6)
    for top in (2**22, 2**30, 2**45, 2**62, 2**100):
        x = np.array([[float(int(c * top)) for c in r] for r in rng.uniform(-1, 1, (30, 700))])
        x[5] = -x[6]
        x[7, 1:] = x[8, 2:] = 0
        exact = [[sum(int(c) * int(d) for c, d in zip(a, b, strict=True)) for b in x] for a in x[:8]]
        assert mtree.products(x[:8], x).tolist() == [[min(max(s, int(mtree.UNDER)), int(mtree.OVER)) for s in r] for r in exact]


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    x = np.round(np.repeat(rng.normal(size=(20, 6)) * 500, 100, axis=0) + rng.normal(size=(2000, 6)) * 5)
    tree = mtree.Tree(x)
    for v, rows in enumerate(tree.rows):
        if rows is not None:
            assert len(rows) <= mtree.PAGE and tree.far[v].max() <= tree.node_radius[v] + 1e-9
    ids = np.arange(len(x))
    q, i, s = mtree.search(ids, x, ids[:40], x[:40], 5)
    for a in range(40):
        want = sorted(((-(x[a] @ x[j]), j) for j in ids if j != a))[:5]
        assert list(zip(i[q == a], s[q == a], strict=True)) == [(j, -v) for v, j in want]


@pytest.mark.parametrize("spread,most", [(0.2, 0.2), (0.05, 0.15)])
def test_share_of_products_that_the_tree_takes(spread, most):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 64))[rng.integers(0, 200, 8192)] + spread * rng.normal(size=(8192, 64))  # 40 a cluster
    x = np.floor(64 * x / np.linalg.norm(x, axis=1, keepdims=True))
    ids, queries, taken = np.arange(len(x)), np.arange(0, len(x), 20), []
    q, found, s = mtree._tree_search(ids, x, queries, x[queries], 20, taken)
    assert sum(taken) / (len(x) * len(queries)) < most
    for i in range(0, len(queries), 50):
        want = sorted(((-(x[queries[i]] @ x[j]), j) for j in ids if j != queries[i]))[:20]
        assert list(zip(found[q == i], s[q == i], strict=True)) == [(j, -v) for v, j in want]


def test_nearest_reaches_recall_and_scores_exactly(llm, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 150)
    x, df = vectors(llm, np.random.default_rng(1))
    rows = ann.nearest(df, is_query()).collect()
    want = brute([*enumerate(x), (7, x[7])], range(0, len(x), 5), 20, lambda a, b: float(a @ b))
    hit = 0
    for r in rows:
        assert r.query_id != r.vec_id and r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), abs=1e-12)
        hit += r.score >= want[r.query_id][-1][2] - 1e-12
    assert {r.query_id for r in rows} == set(want) and hit >= 0.97 * 20 * len(want)


@pytest.mark.parametrize("spread,most_verified", [(None, 0.75), (0.2, 0.05), (0.05, 0.03)])
def test_share_of_pairs_that_the_search_verifies(spread, most_verified):
    """Random vectors, and 200 clusters: recall beside what was multiplied for it."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 64))
    if spread:
        x = rng.normal(size=(200, 64))[rng.integers(0, 200, 6000)] + spread * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, queries, verified = np.arange(len(x)), np.arange(0, len(x), 60), []
    q, found, _ = ann._search(ann.PROJECTIONS, ann.CERTAIN, 0, verified)(ids, x, queries, x[queries], 20)
    hit = 0
    for i, a in enumerate(queries):
        s = x @ x[a]
        s[a] = -np.inf
        hit += len(set(np.argsort(-s)[:20]) & set(found[q == i]))
    assert hit / (20 * len(queries)) > 0.93 and sum(verified) / (len(x) * len(queries)) < most_verified


def test_common_vectors_go_to_the_smallest_ids():
    x = np.repeat(np.random.default_rng(7).normal(size=(3, 16)), 900, axis=0)
    order = np.random.default_rng(8).permutation(len(x))
    q, found, s = ann._search(ann.PROJECTIONS, ann.CERTAIN, 0)(order, x, order[:1], x[:1], 5)
    assert found.tolist() == sorted(set(order[:900]) - {order[0]})[:5]


def test_few_vectors_and_none(llm):
    few = llm.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [0.5])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id, r.score) for r in ann.nearest(few, is_query()).collect()] == [(0, 1, 5.0)]
    assert [(r.query_id, r.vec_id, r.score) for r in mtree.exact_top_k(few, is_query()).collect()] == [(0, 1, 64 * 64 * 5)]
    none = few.where("vec_id < 0")
    assert ann.nearest(none, is_query()).count() == 0 == mtree.exact_top_k(none, is_query()).count()


def test_chi_square_law():
    draw = (np.random.default_rng(0).normal(size=(200_000, 8)) ** 2).sum(axis=1)
    for x in (2.0, 7.3, 18.2):
        assert ann.chi_square(np.array([x]), 8)[0] == pytest.approx((draw <= x).mean(), abs=0.005)


def test_best_keeps_ties_by_id():
    b = Best(1, 3)
    b.add(np.zeros(3, int), np.array([9, 4, 7]), np.array([1.0, 1.0, 2.0]))
    b.add(np.zeros(2, int), np.array([1, 8]), np.array([1.0, 0.5]))
    assert b.rows()[1].tolist() == [7, 1, 4]


PAGES = [
    (1, "http://a/\r\nX: 1", "é" * 600),
    (2, None, "é" * 600),
    (9, "u%0A", "é" * 600),
    (9, "again", "é" * 600),
    (3, "u", "x" * 999),
    (4, "u", "x" * 999),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "WARC/1.1\r\n\r\nHTTP\r\n\r\n" * 200_000),
    (None, "u", "é" * 600),
]


def pages(llm):
    return llm.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)


def test_round_trip(llm):
    got = sorted(tuple(r) for r in warc.round_trip(pages(llm)).fillna(-1).collect())
    want = []
    for i, _, html in PAGES:
        b = (html or "").encode()
        again = html == "é" * 600 and i != 9
        want.append((-1 if i is None else i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", 9 if again else -1))
    assert got == sorted(want)
    assert warc.round_trip(pages(llm).where("page_id < 0")).count() == 0


def test_archive_keeps_all_fields(llm, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.archive(pages(llm), path)
    files = os.listdir(tmp_path / "w")
    assert files and all(f.endswith(".warc") for f in files if not f.startswith("."))
    back = llm.read.format("warc").load(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, warc.to_records(pages(llm)).select(*back.columns).collect()))
    only = back.where("record_type = 'revisit' AND page_id < 2")
    assert [(r.page_id, r.refers_to, r.payload) for r in only.collect()] == [(1, 9, None)]


def test_unwanted_blocks_are_not_read(llm, tmp_path, monkeypatch):
    path = f"{tmp_path}/w"
    warc.archive(pages(llm), path)
    read = []
    monkeypatch.setattr(warc._Records, "block", lambda self, start, length: read.append(length) or b"\r\n\r\n")
    for payload, kind, blocks in ((True, "revisit", 0), (False, "response", 0), (True, "response", 8)):
        reader = warc.WarcReader(path, payload, 1 << 20)
        assert list(reader.pushFilters([warc.EqualTo(("record_type",), kind), warc.IsNotNull(("payload",))])) == [warc.IsNotNull(("payload",))]
        read.clear()
        rows = [r for p in reader.partitions() for r in reader.read(p)]
        assert len(rows) == {"revisit": 2 + 1, "response": 7}[kind] or blocks
        assert len(read) == (len(rows) if payload and kind == "response" else 0)


def test_pipeline_stages(llm, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = first = llm.read.parquet(f"{sf}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        stage(llm, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = llm.read.parquet(f"{tmp_path}/{name}")
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == first.columns
    assert sizes[0] == first.count() > sizes[1] == sizes[2] and sizes[3] > 0 and sizes[4] >= sizes[3]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secrets", "mixing", "packing"]
    empty = first.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, empty, sf).count() == 0


def foreign(kind, id_, block, content=None, uri="http://a.example/x"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID:{id_}\r\nWARC-Target-URI: {uri}\r\nContent-Type: {content or 'application/http; msgtype=response'}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_foreign_and_compressed_archives(llm, tmp_path):
    import gzip

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    big = b"<p>" + b"y" * 3_000_000
    records = [
        foreign("warcinfo", "<urn:uuid:1>", b"software: other", "application/warc-fields"),
        foreign("response", "<urn:uuid:2>", http + "<p>\u00fc\r\n\r\n".encode() + b"\xff"),
        foreign("response", "<urn:page:x7>", http + big),
        foreign("response", "<urn:page:7>", http),
        foreign("resource", "<urn:uuid:4>", b"plain\r\n\r\ntext", "text/plain"),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))  # a member for each record
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "d.txt").write_bytes(b"no archive")
    warc.register(llm)
    rows = llm.read.format("warc").load(f"{tmp_path}").orderBy("record_id", "page_id").collect()
    assert len(rows) == 3 * len(records)
    got = {(r.record_id, r.record_type, r.page_id, r.target_uri, r.payload) for r in rows}
    u = "http://a.example/x"
    assert got == {
        ("<urn:uuid:1>", "warcinfo", None, u, None),
        ("<urn:uuid:2>", "response", None, u, "<p>\u00fc\r\n\r\n\ufffd"),
        ("<urn:page:x7>", "response", None, u, big.decode()),
        ("<urn:page:7>", "response", 7, u, ""),
        ("<urn:uuid:4>", "resource", None, u, None),
    }
    heads = llm.read.format("warc").option("payload", "false").load(f"{tmp_path}").where("page_id = 7")
    assert [tuple(r)[:3] for r in heads.collect()] == [(7, u, "response")] * 3


def test_payloads_are_not_shuffled_for_few_repeated_digests(llm):
    plan = warc.to_records(pages(llm))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    limit = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = sorted(tuple(r) for r in warc.round_trip(pages(llm)).fillna(-1).collect())
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert joined == sorted(tuple(r) for r in warc.round_trip(pages(llm)).fillna(-1).collect())
