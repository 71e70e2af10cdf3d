"""Ball k-means, whitening and files of ids: by brute force, round trips, and rows that are null, empty, repeated or odd."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridjobs.llm import ball_kmeans, queries, repair_ids, whitening

DATA = "/root/testdata/sf0.001"
PATH = P.path("word_bpe_49k.json")
VECTORS = "vec_id long, embedding array<double>, cluster int, block long, x string, id int, n long"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 7, 8, "clash", 9, 1) for i, v in rows], VECTORS)


# --- ball k-means ----------------------------------------------------------------------------------------------------


def kmeans(ids, x, k, rounds, seed=2):
    """Every distance in every round."""
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v.tolist()) for i, v in zip(ids, x, strict=True) if i is not None)
    c = [np.array(v, np.int64) for _, v in order[:k]]
    for done in range(rounds + 1):
        d = np.stack([((x - m) ** 2).sum(1) for m in c], 1)
        own = d.argmin(1)
        if done < rounds:
            c = [np.array([int(s) // int((own == j).sum()) for s in x[own == j].sum(0)]) if (own == j).any() else m for j, m in enumerate(c)]
    return own, d.min(1), c


@pytest.mark.parametrize("spread", [0.02, 0.4])
def test_ball_kmeans_by_brute_force(spark, spread):
    r = np.random.default_rng(1)
    centers = r.standard_normal((9, 6))
    v = centers[r.integers(0, 9, 700)] + spread * r.standard_normal((700, 6))
    v[:200] = v[0]  # copies
    v[300:340] = np.round(v[300:340] * 2) / 2  # ties
    ids = [None if i in (5, 6) else i // 2 if i < 20 else i for i in range(700)]
    x = np.floor(256 * v).astype(np.int64)
    bad = [(9000, None), (9001, [1.0] * 5), (9002, [1.0] * 5 + [None]), (9003, [1.0] * 5 + [float("nan")]), (9004, [1.0] * 5 + [float("inf")]), (9005, [])]
    rows = vectors_of(spark, [*zip(ids, v.tolist(), strict=True), *bad]).repartition(5)
    got = ball_kmeans.cluster(rows, 12, 5, dim=6).collect()
    own, dist, c = kmeans(ids, x, 12, 5)
    want = sorted((i is None, i or 0, int(a), int(d)) for i, a, d in zip(ids, own, dist, strict=True))
    assert sorted((q.vec_id is None, q.vec_id or 0, q.cluster, q.distance) for q in got) == want
    digest = {j: hashlib.sha256(",".join(map(str, m.tolist())).encode()).hexdigest() for j, m in enumerate(c)}
    for q in got:
        assert (q.inertia, q.cluster_inertia, q.centroid_sha256) == (int(dist.sum()), int(dist[own == q.cluster].sum()), digest[q.cluster])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("ball_kmeans")]


def test_ball_kmeans_of_few_and_large_vectors(spark):
    few = vectors_of(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [8.0, 8.0])])
    got = {q.vec_id: (q.cluster, q.distance) for q in ball_kmeans.cluster(few, 40, 2, dim=2).collect()}
    first = sorted((1, 2, 3), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())
    assert got == {1: (min(first.index(1), first.index(2)), 0), 2: (min(first.index(1), first.index(2)), 0), 3: (first.index(3), 0)}
    assert ball_kmeans.cluster(few.limit(0), dim=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ball_kmeans.cluster(few.filter("vec_id > 5"), dim=2).count() == 0
    far = vectors_of(spark, [(1, [4e5, 0.0]), (2, [-4e5, 1.0]), (3, [4e5, 1.0])])  # beyond what doubles hold
    assert {q.vec_id: q.distance for q in ball_kmeans.cluster(far, 1, 0, dim=2).collect()}[2] in (0, (2 * 102400000) ** 2, (2 * 102400000) ** 2 + 256**2)
    with pytest.raises(Exception, match="after scaling"):
        ball_kmeans.cluster(vectors_of(spark, [(1, [1e9, 0.0])]), dim=2).count()


def test_balls_leave_far_centroids_out():
    r = np.random.default_rng(2)
    c = (1000 * r.standard_normal((30, 4))).astype(np.int64)
    own = r.integers(0, 30, 3000)
    x = c[own] + r.integers(-40, 41, (3000, 4))
    first, d = ball_kmeans.assign(x, None, ball_kmeans.balls(c))
    radii = [int(d[first == i].max()) if (first == i).any() else None for i in range(30)]
    moved = c + r.integers(-30, 31, c.shape)
    model = ball_kmeans.balls(moved, c, radii)
    assert sum(map(len, model.near)) < 30 * 29 / 4
    full = ball_kmeans.assign(x, None, model)
    ringed = ball_kmeans.assign(x, first, model)
    assert (full[0] == ringed[0]).all()
    assert (full[1] == ringed[1]).all()


# --- whitening -------------------------------------------------------------------------------------------------------


def whitened(rows, components=16):
    x = [[int(np.floor(64 * e)) + 1_000_000 for e in v] for v in rows]
    fit = np.array(sorted(set(map(tuple, x))), np.int64)
    n, s = len(fit), fit.sum(0)
    cov = np.cov(fit.T.astype(float), bias=True).reshape(fit.shape[1], -1)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x], (np.array(x) - fit.mean(0)) @ v / np.sqrt(e), e / np.trace(cov)


def compared(got, ids, n, deviation, w, share):
    by = {}
    for q in got:
        by.setdefault(q.component, {})[q.vec_id] = q
    assert sorted(by) == list(range(1, len(share) + 1))
    for c, own in by.items():
        a = np.array([own[i].whitened for i in ids])
        sign = np.sign(a @ w[:, c - 1])
        np.testing.assert_allclose(a * sign, w[:, c - 1], atol=1e-6)
        assert [q.explained for q in own.values()] == pytest.approx([share[c - 1]] * len(own), rel=1e-9)
        assert [own[i].deviation for i in ids] == deviation
        assert {q.n for q in own.values()} == {n}
    assert max(q.identity_error for q in got) < 1e-6


def test_whitening_by_brute_force(spark):
    r = np.random.default_rng(3)
    v = r.standard_normal((300, 5)) @ r.standard_normal((5, 5)) + 3
    v[:90] = v[0]
    bad = [(9000, None), (9001, [1.0, None]), (9002, [1.0, float("nan")]), (9003, [1.0, float("-inf")]), (9004, []), (None, v[1].tolist())]
    got = whitening.whiten(vectors_of(spark, [*enumerate(v.tolist()), *bad]), 3).collect()
    assert sum(q.vec_id is None for q in got) == 3
    compared([q for q in got if q.vec_id is not None], range(300), *whitened(v, 3))
    assert len(got) == 301 * 3


def test_whitening_of_odd_tables(spark):
    one = vectors_of(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])
    assert whitening.whiten(one).count() == 0  # no variance
    assert whitening.whiten(one.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = vectors_of(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)] + [(10, [1.0]), (11, [3.0]), (11, [3.0])])
    got = sorted((q.vec_id, q.component, q.n, round(abs(q.whitened), 9), round(q.explained, 9)) for q in whitening.whiten(line).collect())
    assert got[:2] == [(0, 1, 5, round(2**0.5, 9), 1.0), (1, 1, 5, round(0.5**0.5, 9), 1.0)]
    assert got[5:] == [(10, 1, 2, 1.0, 1.0), (11, 1, 2, 1.0, 1.0), (11, 1, 2, 1.0, 1.0)]  # a fit of their own
    large = vectors_of(spark, [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 0.0])])
    assert {q.deviation for q in whitening.whiten(large).collect()} == {None, 32**2 * 0 + (3 * 1_000_000 - 3_000_000) ** 2 + 64**2}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(vectors_of(spark, [(1, [1e300])])).count()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_whitening_query_by_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    compared(queries.op12_whitening(spark, DATA).collect(), [q.vec_id for q in rows], *whitened([q.embedding for q in rows]))


# --- files of ids ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encode():
    tok = Tokenizer.from_file(PATH)
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 2]


def ids_of(row):
    return np.frombuffer(row.ids, "<u4").tolist()


def test_ids_come_back_from_files(spark, tmp_path, encode):
    sentence = "The cat's mat, THE dog\tand a　wide\nline é è ǅ İstanbul 12345 it's "
    texts = [(i * 7 % 50, sentence * (i % 5) + f"number {i}") for i in range(50)]
    texts += [(60, None), (61, ""), (62, " \n "), (63, "<|endoftext|> a<|startoftext|>b <|EndOfText|>"), (64, "x" * 3000), (65, "word " * 20_000), (None, "no key"), (None, None)]
    texts += [(70, "again")] * 30 + [(70, f"another {i}") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "k", 3, "d") for i, t in texts], "doc_id long, text string, keys string, part int, data string").repartition(6)
    path = str(tmp_path / "ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as they are, the parts stay apart
    try:
        repair_ids.write_ids(docs, path, PATH, 2, shard=500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(repair_ids.read_ids(spark, path).collect(), key=lambda q: q.start)
    assert sorted((q.doc_id is None, q.doc_id, ids_of(q)) for q in got) == sorted((i is None, i, encode(t)) for i, t in texts)
    at = 0
    for q in got:
        assert (q.start, q.n_tokens) == (at, len(ids_of(q)))
        at += q.n_tokens
    keys = [q.doc_id for q in got]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    shards = spark.read.parquet(path).collect()
    assert len(shards) > 5
    assert all(q.n_ids < 500 + 20_001 for q in shards)
    assert len({q.part for q in shards if 70 in q.keys}) > 1  # a key of many rows takes several parts
    word = next(q for q in shards if 65 in q.keys)
    assert len(word.data) < 20_000 / 4  # compressed


def test_ids_of_an_empty_table_and_of_string_keys(spark, tmp_path, encode):
    docs = spark.createDataFrame([("b", "one two"), ("a", "three"), (None, "four")], "doc_id string, text string")
    repair_ids.write_ids(docs.limit(0), str(tmp_path / "none"), PATH, 2)
    assert repair_ids.read_ids(spark, str(tmp_path / "none")).count() == 0
    repair_ids.write_ids(docs, str(tmp_path / "s"), PATH, 2)
    got = sorted(repair_ids.read_ids(spark, str(tmp_path / "s")).collect(), key=lambda q: q.start)
    assert [(q.doc_id, ids_of(q)) for q in got] == [(None, encode("four")), ("a", encode("three")), ("b", encode("one two"))]


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip_and_random_access(seed):
    r = np.random.default_rng(seed)
    words = [r.integers(0, 50, int(n)) for n in r.integers(1, 9, 12)]
    docs = [np.concatenate([words[int(i)] for i in r.integers(0, 12, int(n))]) if n else np.zeros(0, int) for n in r.integers(0, 60, 40)]
    docs[3], docs[4] = np.full(501, 7), np.array([1, 2] * 200)  # runs
    ids = np.concatenate(docs).astype("<u4")
    x = repair_ids.compress(ids, np.cumsum([len(d) for d in docs]), 100, least=3)
    assert len(x.rules) > 10
    assert len(x.symbols) < len(ids) / 2
    y = repair_ids.opened(repair_ids.packed(x))
    assert (repair_ids.expand(y, y.symbols) == ids).all()
    for i, d in enumerate(docs):
        for first in range(0, len(d) + 1, 7):
            for count in (0, 1, 5, len(d) - first):
                assert repair_ids.read_range(y, i, first, count).tolist() == d[first : first + count].tolist()
    for (a, b), n in zip(x.rules.astype(int), x.lengths, strict=True):
        assert n == sum(1 if s < 100 else x.lengths[s - 100] for s in (a, b))
    with pytest.raises(ValueError, match="not a shard"):
        repair_ids.opened(b"x" * 64)


def test_words_of_odd_texts_by_the_tokenizer(encode):
    r = np.random.default_rng(9)
    alphabet = list("abAB'sST.,!?-<|>09 \n\t\u0301\u030cJjH\u03a3\u03c3\u03c2\u0130\u01c5\u00e9\u00c9\u212a\x0b\x1c\x85\u3000(\"&\u00b2\u00bd\u0663\u5b57\x00")
    texts = ["".join(r.choice(alphabet, int(n))) for n in r.integers(0, 30, 4000)]
    texts += ["<|endoftext|>.", "a<|startoftext|>)", "it's they're I'LL", "''s 't", "word'.", "\u00e9t\u00e9, \u0391\u03a3. x\u00b2,", ""]
    ids, ends = repair_ids.words_of(PATH).ids(pa.array(texts))
    for t, got in zip(texts, np.split(ids, ends[:-1]), strict=True):
        assert got.tolist() == encode(t)[:-1], t


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_ids_query_by_the_tokenizer(spark, encode):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {q.doc_id: q for q in queries.op13_repair_ids(spark, DATA).collect()}
    at = 0
    for d in docs:
        ids, q = encode(d.text), got.pop(d.doc_id)
        assert (q.start, q.n_tokens, q.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got
