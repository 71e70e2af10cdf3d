"""Each operator and stage on small tables: results by brute force, nulls, empty texts and tables, repeated rows, clashing columns."""

import hashlib
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from gridjobs.llm import bpe, ctw, html_text, itq_dedup, ngram_join, packing, quality_mil, toxicity_knn
from gridjobs.llm.common import held_out
from gridjobs.llm.components import components
from gridjobs.llm.sharding import assign_shards
from gridjobs.llm.topk import exact_top_k

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t string, c long, root long, g long"
MULTI, JSON, RANKS = (P.path(x) for x in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def words(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghij"), 4)) for _ in range(n))


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", None, 1, "clash", 5, 6, 7) for i, t in texts], SCHEMA)


BASE = words(1, 200)
TEXTS = [
    (0, BASE), (1, BASE), (2, BASE + " more"), (3, BASE[:-30]), (4, words(2, 60)), (5, None), (6, ""), (7, "one two"), (7, "one two"), (8, "  ONE two\n"), (None, "without a key " * 3),
    (9, " ".join(words(5, 1).split() * 5000)), (10, words(2, 30) + " " + words(3, 60)), (11, None), (12, "<|endoftext|> a　b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, TEXTS)


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, TEXTS[:1]).limit(0)


def test_bpe(docs, empty):
    pairs = bpe.byte_pairs(MULTI, P.PATTERN)
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_digests(docs, MULTI, P.PATTERN).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((i is None, i, len(x := enc.encode_ordinary(t or "")), sha(",".join(map(str, x)).encode()), sha((t or "").encode())) for i, t in TEXTS)
    assert got == want
    assert bpe.bpe_digests(empty, MULTI, P.PATTERN).count() == 0
    row = bpe.bpe_round_trip(docs.filter("doc_id = 12"), MULTI, P.PATTERN).first()
    assert bytes(row.decoded).decode() == "<|endoftext|> a　b"
    assert row.ids == enc.encode_ordinary("<|endoftext|> a　b")


def test_sharding(docs, empty):
    got = assign_shards(docs, 4).collect()
    assert len(got) == len(TEXTS)
    by_text = {}
    for r in got:
        by_text.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    sizes = {(r.doc_id, r.text_crc32): r.size for r in got}
    assert sizes[5, 0] == 1
    assert sizes[0, zlib.crc32(BASE.encode())] == len(BASE) + 1
    assert assign_shards(empty, 4).count() == 0


def test_sharding_is_longest_first(spark, monkeypatch):
    """Against a heap over all groups, one by one: equal loads, with hot texts, runs of equal sizes and numbering in parts."""
    monkeypatch.setattr("gridjobs.llm.sharding.NUMBERED", 7)
    monkeypatch.setattr("gridjobs.llm.sharding.HOT", 20)
    texts = [(i, "x" * (7 * i % 101) + str(i)) for i in range(200)]
    texts += [(200 + i, f"{i:04d}") for i in range(150)] + [(1000 + i, "the hot text") for i in range(170)] + [(2000, None), (2001, "")]
    got = assign_shards(docs_of(spark, texts), 8).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in texts)
    groups = {}
    for _, t in texts:
        groups[t or ""] = groups.get(t or "", 0) + len(t or "") + 1
    loads = [0] * 8
    for size in sorted(groups.values(), reverse=True):
        loads[loads.index(min(loads))] += size
    found = [0] * 8
    for r in got:
        found[r.shard] += r.size
    assert found == loads
    assert len({r.shard for r in got if 1000 <= r.doc_id < 2000}) == 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_ngram_join_by_brute_force(spark, docs, empty):
    r = np.random.default_rng(3)
    more = []
    for k in range(12):  # near copies of several degrees, chains among them
        w = words(100 + k % 4, 120).split()
        for _ in range(int(r.integers(0, 9))):
            w[int(r.integers(0, len(w)))] = "changed"
        more.append((100 + k, " ".join(w)))
    texts = [(i if i is not None else None, t) for i, t in TEXTS] + more
    got = ngram_join.join(docs_of(spark, texts)).collect()
    assert len(got) == len(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for _, t in texts]
    want = []
    for a in range(len(texts)):
        links = [b for b in range(len(texts)) if b != a and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
        seen, todo = {a}, [a]
        while todo:
            x = todo.pop()
            for b in range(len(texts)):
                if b not in seen and sets[x] and sets[b] and len(sets[x] & sets[b]) >= 0.8 * len(sets[x] | sets[b]) - 1e-9:
                    seen.add(b)
                    todo.append(b)
        ids = [texts[x][0] for x in seen if texts[x][0] is not None]
        want.append((str(texts[a][0]), len(links), str(min(ids) if ids else None)))
    assert sorted((str(x.doc_id), x.n_links, str(x.component_id)) for x in got) == sorted(want)
    assert ngram_join.join(empty).count() == 0


def test_ngram_join_splits_large_groups(spark, monkeypatch):
    base = words(50, 150).split()
    texts = [(i, " ".join([*base[: 150 - i % 7], f"end{i}"])) for i in range(60)]
    whole = {r.doc_id: (r.n_links, r.component_id) for r in ngram_join.join(docs_of(spark, texts)).collect()}
    monkeypatch.setattr(ngram_join, "GROUP", 8)
    monkeypatch.setattr("gridjobs.llm.blocks.meetings.__defaults__", (8,))
    assert {r.doc_id: (r.n_links, r.component_id) for r in ngram_join.join(docs_of(spark, texts)).collect()} == whole
    assert {n for n, _ in whole.values()} == {59}


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame(edges, "a long, b long").limit(0)).count() == 0


VECTOR = "vec_id long, embedding array<float>, label int, c long, v int, id long"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], VECTOR)


def some_vectors():
    r = np.random.default_rng(5)
    centres = r.standard_normal((20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + r.standard_normal(16) * (0.05 + 0.1 * (i % 5))]) for i in range(300)]
    return [*rows, (300, rows[0][1]), (301, None), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] * 16), (305, []), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (300, rows[0][1])]


def test_itq_dedup_against_all_pairs(spark):
    rows = some_vectors()
    got = {}
    for r in itq_dedup.near_duplicates(vectors_of(spark, rows)).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = total = 0
    for a in ok:
        va = np.array(rows[a][1], np.float32).astype(float)
        n = sum(1 for b in ok if b != a and len(rows[b][1]) == len(va) and va @ (vb := np.array(rows[b][1], np.float32).astype(float)) / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.95)
        assert got[rows[a][0]][0][0] <= n
        found, total = found + got[rows[a][0]][0][0], total + n
    assert found >= 0.97 * total > 0
    assert got[301] == [(0, 301, True)] and got[302] == [(0, 302, True)] and got[304] == [(0, 304, True)]
    assert got[307][0][:2] == (1, 306)
    assert len(got[300]) == 2
    assert itq_dedup.near_duplicates(vectors_of(spark, rows[:1]).limit(0)).count() == 0


def test_itq_dedup_finds_pairs_just_above_the_threshold(spark):
    """3,000 planted pairs of cosine 0.9505 to 0.96 among clustered vectors: nearly all found, nothing else."""
    r = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(r.standard_normal((30, 64))[r.integers(0, 30, 3000)] * 0.5 + r.standard_normal((3000, 64)))
    away = r.standard_normal(base.shape)
    away = unit(away - (away * base).sum(1, keepdims=True) * base)
    cos = r.uniform(0.9505, 0.96, (3000, 1))
    both = np.concatenate([base, cos * base + np.sqrt(1 - cos * cos) * away]).astype(np.float32).astype(float)
    got = {x.vec_id: x.n_links for x in itq_dedup.near_duplicates(vectors_of(spark, [(i, v.tolist()) for i, v in enumerate(both)])).collect()}
    want = (unit(both) @ unit(both).T >= 0.95).sum(1) - 1
    assert all(got[i] <= want[i] for i in range(6000))
    assert sum(got.values()) >= 0.99 * want.sum() >= 0.99 * 6000


def test_exact_top_k(spark, monkeypatch):
    rows = [(i, v) for i, v in some_vectors() if i != 300]
    monkeypatch.setattr("gridjobs.llm.topk.SHARD", 40)
    monkeypatch.setattr("gridjobs.llm.topk.QUERY_BLOCK", 4)
    monkeypatch.setattr("gridjobs.llm.topk.FAN_IN", 3)
    got = {}
    for r in exact_top_k(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    v = {i: np.floor(64 * np.array(x, np.float32).astype(float)).astype(int) for i, x in rows if x and all(y is not None and np.isfinite(y) for y in x)}
    for q in (i for i in v if i % 20 == 0):
        own = sorted((-int(v[q] @ v[i]), i) for i in v if i != q and len(v[i]) == len(v[q]))
        assert got[q] == [(i, -s) for s, i in own[:7]]
    assert exact_top_k(vectors_of(spark, rows).limit(0), F.lit(True)).count() == 0


def test_packing(docs, empty):
    got = packing.pack(docs, JSON, RANKS, P.PATTERN, 64).collect()
    tok = packing.tokenizer(JSON)
    want = sorted((str(i), s, zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes()), len(ids)) for i, t in TEXTS for ids in [[*tok.encode(t or "", add_special_tokens=False).ids, 1]] for s in range(0, len(ids), 64))
    assert sorted((str(r.doc_id), r.start, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty, JSON, window=64).count() == 0


def test_ctw(spark, docs, empty):
    out = held_out(F.col("doc_id"), 7, 2)
    got = ctw.score_documents(docs, out).collect()
    assert len(got) == len(TEXTS)
    learn = [t or "" for i, t in TEXTS if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    count = {}
    for t in learn:
        for w in [*t.encode().lower().split(), None]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    by = {(r.doc_id, r.n_tokens): r for r in got}
    for i, t in TEXTS:
        own = [*(t or "").encode().lower().split(), None]
        r = by[i, len(own)]
        assert (r.train_tokens, r.n_known) == (n, sum(w in count for w in own))
        assert r.base_score == pytest.approx(sum(np.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in own))
        assert r.score < 0
    assert ctw.score_documents(empty, out).count() == 0


def labelled(spark):
    r = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(260):
        bad, rude = i % 4 == 0, i % 5 == 1
        w = words(i, 60).split()
        if bad:
            w = [x.upper() + "!!" for x in w[:5]] * 12
        if rude:
            for _ in range(3):
                w[int(r.integers(0, len(w)))] = ["slurx", "slurxish", "foulword"][int(r.integers(0, 3))]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(rude), "x"))
    labels += [(0, None, None, "x"), (None, 1, 1, "x"), (9999, 0, 1, "x"), (5, labels[5][1], labels[5][2], "x")]
    return docs_of(spark, [*rows, (300, None), (301, ""), (None, "no key"), (3, rows[3][1])]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize(("module", "column", "score", "at"), [(quality_mil, "quality", quality_mil.score_quality, 0.3), (toxicity_knn, "toxic", toxicity_knn.score_toxicity, 0.5)])
def test_classifiers(spark, empty, module, column, score, at):
    docs, labels = labelled(spark)
    model = module.learn(docs, labels)
    got = score(docs, model).join(labels.select("doc_id", column).distinct().filter(F.col(column).isNotNull()), "doc_id").filter(held_out(F.col("doc_id"), 5, 0)).collect()
    assert np.mean([(r.score >= at) == bool(r[column]) for r in got]) >= 0.9
    assert score(docs, model).count() == docs.count()
    assert all(0 <= r.score <= 1 for r in score(docs, model).collect())
    assert score(empty, model).count() == 0
    bare = module.learn(docs, labels.limit(0))
    assert score(docs, bare).count() == docs.count()
    assert score(empty, module.learn(empty, labels)).count() == 0


def test_block_max_is_exact():
    from collections import Counter

    r = np.random.default_rng(2)
    examples = [Counter((r.integers(0, 90, r.integers(0, 9)) ** 2 // 90).tolist()) for _ in range(700)]
    rows, terms, n = toxicity_knn.flat(examples)
    y, idf = np.array([int((4 in e) != (r.random() < 0.2)) for e in examples]), r.random(90) + 0.5  # term 4 tells
    index = toxicity_knn.BlockMaxIndex(rows, terms, n, y, np.arange(700), idf, {0: 3.0, 1: 1.0})
    assert 0 < len(index.dense) < 90 and sorted(index.ids.tolist()) == [i for i, e in enumerate(examples) if e]
    assert index.dense.dtype == np.float32
    dense = np.zeros((700, 90))
    for i, e in enumerate(examples):
        for t, c in e.items():
            dense[i, t] = (1 + np.log(c)) * index.weight[t]
    dense /= np.maximum(1e-12, np.sqrt((dense**2).sum(1)))[:, None]
    kept, own_y = dense[index.ids].astype(np.float32).astype(float), y[index.ids]
    ones, zeros = (np.array([[t in e for t in range(90)] for e, v in zip(examples, y, strict=True) if v == c and e]).sum(0) + 0.5 for c in (1, 0))
    b, d = (index.y == 1).sum() + 1 - ones, (index.y == 0).sum() + 1 - zeros
    telling = np.maximum(0, abs(np.log(ones / b) - np.log(zeros / d)) - 3 * np.sqrt(1 / ones + 1 / b + 1 / zeros + 1 / d))
    more = (1 + 3 * telling) ** 2 - 1
    assert (more > 0).any() and (index.weight == idf).all()  # telling terms vote, but don't change who is near
    sent = SimpleNamespace(value=index)
    a = r.normal(size=17)
    scores, found = toxicity_knn.Model(sent, None, "bigint", a, -0.2).score(examples[:90])
    alone = index.nearest(examples[:90], list(range(90)))
    for i, e in enumerate(examples[:90]):
        if not e:
            assert scores[i] == index.bare and not len(found[i][0])
            continue
        for (own, cosine, close), left in ((found[i], None), (alone[i], i)):
            cos = (kept @ dense[i]).round(10)
            cos[index.ids == left] = 0
            order = np.lexsort((np.arange(len(cos)), -cos))
            want = np.concatenate([[j for j in order if own_y[j] == c and cos[j] > 0][: index.k] for c in (1, 0)]).astype(int)
            assert own.tolist() == want.tolist() and cosine == pytest.approx(cos[want], abs=1e-9)
            assert close == pytest.approx(cos[want] + (kept[want] * more) @ dense[i], abs=1e-5)
        own, cosine, close = found[i]
        w = np.where(own_y[own] == 1, 1.0, 3.0) * close**2 / (1.05 - cosine.clip(max=1.0))
        v = np.clip((w @ own_y[own] + 0.02 * index.bare) / (w.sum() + 0.02), 1e-5, 1 - 1e-5)
        x = [np.log(v / (1 - v))]
        for by in (close, cosine):
            for c in (1, 0):
                best = sorted(by[own_y[own] == c], reverse=True)
                x += [np.log(sum(best[:k]) / k + 1e-4) for k in (1, 4, 16, 32)]
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-(a @ x - 0.2))), abs=1e-6)


def test_logistic_converges_on_parted_votes():
    x = np.r_[np.linspace(-6, -1, 300), np.linspace(1, 6, 40)]
    y = (x > 0).astype(float)
    a, b = toxicity_knn.logistic(np.c_[x, 0 * x], y, np.where(x > 0, 1.0, 8.0))
    assert 0.5 < a[0] < 20 and abs(a[1]) < 1e-6 and abs(b) < 20
    clear = abs(x) >= 1.5  # the ridge and the lighter class move the edge a little
    assert (((a[0] * x + b) > 0) == (y == 1))[clear].all()


def test_toxicity_with_string_keys(spark):
    """Keys of any type; a text's evidence is itself, where it is an example; clashing names; ties by key."""
    texts = [(f"k{i}", words(i // 2, 30) + (" slurx" if i % 6 < 2 else ""), f"t{i}") for i in range(80)]
    docs = spark.createDataFrame(texts, "name string, text string, t string")
    labels = spark.createDataFrame([(k, int(i % 6 < 2)) for i, (k, _, _) in enumerate(texts)], "name string, toxic int")
    learned = {r.name for r in docs.filter(~held_out(F.col("name"), 5, 0)).collect()}
    got = {r.name: r for r in toxicity_knn.score_toxicity(docs, toxicity_knn.learn(docs, labels, key="name"), key="name").collect()}
    assert len(got) == 80
    for i, (k, _, _) in enumerate(texts):
        same = sorted({k, texts[i ^ 1][0]} & learned)
        if same:
            assert got[k].nearest == same[0] and got[k].cosine == pytest.approx(1, abs=1e-6)


def test_html(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x"), (2, None, "x"), (3, "", "x"), (1, "<p>a", "x")], "page_id long, html string, text string")
    assert sorted(tuple(r) for r in html_text.extract_text(pages).collect()) == [(1, "a"), (1, "a"), (2, ""), (3, "")]
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_near_duplicates_stage_with_null_and_repeated_keys(spark):
    """One row of each group, by brute force over word n-grams; keys may be null or name several texts; a column is called row_id."""
    a, b, c, d = (words(i, 60) for i in (900, 901, 902, 903))
    rows = [(3, a), (5, a + " more"), (5, b), (None, b + " x"), (None, c), (None, c + " y"), (None, c + " y"), (7, d), (7, d), (7, d + " z"), (8, None), (8, ""), (9, ""), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row_id int")
    got = [(r.doc_id, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(got) == len(set(got)) == 7
    assert {(3, a), (5, b), (8, ""), (9, ""), (None, "")} <= set(got)
    rest = sorted((x for x in got if x[1][:60] in (c[:60], d[:60])), key=str)
    assert rest[0][0] == 7 and rest[0][1] in (d, d + " z")
    assert rest[1][0] is None and rest[1][1] in (c, c + " y")


def test_pipeline(spark, tmp_path):
    docs, labels = labelled(spark)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    copies = spark.createDataFrame([(500, words(2, 60)), (501, words(2, 60) + " tail"), (502, words(77, 80))], "doc_id long, text string")
    docs = docs.unionByName(copies, allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
    ids = {r.doc_id for r in kept.collect()}
    assert 502 in ids
    assert not {500, 501} & ids
    assert len(ids & {i for i in range(260) if i % 4 and i % 5 != 1}) >= 130
    assert len(ids & {i for i in range(260) if i % 4 == 0 or i % 5 == 1}) <= 8
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.select("doc_id").collect()} == ids
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
