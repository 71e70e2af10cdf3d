import re
import time

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gridjobs.llm import bpe, ctw, ngram_join, packing
from gridjobs.llm.blocks import pairs, roots
from gridjobs.llm.bpe import byte_pairs
from gridjobs.llm.chunks import ChunkEncoder, slices
from gridjobs.llm.html_text import html_to_text
from gridjobs.llm.itq_dedup import once, tables_of
from gridjobs.llm.quality_mil import AttentionBags, encode
from gridjobs.llm.sharding import longest_first
from gridjobs.llm.topk import NONE, best, products

from dense_tree import Tree

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "  a  b ", "\n x", "a　b  c\x1cd e\x85f", "1²½Ⅷ٣ áb 漢字かな", "a" * 700, "x \n\n  y\t\tz ", "don't I'll 'S", "é́ z\x00 \x1c q", "a \x1c b", " " * 50, "\n" * 9 + "a b\t "]


@pytest.fixture(scope="module")
def reference():
    pairs_ = byte_pairs(PATH, P.PATTERN)
    return pairs_, tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=pairs_.ranks, special_tokens={})


def test_bpe_odd_texts(reference):
    pairs_, enc = reference
    ids = ChunkEncoder(pairs_.encode_many).ids(ODD)
    assert ids == [np.array(enc.encode_ordinary(t), "<u4").tobytes() for t in ODD]
    assert [pairs_.decode(np.frombuffer(x, "<u4").tolist()).decode() for x in ids] == ODD


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
def test_bpe_any_text(texts):
    pairs_ = byte_pairs(PATH, P.PATTERN)
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=pairs_.ranks, special_tokens={})
    assert ChunkEncoder(pairs_.encode_many, 4).ids(texts) == [np.array(enc.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_ranks_and_tokenizer_agree():
    tok, fast = packing.tokenizer(P.path("byte_bpe_50k.json")), packing.ranks(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    encoder = ChunkEncoder(lambda new: [np.array(fast.encode_ordinary(t), "<u4").tobytes() for t in new])
    assert encoder.ids(ODD) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD]


def test_slices_cover_all():
    for texts in ([], ["a"], ["a" * 10, "", "b" * 3, ""]):
        assert [t for s in slices(texts, 5) for t in texts[s]] == texts


def test_plan_places_every_piece_once():
    have = np.bincount(np.r_[np.full(40, 700), np.arange(1, 60), np.full(7, 128), 3], minlength=701)
    window = 701
    have = np.r_[have, np.zeros(window + 1 - len(have), int)]
    p = packing.plan(have, window)
    fill, seen = {}, {}
    for r in p.itertuples():
        for k in range(r.first, r.last):
            seen[r.length, k] = seen.get((r.length, k), 0) + 1
            fill.setdefault(r.base + (k - r.first) // r.many, []).append((r.at + (k - r.first) % r.many * r.length, r.length))
    assert seen == {(length, k): 1 for length in range(1, window + 1) for k in range(have[length])}
    for own in fill.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window


def test_plan_wastes_little():
    have = np.bincount(np.minimum(2047, np.random.default_rng(0).lognormal(6.3, 1, 5000).astype(int) + 1), minlength=2049)
    p = packing.plan(have, 2048)
    n = (p["base"] + (p["last"] - p["first"] - 1) // p["many"]).max() + 1
    assert (have * np.arange(2049)).sum() / 2048 / n > 0.99


def one_by_one(sizes, counts, bins):
    loads, out = [0] * bins, {}
    for size, count in sorted(zip(sizes, counts, strict=True), reverse=True):
        out[size] = [0] * bins
        for _ in range(count):
            b = min(range(bins), key=lambda b: (loads[b], b))
            loads[b] += size
            out[size][b] += 1
    return [out[size] for size in sizes]


def test_longest_first_is_greedy():
    assert longest_first([5, 4, 3], [1, 1, 3], 2) == [[1, 0], [0, 1], [1, 2]]
    assert longest_first([], [], 3) == []
    r = np.random.default_rng(1)
    for top, most in ((20, 3), (300, 200), (5000, 400)):  # runs dealt one by one and runs dealt in one step
        for bins in (1, 3, 8):
            sizes = r.choice(np.arange(1, top), 12, replace=False).tolist()
            counts = r.integers(1, most, 12).tolist()
            assert longest_first(sizes, counts, bins) == one_by_one(sizes, counts, bins)


def test_best_breaks_ties_by_id():
    scores = np.array([[5, 7, 7, NONE, 5, 1]])
    s, i = best(scores, np.array([9, 3, 2, 1, 4, 8]), 4)
    assert s.tolist() == [[7, 7, 5, 5]]
    assert i.tolist() == [[2, 3, 4, 9]]
    big = np.array([[2**40, 1]])
    assert products(big, big)[0, 0] == np.int64(np.uint64((2**80 + 1) % 2**64))


def test_context_tree_is_a_distribution_and_follows_the_definition():
    texts = [b"abracadabra", b"abra", b"", b"cadabra " * 5]
    keys, n = ctw.Bytes(ctw.joined(texts, 2), np.array(list(map(len, texts))), 2).counted()
    cells = []
    for d in range(3):
        for k, m in zip(keys.tolist(), n.tolist(), strict=True):
            cells.append((d, k >> (8 * (3 - d)), k & 255, m))
    cells = pd.DataFrame(cells, columns=["d", "ctx", "sym", "n"]).groupby(["d", "ctx", "sym"], as_index=False).sum()
    tree = Tree(cells, 2)
    unseen = np.bincount(tree.code, minlength=tree.logs.shape[1])[-1]
    assert (10.0 ** (tree.logs[:, tree.code] + np.where(tree.code == tree.code.max(), tree.other, 0))).sum(1) == pytest.approx(1, abs=1e-4)
    assert tree.other == pytest.approx(-np.log10(unseen))
    assert (tree.zero + tree.one).sum(1).min() >= 1 and not (tree.zero * tree.one).any()
    # the first decision, by the recursion itself: half of the estimate, half of the product below
    counts, side = {}, tree.one[tree.code, -1].astype(int)
    for t in texts:
        s = b"\0\0" + t + b"\xff"
        for i in range(2, len(s)):
            for ctx in ((), (s[i - 1],), (s[i - 1], s[i - 2])):
                c = counts.setdefault(ctx, [0, 0])
                c[side[s[i]]] += 1
    kt = lambda c: float(ctw.log_kt(np.array([float(c[0])]), np.array([float(c[1])]))[0])

    def whole(ctx):
        below = [x for x in counts if len(x) == len(ctx) + 1 and x[: len(ctx)] == ctx]
        return kt(counts[ctx]) if not below else np.logaddexp(kt(counts[ctx]), sum(whole(x) for x in below)) - np.log(2)

    def one(path, ctx=()):
        c = counts[ctx]
        p = (c[1] + 0.5) / (sum(c) + 1)
        if len(ctx) == 2:
            return p
        w = np.exp(kt(c) - np.log(2) - whole(ctx))
        return w * p + (1 - w) * one(path, path[: len(ctx) + 1])

    state = tree.child[tree.child[0, tree.code[ord("r")]], tree.code[ord("b")]]
    assert (10.0 ** tree.logs[state])[tree.one[:, -1] == 1].sum() == pytest.approx(one((ord("r"), ord("b"))), rel=1e-3, abs=1e-6)
    assert tree.score([b"abra"])[0] > tree.score([b"zzzz"])[0]


def test_log_kt():
    from math import lgamma, log, pi

    pairs_of = [(0, 0), (0, 1), (3, 0), (7, 9), (4095, 1), (4096, 5000), (10**7, 3)]
    want = [lgamma(z + 0.5) + lgamma(o + 0.5) - lgamma(z + o + 1) - log(pi) for z, o in pairs_of]
    assert ctw.log_kt(*np.array(pairs_of, float).T) == pytest.approx(want, rel=1e-8, abs=1e-8)


def test_keys_are_found_and_summed_across_windows(monkeypatch):
    monkeypatch.setattr(ctw, "COUNTED", 7)
    monkeypatch.setattr(ctw, "SUMMED", 5)
    texts = [b"abracadabra", b"", b"abra", b"x" * 30]
    raw = ctw.Bytes(ctw.joined(texts, 3), np.array(list(map(len, texts))), 3)
    keys, n = raw.counted()
    assert [raw.text(i) for i in range(4)] == texts and raw.only(np.arange(4) == 1).counted()[1].tolist() == [1]
    want = {}
    for t in texts:
        s = b"\0\0\0" + t + ctw.END
        for i in range(3, len(s)):
            k = int.from_bytes(s[i - 3 : i][::-1] + s[i : i + 1], "big")
            want[k] = want.get(k, 0) + 1
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == want
    assert ctw.unpacked_keys(ctw.packed_keys(keys)).tolist() == keys.tolist()
    assert ctw.Lookup(keys, np.arange(len(keys)))(keys[::-1]).tolist() == list(range(len(keys)))[::-1]
    assert raw.sums(keys, np.ones(len(keys))).tolist() == [len(t) + 1 for t in texts]


def test_bayesian_bound():
    assert ngram_join.needed(125) < 100
    assert ngram_join.needed(25) <= 14
    sig = np.tile(np.arange(125, dtype=np.uint16), (2, 1))
    assert ngram_join.likely(sig, np.array([0]), np.array([1])).tolist() == [0]


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 40), st.integers(0, 10**6), st.booleans())
def test_linked_equals_sets(n, seed, cross):
    r = np.random.default_rng(seed)
    base = [r.integers(0, 40, 30) for _ in range(3)]
    sets = [np.unique(np.r_[base[i % 3][: 30 - r.integers(0, 5)], r.integers(0, 60, r.integers(0, 4))]).astype(np.uint64) for i in range(n)]
    side = r.integers(0, 2, n)
    got = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in ngram_join.linked(sets, cross, side)), strict=True)}
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if (not cross or side[i] != side[j]) and len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j])) - 1e-9}
    assert got == want


def test_pairs_and_roots():
    group = np.array([0, 0, 0, 1, 2, 2])
    cross, side = np.array([False] * 4 + [True] * 2), np.array([0, 0, 0, 0, 0, 1])
    got = {(int(a), int(b)) for i, j in pairs(group, cross, side) for a, b in zip(i, j, strict=True)}
    assert got == {(0, 1), (1, 2), (0, 2), (4, 5)}
    assert roots(6, np.array([5, 4, 1]), np.array([4, 3, 0])).tolist() == [0, 0, 2, 3, 3, 3]


def test_tables_follow_the_size():
    small, large = tables_of(1000, 64, 0.95), tables_of(10**7, 64, 0.95)
    assert small[0] < large[0]
    assert small[1] < large[1]
    assert 0 < small[2] < large[2] < large[0] * large[1] / 3


def test_near_keys_meet_once():
    r = np.random.default_rng(2)
    code = r.integers(0, 1 << 8, (40, 3)).astype(np.int32)
    for i in range(40):
        for j in range(i):
            differ = (code[i] ^ code[j])[None]
            near = [t for t in range(3) if int(differ[0, t]).bit_count() <= 2]
            taken = 0
            for t in range(3):
                both = {int(code[i, t]) ^ b for b in [0, *(1 << k for k in range(8))]} & {int(code[j, t]) ^ b for b in [0, *(1 << k for k in range(8))]}
                assert bool(both) == (t in near)
                taken += sum(once(np.array([t]), np.array([h]), differ, code[i][None])[0] for h in both)
            assert taken == bool(near)


def test_attention_gradients():
    r = np.random.default_rng(0)
    m = AttentionBags(5, 4, 3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, sizes, y, w = r.standard_normal((7, 5)), np.array([3, 1, 3]), np.array([1.0, 0, 1]), np.ones(3)
    loss = lambda: -np.mean(y * np.log(m.forward(x, sizes)["y"]) + (1 - y) * np.log(1 - m.forward(x, sizes)["y"]))
    g = m.gradients(x, sizes, y, w)
    for k in m.p:
        at = np.unravel_index(m.p[k].size // 2, m.p[k].shape)
        keep = m.p[k][at]
        m.p[k][at] = keep + 1e-5
        up = loss()
        m.p[k][at] = keep - 1e-5
        down = loss()
        m.p[k][at] = keep
        assert g[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_passages_cover_the_text():
    x, sizes = encode(["", "a" * 481, "b c"])
    assert sizes.tolist() == [1, 2, 1]
    assert len(x) == 4
    assert np.isfinite(x).all()


def test_html_layout():
    got = html_to_text(
        "<head><title>x</title></head><body><h1>T &amp; t</h1><p>a <b>b</b>  c<p>d<br>e<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>three</ul>"
        "<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>q<br>r<td>2</table><div hidden>no</div><div style='display: none'>no</div>"
        "<pre>\n  k\n   l</pre><script>if(a<b)'</p>'</script> <a href='x>y'>l</a> 3 < 4 <!-- c -->e"
    )
    assert got == "T & t\n\na b c\n\nd\ne\n\n- one\n- two\n  3. x\n  4. y\n- three\n\nName       N\nlong name  1\nq          2\nr\n\n  k\n   l\n\nl 3 < 4 e"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/abpdivtrliuhe \"'=!-&;", max_size=80))
def test_html_never_fails(source):
    html_to_text(source)


def test_html_deep_nesting_and_all_words():
    assert html_to_text("<div>" * 50_000 + "x") == "x"
    words = [f"w{i}" for i in range(300)]
    source = "".join(f"<{t}>{w}</{t}> " for w, t in zip(words, ["p", "b", "li", "td", "div", "h2", "span", "a", "em", "ul"] * 30, strict=True))
    assert re.findall(r"w\d+", html_to_text(source)) == words
    assert html_to_text(None) == html_to_text("") == ""


def test_html_quotes_open_strings_only_after_an_equals_sign():
    assert html_to_text("<p title=it's>Hello <b>don't</b> rest</p><p>tail</p>") == "Hello don't rest\n\ntail"
    assert html_to_text("""<p class="a"b'>Hello</p><p>more's here</p>""") == "Hello\n\nmore's here"
    assert html_to_text("""<p a = "x > y" b= 'z>' c=>one</p><p " d>two</p>""") == "one\n\ntwo"
    assert html_to_text("<div hidden='x'>no</div><div style=\"display:none\">no</div>yes") == "yes"


def test_html_cells_below_a_cell_that_spans_rows():
    page = "<table><tr><td rowspan=2>left<td>a<td rowspan=0>end<tr><td colspan=1>bb<tr><td>c<td>dd<tr><td colspan=2>wide one here</table>after"
    assert html_to_text(page).split("\n") == ["left  a   end", "      bb", "c     dd", "wide one here", "", "after"]
    assert html_to_text("<table><tr><td rowspan=99999 colspan=900>x</table><table><tr><td rowspan=a>y</table>") == "x\n\ny"


def test_html_visible_inside_hidden():
    show, hide = '<i style="visibility:visible">', '<div style="color: red; visibility: hidden !important">'
    assert html_to_text(f"a{hide}no {show}yes</i> no<p>no</div>b") == "a\nyes\nb"
    assert html_to_text(f'a<div style="visibility:hidden;display:none">no {show}no</i></div>b') == "ab"
    assert html_to_text('<div style="visibility:hidden; visibility:visible">shown</div>') == "shown"
    assert html_to_text(f"{hide}<ol><li>no<li>{show}two</i></ol><hr><q>no</q><br><table><tr><td>no<td>{show}cell</table></div>end").split("\n") == ["   two", "  cell", "end"]


def test_html_deep_nesting_is_linear():
    from time import process_time

    began = process_time()
    assert html_to_text("<div>" * 50_000 + "deep" + "</div>" * 50_000) == "deep"
    assert process_time() - began < 10


@pytest.mark.parametrize("kind", ["letters", "one", "few", "signs", "mixed"])
def test_long_unbroken_pieces_merge_as_tiktoken_says(kind, reference, monkeypatch):
    r = np.random.default_rng(4)
    alphabet = {"letters": "abcdefghijklmnopqrstuvwxyz", "one": "a", "few": "ab", "signs": "-=_*#", "mixed": "etaoinéßд漢"}[kind]
    pairs, enc = reference
    text = "".join(r.choice(list(alphabet), 1_000_000 if kind in ("letters", "one") else 20_000))
    start = time.monotonic()
    (got,) = pairs.encode_many([text])
    assert time.monotonic() - start < 60
    assert np.frombuffer(got, "<u4").tolist() == enc.encode_ordinary(text)
    monkeypatch.setattr(bpe, "LONG", 1)  # short pieces too, where ties and overlaps are dense
    for n in range(2, 60):
        piece = "".join(r.choice(list(alphabet), n))
        (got,) = pairs.encode_many([piece])
        assert np.frombuffer(got, "<u4").tolist() == enc.encode_ordinary(piece)
