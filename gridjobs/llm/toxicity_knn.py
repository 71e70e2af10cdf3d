"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

Every word of every sampled example is a term; its weight is (1 + log tf) * idf, and idf counts all documents. A text's nearest
examples of each class are found by the cosine of these weights alone. Then they vote: an example's vote is its closeness, which
counts the part of the cosine that comes from telling terms (whose share surely differs between the classes, by the lower bound
of the log odds ratio) more. What the votes of both classes mean is learned from the examples, each left out of its own search.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import slices
from .common import whole, written
from .labelled import sample
from .quality_mil import sigmoid

#: Labelled examples of each class in the index, at most.
PER_CLASS = 4_000
#: Neighbours of each class that vote; examples of a block; texts searched together.
NEIGHBOURS, BLOCK, TOGETHER = 32, 256, 32
#: How much more telling terms count in a vote, and standard errors that the odds ratio is lowered by.
TELLING, ERRORS = 3.0, 3.0
#: Votes of so many of the nearest examples of a class are summed up apart; closeness and cosine are held this far from 0.
NEAREST, LEAST = (1, 4, 16, 32), 1e-4
#: Votes are held this far from 0 and 1.
EDGE = 1e-5
#: Share of the examples from which on a term's weights are a dense row.
DENSE = 0.12
#: Texts of stored terms that are scored at once.
ROWS = 512
WORD = re.compile(r"\w+")
NONE = np.zeros(0, np.int32)


def spans(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each a up to its b, and which pair each comes from."""
    a, many = a.astype(np.int64), b.astype(np.int64) - a
    which = np.repeat(np.arange(len(a)), many)
    return np.arange(len(which)) + (a - np.cumsum(many) + many)[which], which


class Terms:
    """Numbers of the vocabulary's terms in a text, and their counts; what a chunk between spaces holds is looked up once."""

    def __init__(self, vocabulary: dict[str, int], most: int = 400_000):
        self.vocabulary, self.most, self.known = vocabulary, most, {}

    def look_up(self, chunks: Iterable[str]) -> None:
        if len(self.known) > self.most:
            self.known.clear()
        known, get = self.known, self.vocabulary.get
        for c in set(chunks).difference(known):
            i = get(c)  # a chunk that is a term holds no other
            known[c] = (i,) if i is not None else tuple(i for t in WORD.findall(c) if (i := get(t)) is not None)

    def distinct(self, text: str) -> list[int]:
        chunks = set(text.lower().split())
        self.look_up(chunks)
        return list(set().union(*map(self.known.__getitem__, chunks)))

    def __call__(self, text: str) -> dict[int, int]:
        chunks = Counter(text.lower().split())
        self.look_up(chunks)
        known, out = self.known, {}
        for c, n in chunks.items():
            for i in known[c]:
                out[i] = out.get(i, 0) + n
        return out


class Counted:
    """Terms of a text and their counts as two arrays, as they are stored, in place of a dict."""

    __slots__ = ("n", "terms")

    def __init__(self, terms: bytes, n: bytes):
        self.terms, self.n = np.frombuffer(terms, np.int32), np.frombuffer(n, np.int32)

    def __len__(self) -> int:
        return len(self.terms)


def flat(counts: list[dict[int, int]] | list[Counted]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, term and count, of all texts."""
    many = np.fromiter(map(len, counts), np.int64, len(counts))
    if counts and isinstance(counts[0], Counted):
        return np.repeat(np.arange(len(counts)), many), np.concatenate([c.terms for c in counts]).astype(np.int64), np.concatenate([c.n for c in counts]).astype(float)
    terms = np.fromiter(chain.from_iterable(counts), np.int64, int(many.sum()))
    n = np.fromiter(chain.from_iterable(c.values() for c in counts), float, int(many.sum()))
    return np.repeat(np.arange(len(counts)), many), terms, n


class BlockMaxIndex:
    """Weights by term over examples in blocks; a block's largest weight of each term bounds what it can reach.

    Terms that many examples hold are dense rows, whose part of the cosines is a matrix product; the others are postings, read
    only for blocks whose bound reaches the k-th best that is known so far. Examples' weights are single-precision numbers.
    """

    def __init__(self, rows: np.ndarray, terms: np.ndarray, n: np.ndarray, y: np.ndarray, ids: np.ndarray, idf: np.ndarray, stands: dict[int, float], telling: float = TELLING, k: int = NEIGHBOURS):
        """rows, terms, n: number of the example, term, count; y (1 or 0), ids: of each example. A block holds examples of one class."""
        self.k, share = k, np.array([stands.get(int(v), 1.0) for v in y])
        bare = np.bincount(rows, minlength=len(y)) == 0
        self.bare = (float((share * (y == 1))[bare].sum()) + 0.5) / (float(share[bare].sum()) + 50.0)
        self.weight = idf
        w = self.weighted(rows, terms, n, len(y))
        # toxic examples first; then like ones side by side, so that few blocks hold much of a term; those without any term are left out
        order = np.lexsort((-w, rows))
        first = np.flatnonzero(np.r_[True, np.diff(rows[order]) > 0]) if len(rows) else np.zeros(0, int)
        some, leading = rows[order][first], terms[order][first]
        some = some[np.lexsort((ids[some], leading, -y[some]))]
        place = np.zeros(len(y), np.int64)
        place[some] = np.arange(len(some))
        self.y, self.ids, self.stands = y[some].astype(float), ids[some], np.array([stands.get(1, 1.0), stands.get(0, 1.0)])
        self.size, ones = len(some), int((y[some] == 1).sum())
        self.repeats = int(np.unique(self.ids, return_counts=True)[1].max()) if len(some) else 0  # rows that share an id
        # columns: as rows, but the other class begins with a block of its own
        begin = -(-ones // BLOCK) * BLOCK
        self.blocks = (begin - (ones - self.size) + BLOCK - 1) // BLOCK
        self.classes = [(row, at, many) for row, at, many in ((0, 0, ones), (ones, begin, self.size - ones)) if many]
        rows = place[rows]
        # the telling terms of each example: what they add to its closeness
        more = (1 + telling * told_apart(terms, rows, self.y, len(idf))) ** 2 - 1
        at = np.flatnonzero(more[terms] > 0)
        at = at[np.argsort(rows[at], kind="stable")]
        self.told = np.searchsorted(rows[at], np.arange(self.size + 1))
        self.told_terms, self.told_more = terms[at].astype(np.int32), (w[at] * more[terms[at]]).astype(np.float32)
        rows = rows + (rows >= ones) * (begin - ones)
        held = np.bincount(terms, minlength=len(idf))
        self.dense_of = np.full(len(idf), -1, np.int64)
        often = np.flatnonzero(held > DENSE * self.size)
        self.dense_of[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.blocks * BLOCK), np.float32)
        at = self.dense_of[terms] >= 0
        self.dense[self.dense_of[terms[at]], rows[at]] = w[at]
        rows, terms, w = rows[~at], terms[~at], w[~at]
        order = np.lexsort((rows, terms))
        rows, terms, self.weights = rows[order], terms[order], w[order].astype(np.float32)
        # runs of a term's postings in one block: where they start, the block, the largest weight
        block = rows // BLOCK
        self.run = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])]) if len(terms) else np.zeros(0, int)
        self.rows, self.block = rows.astype(np.min_scalar_type(self.blocks * BLOCK)), block[self.run].astype(np.min_scalar_type(self.blocks))
        self.most = np.maximum.reduceat(self.weights, self.run) if len(self.run) else np.zeros(0, np.float32)
        self.runs = np.searchsorted(terms[self.run], np.arange(len(idf) + 1)).astype(np.int32)
        self.run = np.r_[self.run, len(terms)].astype(np.int32)

    def weighted(self, rows: np.ndarray, terms: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
        """Weights of length 1 for each text."""
        w = (1 + np.log(n)) * self.weight[terms]
        return w / np.maximum(1e-12, np.sqrt(np.bincount(rows, w * w, size)))[rows]

    def nearest(self, counts: list[dict[int, int]], leave: list | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the rows, cosines and closenesses of its k nearest examples of each class, by class and falling cosine.

        Cosines are exact to ten decimals, ties by row. leave: an id for each text, to be left out.
        """
        many, wide = len(counts), self.blocks * BLOCK
        if not self.size:
            return [(NONE, np.zeros(0), np.zeros(0))] * many
        q, t, n = flat(counts)
        w = self.weighted(q, t, n, many)
        starts, all_terms, all_weights = np.searchsorted(q, np.arange(many + 1)), t, w
        of = self.dense_of[t]
        asked = np.zeros((many, len(self.dense)))
        asked[q[of >= 0], of[of >= 0]] = w[of >= 0]
        if self.dense.dtype != np.float64:
            self.dense = self.dense.astype(np.float64)  # sums are taken in double precision; what is sent is half as large
        found = asked @ self.dense
        q, t, w = q[of < 0], t[of < 0], w[of < 0]
        run, own = spans(self.runs[t], self.runs[t + 1])
        cell = q[own] * self.blocks + self.block[run]
        bound = found.reshape(many, self.blocks, BLOCK).max(2).ravel() + np.bincount(cell, w[own] * self.most[run], many * self.blocks)
        def read(wanted: np.ndarray) -> np.ndarray:
            here = np.flatnonzero(wanted[cell])
            first, of_run = self.run[run[here]], own[here]
            length = self.run[run[here] + 1] - first
            posting, _ = spans(first, first + length)
            place = np.repeat(q[of_run] * wide, length) + self.rows[posting]
            return np.bincount(place, np.repeat(w[of_run], length) * self.weights[posting], many * wide).reshape(many, wide)

        # the blocks of a class's largest bounds first: most others can't reach what they hold
        best, kth = np.zeros((many, self.blocks), bool), {}
        for row, at, size in self.classes:
            own_blocks = bound.reshape(many, -1)[:, at // BLOCK : -(-(at + size) // BLOCK)]
            few = min(2, own_blocks.shape[1])
            best[np.arange(many)[:, None], at // BLOCK + np.argpartition(-own_blocks, few - 1, 1)[:, :few]] = True
            kth[row] = min(self.k + (leave is not None) * self.repeats, size)
        found += read(best.ravel())
        left = np.zeros((many, self.blocks), bool)
        for row, at, size in self.classes:
            mine = slice(at // BLOCK, -(-(at + size) // BLOCK))
            known = np.where(np.repeat(best[:, mine], BLOCK, 1)[:, :size], found[:, at : at + size], 0)
            reach = np.partition(known, size - kth[row], 1)[:, size - kth[row]]
            left[:, mine] = ~best[:, mine] & (bound.reshape(many, -1)[:, mine] >= reach[:, None] - 1e-9)
        found += read(left.ravel())
        self.read = float((best | left).mean())
        found = np.where(np.repeat(best | left, BLOCK, 1), found, 0).round(10)
        out = []
        asks = np.zeros(len(self.weight))
        for i in range(many):
            rows, cosines = [], []
            for row, at, size in self.classes:
                cosine = found[i, at : at + size]
                if leave is not None:
                    cosine[self.ids[row : row + size] == leave[i]] = 0
                k = min(self.k, size)
                least = np.partition(cosine, size - k)[size - k]
                near = np.flatnonzero(cosine >= max(least, 1e-10))
                near = near[np.lexsort((near, -cosine[near]))][:k]
                rows.append(row + near)
                cosines.append(cosine[near])
            rows, cosine = np.concatenate(rows), np.concatenate(cosines)
            mine = slice(starts[i], starts[i + 1])
            asks[all_terms[mine]] = all_weights[mine]
            told, of_row = spans(self.told[rows], self.told[rows + 1])
            out.append((rows, cosine, cosine + np.bincount(of_row, asks[self.told_terms[told]] * self.told_more[told], len(rows))))
            asks[all_terms[mine]] = 0
        return out

    def sums(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each text the log odds of the toxic share of all votes, each weighted by closeness and by the examples it stands for; then the logs of each class's mean closeness and mean cosine."""
        by = np.zeros((2, len(found), 2, self.k))  # closeness and cosine, by text and class
        for i, (rows, cosine, close) in enumerate(found):
            m = int(np.searchsorted(-self.y[rows], -0.5))  # toxic ones come first
            by[0, i, 0, :m], by[0, i, 1, : len(rows) - m] = close[:m], close[m:]
            by[1, i, 0, :m], by[1, i, 1, : len(rows) - m] = cosine[:m], cosine[m:]
        w = (by[0] ** 2 / (1.05 - np.minimum(by[1], 1.0))).sum(2) * self.stands
        v = np.clip((w[:, 0] + 0.02 * self.bare) / (w.sum(1) + 0.02), EDGE, 1 - EDGE)
        sums = np.cumsum(-np.sort(-by, 3), 3)[..., np.minimum(NEAREST, self.k) - 1]
        logs = np.log(sums / NEAREST + LEAST)
        return np.c_[np.log(v / (1 - v)), logs[0].reshape(len(found), -1), logs[1].reshape(len(found), -1)]

    def votes(self, counts: list[dict[int, int]], leave: list | None = None) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """For each text what its neighbours' votes sum up to, by closeness and by the bare cosine, and the neighbours."""
        found = []
        for i in range(0, len(counts), TOGETHER):
            found += self.nearest(counts[i : i + TOGETHER], leave and leave[i : i + TOGETHER])
        return self.sums(found), found


def told_apart(terms: np.ndarray, rows: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """How far each term's log odds ratio between the classes lies from 0, less ERRORS standard errors; 0 where it may be chance."""
    ones = np.bincount(terms, y[rows] == 1, size)
    zeros = np.bincount(terms, minlength=size) - ones
    a, b, c, d = ones + 0.5, (y == 1).sum() - ones + 0.5, zeros + 0.5, (y != 1).sum() - zeros + 0.5
    return np.maximum(0, np.abs(np.log(a / b) - np.log(c / d)) - ERRORS * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of the columns, and the constant, of the weighted logistic regression of y on x, by Newton's method, each step halved until the loss falls.

    Columns are brought to mean 0 and spread 1 inside; a small ridge keeps parted classes finite.
    """
    w = w / w.sum()
    mean = w @ x
    spread = np.sqrt(w @ (x - mean) ** 2) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    keep = ridge * np.r_[np.ones(x.shape[1]), 1e-3]
    loss = lambda v: float(w @ (np.logaddexp(0, z @ v) - y * (z @ v)) + 0.5 * keep @ v**2)
    v = np.zeros(z.shape[1])
    for _ in range(100):
        p = sigmoid(z @ v)
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (w * (p - y)) + keep * v)
        size = 1.0
        while size > 1e-6 and loss(v - size * step) > loss(v):
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    a = v[:-1] / spread
    return a, float(v[-1] - a @ mean)


class Model(NamedTuple):
    """An index and its vocabulary as the tasks get them, each sent once, and the calibration of its votes."""

    index: Broadcast
    vocabulary: Broadcast
    key: str = "bigint"  # type of the examples' ids
    a: np.ndarray | None = None  # None: the first of the votes' figures as it is
    b: float = 0.0

    def score(self, counts: list[dict[int, int]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Calibrated scores, and the neighbours; a text without any term has the rate of such examples."""
        x, found = self.index.value.votes(counts)
        return np.where([len(c) > 0 for c in counts], sigmoid(x @ self.a + self.b if self.a is not None else x[:, 0]), self.index.value.bare), found


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, text: str = "text", key: str = "doc_id", telling: float = TELLING) -> Model:
    """Index of at most per_class labelled examples of each class, over all their words.

    Document frequencies are counted over all documents. key may be of any type that Python orders. Votes are calibrated by a
    logistic regression on the examples' own votes, each left out of its own search.
    """
    return learn_with(docs, labels, label, per_class, text, key, telling, keep=False)[0]


def learn_with(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, text: str = "text", key: str = "doc_id", telling: float = TELLING, keep: bool = True) -> tuple[Model, DataFrame | None]:
    """As learn; with keep, also the terms of every document (key, terms, counts), written as frequencies are counted, so that texts are taken apart once."""
    spark = docs.sparkSession
    rows, stands = sample(docs, labels, label, per_class, text, key)
    rows = written(rows.select(F.col(key).alias("id"), "y", "t"), "toxicity-examples")

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"term": list({t for x in pdf["t"] for t in WORD.findall(x.lower())})})

    vocabulary = {t: i for i, t in enumerate(sorted(rows.select("t").mapInPandas(terms, "term string").distinct().toArrow().column("term").to_pylist()))}  # terms of 2 * per_class rows
    shared = spark.sparkContext.broadcast(vocabulary)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, df, total = Terms(shared.value), np.zeros(len(shared.value), np.int64), 0
        for pdf in batches:
            total += len(pdf)
            for t in pdf["t"]:
                df[find.distinct(t)] += 1
        some = np.flatnonzero(df)
        yield pd.DataFrame({"i": np.r_[-1, some], "n": np.r_[total, df[some]]})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Terms(shared.value)
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts):
                found = [find(t) for t in texts[at]]
                yield pd.DataFrame({key: pdf[key].iloc[at].to_numpy(), "terms": [np.fromiter(c, np.int32, len(c)).tobytes() for c in found], "counts": [np.fromiter(c.values(), np.int32, len(c)).tobytes() for c in found]})

    def frequencies_kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(len(shared.value), np.int64), 0
        for pdf in batches:
            total += len(pdf)
            df += np.bincount(np.frombuffer(b"".join(pdf["terms"]), np.int32), minlength=len(df))
        some = np.flatnonzero(df)
        yield pd.DataFrame({"i": np.r_[-1, some], "n": np.r_[total, df[some]]})

    kept = None
    if keep:
        kept = written(docs.select(F.col(key), whole(F.col(text)).alias("t")).mapInPandas(counted, f"{key} {dict(docs.dtypes)[key]}, terms binary, counts binary"), "toxicity-terms")
        each = kept.select("terms").mapInPandas(frequencies_kept, "i int, n long")
    else:
        each = docs.select(whole(F.col(text)).alias("t")).mapInPandas(frequencies, "i int, n long")
    got = each.groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # a row for each term of the vocabulary
    df = np.zeros(len(vocabulary) + 1)
    df[got.column("i").to_numpy()] = got.column("n").to_numpy()  # the last place has the number of documents
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Terms(shared.value)
        for pdf in batches:
            found = [find(t) for t in pdf["t"]]
            yield pd.DataFrame({"id": pdf["id"], "y": pdf["y"], "terms": [np.fromiter(c, np.int32, len(c)).tobytes() for c in found], "counts": [np.fromiter(c.values(), np.int32, len(c)).tobytes() for c in found]})

    got = rows.mapInPandas(vectors, f"id {dict(docs.dtypes)[key]}, y int, terms binary, counts binary").toArrow()  # 2 * per_class rows
    ids, y = np.array(got.column("id").to_pylist()), got.column("y").to_numpy()
    own_terms, own_counts = ([np.frombuffer(x, np.int32) for x in got.column(c).to_pylist()] for c in ("terms", "counts"))
    own = np.repeat(np.arange(len(ids)), [len(x) for x in own_terms])
    index = BlockMaxIndex(own, np.concatenate([NONE, *own_terms]).astype(np.int64), np.concatenate([NONE, *own_counts]).astype(float), y, ids, idf, stands, telling)
    model = Model(spark.sparkContext.broadcast(index), shared, dict(docs.dtypes)[key])
    if len(index.y) < 20 or index.y.min() == index.y.max():
        return model, kept

    def leave_one_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Terms(model.vocabulary.value)
        for pdf in batches:
            counts = [find(t) for t in pdf["t"]]
            some = np.array([len(c) > 0 for c in counts])
            yield pd.DataFrame({"y": pdf["y"], "x": list(model.index.value.votes(counts, pdf["id"].to_list())[0])})[some]

    got = rows.repartition(4 * spark.sparkContext.defaultParallelism, "id").mapInPandas(leave_one_out, "y int, x array<double>").toArrow()  # 2 * per_class rows
    y = got.column("y").to_numpy()
    a, b = logistic(np.array(got.column("x").to_pylist()), y.astype(float), np.array([stands[int(v)] for v in y]))
    return model._replace(a=a, b=b), kept


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Score every whole text: key, score, and the evidence: nearest (id of the closest example), cosine, toxic_near (toxic ones among the nearest NEIGHBOURS of both classes).

    A null text counts as empty; a text without any term of the vocabulary has the rate of toxic ones among such examples, and no
    evidence; of equally near examples those first in the index count (toxic ones, like examples side by side, then by id); repeated rows each
    keep a row; an empty table gives no rows; other columns are never read. Cosines are taken over the examples' terms.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Terms(model.vocabulary.value)
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts):
                yield evidence(model, key, pdf[key].iloc[at].to_numpy(), [find(t) for t in texts[at]])

    return docs.select(F.col(key), whole(F.col(text)).alias("t")).mapInPandas(run, scored_schema(docs, model, key))


def score_terms(terms: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """As score_toxicity, from the terms that learn_with has kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), ROWS):
                some = pdf.iloc[i : i + ROWS]
                yield evidence(model, key, some[key].to_numpy(), [Counted(t, n) for t, n in zip(some["terms"], some["counts"], strict=True)])

    return terms.mapInPandas(run, scored_schema(terms, model, key))


def scored_schema(df: DataFrame, model: Model, key: str) -> str:
    return f"{key} {dict(df.dtypes)[key]}, score double, nearest {model.key}, cosine double, toxic_near int"


def evidence(model: Model, key: str, keys: np.ndarray, counts: list[dict[int, int]] | list[Counted]) -> pd.DataFrame:
    index = model.index.value
    scores, found = model.score(counts)
    near = [(rows[by], cosine[by]) for rows, cosine, _ in found for by in [np.argsort(-cosine, kind="stable")[: index.k]]]
    nearest = pd.Series([index.ids[r[0]].item() if len(r) else None for r, _ in near], dtype=object)
    return pd.DataFrame({key: keys, "score": scores, "nearest": nearest, "cosine": [c[0] if len(c) else 0.0 for _, c in near], "toxic_near": [int(index.y[r].sum()) for r, _ in near]})


def filter_documents(docs: DataFrame, model: Model, below: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below `below`; only texts go to Python. Null, empty, repeated and very long texts are scored as score_toxicity does."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = Terms(model.vocabulary.value)
        for texts in batches:
            texts = texts.to_list()
            yield pd.Series(np.concatenate([np.zeros(0), *(model.score([find(t) for t in texts[at]])[0] for at in slices(texts))]))

    return docs.filter(score(whole(F.col(text))) < below)
