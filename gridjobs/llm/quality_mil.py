"""Quality by attention-based multiple-instance learning: a document is a bag of passages, labelled as a whole."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import slices
from .common import whole
from .labelled import sample

#: Characters of a passage.
PASSAGE = 480
#: Labelled documents of each class to learn from, at most; all their passages are encoded.
PER_CLASS = 3_000
CLASSES = 11
WIDTH = CLASSES * CLASSES + 8


def byte_classes() -> np.ndarray:
    table = np.full(256, 0, np.int64)
    table[128:] = 8
    for c in range(33, 127):
        table[c] = 7
    for chars, number in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3), (" ", 4), ("\n", 5), (".,;:?'\"-()", 6), ("!", 9), ("|", 10)):
        table[[ord(c) for c in chars]] = number
    return table


TABLE = byte_classes()


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of the texts, in order, and the number of passages of each.

    A vector holds how often each class of character follows each other one, the shares of distinct and of repeated words,
    lengths, and the document's shares of distinct lines and words.
    """
    passages, sizes, extra = [], [], []
    for text in texts:
        lines, words = text.split("\n"), text.split()
        wide = (len(set(lines)) / len(lines), len(set(words)) / max(1, len(words)) ** 0.9, np.log1p(len(words)))
        starts = range(0, max(1, len(text)), PASSAGE)
        sizes.append(len(starts))
        for at in starts:
            piece = text[at : at + PASSAGE]
            own = piece.split()
            n = max(1, len(own))
            extra.append((*wide, len(set(own)) / n, sum(map(eq, own, own[1:])) / n, len(piece) / n / 8, np.log1p(len(own)), not piece))
            passages.append(piece.encode())
    n = np.array([len(p) for p in passages])
    raw = TABLE[np.frombuffer(b"".join(passages), np.uint8)]
    which = np.repeat(np.arange(len(passages)), n)
    pair = which[:-1] * (CLASSES * CLASSES) + raw[:-1] * CLASSES + raw[1:]
    pair = pair[which[:-1] == which[1:]] if len(raw) else pair
    seen = np.bincount(pair, minlength=len(passages) * CLASSES * CLASSES).reshape(len(passages), -1)
    return np.concatenate([np.sqrt(seen / np.maximum(1, n)[:, None]), np.array(extra, float)], 1).astype(np.float32), np.array(sizes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class AttentionBags:
    """h = tanh(x W + b); gate = tanh(h V) * sigmoid(h U); attention = softmax of gate . a within a bag; P = sigmoid(sum(attention * h) . c + d)."""

    def __init__(self, width: int, hidden: int = 32, gate: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        self.p = {"W": init(width, hidden), "b": np.zeros(hidden, np.float32), "V": init(hidden, gate), "U": init(hidden, gate), "a": init(gate), "c": init(hidden), "d": np.zeros(1, np.float32)}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Standardised by the training passages; what lies far beyond them counts as their edge."""
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        p, first, bag = self.p, np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        e = (t * s) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        w = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(w[:, None] * h, first)
        return {"h": h, "t": t, "s": s, "w": w, "z": z, "y": sigmoid(z @ p["c"] + p["d"][0]), "bag": bag, "first": first}

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, sizes)
        dy = ((f["y"] - y) * weight / weight.sum()).astype(np.float32)
        dz = dy[:, None] * p["c"]
        dh = f["w"][:, None] * dz[f["bag"]]
        dw = (f["h"] * dz[f["bag"]]).sum(1)
        de = f["w"] * (dw - np.add.reduceat(f["w"] * dw, f["first"])[f["bag"]])
        dts = de[:, None] * p["a"]
        dv, du = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
        dh = (dh + dv @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du, "a": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def fit(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, batch: int = 128, rate: float = 4e-3, decay: float = 1e-4) -> AttentionBags:
        """Adam on mini-batches of bags."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = self.scaled(x)
        first, r, step = np.cumsum(sizes) - sizes, np.random.default_rng(11), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for done in range(rounds):
            order = r.permutation(len(sizes))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                rows = np.concatenate([np.arange(first[i], first[i] + sizes[i]) for i in own])
                step += 1
                for k, g in self.gradients(x[rows], sizes[own], y[own], weight[own]).items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (1 - done / rounds) * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each text, and the number of its passage with the most attention."""
        x, sizes = encode(texts)
        f = self.forward(self.scaled(x), sizes)
        first = np.r_[f["first"], len(x)]
        return f["y"], np.array([int(f["w"][a:b].argmax()) for a, b in zip(first[:-1], first[1:], strict=True)])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, text: str = "text", key: str = "doc_id") -> AttentionBags:
    """Fit on a sample of at most per_class labelled documents of each class; weights restore the classes' shares."""
    rows, stands = sample(docs, labels, label, per_class, text, key)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts, 1_500_000):
                x, sizes = encode(texts[at])
                parts = np.split(x, np.cumsum(sizes)[:-1])
                yield pd.DataFrame({"k": pdf["k"].iloc[at], "y": pdf["y"].iloc[at], "x": [p.tobytes() for p in parts]})

    got = rows.select(F.col(key).cast("string").alias("k"), "y", "t").mapInPandas(features, "k string, y int, x binary").toPandas().sort_values("k")
    model = AttentionBags(WIDTH)
    if got["y"].nunique() < 2:  # nothing to tell apart: the share of good ones
        model.p = {k: np.zeros_like(v) for k, v in model.p.items()}
        model.p["d"][:] = 4.0 if len(got) and got["y"].iloc[0] == 1 else -4.0 if len(got) else 0.0
        return model
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in got["x"]]
    y = got["y"].to_numpy(np.float32)
    weight = np.where(y == 1, stands[1], stands[0]).astype(np.float32)
    return model.fit(np.concatenate(bags), np.array([len(b) for b in bags]), y, weight)


def score_quality(docs: DataFrame, model: AttentionBags, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Score every whole text: key, score, passage (the one with the most attention).

    A null text counts as empty, which is one empty passage with a score of its own; repeated rows each keep a row; an empty
    table gives no rows; other columns are never read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts, 1_500_000):
                y, passage = shared.value.score(texts[at])
                yield pd.DataFrame({key: pdf[key].iloc[at], "score": y.astype(float), "passage": passage})

    return docs.select(F.col(key), whole(F.col(text)).alias("t")).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, score double, passage long")


def filter_documents(docs: DataFrame, model: AttentionBags, least: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores `least` or more; only texts go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.to_list()
            yield pd.Series(np.concatenate([np.zeros(0), *(shared.value.score(texts[at])[0] for at in slices(texts, 1_500_000))]).astype(float))

    return docs.filter(score(whole(F.col(text))) >= least)
