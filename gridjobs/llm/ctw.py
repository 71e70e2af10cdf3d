"""Language-model scoring by context-tree weighting over bytes, beside a smoothed word-count baseline.

A byte is a run of binary decisions down a Huffman tree of the training bytes, so that frequent bytes take few; bytes that
no training text holds share one leaf. Each decision is a node, whose tree splits by the preceding bytes, nearest first. A
context has its place if the corpus visits it, so the tree grows with the corpus and stays dealt out by the nearest bytes; a
context's other continuations stay together in one further leaf. At each context the Krichevsky-Trofimov estimate
stands against the product of what lies below it, half each; the posterior weights mix the estimates of all depths.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from copy import copy

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import slices
from .common import partitions, whole, written

#: Preceding bytes of the longest context (seven at most: with the symbol they make a 64-bit key), and visits that a context needs for a place of its own.
DEPTH, LEAST = 6, 1
#: The tree is dealt out by so many nearest bytes of the context; chunks whose contexts one task looks up.
DEAL, TOGETHER = 3, 64
#: Closes every text; no UTF-8 text holds it. Zeros stand before a text's first byte.
END = b"\xff"
#: Characters of a chunk; bytes whose contexts are packed at once where they are counted and where they are looked up.
CHARS, COUNTED, SUMMED = 14_000_000, 4_000_000, 1_000_000
#: Counts whose gamma functions are tabled.
SMALL = 4096


# --- the tree -------------------------------------------------------------------------------------------------------


def stirling(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for large x."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


#: ln gamma(n + 1/2) and ln gamma(n + 1) for n = 0, 1, ...
HALVES = np.cumsum(np.r_[0.5 * np.log(np.pi), np.log(np.arange(SMALL - 1) + 0.5)])
WHOLES = np.cumsum(np.r_[0.0, np.log(np.arange(1, SMALL))])


def tabled(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    out = table[np.minimum(n, SMALL - 1).astype(np.int64)]
    large = n >= SMALL
    if large.any():
        out[large] = stirling(n[large] + shift)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return tabled(zeros, HALVES, 0.5) + tabled(ones, HALVES, 0.5) - tabled(zeros + ones, WHOLES, 1.0) - np.log(np.pi)


def decomposition(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Huffman's tree over symbols that occur n times: which symbols (rows) lie on the zero and the one side of each node."""
    heap = [(float(c), i, 1 << i) for i, c in enumerate(n)]
    heapq.heapify(heap)
    sides = []
    while len(heap) > 1:
        (c0, _, zero), (c1, _, one) = heapq.heappop(heap), heapq.heappop(heap)
        sides.append((zero, one))
        heapq.heappush(heap, (c0 + c1, len(n) + len(sides), zero | one))
    held = lambda k: np.array([[s[k] >> i & 1 for s in sides] for i in range(len(n))], np.float64).reshape(len(n), len(sides))
    return held(0), held(1)


class Paths:
    """The decisions on the way to each symbol: nodes, and whether the one side is taken."""

    def __init__(self, n: np.ndarray):
        """n: how often each byte value occurs in the training texts."""
        seen = np.union1d([0], np.flatnonzero(n))  # zeros stand before texts
        self.code = np.full(256, len(seen), np.int64)
        self.code[seen] = np.arange(len(seen))
        self.other = -np.log10(max(1, 256 - len(seen)))
        zero, one = decomposition(np.r_[n[seen], 0].astype(float))
        column, node = np.nonzero(zero + one)
        self.node = node.astype(np.uint64)
        self.bit = one[column, node]
        self.edge = np.searchsorted(column, np.arange(len(seen) + 2))
        self.root = zero.shape[1] - 1

    def expand(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each decision on the way to each key's symbol: the number of the key, the node, the side."""
        column = self.code[(keys & np.uint64(255)).astype(np.int64)]
        first, many = self.edge[column], self.edge[column + 1] - self.edge[column]
        row = np.repeat(np.arange(len(keys)), many)
        at = np.arange(len(row)) + np.repeat(first - np.cumsum(many) + many, many)
        return row, self.node[at], self.bit[at]


class Level:
    """Contexts of one depth by node, packed as context << 8 | node in ascending order, with zeros and ones; only decisions met there are held."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        add = lambda x: np.add.reduceat(x[order], first) if len(first) else np.zeros(0)
        self.key, self.zeros, self.ones = key[first], add(zeros), add(ones)

    def above(self) -> np.ndarray:
        return self.key >> 16 << 8 | self.key & 255

    def often(self, root: int, least: int) -> None:
        """Keep the contexts that are visited `least` times or more; the root's decision is made at each visit."""
        context, own = self.key >> 8, np.flatnonzero(self.key & 255 == root)
        if len(own):
            keep = (self.zeros + self.ones)[own][np.searchsorted(context[own], context)] >= least
            self.key, self.zeros, self.ones = self.key[keep], self.zeros[keep], self.ones[keep]

    def under(self, below: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the contexts right below hold: zeros, ones, ln of their block probabilities."""
        at, n = np.searchsorted(self.key, below.above()), len(self.key)
        return np.bincount(at, below.zeros, n), np.bincount(at, below.ones, n), np.bincount(at, below.total, n)

    def weigh(self, root: int, zeros: np.ndarray, ones: np.ndarray, total: np.ndarray) -> None:
        """Block probabilities, the weight of stopping, and the counts of continuations that have no context of their own.

        zeros, ones, total: what lies right below, as `under` gives it.
        """
        own = log_kt(self.zeros, self.ones)
        self.rest = self.zeros - zeros, self.ones - ones
        context, roots = self.key >> 8, self.key & 255 == root
        parted = np.isin(context, context[roots & (zeros + ones > 0)])
        split = np.where(parted, log_kt(*self.rest) + total, own)
        self.total = np.where(parted, np.logaddexp(own, split) - np.log(2), own)
        self.stop = np.where(parted, np.exp(np.minimum(0, own - np.log(2) - self.total)), 1.0)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(key), int), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, self.key[at] == key


def nothing(level: Level) -> tuple[np.ndarray, ...]:
    return (np.zeros(len(level.key)),) * 3


def grown(keys: np.ndarray, n: np.ndarray, paths: Paths, depth: int, deal: int, least: int) -> tuple[Level, list[Level]]:
    """From pairs of context and symbol: the level right above `deal`, not weighed, and those from there to depth, weighed from the deepest up."""
    row, node, bit = paths.expand(keys)
    levels = [Level((keys >> np.uint64(8))[row] << 8 | node, n[row] * (1 - bit), n[row] * bit)]
    for _ in range(depth - deal + 1):
        levels.insert(0, Level(levels[0].above(), levels[0].zeros, levels[0].ones))
    below = None
    for level in reversed(levels[1:]):
        level.often(paths.root, least)
        level.weigh(paths.root, *(nothing(level) if below is None else level.under(below)))
        below = level
    return levels[0], levels[1:]


def predicted(levels: list[Level], paths: Paths, keys: np.ndarray, depth: int) -> np.ndarray:
    """log10 probability of each key's symbol after its context, by the levels from depth 0 on."""
    row, node, bit = paths.expand(keys)
    one, given, left = np.full(len(row), 0.5), np.zeros(len(row)), np.ones(len(row))
    context, at = keys >> np.uint64(8), np.arange(len(row))
    inside = np.ones(len(keys), bool)  # whether the context of this depth has its place
    for d, level in enumerate(levels):
        place, met = level.find(context[row[at]] >> 8 * (depth - d) << 8 | node[at])
        one[at[~met]] = given[at[~met]] + left[at[~met]] / 2  # nothing is known of this decision from here on
        at, place = at[met], place[met]
        z, o = level.zeros[place], level.ones[place]
        so_far = given[at] + left[at] * level.stop[place] * ((o + 0.5) / (z + o + 1))
        open_ = left[at] * (1 - level.stop[place])
        z, o = level.rest[0][place], level.rest[1][place]
        one[at] = so_far + open_ * ((o + 0.5) / (z + o + 1))
        if d < depth:
            given[at], left[at] = so_far, open_
            inside[inside] = levels[d + 1].find(context[inside] >> 8 * (depth - d - 1) << 8 | paths.root)[1]
            at = at[inside[row[at]]]
    one = np.clip(one, 1e-12, 1 - 1e-12)
    out = np.bincount(row, np.log10(np.where(bit > 0, one, 1 - one)), len(keys))
    return out + np.where(paths.code[(keys & np.uint64(255)).astype(np.int64)] == len(paths.edge) - 2, paths.other, 0.0)


def upper(joint: pd.DataFrame, paths: Paths, deal: int, least: int) -> list[Level]:
    """The levels above `deal`, weighed. joint: the parts' sums of the lowest of them: key, zeros, ones and what lies right below."""
    joint = joint.sort_values("key")
    columns = [joint[c].to_numpy(float) for c in ("zeros", "ones", "zeros_under", "ones_under", "total_under")]
    levels = [Level(joint["key"].to_numpy(np.uint64), *columns[:2])]
    for _ in range(deal - 1):
        levels.insert(0, Level(levels[0].above(), levels[0].zeros, levels[0].ones))
    every, below = levels[-1].key, None
    for d in range(deal - 1, -1, -1):
        level = levels[d]
        if d:
            level.often(paths.root, least)
        level.weigh(paths.root, *(level.under(below) if below else (x[np.isin(every, level.key)] for x in columns[2:])))
        below = level
    return levels


# --- texts as keys --------------------------------------------------------------------------------------------------


def joined(texts: list[bytes], depth: int) -> bytes:
    pad = b"\0" * depth
    return b"".join([pad + t + END for t in texts])


class Bytes:
    """Joined texts of so many bytes, each after `depth` zeros and closed by END; keys pack a context, nearest byte first, and its symbol."""

    def __init__(self, raw: bytes, size: np.ndarray, depth: int):
        self.raw, self.depth, self.size = np.frombuffer(raw, np.uint8), depth, size + depth + 1
        self.first = np.cumsum(self.size) - self.size
        self.coded = np.ones(len(self.raw), bool)
        for i in range(depth):
            self.coded[self.first + i] = False

    def text(self, i: int) -> bytes:
        return self.raw[self.first[i] + self.depth : self.first[i] + self.size[i] - 1].tobytes()

    def windows(self, wide: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Where a window starts, its keys, and which of them are coded."""
        for a in range(self.depth, len(self.raw), wide):
            b = min(a + wide, len(self.raw))
            key = np.zeros(b - a, np.uint64)
            for d in range(1, self.depth + 1):
                key <<= np.uint64(8)
                key |= self.raw[a - d : b - d]
            key <<= np.uint64(8)
            key |= self.raw[a:b]
            yield a, key, self.coded[a:b]

    def only(self, some: np.ndarray) -> Bytes:
        """The same with only some texts coded."""
        out = copy(self)
        out.coded = self.coded & np.repeat(some, self.size)
        return out

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of coded symbols, ascending, and their counts."""
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, key, coded in self.windows(COUNTED):
            key = key[coded]
            key.sort()
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
            keys, n = added([keys, key[first]], [n, np.diff(np.r_[first, len(key)])])
        return keys, n

    def sums(self, keys: np.ndarray, value: np.ndarray) -> np.ndarray:
        """For each text the sum of its symbols' values; keys holds every key of the texts."""
        find, out = Lookup(keys, value), np.zeros(len(self.first))
        for a, key, coded in self.windows(SUMMED):
            at = np.zeros(len(key))
            at[coded] = find(key[coded])
            t = slice(int(np.searchsorted(self.first, a, "right")) - 1, int(np.searchsorted(self.first, a + len(key) - 1, "right")))
            out[t] += np.add.reduceat(at, np.maximum(self.first[t] - a, 0))
        return out


def added(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of ascending runs, ascending, and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(key, kind="stable")  # merges runs
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    return key[first], np.add.reduceat(n, first) if len(first) else n


class Lookup:
    """Values of keys that are all known, by a sparse hash table with linear probing, keys and values in its order."""

    def __init__(self, keys: np.ndarray, value: np.ndarray):
        self.size = max(8, 3 * len(keys))
        self.keys, self.value = np.full(self.size, 2**64 - 1, np.uint64), np.zeros(self.size, value.dtype)  # no key is all ones
        pos = self.hash(keys)
        while len(keys):
            free = self.keys[pos] == self.keys.dtype.type(2**64 - 1)
            self.keys[pos[free]] = keys[free]
            out = self.keys[pos] != keys
            self.value[pos[~out]] = value[~out]
            keys, value, pos = keys[out], value[out], (pos[out] + 1) % self.size

    def hash(self, keys: np.ndarray) -> np.ndarray:
        """A place below size, which is less than 2 ** 32."""
        return ((keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) * np.uint64(self.size) >> np.uint64(32)).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        pos = self.hash(keys)
        out, off = self.value[pos], np.flatnonzero(self.keys[pos] != keys)
        pos, keys = pos[off], keys[off]
        while len(off):
            pos = (pos + 1) % self.size
            out[off] = self.value[pos]
            more = self.keys[pos] != keys
            off, pos, keys = off[more], pos[more], keys[more]
        return out


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as steps, byte by byte, which compresses well."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


# --- documents ------------------------------------------------------------------------------------------------------


def score_documents(docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id", depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """Score all whole texts by the context tree and by add-one word counts, both learned from rows that aren't held out.

    Returns key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text and its end),
    bits_per_byte. ASCII letters are taken in lower case. A null text counts as empty: it has one token, the end. Repeated
    rows each count and keep a row; an empty table gives no rows; other columns are ignored. A very long text is a chunk of
    its own, whose contexts are packed window by window. depth is 1 to 7.

    One pass over the texts cuts them into chunks and sends each chunk's distinct words and distinct pairs of context and
    symbol, with their counts in its training texts, to buckets: words by a hash, pairs by the context's DEAL nearest bytes,
    so a frequent one costs one entry in each chunk. A bucket of pairs adds up its counts, weighs its part of the tree and
    sends sums up; the levels above DEAL, at most 256 ** (DEAL - 1) contexts whatever the corpus, meet on the driver and go
    back to all. Then a bucket predicts each of its pairs once and answers the chunks, where sums by text are taken.
    """
    assert 1 <= depth <= 7
    spark = docs.sparkSession
    kind, deal = dict(docs.dtypes)[key], min(DEAL, depth)
    buckets = max(32, 4 * partitions(spark))
    rows = docs.select(F.col(key), whole(F.col(text)).alias("t"), held_out.alias("held_out"))
    names = ["chunk", "part", "bucket", key, "held_out", "size", "items", "counts", "n"]
    schema = f"chunk long, part int, bucket int, {key} {kind}, held_out boolean, size int, items binary, counts binary, n long"

    def dealt(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of ascending keys by bucket, and where each bucket starts in it."""
        place = keys >> np.uint64(8 * (depth + 1 - deal))
        place = ((place * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) >> np.uint64(8)) % np.uint64(buckets)
        order = np.argsort(place.astype(np.min_scalar_type(buckets)), kind="stable")
        return order, np.searchsorted(place[order], np.arange(buckets + 1, dtype=np.uint64))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of part 0: documents; 1: words; 2: pairs of context and symbol; 3: symbols of training texts; 4: the texts, packed."""
        chunk = TaskContext.get().partitionId() << 32
        for pdf in batches:
            texts, out_of = pdf["t"].to_list(), pdf["held_out"].to_numpy(bool)
            for at in slices(texts, CHARS):
                own, held = [t.encode().lower() for t in texts[at]], out_of[at]
                size = np.fromiter(map(len, own), np.int64, len(own))
                made = lambda part, **columns: pd.DataFrame({**dict.fromkeys(names), "chunk": chunk, "part": part, **columns})[names]  # noqa: E731, B023
                yield made(0, **{key: pdf[key].iloc[at].to_numpy(), "held_out": held, "size": size, "n": np.arange(len(own))}).astype({key: pdf[key].dtype})
                words = Counter()
                for t, h in zip(own, held, strict=True):
                    if not h:
                        words.update(t.split())
                for w in set().union(*(t.split() for t, h in zip(own, held, strict=True) if h)):
                    words.setdefault(w, 0)
                shares = [[] for _ in range(buckets)]
                for w in words:
                    shares[zlib.crc32(w) % buckets].append(w)
                some = [b for b in range(buckets) if shares[b]]
                yield made(1, bucket=some, items=[b" ".join(shares[b]) for b in some], counts=[np.array([words[w] for w in shares[b]], np.int64).tobytes() for b in some])
                del words, shares
                raw = joined(own, depth)
                yield made(4, items=[zlib.compress(raw, 1)])
                raw, own = Bytes(raw, size, depth), None
                learned = raw.only(~held)
                symbols = np.bincount(learned.raw[learned.coded], minlength=256)
                yield made(3, bucket=np.flatnonzero(symbols), n=symbols[symbols > 0])
                keys, n = learned.counted()
                more = raw.only(held).counted()[0]
                del raw, learned
                keys, n = added([keys, more], [n, np.zeros(len(more), np.int64)])
                order, edge = dealt(keys)
                parts = [order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
                some = [b for b in range(buckets) if len(parts[b])]
                yield made(2, bucket=some, items=[packed_keys(keys[parts[b]]) for b in some], counts=[n[parts[b]].astype(np.uint32).tobytes() for b in some])
                chunk += 1

    held = written(rows.mapInPandas(read, schema), "ctw-chunks")
    trained = held.filter("part = 0 AND NOT held_out").count()

    def add_words(pdf: pd.DataFrame) -> pd.DataFrame:
        total = Counter()
        for items, n in zip(pdf["items"], pdf["counts"], strict=True):
            for w, c in zip(items.split(b" "), np.frombuffer(n, np.int64).tolist(), strict=True):
                total[w] += c
        sums = [np.array([total[w] for w in items.split(b" ")], np.int64).tobytes() for items in pdf["items"]]
        n, v = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        n[0], v[0] = total.total(), sum(c > 0 for c in total.values())
        return pd.DataFrame({"chunk": pdf["chunk"], "items": pdf["items"], "sums": sums, "n": n, "v": v})

    words = held.filter("part = 1").select("chunk", "bucket", "items", "counts").groupBy("bucket")
    words = written(words.applyInPandas(add_words, "chunk long, items binary, sums binary, n long, v long"), "ctw-words")
    n_all, v_all = (x or 0 for x in words.agg(F.sum("n"), F.sum("v")).first())
    n_all, v_all = n_all + trained, v_all + (trained > 0)

    symbols = np.zeros(256)
    for r in held.filter("part = 3").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # 256 rows at most
        symbols[r.bucket] = r.n
    paths = Paths(symbols)
    sums_of = ["zeros", "ones", "zeros_under", "ones_under", "total_under"]

    def add_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = added([unpacked_keys(x) for x in pdf["items"]], [np.frombuffer(x, np.uint32).astype(np.int64) for x in pdf["counts"]])
        some = n > 0
        joint, levels = grown(keys[some], n[some].astype(float), paths, depth, deal, least)
        sums = pd.DataFrame(dict(zip(["key", *sums_of], [joint.key.astype(np.int64), joint.zeros, joint.ones, *joint.under(levels[0])], strict=True)))
        cells = pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "items": [packed_keys(keys)], "counts": [n.tobytes()]})
        return pd.concat([cells, sums])[["bucket", "items", "counts", "key", *sums_of]].astype({"bucket": "Int64", "key": "Int64"})

    pairs = held.filter("part = 2").select("bucket", "items", "counts").groupBy("bucket")
    pairs = written(pairs.applyInPandas(add_pairs, "bucket int, items binary, counts binary, key long, " + ", ".join(f"{c} double" for c in sums_of)), "ctw-pairs")
    joint = pairs.filter("key IS NOT NULL").groupBy("key").agg(*[F.sum(c).alias(c) for c in sums_of]).toPandas()  # 256 ** (DEAL - 1) contexts at most
    tree = spark.sparkContext.broadcast((paths, upper(joint, paths, deal, least)))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths, levels = tree.value
        for pdf in batches:
            for bucket, items, counts in zip(pdf["bucket"], pdf["items"], pdf["counts"], strict=True):
                keys, n = unpacked_keys(items), np.frombuffer(counts, np.int64)
                own = levels + grown(keys[n > 0], n[n > 0].astype(float), paths, depth, deal, least)[1]
                logs = [predicted(own, paths, keys[i : i + 100_000], depth) for i in range(0, len(keys), 100_000)]
                yield pd.DataFrame({"bucket": [bucket], "items": [items], "logs": [np.concatenate(logs).astype(np.float32).tobytes()]})

    cells = pairs.filter("items IS NOT NULL").select("bucket", "items", "counts").repartition(partitions(spark), "bucket")
    cells = written(cells.mapInPandas(predict, "bucket int, items binary, logs binary"), "ctw-logs")

    salts = max(1, held.filter("part = 0").select("chunk").distinct().count() // TOGETHER)
    asked = held.filter("part = 2").select("chunk", "bucket", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt"), "items")
    cells = cells.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))

    def look_up(own: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"chunk": [], "bucket": [], "sums": []})
        keys, logs = unpacked_keys(cells["items"].iloc[0]), np.frombuffer(cells["logs"].iloc[0], np.float32)
        return pd.DataFrame({"chunk": own["chunk"], "bucket": own["bucket"], "sums": [logs[np.searchsorted(keys, unpacked_keys(x))].tobytes() for x in own["items"]]})

    logs = asked.groupBy("bucket", "salt").cogroup(cells.groupBy("bucket", "salt")).applyInPandas(look_up, "chunk long, bucket int, sums binary")

    def meet(own: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("n")
        raw = Bytes(zlib.decompress(back.loc[back["part"] == 4, "items"].iloc[0]), own["size"].to_numpy(np.int64), depth)
        log_of = {}
        for items, sums in back.loc[back["part"] == 1, ["items", "sums"]].itertuples(index=False):
            log_of.update(zip(items.split(b" "), np.log10(np.frombuffer(sums, np.int64) + 1.0).tolist(), strict=True))
        n_tokens, n_known, base = [], [], []
        for i in range(len(own)):
            found = list(map(log_of.__getitem__, raw.text(i).split()))
            n_tokens.append(len(found) + 1)
            n_known.append(len(found) - found.count(0.0) + (trained > 0))
            base.append(sum(found) + np.log10(trained + 1) - n_tokens[-1] * np.log10(n_all + v_all + 1))
        del log_of
        back = back[back["part"] == 2].sort_values("bucket")
        keys = raw.counted()[0]
        logs = np.zeros(len(keys), np.float32)
        logs[dealt(keys)[0]] = np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(x, np.float32) for x in back["sums"])])
        score = raw.sums(keys, logs)
        out = own[[key, "held_out"]].assign(n_tokens=n_tokens, n_known=n_known, train_tokens=n_all, base_score=base, score=score)
        out["bits_per_byte"] = -score * np.log2(10) / (own["size"] + 1)
        return out

    none = F.lit(None).cast("binary")
    back = words.select("chunk", F.lit(1).alias("part"), F.lit(0).alias("bucket"), "items", "sums")
    back = back.unionByName(held.filter("part = 4").select("chunk", "part", F.lit(0).alias("bucket"), "items", none.alias("sums")))
    back = back.unionByName(logs.select("chunk", F.lit(2).alias("part"), "bucket", none.alias("items"), "sums"))
    documents = held.filter("part = 0").select("chunk", key, "held_out", "size", "n")
    return documents.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(
        meet, f"{key} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )
