"""Jaccard self-join of word n-gram sets: MinHash values compared step by step, with Bayesian pruning, then exact counts."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import group_numbers, in_groups, meetings, pairs, roots
from .chunks import slices
from .common import partitions, rows_by_key, whole, written
from .components import components

#: Words of an n-gram and the similarity of a link.
WORDS, LEAST = 5, 0.8
#: Bands of LSH and MinHash values of each: a pair at 0.8 collides in some band but for 1 in 20,000.
BANDS, ROWS = 25, 5
#: A pair is dropped once the probability that it reaches LEAST is below this.
TOLERANCE = 1e-6
#: Members of a candidate component that are verified in one task; larger components are split by sizes and blocks.
GROUP = 512
SALTS = np.random.default_rng(20240501).integers(1, 1 << 32, (2, BANDS * ROWS), np.uint64).astype(np.uint32)
SALTS[0] |= np.uint32(1)
MIX = np.random.default_rng(20240502).integers(1, 1 << 63, (BANDS, ROWS), np.uint64) | np.uint64(1)


def needed(compared: int, least: float = LEAST, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values among `compared` for which P(similarity >= least) is still tolerance, under a flat prior.

    The posterior is Beta(m + 1, n - m + 1), whose upper tail is P(Binomial(n + 1, least) <= m).
    """
    tail = 0.0
    for m in range(compared + 1):
        tail += comb(compared + 1, m) * least**m * (1 - least) ** (compared + 1 - m)
        if tail >= tolerance:
            return m
    return compared


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of texts; a text of fewer words is one n-gram of all its words."""

    def __init__(self, words: int = WORDS, most: int = 200_000):
        import xxhash

        self.words, self.most, self.known, self.hash = words, most, {}, xxhash.xxh3_64_intdigest

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.lower().split() for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        for w in set().union(*split).difference(self.known):
            self.known[w] = self.hash(w)
        get = self.known.__getitem__
        out = []
        for words in split:
            h = np.fromiter(map(get, words), np.uint64, len(words))
            n = min(self.words, len(h)) or 1
            key = np.zeros(max(0, len(h) - n + 1), np.uint64)
            for i in range(n):
                key = (key ^ h[i : len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out.append(np.unique(key))
        return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, 16 bits of each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        low = np.minimum(low, (x[at : at + 512, None] * SALTS[0] + SALTS[1]).min(0))
    low ^= low >> np.uint32(15)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def band_keys(sig: np.ndarray) -> np.ndarray:
    mixed = ((sig.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * MIX).sum(1, dtype=np.uint64)
    return (mixed ^ (mixed >> np.uint64(31))).astype(np.int64)


def likely(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) stay after each step's pruning."""
    alive, same = np.arange(len(i)), np.zeros(len(i), np.int32)
    for step in range(0, BANDS * ROWS, 25):
        part = sig[:, step : step + 25]
        same = same + (part[i[alive]] == part[j[alive]]).sum(1, dtype=np.int32)
        stay = same >= needed(step + 25)
        alive, same = alive[stay], same[stay]
    return alive


def first_band(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (sig[i] == sig[j]).reshape(len(i), BANDS, ROWS).all(2).argmax(1)


def overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[rows] with sets[cols], exactly."""
    both = np.concatenate([rows, cols[~np.isin(cols, rows)]])
    place = {int(r): p for p, r in enumerate(both)}
    flat = np.concatenate([sets[r] for r in both])
    owner = np.repeat(np.arange(len(both)), [len(sets[r]) for r in both])
    _, at, many = np.unique(flat, return_inverse=True, return_counts=True)
    shared = many[at] > 1
    owner, at = owner[shared], at[shared]
    _, at = np.unique(at, return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    a, b = np.array([place[int(r)] for r in rows]), np.array([place[int(c)] for c in cols])
    out = np.zeros((len(rows), len(cols)), np.float32)
    wide = int(at[-1]) + 1 if len(at) else 0
    for start in range(0, wide, 4096):
        lo, hi = np.searchsorted(at, [start, start + 4096])
        m = np.zeros((len(both), min(4096, wide - start)), np.float32)
        m[owner[lo:hi], at[lo:hi] - start] = 1
        out += m[a] @ m[b].T
    return out


def linked(sets: list[np.ndarray], cross: bool, side: np.ndarray, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets whose Jaccard similarity is at least `least`; cross: of unlike sides only."""
    size = np.array([len(s) for s in sets])
    if len(sets) <= 24:
        i, j = np.triu_indices(len(sets), 1)
        ok = np.minimum(size[i], size[j]) >= least * np.maximum(size[i], size[j]) - 1e-9
        if cross:
            ok &= side[i] != side[j]
        i, j = i[ok], j[ok]
        same = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], float)
    else:
        rows, cols = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(sets)),) * 2
        if not len(rows) or not len(cols):
            return np.zeros(0, int), np.zeros(0, int)
        got = overlaps(sets, rows, cols)
        a, b = np.nonzero(got >= least * np.maximum(size[rows][:, None], size[cols][None, :]) - 0.5)
        if not cross:
            a, b = a[a < b], b[a < b]
        i, j, same = rows[a], cols[b], got[a, b].astype(float)
    hit = same >= least * (size[i] + size[j] - same) - 1e-9
    return i[hit], j[hit]


def perhaps(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be a wanted class_id, so that few texts are shuffled for the join that decides.

    A bitmap of 2^25 bits, 1,024 rows of 4 KB whatever the input, is broadcast; a full bitmap lets all rows pass.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(1 << 25))
    own = F.pmod(F.xxhash64("class_id"), F.lit(1 << 25))
    maps = wanted.select(F.bitmap_bucket_number(own).alias("bucket"), F.bitmap_bit_position(own).alias("at")).groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    marked = rows.withColumns({"bucket": F.bitmap_bucket_number(bit), "at": F.bitmap_bit_position(bit)}).join(F.broadcast(maps), "bucket")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return marked.filter(F.floor(byte / F.pow(F.lit(2), F.col("at") % 8)) % 2 == 1).select(rows.columns)


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", row: Column | None = None) -> DataFrame:
    """Links between documents whose sets of five-word n-grams (lower case) have a Jaccard similarity of 0.8 or more.

    Returns a row for each document: key, class_id (smallest key among documents of the same set), n_links (other documents
    linked with it, those of its class included), component_id (smallest key that links reach).

    Documents of equal sets are one class from the start, so a group of copies of any size costs one row. Classes that
    collide in a band meet in blocks; a task compares their MinHash values and returns a star for each cluster that
    survives the pruning, never the pairs. Within the clusters' components every two classes of like sizes are then
    compared exactly, again in blocks, which return counts and stars.

    Null, empty and wordless texts have no n-grams: each is a class without links. Repeated rows are copies of each other;
    rows without a key count as copies, but name no class unless nothing else does (null). An empty table gives no rows;
    other columns are ignored.

    row: bytes that tell rows apart where keys may repeat or be null; returned as row_id beside component, a number of the
    component (null where a text has no words).
    """
    spark, kind, n = docs.sparkSession, dict(docs.dtypes)[key], partitions(docs.sparkSession)
    own = [] if row is None else [row.alias("row_id")]
    extra = ["row_id"] if own else []
    rows = docs.select(F.col(key), whole(F.col(text)).alias("t"), *own)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts):
                sets = shingler(texts[at])
                yield pd.DataFrame({key: pdf[key].iloc[at], "c": pd.array([shingler.hash(s.tobytes()) - (1 << 63) if len(s) else None for s in sets], "Int64"), "sig": [signature(s).tobytes() if len(s) else None for s in sets], **{e: pdf[e].iloc[at] for e in extra}})

    signed = written(rows.mapInPandas(sign, f"{key} {kind}, c long, sig binary" + ", row_id binary" * len(extra)), "ngram-signatures")
    members = signed.select(key, "c", *extra)
    classes = written(signed.filter("c IS NOT NULL").groupBy("c").agg(F.min(key).alias("class_id"), F.count("*").alias("copies"), F.first("sig").alias("sig")), "ngram-classes")

    def bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = np.concatenate([np.zeros(0, np.int64), *(band_keys(np.frombuffer(s, np.uint16)) for s in pdf["sig"])])
            yield pd.DataFrame({"c": np.repeat(pdf["c"].to_numpy(np.int64), BANDS), "band": np.tile(np.arange(BANDS, dtype=np.int32), len(pdf)), "h": keys})

    def clusters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["band", "h", "bi", "bj"]
        for pdf in rows_by_key(batches, keys):
            sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), -1)
            band, c, found = pdf["band"].to_numpy(), pdf["c"].to_numpy(np.int64), []
            for i, j in pairs(group_numbers(pdf, keys), (pdf["bi"] != pdf["bj"]).to_numpy(), pdf["side"].to_numpy()):
                own = likely(sig, i, j)
                i, j = i[own], j[own]
                new = first_band(sig, i, j) == band[i]  # it has been seen in an earlier band
                found.append((i[new], j[new]))
            if found:
                root = roots(len(pdf), *(np.concatenate(x) for x in zip(*found, strict=True)))
                own = np.flatnonzero(root != np.arange(len(pdf)))
                yield pd.DataFrame({"a": c[own], "b": c[root[own]]})

    keyed = classes.select("c", "sig").mapInPandas(bands, "c long, band int, h long")
    near = meetings(keyed, ["band", "h"], "c").join(classes.select("c", "sig"), "c")
    stars = in_groups(near, ["band", "h", "bi", "bj"], 2 * n).mapInPandas(clusters, "a long, b long")
    candidates = written(components(stars).join(classes.select(F.col("c").alias("id"), "class_id", "copies"), "id"), "ngram-candidates")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts):
                part, found = pdf.iloc[at], shingler(texts[at])
                own = np.array([len(s) > 0 and shingler.hash(s.tobytes()) - (1 << 63) == c for s, c in zip(found, part["id"], strict=True)], bool)
                if own.any():
                    yield part.loc[own, ["id", "root", "copies"]].assign(shingles=[s.tobytes() for s, o in zip(found, own, strict=True) if o])

    mine = perhaps(rows, candidates, key).join(candidates, F.col(key).eqNullSafe(F.col("class_id"))).select("id", "root", "copies", "t")
    mine = written(mine.mapInPandas(sets, "id long, root long, copies long, shingles binary").dropDuplicates(["id"]), "ngram-sets")
    # a component of one task's size meets as a whole; of a larger one, blocks of sizes that a link allows
    level = F.floor(F.log(F.octet_length("shingles") / 8) / F.lit(-np.log(LEAST)) + 1e-9).cast("int")
    sizes = mine.groupBy("root").count()
    mine = mine.join(sizes, "root").withColumn("level", F.when(F.col("count") > GROUP, level).otherwise(0)).drop("count")
    blocks = mine.groupBy("root", "level").count().select("root", "level", F.ceil(F.col("count") / GROUP).cast("int").alias("blocks"))
    mine = mine.join(blocks, ["root", "level"]).withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    other = blocks.select(F.col("root").alias("r"), F.col("level").alias("ol"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("ob"))
    met = mine.join(other, (F.col("root") == F.col("r")) & (F.abs(F.col("level") - F.col("ol")) <= 1))
    first, second = F.struct("level", "b"), F.struct(F.col("ol").alias("level"), F.col("ob").alias("b"))
    met = met.withColumns({"p": F.least(first, second), "q": F.greatest(first, second), "side": (first > second).cast("int")})
    met = met.select("root", F.col("p.level").alias("l1"), F.col("p.b").alias("b1"), F.col("q.level").alias("l2"), F.col("q.b").alias("b2"), "side", "id", "copies", "shingles")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["root", "l1", "b1", "l2", "b2"]
        for pdf in rows_by_key(batches, keys):
            ids, copies, side = (pdf[c].to_numpy(np.int64) for c in ("id", "copies", "side"))
            cross = ((pdf["l1"] != pdf["l2"]) | (pdf["b1"] != pdf["b2"])).to_numpy()
            group = group_numbers(pdf, keys)
            edge = np.r_[np.searchsorted(group, np.arange(int(group[-1]) + 1)), len(pdf)]
            shingles = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
            found = []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if b - a > 1:
                    i, j = linked(shingles[a:b], bool(cross[a]), side[a:b])
                    found.append((i + a, j + a))
            if not found:
                continue
            i, j = (np.concatenate(x).astype(int) for x in zip(*found, strict=True))
            links = np.zeros(len(pdf), np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = roots(len(pdf), i, j)
            own = np.flatnonzero(links)
            yield pd.DataFrame({"a": ids[own], "b": ids[root[own]], "links": links[own]})

    links = written(in_groups(met, ["root", "l1", "b1", "l2", "b2"], 2 * n).mapInPandas(verify, "a long, b long, links long"), "ngram-links")
    counts = links.groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    joined = components(links.select("a", "b")).withColumnRenamed("id", "c")
    named = classes.select("c", "class_id", "copies").join(joined, "c", "left").join(counts, "c", "left").withColumn("root", F.coalesce("root", "c"))
    named = written(named.select("c", "class_id", "root", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-named")
    lowest = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = named.join(lowest, "root").withColumnRenamed("root", "component")
    extra = [*extra, "component"] if extra else []
    out = members.filter("c IS NOT NULL").join(named, "c").select(key, "class_id", "n_links", "component_id", *extra)
    alone = members.filter("c IS NULL").withColumn("component", F.lit(None).cast("long"))
    return out.union(alone.select(key, F.col(key).alias("class_id"), F.lit(0).cast("long"), F.col(key), *extra))
