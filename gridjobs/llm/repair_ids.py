"""Token ids of a corpus in files, compressed by Re-Pair: in each shard frequent pairs of ids are replaced by new symbols, again and
again; the shard keeps its rules and the length that each symbol expands to, so that any stretch of a document is decoded alone.

A shard is a row of the written table: its place (part, number), how many ids lie before it in its part, its documents' keys and
`data`, in little-endian numbers: MAGIC, the first new symbol, the number of rules, of documents, the bytes of a symbol (4 bytes
each) and the number of symbols (8 bytes); the rules' left and right symbols (4 bytes each), their expansion lengths (8); the end
of each document in symbols (8) and in ids (8); the symbols, in as few whole bytes as hold the largest.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import whole

MAGIC, HEAD = b"RPG1", "<4sIIIIQ"
#: Ids of a shard, at least, but for the last of a part.
SHARD = 1_000_000
#: Rounds of replacement in a shard, and the least number of uses of a rule: it takes 16 bytes and saves 2 or 3 a use.
ROUNDS, LEAST = 8, 10
#: Words, and pieces of them, that an encoder keeps, and their largest length.
WORDS, LONG = 600_000, 100
#: Bytes of text that are encoded together, about, and words whose ids are laid out together.
BATCH, TOGETHER = 12_000_000, 1_000_000
NO_PAIR = np.uint64(2**64 - 1)


class Shard(NamedTuple):
    """base: the first symbol that stands for a pair; at: the documents' ends, in symbols and in ids."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    at: np.ndarray
    symbols: np.ndarray


class Words:
    """Ids of texts by a tokenizer that drops white space, lower-cases and splits by a fixed pattern (that of PIECE, over all letters).

    ASCII white space separates words for it, whatever stands around, and it forgets capitals, so words are taken in lower case, each
    distinct word of a batch is looked up once, and its ids are made once while it is known. A new word of ASCII alone is put together
    from its pieces. Texts that hold what may be a special token, whose case counts, or marks that may join a letter before it is
    lower-cased, keep their capitals.
    """

    ODD = "<\\||[\u0300-\u037f]"
    #: The pattern on lower-case ASCII.
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    #: The characters that stand for bytes in the vocabulary: those that can be printed for themselves, the others from 256 on.
    PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
    BYTES = dict(zip(sorted(set(range(256)) - set(PRINTED)), map(chr, range(256, 512)), strict=False))

    def __init__(self, path: str):
        tok = Tokenizer.from_file(path)
        self.base = max(tok.get_vocab(with_added_tokens=True).values()) + 1
        self.encode, self.model = tok.encode, tok.model.tokenize
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def single(self, p: str) -> bytes:
        """Ids of a piece that is normalized and that the pattern splits no further."""
        if not (p.isascii() and p.isprintable()):
            p = p.encode().decode("latin-1").translate(self.BYTES)
        return array("I", [t.id for t in self.model(p)]).tobytes()

    def word(self, w: str) -> bytes:
        bare = w.rstrip(".,;:!?)")
        ascii_ = w.isascii() and w.islower()
        if ascii_ and bare.isalpha():  # most words: letters, and what ends them
            return self.learn(bare, True) + (self.learn(w[len(bare) :], True) if len(bare) < len(w) else b"")
        if ascii_ and "<|" not in w:
            return b"".join([self.learn(p, True) for p in self.PIECE.findall(w)])
        if bare and len(bare) < len(w) and bare[-1].lower()[-1].isalnum():  # what ends a word is a piece of its own
            return self.learn(bare) + self.learn(w[len(bare) :])
        return self.learn(w)

    def learn(self, p: str, alone: bool = False) -> bytes:
        ids = self.pieces.get(p)
        if ids is None:
            if alone or (p.isalpha() and p.islower() and unicodedata.is_normalized("NFC", p)):
                ids = self.single(p)
            else:
                ids = array("I", self.encode(p, add_special_tokens=False).ids).tobytes()
            if len(p) <= LONG:
                self.pieces[p] = ids
        return ids

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's end."""
        texts = pc.if_else(pc.match_substring_regex(texts, self.ODD), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        for held in (self.known, self.pieces):
            if len(held) > WORDS:
                held.clear()
        distinct, get = words.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known.get
        found = list(map(get, distinct))
        for i, ids in enumerate(found):
            if ids is None:
                w = distinct[i]
                found[i] = ids = self.word(w)
                if len(w) <= LONG:
                    self.known[w] = ids
        flat, many = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, which = np.cumsum(many) - many, words.indices.to_numpy()
        ends = np.cumsum(many[which])
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        for at in range(0, len(which), TOGETHER):
            w, e = which[at : at + TOGETHER], ends[at : at + TOGETHER]
            a, b = int(e[0] - many[w[0]]), int(e[-1])
            out[a:b] = flat[np.repeat(starts[w] - e + many[w], many[w]) + np.arange(a, b)]
        return out, np.append(0, ends)[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """Kept from task to task of a worker."""
    return Words(path)


def cuts(sizes: np.ndarray) -> list[slice]:
    """Runs of texts of about BATCH bytes each."""
    group = np.cumsum(sizes) // BATCH
    edges = np.flatnonzero(np.diff(group, prepend=-1))
    return [slice(int(a), int(b)) for a, b in zip(edges, np.append(edges[1:], len(sizes)), strict=True)]


def frequent(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs occur `least` times and more, by rising frequency; at each place the number of its pair there, from 1 (0: none); and
    the places whose pair is rarer.

    Of two pairs that share a slot of the table, the more frequent is found; the other waits for the next round, and isn't called rare.
    """
    ordered = np.sort(pairs)
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    many = np.diff(np.append(edge, len(ordered)))
    some = (many >= least) & (ordered[edge] != NO_PAIR)
    found, many = ordered[edge[some]], many[some]
    found = found[np.argsort(many, kind="stable")]
    bits = max(10, int(len(found) * 8).bit_length())
    slot = lambda p: (p * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    table = np.zeros(1 << bits, np.int32)
    own = slot(found)
    table[own] = np.arange(1, len(found) + 1, dtype=np.int32)
    shared = np.bincount(own, minlength=len(table)) > 1
    at = slot(pairs)
    number = table[at]
    number[np.append(NO_PAIR, found)[number] != pairs] = 0
    return found, number, (number == 0) & ~shared[at]


def compress(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int = ROUNDS, least: int = LEAST) -> Shard:
    """The grammar of ids (below base) of documents that end at `ends`. No pair spans two documents.

    A pair that is rare once stays so, since others' replacement only takes its places away: a round counts what isn't known to be rare.
    It replaces all frequent pairs at once: where two overlap, the more frequent; of a run of one pair every second.
    """
    s, last = ids.astype(np.uint32), np.zeros(len(ids), bool)
    last[ends[ends > np.append(0, ends[:-1])] - 1] = True
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.int64)
    rare = last.copy()  # no pair begins at a document's last symbol
    for _ in range(rounds):
        open_ = np.flatnonzero(~rare[:-1])
        if not len(open_):
            break
        number = np.zeros(len(s) - 1, np.int32)
        found, number[open_], rare[open_] = frequent((s[open_].astype(np.uint64) << np.uint64(32)) | s[open_ + 1], least)
        take, same = number > 0, np.append(False, (number[1:] == number[:-1]) & (number[1:] > 0))
        take[1:] &= (number[1:] > number[:-1]) | same[1:]
        take[:-1] &= number[:-1] >= number[1:]
        if same.any():  # of a run of one pair, such as a a a a, every second place
            place = np.arange(len(same))
            take &= (place - np.maximum.accumulate(np.where(same, 0, place))) % 2 == 0
        where = np.flatnonzero(take)
        used = np.bincount(number[where], minlength=len(found) + 1) >= least
        where = where[used[number[where]]]
        if not len(where):
            break
        used[0] = False
        symbol = (base + len(rules) + np.cumsum(used) - 1).astype(np.uint32)
        new = found[used[1:]]
        new = np.stack([new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        long = np.append(np.ones(1, np.int64), lengths)  # 0: an id
        lengths = np.append(lengths, long[np.maximum(new.astype(np.int64) - base + 1, 0)].sum(1))
        rules = np.concatenate([rules, new])
        s[where] = symbol[number[where]]
        last[where] = last[where + 1]
        rare[where] = last[where]
        before = where[where > 0] - 1
        rare[before] = last[before]
        keep = np.ones(len(s), bool)
        keep[where + 1] = False
        s, last, rare = s[keep], last[keep], rare[keep]
    own = np.concatenate([[0], np.flatnonzero(last) + 1])  # a document without ids ends where the one before it does
    at = own[np.cumsum(ends > np.append(0, ends[:-1]))] if len(ends) else np.zeros(0, np.int64)
    return Shard(base, rules, lengths, np.stack([at, ends.astype(np.int64)], 1), s)


def packed(x: Shard) -> bytes:
    width = max(1, (int(x.symbols.max(initial=0)).bit_length() + 7) // 8)
    head = struct.pack(HEAD, MAGIC, x.base, len(x.rules), len(x.at), width, len(x.symbols))
    symbols = x.symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    return b"".join([head, x.rules.astype("<u4").tobytes(), x.lengths.astype("<i8").tobytes(), x.at.T.astype("<i8").tobytes(), symbols.tobytes()])


def opened(data: bytes) -> Shard:
    magic, base, rules, docs, width, n = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise ValueError("not a shard of ids")
    at = struct.calcsize(HEAD)

    def read(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    pairs, lengths, ends = read("<u4", 2 * rules).reshape(-1, 2), read("<i8", rules), read("<i8", 2 * docs).reshape(2, -1).T
    symbols = np.zeros((n, 4), np.uint8)
    symbols[:, :width] = read("u1", n * width).reshape(-1, width)
    return Shard(base, pairs, lengths, ends, symbols.view("<u4")[:, 0])


def expand(x: Shard, symbols: np.ndarray) -> np.ndarray:
    """The ids of symbols: a pass for each level of the rules."""
    while (pair := symbols >= x.base).any():
        to = np.cumsum(1 + pair) - 1 - pair
        out = np.empty(len(symbols) + int(pair.sum()), np.uint32)
        inside = symbols[pair] - x.base
        out[to] = symbols
        out[to[pair]] = x.rules[inside, 0]
        out[to[pair] + 1] = x.rules[inside, 1]
        symbols = out
    return symbols


def read_range(x: Shard, doc: int, first: int, count: int) -> np.ndarray:
    """`count` ids of a shard's document from its id `first` on; only symbols that hold some of them are expanded."""
    own = x.symbols[(x.at[doc - 1, 0] if doc else 0) : x.at[doc, 0]].astype(np.int64)
    ends = np.cumsum(np.append(np.ones(1, np.int64), x.lengths)[np.maximum(own - x.base + 1, 0)])
    a, b = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, first + count, side="left") + 1
    before = int(ends[a - 1]) if a else 0
    return expand(x, own[a:b].astype(np.uint32))[first - before : first - before + count]


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, text: str = "text", key: str = "doc_id", shard: int = SHARD) -> None:
    """Encode every text, append end_id, and write all ids in ascending order of the key (null keys first) as shards under `path`.

    Ranges of keys are the parts, sorted in themselves; rows of one key are ordered by their text's checksum, so that a key of very
    many rows takes several parts. A part's ids are cut into shards between documents as they come, so a task holds one shard
    of ids, or one document if that is longer. A null text counts as empty; an empty table gives no shards.
    """
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("t"), F.monotonically_increasing_id().alias("row"))
    order = ["key", "sum", "row"]
    rows = rows.withColumn("sum", F.crc32(F.col("t").cast("binary"))).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = words_of(tokenizer_path), TaskContext.get().partitionId()
        base = max(words.base, end_id + 1)
        held: list[np.ndarray] = []
        keys: list[str | None] = []
        size = number = before = 0

        def closed() -> pa.RecordBatch:
            data = packed(compress(np.concatenate(held), np.cumsum([len(x) for x in held]), base))
            values = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before]), pa.array([size]), pa.array([keys], pa.list_(pa.string())), pa.array([data])]
            return pa.RecordBatch.from_arrays(values, ["part", "number", "before", "n_ids", "keys", "data"])

        for batch in batches:
            own, texts = batch.column(0).to_pylist(), batch.column(1)
            for some in cuts(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                ids, ends = words.ids(texts[some])
                ids = np.insert(ids, ends, end_id)
                for k, x in zip(own[some], np.split(ids, ends[:-1] + np.arange(1, len(ends))), strict=True):
                    held.append(x)
                    keys.append(k)
                    size += len(x)
                    if size >= shard:
                        yield closed()
                        before, number, size = before + size, number + 1, 0
                        held, keys = [], []
        if held:
            yield closed()

    # keys travel as strings, so that null keys leave the others' type alone
    shards = rows.select(F.col("key").cast("string"), "t").mapInArrow(run, "part int, number int, before long, n_ids long, keys array<string>, data binary")
    shards.withColumn("keys", F.col("keys").cast(f"array<{kind}>")).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Every document of the files: key, start (ids of all documents before it), n_tokens and ids (little-endian 4 bytes each)."""
    shards = spark.read.parquet(path)
    kind = dict(shards.dtypes)["keys"].removeprefix("array<").removesuffix(">")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each partition of the write
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("start"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                x = opened(r.data)
                ids = expand(x, x.symbols).astype("<u4", copy=False)
                ends = x.at[:, 1]
                starts = np.append(0, ends[:-1])
                found = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pd.DataFrame({"k": list(r.keys), "start": r.start + starts, "n_tokens": ends - starts, "ids": found})

    rows = shards.join(F.broadcast(parts), "part").select(F.col("keys").cast("array<string>").alias("keys"), "data", (F.col("start") + F.col("before")).alias("start"))
    return rows.mapInPandas(run, "k string, start long, n_tokens long, ids binary").select(F.col("k").cast(kind).alias(key), "start", "n_tokens", "ids")
