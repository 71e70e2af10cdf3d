"""Byte-level BPE encoding and decoding on length-bucketed, padded numpy matrices; pieces longer than the buckets stand alone."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkEncoder, slices
from .common import whole

#: No merge; also pads the matrices. Ids are below it.
NONE = 0xFFFF
#: Cells of one matrix.
CELLS = 2_000_000
#: Pieces of more bytes than this are merged one by one, all places of a pair in a round; BLOCK places share a minimum.
LONG, BLOCK = 1024, 256


class PairTable:
    """Open-addressing table from pairs of ids to the id (which is the rank) that they merge into."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 6).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        home, todo, self.probes = self.home(keys), np.arange(len(keys)), 0
        while len(todo):
            at = (home[todo] + self.probes) & (len(self.keys) - 1)
            free = np.flatnonzero(self.keys[at] == -1)
            free = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[free]], self.values[at[free]] = keys[todo[free]], values[todo[free]]
            todo = np.delete(todo, free)
            self.probes += 1

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 16) | right
        out, todo, at = np.full(keys.shape, NONE, np.int32), None, self.home(keys)
        for probe in range(self.probes):
            here = self.keys[at]
            hit = here == keys
            if probe == 0:
                out[hit] = self.values[at[hit]]
                todo = np.flatnonzero(~hit & (here != -1))
            else:
                out[todo[hit]] = self.values[at[hit]]
                todo = todo[~hit & (here != -1)]
            if not len(todo):
                break
            if probe == 0:
                keys, at = keys[todo], at[todo]
            else:
                more = ~hit & (here != -1)
                keys, at = keys[more], at[more]
            at = (at + 1) & (len(self.keys) - 1)
        return out


class BytePairs:
    """A rank file's vocabulary: encode() merges as the file's ranks say, decode() joins the tokens' bytes."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get, keys, values = self.ranks.get, [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 16 | b)
                    values.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(values, np.int32))

    def merged(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of padded ids, each merged to its end: yields (row numbers, their padded ids) as rows end.

        Each round every row merges its leftmost pair of least rank and closes the gap, so the matrix loses a column; only
        the two pairs about the merged id are looked up anew.
        """
        rows = np.arange(len(ids))
        rank = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while ids.shape[1] > 1:
            at = rank.argmin(1)
            least = rank[np.arange(len(rows)), at]
            ended = least == NONE
            if ended.any():
                yield rows[ended], ids[ended]
                go = ~ended
                rows, ids, rank, at, least = rows[go], ids[go], rank[go], at[go], least[go]
                if not len(rows):
                    return
            each = np.arange(len(rows))
            ids[each, at] = least
            after = np.arange(ids.shape[1] - 1) > at[:, None]
            ids = np.where(after, ids[:, 1:], ids[:, :-1])
            rank = np.where(after[:, 1:], rank[:, 1:], rank[:, :-1]) if rank.shape[1] > 1 else rank[:, :0]
            # rank[:, j] for j >= at now holds what stood one to the right; the pairs on either side of the merged id are new
            for place, ok in ((at, at < rank.shape[1]), (at - 1, at > 0)):
                r, p = each[ok], place[ok]
                rank[r, p] = self.pairs.find(ids[r, p], ids[r, p + 1])
        yield rows, ids

    def merged_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row merged to its end, with the result of merged() in time that grows with the merges, not their square.

        A round merges the pair of least rank at all its places from left to right, but for overlapping ones, up to the
        first place whose merge makes a pair of a still lower rank, which is next in line. Places keep their numbers and know
        the places before and after; a minimum for each block of places saves looking at all of them.
        """
        n = len(ids)
        ids = np.append(ids, NONE)  # at n, which is also -1: no neighbour
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        blocks = np.full((n // BLOCK + 1, BLOCK), NONE, np.int32)
        rank = blocks.reshape(-1)
        rank[: n - 1] = self.pairs.find(ids[: n - 1], ids[1:n])
        low, alive = blocks.min(1), np.ones(n, bool)
        while (least := low.min()) != NONE:
            near = np.flatnonzero(low == least)
            row, column = np.nonzero(blocks[near] == least)
            at = near[row] * BLOCK + column
            start = np.r_[True, after[at[:-1]] != at[1:]]
            each = np.arange(len(at))
            at = at[(each - np.maximum.accumulate(np.where(start, each, 0))) % 2 == 0]
            gone = after[at]
            left = ids[before[at]]
            left[1:][before[at[1:]] == gone[:-1]] = least
            same = np.full(len(at), least, np.int32)
            lower = (self.pairs.find(left, same) < least) | (self.pairs.find(same, ids[after[gone]]) < least)
            if lower.any():
                upto = int(lower.argmax()) + 1
                at, gone = at[:upto], gone[:upto]
            ids[at], alive[gone], rank[gone] = least, False, NONE
            after[at] = after[gone]
            before[after[at]] = at
            first = before[at]
            rank[at] = self.pairs.find(ids[at], ids[after[at]])
            rank[first] = self.pairs.find(ids[first], ids[at])
            touched = np.unique(np.concatenate([at, gone, first[first >= 0]]) // BLOCK)
            low[touched] = blocks[touched].min(1)
        return ids[:n][alive]

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.uint32)
            elif len(piece) > LONG:
                out[i] = self.merged_long(self.single[np.frombuffer(piece, np.uint8)]).astype(np.uint32)
            elif piece:
                n = len(piece)
                by_width.setdefault(n if n <= 16 else 1 << (n - 1).bit_length(), []).append(i)
            else:
                out[i] = np.empty(0, np.uint32)
        for width, which in by_width.items():
            step = max(1, CELLS // width)
            for a in range(0, len(which), step):
                part = which[a : a + step]
                raw = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
                n = np.array([len(pieces[i]) for i in part])
                ids = np.full((len(part), int(n.max())), NONE, np.int32)
                ids[np.arange(ids.shape[1]) < n[:, None]] = self.single[raw]
                for rows, done in self.merged(ids):
                    kept = done != NONE
                    flat = done[kept].astype(np.uint32)
                    for i, ends in zip(rows, np.split(flat, kept.sum(1).cumsum()[:-1]), strict=True):
                        out[part[i]] = ends
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes; each match of the pattern is encoded by itself, once."""
        split = [self.pattern.findall(t) for t in texts]
        pieces = list({p for s in split for p in s})
        of = {p: ids.astype("<u4").tobytes() for p, ids in zip(pieces, self.encode_pieces([p.encode() for p in pieces]), strict=True)}
        return [b"".join([of[p] for p in s]) for s in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every whole text, then decode the ids.

    Returns key, ids (array<int>), decoded (binary). A null text counts as empty and has no ids; repeated rows each keep a
    row; an empty table gives no rows; other columns are ignored. Very long texts, unbroken ones too, take time in about
    proportion to their length. `path` is a rank file that all executors can read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = byte_pairs(path, pattern)
        encoder = ChunkEncoder(pairs.encode_many)
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in encoder.ids(texts[at])]
                yield pd.DataFrame({key: pdf[key].iloc[at], "ids": ids, "decoded": [pairs.decode(x.tolist()) for x in ids]})

    return _map(docs, run, text, key, "ids array<int>, decoded binary")


def bpe_digests(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As bpe_round_trip, but in place of ids and bytes their number and SHA-256 digests, so that neither leaves its task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = byte_pairs(path, pattern)
        encoder = ChunkEncoder(pairs.encode_many)
        digest = lambda x: hashlib.sha256(x).hexdigest()
        for pdf in batches:
            texts = pdf["t"].to_list()
            for at in slices(texts):
                ids = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts[at])]
                yield pd.DataFrame(
                    {
                        key: pdf[key].iloc[at],
                        "n_tokens": [len(x) for x in ids],
                        "ids_sha256": [digest(",".join(map(pairs.decimals.__getitem__, x)).encode()) for x in ids],
                        "decoded_sha256": [digest(pairs.decode(x)) for x in ids],
                    }
                )

    return _map(docs, run, text, key, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _map(docs: DataFrame, run, text: str, key: str, columns: str) -> DataFrame:
    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), whole(F.col(text)).alias("t")).mapInPandas(run, f"{key} {kind}, {columns}")
