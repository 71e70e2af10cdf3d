"""Packing into windows: repeat counts of shallow length combinations by non-negative least squares, residuals greedily."""

from __future__ import annotations

import array
import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import ChunkEncoder, slices
from .common import whole, written

#: Rows of one length that are numbered together, about, and the most ranges that a length is cut into.
RANGE_ROWS, MAX_RANGES = 20_000, 4_096
#: Lengths of three pieces that fill a window are taken from a grid of this step.
GRID = 16


def combinations(window: int, grid: int = GRID) -> np.ndarray:
    """Rows of up to three lengths that fill a window exactly; 0 stands for no piece. All pairs, and triples on a grid."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([a, window - a, np.zeros_like(a)], 1)
    g = np.arange(grid, window, grid)
    x, y = np.meshgrid(g, g, indexing="ij")
    z = window - x - y
    ok = (x <= y) & (y <= z)
    return np.concatenate([pairs, np.stack([x[ok], y[ok], z[ok]], 1)])


def repeats(patterns: np.ndarray, have: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients: how often each pattern should occur, unrounded."""
    n, m = len(have), len(patterns)
    goal = have.astype(float).copy()
    goal[0] = 0
    used = patterns > 0

    def forward(x: np.ndarray) -> np.ndarray:
        y = np.bincount(patterns.ravel(), np.repeat(x, patterns.shape[1]), minlength=n)
        y[0] = 0
        return y

    def back(r: np.ndarray) -> np.ndarray:
        return (r[patterns] * used).sum(1)

    v = np.ones(m)
    for _ in range(20):  # the largest eigenvalue bounds the step
        v = back(forward(v))
        v /= np.linalg.norm(v)
    step = 1 / max(1.0, 1.05 * float(v @ back(forward(v))))
    x = y = np.zeros(m)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(forward(y) - goal))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(have: np.ndarray, window: int) -> pd.DataFrame:
    """Where the pieces of each length go. have[l]: number of pieces of length l.

    Each row serves pieces first <= rank < last of a length: piece r lies in sequence base + (r - first) // many at
    offset at + (r - first) % many * length.
    """
    left = have.astype(np.int64).copy()
    left[0] = 0
    taken, rows, base = np.zeros_like(left), [], 0

    def put(items: list[tuple[int, int]], times: int) -> None:
        nonlocal base
        at = 0
        for length, many in items:
            rows.append((length, int(taken[length]), int(taken[length] + times * many), base, at, many))
            taken[length] += times * many
            left[length] -= times * many
            at += length * many
        base += times

    put([(window, 1)], int(left[window]))
    if left.any():
        patterns = combinations(window)
        want = repeats(patterns, left[: window + 1])
        for i in np.argsort(-want, kind="stable"):
            if want[i] < 0.5:
                break
            lengths, many = np.unique(patterns[i][patterns[i] > 0], return_counts=True)
            times = min(int(round(want[i])), int((left[lengths] // many).min()))
            if times > 0:
                put([(int(a), int(b)) for a, b in zip(lengths, many, strict=True)], times)
    while left.any():  # what rounding leaves: the longest piece, then the longest that still fits, and so on
        room, below, items = window, window, []
        while (fits := np.flatnonzero(left[: min(room, below) + 1])).size:
            length = int(fits[-1])
            many = min(room // length, int(left[length]))
            items.append((length, many))
            room, below = room - length * many, length - 1
        put(items, min(int(left[length]) // many for length, many in items))
    return pd.DataFrame(rows, columns=["length", "first", "last", "base", "at", "many"])


@lru_cache(maxsize=1)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def ranks(path: str, pattern: str):
    """The same vocabulary as ranks; its library has far less to do for each of very many short chunks."""
    import tiktoken

    with open(path, "rb") as lines:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})


def pieces(docs: DataFrame, path: str, ranks_path: str | None, pattern: str | None, window: int, end_id: int, text: str, key: str) -> DataFrame:
    """Each document's ids and end id, cut into whole windows and a rest: key, start, length, ids_crc32, doc_tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(path)
        special = [t.content for t in tok.get_added_tokens_decoder().values()]
        slow = lambda t: array.array("I", tok.encode(t, add_special_tokens=False).ids).tobytes()
        fast = ranks(ranks_path, pattern).encode_ordinary if ranks_path else None
        encoder = ChunkEncoder(lambda new: [array.array("I", fast(t)).tobytes() for t in new] if fast else [slow(t) for t in new])
        end = np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            texts = pdf["t"].to_list()
            for part in slices(texts):
                rows = []
                odd = [any(s in t for s in special) for t in texts[part]]  # a special token's own string can hold a space
                plain = iter(encoder.ids([t for t, o in zip(texts[part], odd, strict=True) if not o]))
                for k, t, o in zip(pdf[key].iloc[part], texts[part], odd, strict=True):
                    ids = (slow(t) if o else next(plain)) + end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        own = ids[4 * start : 4 * (start + window)]
                        rows.append((k, start, len(own) // 4, zlib.crc32(own), n))
                yield pd.DataFrame(rows, columns=[key, "start", "length", "ids_crc32", "doc_tokens"]).astype({key: pdf[key].dtype})

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), whole(F.col(text)).alias("t")).mapInPandas(run, f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, window: int = 2048, end_id: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pack all documents into sequences of at most `window` tokens.

    Returns a row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset. Whole windows of long
    documents are sequences by themselves; the rests meet in combinations that the plan finds from their lengths' histogram,
    which has `window` bins whatever the input. The plan goes back to the pieces by their rank among those of their length;
    ranks are counted in ranges, so that a length that very many pieces have is not one task's work.

    A null or empty text has its end id alone; repeated rows each keep their pieces; an empty table gives no rows; other
    columns are ignored. `path` is a tokenizer file that all executors can read; `ranks_path` and `pattern`, if given, are
    the same vocabulary as ranks, which encode texts that hold no special token's string.
    """
    spark = docs.sparkSession
    cut = pieces(docs, path, ranks_path, pattern, window, end_id, text, key)
    cut = written(cut.withColumn("r", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(MAX_RANGES)).cast("int")), "pack-pieces")
    counts = cut.groupBy("length").count().toPandas()  # at most `window` rows
    have = np.zeros(window + 1, np.int64)
    have[counts["length"].to_numpy(int)] = counts["count"].to_numpy(int)
    most = max(1, min(MAX_RANGES, int(have.max()) // RANGE_ROWS))
    cut = cut.withColumn("r", F.col("r") % most)
    where = spark.createDataFrame(plan(have, window), "length long, first long, last long, base long, at long, many long")
    own = cut.groupBy("length", "r").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("r").rowsBetween(Window.unboundedPreceding, -1))
    own = own.select("length", "r", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "r").orderBy(key, "start", "ids_crc32"))
    ranked = cut.withColumn("place", place).join(own, ["length", "r"]).withColumn("rank", F.col("place") - 1 + F.col("before"))
    nth = F.col("rank") - F.col("first")
    return (
        ranked.join(F.broadcast(where.withColumnRenamed("length", "l")), (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))  # a few rows for each length
        .withColumn("sequence_id", F.col("base") + F.floor(nth / F.col("many")))
        .withColumn("offset", F.col("at") + nth % F.col("many") * F.col("length"))
        .select(key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )
