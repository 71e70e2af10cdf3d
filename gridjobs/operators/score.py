"""Batch scoring by an ensemble of small networks, and measures of fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Numbers of all networks together, at most: what the driver and each worker hold.
MOST_NUMBERS = 20_000_000
NAMES = {"bias": "b", "mean": "mean", "variance": "var", "gain": "gain", "shift": "shift"}


def fit_metrics(df: DataFrame, truth: str, guess: str, part: list[str] | None = None) -> DataFrame:
    """r2, rmse, mae and n over the rows where both have a value."""
    d = F.col(truth) - F.col(guess)
    both = df.filter(d.isNotNull())
    keys = part or []
    return both.groupBy(*keys).agg((1 - F.avg(d * d) / F.var_pop(truth)).alias("r2"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"), F.count("*").alias("n"))


def member(seed: int, width: int, hidden: tuple[int, int] = (64, 32)) -> dict[str, np.ndarray]:
    """Weights of one network with its normalisation statistics, drawn by a seed: stands for trained ones."""
    r = np.random.default_rng(seed)
    sizes, out = (width, *hidden, 1), {}
    for i in range(3):
        out[f"w{i}"] = r.standard_normal((sizes[i], sizes[i + 1])) / np.sqrt(sizes[i])
        out[f"b{i}"] = r.standard_normal(sizes[i + 1]) * 0.1
        if i < 2:
            out |= {f"mean{i}": r.standard_normal(sizes[i + 1]) * 0.1, f"var{i}": r.random(sizes[i + 1]) + 0.5, f"gain{i}": r.random(sizes[i + 1]) + 0.5, f"shift{i}": r.standard_normal(sizes[i + 1]) * 0.1}
    return out


def load_members(spark: SparkSession, path: str) -> list[dict[str, np.ndarray]]:
    """The networks of an ensemble from a table of their units, checked: layers 0, 1 and 2 without gaps, units numbered from 0, as many
    weights as the layer before has units, finite numbers, variances of 0 and more, all members of one width.

    Columns: member, layer, unit, weights array<double>, bias; mean, variance, gain and shift, which the last layer has no use for.
    The table is read by the driver and sent to the tasks; its size is checked first.
    """
    df = spark.read.parquet(path)
    if missing := {"member", "layer", "unit", "weights", "bias", "mean", "variance", "gain", "shift"} - set(df.columns):
        raise ValueError(f"the weights lack {sorted(missing)}")
    numbers, rows = df.agg(F.sum(F.size("weights")), F.count("*")).first()
    if not rows:
        raise ValueError(f"{path} holds no network")
    if (numbers or 0) + 5 * rows > MOST_NUMBERS:
        raise ValueError(f"{numbers} weights are more than {MOST_NUMBERS}")
    units: dict[int, dict[int, list]] = {}
    for u in df.orderBy("member", "layer", "unit").collect():
        units.setdefault(u.member, {}).setdefault(u.layer, []).append(u)
    members = []
    for m, layers in units.items():
        if sorted(layers) != [0, 1, 2]:
            raise ValueError(f"member {m} has the layers {sorted(layers)}")
        out: dict[str, np.ndarray] = {}
        for i in range(3):
            own = layers[i]
            if [u.unit for u in own] != list(range(len(own))):
                raise ValueError(f"member {m}, layer {i}: units aren't numbered from 0 without gaps")
            wide = len(layers[i - 1]) if i else len(own[0].weights or [])
            if any(u.weights is None or len(u.weights) != wide for u in own):
                raise ValueError(f"member {m}, layer {i}: not all units have {wide} weights")
            out[f"w{i}"] = np.array([u.weights for u in own], float).T
            columns = ["bias", *(["mean", "variance", "gain", "shift"] if i < 2 else [])]
            out |= {f"{NAMES[c]}{i}": np.array([getattr(u, c) for u in own], float) for c in columns}
        if not all(np.isfinite(x).all() for x in out.values()) or any((out[f"var{i}"] < 0).any() for i in range(2)):
            raise ValueError(f"member {m} has null or non-finite numbers or a negative variance")
        if len(layers[2]) != 1:
            raise ValueError(f"member {m} has {len(layers[2])} outputs")
        members.append(out)
    if len({x["w0"].shape[0] for x in members}) != 1:
        raise ValueError("the members have unlike numbers of features")
    return members


def forward(w: dict[str, np.ndarray], x: np.ndarray, eps: float = 1e-5) -> np.ndarray:
    """Two layers, each linear, normalised by its statistics and rectified, then a linear output; no dropout when scoring."""
    for i in range(2):
        x = x @ w[f"w{i}"] + w[f"b{i}"]
        x = np.maximum(0, (x - w[f"mean{i}"]) / np.sqrt(w[f"var{i}"] + eps) * w[f"gain{i}"] + w[f"shift{i}"])
    return (x @ w["w2"] + w["b2"])[:, 0]


def predict(df: DataFrame, keys: list[str], feature: str, members: list[dict[str, np.ndarray]]) -> DataFrame:
    """(keys, member, prediction): each batch of rows is one matrix for each member. A row without features, or with a null or NaN one, gets null."""
    weights = df.sparkSession.sparkContext.broadcast(members)
    width = members[0]["w0"].shape[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.array([r if r is not None and len(r) == width else [np.nan] * width for r in pdf[feature]], float).reshape(-1, width)
            for m, w in enumerate(weights.value):
                y = forward(w, x)
                yield pdf[keys].assign(member=np.int32(m), prediction=[None if np.isnan(v) else v for v in y])

    schema = ", ".join(f"{k} {dict(df.dtypes)[k]}" for k in keys)
    return df.select(*keys, feature).mapInPandas(run, f"{schema}, member int, prediction double")


def ensemble(predictions: DataFrame, keys: list[str]) -> DataFrame:
    return predictions.groupBy(*keys).agg(F.avg("prediction").alias("mean"), F.stddev_pop("prediction").alias("std"), F.count("prediction").alias("members"))
