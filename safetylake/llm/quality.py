"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A text becomes a short vector of statistics. Random Fourier features of the
standardised vector approximate a Gaussian kernel; the normal equations of ridge
regression on them are summed per partition and then over a fixed number of
groups, so what reaches the driver is a few matrices of a fixed size, however
many labelled rows there are. Raw scores are binned at a fixed resolution, and
pool-adjacent-violators on the bins gives the monotone map to probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_of, staged

N_STATS = 16
_PUNCT = bytes(set(range(0x21, 0x7F)) - set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_TO_CLASS = bytes.maketrans(
    bytes(range(128)),
    bytes((ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 else ord("0") if 48 <= c <= 57
           else ord(" ") if c in (32, 9, 10, 11, 12, 13) else ord("!")) for c in range(128)))


def statistics(text: str | None) -> list[float]:
    """``N_STATS`` numbers about one whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return [0.0] * N_STATS
    cls = raw.translate(_TO_CLASS)
    up, low, dig, space, other = (cls.count(c) for c in (b"A", b"a", b"0", b" ", b"!"))
    high = n - up - low - dig - space - other
    words = raw.split()
    w = max(1, len(words))
    freq = Counter(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = raw.split(b"\n")
    upper_words = len(re.findall(rb"A{2,}", cls))
    stray = len(re.findall(rb"!{2,}", cls))
    lone = len(re.findall(rb"(?<![^ ])!+(?![^ ])", cls))
    ends = raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")
    letters = max(1, up + low + high)
    return [
        np.log1p(n), np.log1p(w), len(raw) / w, len(freq) / w,
        max(freq.values(), default=0) / w, same / w, up / letters, upper_words / w,
        dig / n, other / n, stray / w, lone / w,
        ends / w, np.log1p(w / max(1, ends)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", uid_col: str | None = None) -> DataFrame:
    """``(_uid, id, x)`` for each row, written to the shared folder: texts are read once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"_uid": b["_uid"], "id": b["id"], "x": [statistics(t) for t in b["t"]]})

    rows = rows_of(docs, uid_col, F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return staged(rows.mapInPandas(run, f"_uid bigint, id {kind}, x array<double>"), "quality-x")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray           # frequencies, N_STATS x dim
    b: np.ndarray
    beta: np.ndarray
    cuts: np.ndarray        # isotonic: bin centres and their probabilities
    probs: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(((x - self.mean) / self.scale) @ self.w + self.b)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.cuts, self.probs) if len(x) else np.zeros(0)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the weighted monotone fit of y."""
    pools: list[list[float]] = []
    for v, c in zip(y, weight):
        pools.append([v, c, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, c2, n2 = pools.pop()
            v1, c1, n1 = pools.pop()
            pools.append([(v1 * c1 + v2 * c2) / (c1 + c2), c1 + c2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools])


def fit(x: DataFrame, dim: int = 256, gamma: float = 0.08, ridge: float = 1e-3, bins: int = 400, groups: int = 8,
        seed: int = 17) -> Model:
    """Fit on rows ``(x array<double>, y double)``, all of them.

    Without rows, or with one class only, the score is that class's share (0.5
    without rows).
    """
    moments = x.select(*[F.struct(F.avg(F.col("x")[i]).alias("m"), F.stddev_pop(F.col("x")[i]).alias("s")).alias(f"c{i}")
                         for i in range(N_STATS)]).first()
    mean = np.array([c.m or 0.0 for c in moments])
    scale = np.array([c.s if c.s and c.s > 1e-9 else 1.0 for c in moments])
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2 * gamma), (N_STATS, dim))
    b = rng.uniform(0, 2 * np.pi, dim)
    model = Model(mean, scale, w, b, np.zeros(dim + 1), np.zeros(1), np.array([0.5]))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, v, n = np.zeros((dim + 1, dim + 1)), np.zeros(dim + 1), 0
        for batch in batches:
            if len(batch):
                z = model.lift(np.stack(batch["x"].to_numpy()))
                a += z.T @ z
                v += z.T @ batch["y"].to_numpy(dtype=float)
                n += len(batch)
        if n:
            yield pd.DataFrame({"a": [a.tobytes()], "v": [v.tobytes()], "n": [n]})

    def add(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, v, n = 0, 0, 0
        for batch in batches:           # Arrow batches of a group, one at a time
            for r in batch.itertuples():
                a, v, n = a + np.frombuffer(r.a), v + np.frombuffer(r.v), n + r.n
        yield pd.DataFrame({"a": [a.tobytes()], "v": [v.tobytes()], "n": [n]})

    shape = "a binary, v binary, n bigint"
    parts = x.select("x", "y").mapInPandas(sums, shape).withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups)))
    a, v, n = np.zeros((dim + 1, dim + 1)), np.zeros(dim + 1), 0
    for r in parts.groupBy("g").applyInPandas(_iterated(add), shape).toLocalIterator():
        a, v, n = a + np.frombuffer(r.a).reshape(a.shape), v + np.frombuffer(r.v), n + r.n
    if not n:
        return model
    model.beta = np.linalg.solve(a / n + ridge * np.eye(dim + 1), v / n)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                s = np.clip(model.raw(np.stack(batch["x"].to_numpy())), -0.5, 1.5)
                yield pd.DataFrame({"bin": np.floor((s + 0.5) / 2 * bins).astype("int64"), "y": batch["y"]})

    got = (x.select("x", "y").mapInPandas(binned, "bin bigint, y double")
           .groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect())
    model.cuts = np.array([(r.bin + 0.5) / bins * 2 - 0.5 for r in got])
    model.probs = isotonic(np.array([r.y for r in got]), np.array([r.n for r in got], dtype=float))
    return model


def _iterated(add):
    """A grouped function over (key, batches), whose input is never held whole."""
    def run(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return add(key, batches)
    return run


def score(x: DataFrame, model: Model) -> DataFrame:
    """``(_uid, id, x)`` to ``(_uid, id, score)``."""
    kind = x.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = model.score(np.stack(b["x"].to_numpy())) if len(b) else np.zeros(0)
            yield pd.DataFrame({"_uid": b["_uid"], "id": b["id"], "score": s})

    return x.mapInPandas(run, f"_uid bigint, id {kind}, score double")


def held_out(id_col: str = "doc_id", remainder: int = 0) -> Column:
    """True where crc32 of the id as text leaves ``remainder`` by 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == remainder, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", uid_col: str | None = None) -> DataFrame:
    """One row per document row: ``_uid`` (``uid_col``, if given), id, ``held_out``, ``score``, ``predicted``.

    Learns from labelled rows that are not held out; several labels of one id are
    averaged, null labels and labels without a document are ignored. Null and
    empty texts have all statistics 0 and are scored like any other. Rows with a
    null id are scored, never learned from. Only the named columns are read.
    """
    x = features(docs, id_col, text_col, uid_col)
    y = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
         .agg(F.avg(F.col(label_col).cast("double")).alias("y")))
    train = staged(x.where(~held_out("id")).join(y, "id").select("x", "y"), "quality-train")
    model = fit(train)
    return score(x, model).select(
        "_uid", F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))


def crc_remainder(doc_id: object) -> int:
    """The fold of one id, outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 5
