"""Toxicity severity: cumulative-link ordinal regression on sparse text features.

``P(grade >= k) = sigmoid(w . x - t_k)`` with one weight vector shared by all
ordered thresholds ``t_1 <= t_2``; the score is the expected grade. Labels are
binary, so grades are derived: 0 for clean texts; toxic ones get 1 or 2, by
whether they hold fewer or more of the terms that set toxic texts apart than the
median toxic text. Features are damped counts of the words and word beginnings whose presence tells
the classes apart best (a G statistic over document frequencies).

Fitting uses at most ``max_rows`` labelled rows, chosen by a hash of the id;
every text is scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import membership, staged
from .quality import held_out

_SPLIT = bytes.maketrans(
    bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122)),
    b" " * sum(not (48 <= c <= 57 or 97 <= c <= 122) for c in range(128)))


def terms(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII bytes."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_SPLIT).split() if text else []


def features(text: str | None) -> Counter:
    """Counts of the words and, marked, of the first five bytes of longer ones (inflected forms share a stem)."""
    words = Counter(terms(text))
    stems: Counter = Counter()
    for w, n in words.items():
        if len(w) > 5:
            stems[b"^" + w[:5]] += n
    words.update(stems)
    return words


@dataclass
class Model:
    index: dict[bytes, int]
    w: np.ndarray
    cuts: np.ndarray        # ordered thresholds

    def vector(self, text: str | None) -> dict[int, float]:
        index = self.index
        return {index[t]: float(np.log1p(n)) for t, n in features(text).items() if t in index}

    def above(self, text: str | None) -> np.ndarray:
        """``P(grade >= k)`` for each threshold."""
        eta = sum(self.w[i] * v for i, v in self.vector(text).items())
        return 1 / (1 + np.exp(np.clip(self.cuts - eta, -500, 500)))


def select_terms(rows: DataFrame, count: int, least: float = 25.0) -> list[bytes]:
    """Up to ``count`` terms that mark toxic texts, by a G statistic of document frequencies of ``least`` or more."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter = Counter()
            toxic: Counter = Counter()
            for t, y in zip(b["t"], b["y"]):
                own = set(features(t))
                seen.update(own)
                if y:
                    toxic.update(own)
            yield pd.DataFrame({"w": list(seen), "n": list(seen.values()), "k": [toxic[w] for w in seen]})

    total = rows.agg(F.count("*").alias("n"), F.sum("y").alias("k")).first()
    n, k = total.n, total.k or 0
    if not 0 < k < n:
        return []
    share = k / n
    df = rows.select("t", "y").mapInPandas(words, "w binary, n bigint, k bigint").groupBy("w").agg(
        F.sum("n").alias("n"), F.sum("k").alias("k"))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    present = part(F.col("k"), F.col("n") * share) + part(F.col("n") - F.col("k"), F.col("n") * (1 - share))
    off = F.lit(n) - F.col("n")
    absent = part(k - F.col("k"), off * share) + part(off - (k - F.col("k")), off * (1 - share))
    best = (df.where(F.col("k") > 1).select("w", (present + absent).alias("g"), (F.col("k") / F.col("n") > share).alias("up"))
            .where((F.col("g") >= least) & F.col("up")).orderBy(F.desc("g"), "w").limit(count).collect())
    return [bytes(r.w) for r in best]


def fit(rows: DataFrame, n_terms: int = 64, l2: float = 1e-4, steps: int = 1500) -> Model:
    """Fit on rows ``(t, y)``, a bounded number of them.

    Without both classes the model has no terms and gives grade 0.
    """
    model = Model({t: i for i, t in enumerate(select_terms(rows, n_terms))}, np.zeros(0), np.array([4.0, 8.0]))
    if not model.index:
        return model
    d = len(model.index)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [model.vector(t) for t in b["t"]]
            yield pd.DataFrame({"y": b["y"], "i": [list(f) for f in found], "v": [list(f.values()) for f in found]})

    got = rows.select("t", "y").mapInPandas(vectors, "y int, i array<int>, v array<double>").toPandas()
    x = np.zeros((len(got), d))
    for r, (i, v) in enumerate(zip(got["i"], got["v"])):
        x[r, list(i)] = v
    y = got["y"].to_numpy()
    hits = (np.expm1(x)).sum(axis=1)
    grade = np.where(y == 0, 0, 1 + (hits > np.median(hits[y == 1])))
    # log-likelihood by Adam over w, the first cut, and the log of the gap to the second
    theta = np.concatenate([np.full(d, 0.1), [2.0, 1.0]])
    m, s = np.zeros(d + 2), np.zeros(d + 2)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, steps + 1):
        w, c1, gap = theta[:d], theta[d], np.exp(theta[d + 1])
        eta = x @ w
        a, b = sig(eta - c1), sig(eta - c1 - gap)       # P(>=1), P(>=2)
        p = np.clip(np.select([grade == 0, grade == 1], [1 - a, a - b], b), 1e-9, None)
        da = np.select([grade == 0, grade == 1], [-1.0, 1.0], 0.0) * a * (1 - a) / p
        db = np.select([grade == 1, grade == 2], [-1.0, 1.0], 0.0) * b * (1 - b) / p
        g = np.concatenate([-(x.T @ (da + db)) / len(x) + l2 * w,
                            [np.mean(da + db), np.mean(db) * gap]])
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        theta -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    model.w, model.cuts = theta[:d], np.array([theta[d], theta[d] + np.exp(theta[d + 1])])
    return model


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Learn from labelled rows that are not held out; at most ``max_rows`` rows, by a hash of the id.

    An id with several rows in the documents counts once, with its smallest text
    (nulls only where it has no other). An id with several labels is toxic if any says so; null labels and ids are left out.
    """
    picked = staged(
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows), "toxicity-labels")
    # the sample is bounded by max_rows, so it may be broadcast
    wanted = membership(picked, F.xxhash64("id"))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .where(wanted(F.xxhash64("id"))).join(F.broadcast(picked), "id")
            .groupBy("id").agg(F.min("t").alias("t"), F.min("y").alias("y")).select("t", "y"))
    return fit(staged(rows, "toxicity-rows"))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``held_out``, ``score`` (probability of any toxicity), ``severity``
    (expected grade, 0 to 2), ``grade`` (the likeliest), ``predicted`` (1 where the score reaches ``threshold``).

    Null and empty texts have no features and get the base rate's grade. A null
    id counts as held out. Only the id and text columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.array([model.above(t) for t in b["t"]]).reshape(len(b), 2)
            grade = np.argmax(np.column_stack([1 - p[:, 0], p[:, 0] - p[:, 1], p[:, 1]]), axis=1)
            yield pd.DataFrame({"id": b["id"], "score": p[:, 0], "severity": p.sum(axis=1), "grade": grade})

    out = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
           .mapInPandas(run, f"id {kind}, score double, severity double, grade int"))
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", "severity", "grade",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
