"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation of the centred vectors is learned on a bounded sample so that the
signs of the rotated coordinates are balanced, faithful bits; rotations from
several starts fill 128 bits. The code is cut into eight 16-bit parts with a
table each. A pair is retrieved where one part differs by at most one bit and the
whole code by at most ``radius``, and kept where the cosine of the original
vectors, in double precision, reaches the threshold. Only the sample is bounded:
every vector is indexed, every retrieved pair is reranked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, staged, stored, with_uid

PARTS, WIDTH, CODE = 8, 16, 128


def learn(sample: np.ndarray, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(mean, projection)`` to ``CODE`` coordinates whose signs are the code."""
    d = sample.shape[1]
    mean = sample.mean(axis=0) if len(sample) else np.zeros(d)
    rng = np.random.default_rng(seed)
    x = sample - mean
    _, _, basis = np.linalg.svd(x.T @ x) if len(sample) > 1 else (None, None, np.eye(d))
    keep = basis[:min(d, CODE)].T                       # principal directions, strongest first
    out: list[np.ndarray] = []
    while sum(p.shape[1] for p in out) < CODE:
        r, _ = np.linalg.qr(rng.normal(size=(keep.shape[1],) * 2))
        v = x @ keep
        for _ in range(rounds if len(sample) > 1 else 0):
            u, _, wt = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ wt).T
        out.append(keep @ r)
    return mean, np.hstack(out)[:, :CODE]


def codes(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Two 64-bit integers a row."""
    bits = (unit - mean) @ projection >= 0
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").reshape(-1, 2)


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(_uid, id, v, dim, norm, same)``; dim is null where a vector can link with nothing."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for e in b["v"]:
                v = None if e is None else np.array([np.nan if c is None else c for c in e], dtype=np.float64)
                if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
                    rows.append((None, None, None, None))
                    continue
                v = v + 0.0                             # one zero
                norm = float(np.linalg.norm(v / np.abs(v).max()) * np.abs(v).max())
                rows.append((v, len(v), norm, hashlib.md5(v.tobytes()).digest()))
            out = pd.DataFrame(rows, columns=["v", "dim", "norm", "same"])
            out["dim"] = out["dim"].astype("Int32")
            yield pd.concat([b[["_uid", "id"]].reset_index(drop=True), out], axis=1)

    rows = with_uid(stored(df).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")))
    return rows.mapInPandas(run, f"_uid bigint, id {kind}, v array<double>, dim int, norm double, same binary")


def _coded(reps: DataFrame, mean: np.ndarray, projection: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                unit = np.stack(b["v"].to_numpy()) / b["norm"].to_numpy()[:, None]
                c = codes(unit, mean, projection)
                yield pd.DataFrame({"n": b["n"], "c0": c[:, 0], "c1": c[:, 1]})

    return reps.select("n", "v", "norm").mapInPandas(run, "n bigint, c0 bigint, c1 bigint")


def _part(slot: int, c0: Column, c1: Column) -> Column:
    return F.shiftrightunsigned(c0 if slot < 4 else c1, WIDTH * (slot % 4)).bitwiseAND(F.lit(0xFFFF).cast("bigint")).cast("int")


def candidates(code: DataFrame, radius: int) -> DataFrame:
    """Pairs ``(a, b)``, a < b, that share a table entry up to one bit; each pair once."""
    parts = F.array(*[_part(k, F.col("c0"), F.col("c1")) for k in range(PARTS)])
    index = code.select("n", "c0", "c1", F.posexplode(parts)).withColumnsRenamed({"pos": "slot", "col": "sub"})
    flips = F.array(F.lit(0), *[F.lit(1 << i) for i in range(WIDTH)])
    probe = index.select("n", "c0", "c1", "slot", F.explode(F.transform(
        flips, lambda f: F.col("sub").bitwiseXOR(f))).alias("sub"))
    a = index.select("slot", "sub", F.col("n").alias("a"), F.col("c0").alias("a0"), F.col("c1").alias("a1"))
    b = probe.select("slot", "sub", F.col("n").alias("b"), F.col("c0").alias("b0"), F.col("c1").alias("b1"))
    x0, x1 = F.col("a0").bitwiseXOR(F.col("b0")), F.col("a1").bitwiseXOR(F.col("b1"))
    first = F.coalesce(*[F.when(F.bit_count(_part(k, x0, x1)) <= 1, F.lit(k)) for k in range(PARTS)])
    # the probes are 136 times their table: never a broadcast by the table's size
    return (a.join(b.hint("merge"), ["slot", "sub"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(x0) + F.bit_count(x1) <= radius) & (first == F.col("slot")))
            .select("a", "b"))


def rerank(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose original vectors have that cosine or more, in double precision."""
    both = (pairs.join(reps.select(F.col("n").alias("a"), F.col("v").alias("va"), F.col("norm").alias("na")), "a")
            .join(reps.select(F.col("n").alias("b"), F.col("v").alias("vb"), F.col("norm").alias("nb")), "b"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for t in batches:
            if t.num_rows:
                x, y = (t.column(c).flatten().to_numpy().reshape(t.num_rows, -1) for c in ("va", "vb"))
                n = t.column("na").to_numpy()[:, None], t.column("nb").to_numpy()[:, None]
                near = np.einsum("ij,ij->i", x / n[0], y / n[1]) >= threshold
                yield t.select(["a", "b"]).filter(pa.array(near))

    return both.select("a", "b", "va", "na", "vb", "nb").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, threshold: float = 0.9, radius: int = 36, sample: int = 8192,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept``.

    Equal vectors are one entry of the index and link with each other; their
    number counts in ``n_links``. Vectors that are null, empty, zero, or hold a
    null or non-finite component link with nothing; vectors of different lengths
    do not link. A repeated row is a further equal vector. ``component_id`` is the
    smallest id reachable; a null id is smallest only where all are null. Only
    the id and vector columns are read. ``sample`` bounds the vectors that the
    rotation is learned from, nothing else.
    """
    rows = staged(_vectors(df, id_col, vec_col), "itq-rows")
    # scaled to the smallest row number of the equal vectors: a node of the graph
    groups = staged(rows.where("dim IS NOT NULL").groupBy("same", "dim").agg(
        F.min("_uid").alias("n"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("low")), "itq-groups")
    reps = staged(rows.join(groups.select(F.col("n").alias("_uid")), "_uid")
                  .select(F.col("_uid").alias("n"), "v", "norm", "dim"), "itq-reps")
    links: DataFrame | None = None
    for (dim,) in reps.select("dim").distinct().collect():
        own = reps.where(F.col("dim") == dim)
        drawn = own.orderBy(F.xxhash64("n")).limit(sample).select("v", "norm").toPandas()
        mean, projection = learn(np.stack(drawn["v"].to_numpy()) / drawn["norm"].to_numpy()[:, None])
        code = staged(_coded(own, mean, projection), "itq-codes")
        found = staged(rerank(staged(candidates(code, radius), "itq-candidates"), own, threshold), "itq-links")
        links = found if links is None else links.union(found)
    if links is None:
        links = rows.select(F.col("_uid").alias("a"), F.col("_uid").alias("b")).limit(0)
    size = groups.select(F.col("n").alias("b"), "copies")
    degree = (links.union(links.select("b", "a")).join(size, "b").groupBy(F.col("a").alias("n"))
              .agg(F.sum("copies").alias("others")))
    comp = components(links, "itq-cc")
    node = (groups.join(degree, "n", "left").join(comp.withColumnRenamed("id", "n"), "n", "left")
            .withColumn("root", F.coalesce("component", "n")))
    least = staged(node.groupBy("root").agg(F.min("low").alias("least")), "itq-least")
    node = staged(node.join(least, "root").select(
        "same", "dim", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.col("least.id").alias("component")), "itq-nodes")
    linked = rows.where("dim IS NOT NULL").join(node, ["same", "dim"]).select("id", "links", "component")
    alone = rows.where("dim IS NULL").select("id", F.lit(0).cast("bigint"), "id")
    return linked.union(alone).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))
