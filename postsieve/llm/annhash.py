"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors become codes of 128 bits: signs after rotations that are learned (principal axes, then iterative quantization) on a
bounded sample. A code is cut into substrings and each substring is indexed. Codes within Hamming radius r agree in at least
one of m substrings up to r // m bits, so probing those finds every one of them; what is found is ranked by inner product.

Vectors are dealt by hash into index shards and queries into blocks; every block meets every shard, and each pair is a group of
bounded size whatever the data. Each shard returns its best of each query, and those are merged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.llm.common import hashed_share

BITS, PIECE = 128, 16


@dataclass
class Coder:
    """Projections to code bits, and the radius that holds the wanted share of true neighbours in the sample."""

    projection: np.ndarray
    longest: float
    radius: int

    def stored(self, x: np.ndarray) -> np.ndarray:
        """Codes of stored vectors: one more axis makes all equally long, so that angles rank as inner products."""
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0.0))
        return self._code(np.column_stack([x, rest]))

    def asked(self, q: np.ndarray) -> np.ndarray:
        return self._code(np.column_stack([q, np.zeros(len(q))]))

    def _code(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.projection > 0, axis=1).view(np.uint16)


def learn_projection(x: np.ndarray, rounds: int = 25, seed: int = 7) -> np.ndarray:
    """Rotations that bring the signs of the principal axes close to the vectors, as many as fill the code."""
    rng = np.random.default_rng(seed)
    _, s, axes = np.linalg.svd(x, full_matrices=False)
    axes = axes[s > 1e-9 * max(s[0], 1e-300)][: BITS // 2].T
    v, found = x @ axes, []
    while sum(f.shape[1] for f in found) < BITS:
        r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.sign(v @ r).T @ v, full_matrices=False)
            r = (u @ w).T
        found.append(axes @ r)
    return np.concatenate(found, axis=1)[:, :BITS]


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum(axis=-1, dtype=np.int64)


def fit(sample: np.ndarray, longest: float, k: int = 20, share: float = 0.98, probes: int = 256) -> Coder:
    """Coder from a sample. The radius covers ``share`` of the pairs (vector, one of its k nearest) inside the sample; in more
    vectors the nearest are nearer still, so it covers at least as many there.
    """
    rest = np.sqrt(np.maximum(longest**2 - (sample * sample).sum(axis=1), 0.0))
    coder = Coder(learn_projection(np.column_stack([sample, rest])), longest, BITS)
    probes = min(probes, len(sample))
    scores = sample[:probes] @ sample.T
    scores[np.arange(probes), np.arange(probes)] = -np.inf
    k = min(k, len(sample) - 1)
    if k > 0:
        nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        codes, asked = coder.stored(sample), coder.asked(sample[:probes])
        coder.radius = int(np.quantile(hamming(asked[:, None, :], codes[nearest]), share))
    return coder


class Index:
    """Substring tables of one shard."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for j in range(codes.shape[1]):
            values, at = np.unique(codes[:, j], return_inverse=True)
            self.tables.append((values, at))

    def within(self, asked: np.ndarray, radius: int) -> np.ndarray:
        """For each query, which codes lie within the radius: probe by substring, then count all bits of what was met.

        Of the 2^16 values of a substring only those that occur are probed: those within reach of the query's substring.
        """
        reach = radius // len(self.tables)
        met = np.zeros((len(asked), len(self.codes)), bool)
        for j, (values, at) in enumerate(self.tables):
            near = np.bitwise_count(asked[:, j, None] ^ values) <= reach
            met |= near[:, at]
        q, v = np.nonzero(met)
        far = hamming(asked[q], self.codes[v]) > radius
        met[q[far], v[far]] = False
        return met


def search_shard(ids, x, query_ids, q, coder: Coder, k: int, step: int = 64):
    """The k best found per query: lists of (query_id, vec_id, score). Where the radius holds fewer than k, it grows."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    index, out = Index(coder.stored(x)), ([], [], [])
    for lo in range(0, len(q), step):
        asked, mine = coder.asked(q[lo : lo + step]), query_ids[lo : lo + step]
        hits = index.within(asked, coder.radius)
        for i, (own, code) in enumerate(zip(mine, asked, strict=True)):
            found, radius = np.flatnonzero(hits[i] & (ids != own)), coder.radius
            while len(found) < k and radius < BITS:
                radius += 8
                found = np.flatnonzero(index.within(code[None], radius)[0] & (ids != own))
            scores = np.einsum("ij,j->i", x[found], q[lo + i])
            best = np.lexsort((ids[found], -scores))[:k]
            out[0].append(np.full(len(best), own))
            out[1].append(ids[found[best]])
            out[2].append(scores[best])
    return [np.concatenate(o) if o else np.zeros(0) for o in out]


def nearest(
    vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    sample: int = 8192, shard_rows: int = 8192, block_rows: int = 4096,
) -> DataFrame:
    """The k nearest by inner product of every query row, as far as found: query_id, rank, vec_id, score.

    Vectors that are null, zero, hold null or non-finite components, have no key or another length than most take no part.
    A query's own key is no candidate of it; ties go to the smaller key. The fit reads at most ``sample`` vectors, chosen by a
    hash of the key; every vector is indexed. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    usable = v.isNotNull() & F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks")).where(usable)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("bigint")).alias("q"))
    most = lengths.orderBy(F.desc("n"), "d").first()
    schema = "query_id bigint, vec_id bigint, score double"
    if most is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == most["d"])
    longest = rows.agg(F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    picked = rows.where(hashed_share("id", most["n"], 2 * sample)).orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()["v"].combine_chunks()
    coder = fit(picked.flatten().to_numpy().reshape(-1, most["d"]), longest, k)
    shards = max(-(-most["n"] // shard_rows), spark.sparkContext.defaultParallelism)
    blocks = max(-(-(most["q"] or 0) // block_rows), 1)
    at = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = rows.select("id", "v", at(shards, 1).alias("shard"), every(blocks).alias("block"))
    asking = rows.where("asks").select("id", "v", at(blocks, 2).alias("block"), every(shards).alias("shard"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            (ids, x), (query_ids, q) = (
                (t["id"].to_numpy(), t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)) for t in (left, right)
            )
            a, b, c = search_shard(ids, x, query_ids, q, coder, k)
        else:
            a, b, c = [], [], []
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    found = stored.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInArrow(run, schema)
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
