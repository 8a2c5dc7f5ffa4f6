"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of words (with their borders). Document frequencies come from all training documents; the
weights are fitted on a bounded sample of them with follow-the-regularised-leader and elastic-net penalties, and one
temperature is fitted on the part of the sample that the weights have not seen.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import Memo, map_batches, texts_of

SLOTS = 1 << 16
SCALE = 40.0


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def _slot(*codes: np.ndarray) -> np.ndarray:
    """Slots of n-grams, given the code points at each place."""
    h = np.full(len(codes[0]), len(codes), np.uint64)
    for c in codes:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


def gram_slots(text: str) -> np.ndarray:
    """Slots of all n-grams of one to three letters inside words, borders included; empty if the text has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    c = np.concatenate([[0], np.where(letters()[points], points, 0), [0]]).astype(np.uint64)
    c = c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]  # one border between words
    if len(c) < 3:
        return np.zeros(0, np.int64)
    inner = c[1:-1] != 0
    return np.concatenate([_slot(c[c != 0]), _slot(c[:-1], c[1:]), _slot(c[:-2][inner], c[1:-1][inner], c[2:][inner])])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of a text and how often each occurs."""
    counts = np.bincount(gram_slots(text), minlength=SLOTS)
    slots = np.flatnonzero(counts)
    return slots, counts[slots]


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents per slot, and documents with letters, over all rows. At most SLOTS + 1 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memo.leave_only()
        df, n = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for t in texts_of(batch.column(0)):
                slots = gram_slots(t)
                if len(slots):
                    n += 1
                    df += np.bincount(slots, minlength=SLOTS) > 0
        full = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1)), pa.array(np.append(df[full], n))], names=["slot", "n"])

    rows = docs.select(text).mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    df, slot, n = np.zeros(SLOTS), rows["slot"].to_numpy(), rows["n"].to_numpy()
    df[slot[slot >= 0]] = n[slot >= 0]
    return df, int(n[slot < 0].sum())


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # slots x languages, idf included
    bias: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str) -> tuple[str, float]:
        slots = gram_slots(text)
        if not len(slots) or not self.langs:
            return "und", 0.0
        logits = (SCALE * (np.bincount(slots, minlength=SLOTS) @ self.weights) / len(slots) + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, alpha=0.5, beta=1.0, l1=0.02, l2=0.02, epochs=3):
    """Weights and bias by FTRL-proximal: per-coordinate rates, L1 keeps most coordinates at zero, L2 keeps the rest small."""
    z, n = np.zeros((SLOTS + 1, n_langs)), np.zeros((SLOTS + 1, n_langs))

    def weights(z, n):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for slots, x, y in rows:
            slots, x = np.append(slots, SLOTS), np.append(x, 1.0)  # the last slot is the bias
            zs, ns = z[slots], n[slots]
            w = weights(zs, ns)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1.0
            g = np.outer(x, p)
            z[slots] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[slots] = ns + g * g
    w = weights(z, n)
    return w[:-1], w[-1]


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss."""
    grid = np.exp(np.linspace(np.log(0.1), np.log(10.0), 200))

    def loss(t):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    return float(min(grid, key=loss)) if len(y) else 1.0


def train(docs: DataFrame, labels: Column, per_lang: int = 1500, text: str = "text", lang: str = "lang", order: str = "doc_id") -> Model:
    """Model from the rows where ``labels`` holds and the language is known.

    Statistics cover all such rows. The fit takes about ``per_lang`` rows of each language (all of them, if fewer), chosen by a
    hash of ``order``; a fifth of these fit the temperature. Only the features of this sample reach the driver.
    """
    known = docs.where(labels & F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(order).alias("h"))
    df, n_docs = document_frequencies(known, "t")
    sizes = {r["l"]: r["n"] for r in known.groupBy("l").agg(F.count("*").alias("n")).collect()}  # a row per language
    langs = sorted(sizes)
    idf = np.log((1 + n_docs) / (1 + df)) + 1.0
    if not langs:
        return Model([], np.zeros((SLOTS, 0)), np.zeros(0))
    million = 1_000_000
    keep = F.lit(False)
    for l, n in sizes.items():
        keep = keep | ((F.col("l") == l) & (F.pmod("h", F.lit(million)) < F.lit(min(million, -(-per_lang * million // n)))))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [gram_counts(t) for t in texts_of(batch.column(0))]
        return pa.RecordBatch.from_pydict({
            "l": batch.column(1), "h": batch.column(2), "slots": pa.array([s.astype("<i4").tobytes() for s, _ in found], pa.binary()),
            "x": pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary()),
        })

    sample = map_batches(known.where(keep), run, "l string, h bigint, slots binary, x binary").toArrow()
    rows = []
    for _, l, x, slots in sorted(zip(*(sample[c].to_pylist() for c in ("h", "l", "x", "slots")), strict=True)):
        slots, x = np.frombuffer(slots, "<i4").astype(np.int64), np.frombuffer(x, "<f4").astype(np.float64)
        if len(slots):
            rows.append((slots, SCALE * x / x.sum() * idf[slots], langs.index(l)))
    fit, check = [r for i, r in enumerate(rows) if i % 5], rows[::5]
    weights, bias = ftrl(fit, len(langs))
    model = Model(langs, weights * idf[:, None], bias)
    if check:
        logits = np.array([x @ weights[slots] + bias for slots, x, _ in check])
        model.temperature = best_temperature(logits, np.array([y for _, _, y in check]))
    return model


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Predicted language and calibrated probability of every whole text: the carried columns, ``lang_pred``, ``score``.

    Texts that are null or hold no letter are ``und`` with score 0, as is every text if nothing could be learned.
    """
    carry = [key] if carry is None else carry
    schema = docs.select(*carry).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in texts_of(batch.column(0))]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=schema.names)

    return docs.select(F.col(text).alias("_text"), *carry).mapInArrow(run, schema)


def bucket_of(key: str, n: int) -> Column:
    return F.crc32(F.col(key).cast("string")) % n
