"""Document fingerprints that add up: a homomorphic multiset hash over the paragraphs of a text.

A paragraph is hashed with its number among its equals in the text (0, 1, ...), so every vector that is summed is another one, and the sums
still depend on the multiset alone: order does not matter, a further copy is added under the next number, and one is taken away under the last.
A fingerprint sums two wide vectors, lane by lane modulo a power of two: four lanes of 64 random bits, for equality, and 1024
lanes of +1 and -1, a sketch. The mean square of the difference of two sketches estimates how many paragraphs two texts do not share.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANES = 1024
SUM_BYTES = 32
#: Sentences and lines, in parts of 64 code points at most, with the marks that end them. The parts make up the whole text.
PARAGRAPH = re.compile(r"[^\n.!?]{1,64}[\n.!?]*|[\n.!?]+")
AT_ONCE = 4096  # parts whose lanes are held side by side


def paragraphs(text: str) -> list[str]:
    return PARAGRAPH.findall(text)


def numbered(parts: Iterable[str], held: Counter) -> Iterator[str]:
    """Names of parts that join a multiset: each with its number among its equals, counted on in ``held``."""
    for p in parts:
        number = held[p]
        held[p] = number + 1
        yield f"{number}:{p}"


class Fingerprint:
    """Sums over the hashed paragraphs of a multiset.

    Adding two fingerprints is the union of their multisets where no paragraph is in both; else make the second one with
    ``held``, the paragraphs of the first, so that its copies are numbered on. Taking away works the same way.
    """

    __slots__ = ("count", "lanes", "sums")

    def __init__(self, parts: Sequence[str] = (), held: Counter | None = None):
        self.count = len(parts)
        self.sums, ones = np.zeros(SUM_BYTES // 8, np.uint64), np.zeros(LANES, np.int64)
        names = numbered(parts, Counter() if held is None else held)
        while chunk := b"".join(hashlib.shake_128(n.encode()).digest(SUM_BYTES + LANES // 8) for n in islice(names, AT_ONCE)):
            drawn = np.frombuffer(chunk, np.uint8).reshape(-1, SUM_BYTES + LANES // 8)
            self.sums += np.ascontiguousarray(drawn[:, :SUM_BYTES]).view("<u8").sum(axis=0, dtype=np.uint64)
            ones += np.unpackbits(drawn[:, SUM_BYTES:], axis=1).sum(axis=0, dtype=np.uint16)
        self.lanes = (2 * ones - self.count).astype(np.uint16)  # modulo 2^16

    @classmethod
    def _made(cls, count: int, sums: np.ndarray, lanes: np.ndarray) -> Fingerprint:
        made = object.__new__(cls)
        made.count, made.sums, made.lanes = count, sums, lanes
        return made

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return self._made(self.count + other.count, self.sums + other.sums, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return self._made(self.count - other.count, self.sums - other.sums, self.lanes - other.lanes)

    def __str__(self) -> str:
        return base64.b64encode(self.count.to_bytes(8, "little") + self.sums.astype("<u8").tobytes() + self.lanes.astype("<u2").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        sums, lanes = np.frombuffer(raw[8 : 8 + SUM_BYTES], "<u8"), np.frombuffer(raw[8 + SUM_BYTES :], "<u2")
        return cls._made(int.from_bytes(raw[:8], "little"), sums.astype(np.uint64), lanes.astype(np.uint16))

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of common paragraphs, 2 |A and B| / (|A| + |B|), copies counted: 1 for equal fingerprints, near 0 without
        common parts. The error has a standard deviation of sqrt(2 / LANES) = 0.044 of the share that is not common."""
        both = self.count + other.count
        gap = (self.lanes - other.lanes).astype(np.int16).astype(np.float64)
        apart = float(gap @ gap) / LANES
        return 1.0 if both == 0 else min(1.0, max(0.0, (both - apart) / both))


def edit(text: str, after: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    k = len(text) // 2
    return text[: len(text) - k] + after[:k]


class _Split:
    """A text, its fingerprint, and the sum over the paragraphs that an edit of its last half leaves alone."""

    def __init__(self, text: str):
        self.text = text
        parts = paragraphs(text)
        cut = len(text) - len(text) // 2
        ends = list(accumulate(map(len, parts)))
        kept = int(np.searchsorted(ends, cut, side="left"))  # paragraphs that end before the cut; the next code point is kept too
        self.held = Counter()
        self.head = Fingerprint(parts[:kept], self.held)
        self.head_end = ends[kept - 1] if kept else 0
        self.print = self.head + Fingerprint(parts[kept:], self.held.copy())

    def edited(self, after: str) -> tuple[str, Fingerprint]:
        new = edit(self.text, after)
        return new, self.head + Fingerprint(paragraphs(new[self.head_end :]), self.held.copy())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint per row: (key, fingerprint). Null counts as empty text; rows stay one to one."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [str(Fingerprint(paragraphs(t or ""))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "fingerprint": pa.array(found, pa.string())})

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fingerprint string")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Rows in ranges of descending key, each range followed by a guest: the first row of the range after it.

    Only the first key of each range passes the driver. Rows without a key come last, in the order of a hash of the text, spread
    over 64 ranges; rows of one key follow each other in that order too, in one range. After the last range comes the first again.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * tasks
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    cuts = sorted(set(rows.select("k").approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    splits = [float("-inf"), *cuts, float("inf")] if cuts else [float("-inf"), 0.0, float("inf")]
    last = len(splits)
    cut = Bucketizer(splits=splits, inputCol="kd", outputCol="b", handleInvalid="keep")
    rows = cut.transform(rows.withColumn("kd", F.col("k").cast("double"))).drop("kd").withColumn("h", F.xxhash64("t"))
    rows = rows.withColumn(
        "r", F.when(F.col("k").isNull(), last + F.lit(31) - F.shiftright("h", 58)).otherwise(last - 1 - F.col("b")).cast("int")
    ).drop("b")
    first = rows.groupBy("r").agg(F.max(F.struct("k", "h")).alias("top")).orderBy("r").collect()  # a row per range
    tops = [(first[(i + 1) % len(first)]["top"], x["r"]) for i, x in enumerate(first)]
    guests = spark.createDataFrame([(t["k"], t["h"], r) for t, r in tops], "gk bigint, gh bigint, to int")
    both = rows.join(F.broadcast(guests), F.col("k").eqNullSafe(F.col("gk")) & (F.col("h") == F.col("gh")), "left")
    own = F.struct(F.col("r"), F.lit(False).alias("guest"))
    places = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("to").alias("r"), F.lit(True).alias("guest"))))
    dealt = both.select("k", "h", "t", F.explode(places).alias("at")).select("k", "h", "t", "at.*")
    return dealt.repartition(tasks, "r").sortWithinPartitions("r", "guest", F.col("k").desc_nulls_last(), F.col("h").desc())


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness; also its likeness to the next document.

    Each text is hashed once. The edited fingerprint is the document's, with the paragraphs behind the cut taken away and those
    of the new end added. Null counts as empty; a lone document is its own next. A task holds two texts and a batch.
    """
    schema = "doc_id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, key, split) of the last row that has not met its next

        for batch in batches:
            out = []
            ks, _, ts, rs, guests = (c.to_pylist() for c in batch.columns)
            for k, t, r, guest in zip(ks, ts, rs, guests, strict=True):
                if guest and held is None:
                    continue  # a further copy of the guest
                new = _Split(t or "")
                if held is not None and held[0] == r:
                    _, own_key, own = held
                    edited, edited_print = own.edited(new.text)
                    near, near_next = own.print.likeness(edited_print), own.print.likeness(new.print)
                    out.append((own_key, len(own.text), edited, str(own.print), str(edited_print), near, near_next))
                held = None if guest else (r, k, new)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    return with_next(docs, key, text).mapInArrow(run, schema)
