"""Periodic runs of words by internal pattern matching.

Texts of a batch stand one behind the other as word numbers, each closed by a mark of its own. A suffix array, made by doubling,
holds the occurrences of every block of 2^k words in one interval; a wavelet matrix over the array answers range successors: the
next occurrence of a block behind a place. Blocks of 2^k words begin at every 2^(k-1)-th place. A run of period q with
2^(k-1) < q <= 2^k and at least 4q words holds such a block with room for q more words behind it, and there the block, being
no shorter than the period, occurs at multiples of q only: its next occurrence is q words on. So each run of at least four periods
is met, by a short progression of occurrences whose step is its smallest period. Steps are then extended word by word to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS_AT_ONCE = 1 << 18  # words that one suffix array takes together; a longer text has an array of its own
LEAST_LEVEL = 2  # blocks of four words find the periods 1 to 4
REPEATS = 4
LEAST_WORDS = 6

FOUND = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class WaveletMatrix:
    """Values below a bound in a fixed order, bit by bit from the highest; each bit row counts its ones in constant time."""

    def __init__(self, values: np.ndarray, bound: int):
        self.rows, self.n = [], len(values)
        for bit in range(max(bound - 1, 1).bit_length() - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            cells = np.zeros(len(values) // 64 + 1, np.uint64)
            cells.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(cells), np.int64)
            np.cumsum(np.bitwise_count(cells[:-1]), out=before[1:])
            zeros = values[~ones]
            self.rows.append((bit, cells, before, len(zeros)))
            values = np.concatenate([zeros, values[ones]])

    @staticmethod
    def _ones(cells: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        cell = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[cell] + np.bitwise_count(cells[cell] & below)

    def count_below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at lo..hi-1 are less than x."""
        count = np.zeros(len(x), np.int64)
        for bit, cells, before, zeros in self.rows:
            lo1, hi1 = self._ones(cells, before, lo), self._ones(cells, before, hi)
            up = (x >> bit & 1).astype(bool)
            count += np.where(up, (hi - hi1) - (lo - lo1), 0)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest (from 0) of the values at lo..hi-1."""
        value = np.zeros(len(nth), np.int64)
        for bit, cells, before, zeros in self.rows:
            lo1, hi1 = self._ones(cells, before, lo), self._ones(cells, before, hi)
            low = (hi - hi1) - (lo - lo1)
            up = nth >= low
            value |= up.astype(np.int64) << bit
            nth = np.where(up, nth - low, nth)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest of the values at lo..hi-1 that is not less than x; -1 where there is none."""
        below = self.count_below(lo, hi, x)
        found = np.full(len(x), -1, np.int64)
        some = below < hi - lo
        found[some] = self.smallest(lo[some], hi[some], below[some])
        return found


def suffix_blocks(ids: np.ndarray, levels: int) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix array, ordered by the first 2^levels words, and per level the blocks that occur elsewhere: place, interval.

    The last id must be unlike all others. Only suffixes that are still alike are sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    slots, keys = np.arange(n), ids[order]
    for level in range(levels + 1):
        # keys stand in the order of their slots; equal ones form the interval of a block of 2^level words
        first = np.ones(len(slots), bool)
        first[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(slots)))
        starts, ends = np.repeat(slots[heads], sizes), np.repeat(slots[heads] + sizes, sizes)
        places = order[slots]
        rank[places] = starts
        alike = np.repeat(sizes > 1, sizes)
        slots, places, starts, ends = slots[alike], places[alike], starts[alike], ends[alike]
        if level >= LEAST_LEVEL:
            block = places & ((1 << level - 1) - 1) == 0
            by_place = np.argsort(places[block])
            blocks[level] = tuple(x[block][by_place] for x in (places, starts, ends))
        if not len(slots) or level == levels:
            break
        keys = rank[places] * n + rank[places + (1 << level)]  # a mark ends every text, so alike blocks end before the last id
        again = np.argsort(keys, kind="stable")
        order[slots], keys = places[again], keys[again]
    return order, blocks


def steps(ids: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per level its stride, places of blocks, and how far on each occurs next, where that may be the period of a run."""
    levels = max(LEAST_LEVEL, (max(longest // REPEATS, 1) - 1).bit_length())
    order, blocks = suffix_blocks(ids, levels)
    if not any(len(places) for places, _, _ in blocks.values()):
        return
    tree = WaveletMatrix(order, len(ids))
    far = np.zeros(len(ids), np.int64)  # no longer block at this place occurs nearer
    for level, (places, lo, hi) in sorted(blocks.items()):
        most = 1 << level
        near = far[places] <= most
        places, lo, hi = places[near], lo[near], hi[near]
        after = tree.successor(lo, hi, places + 1)
        step = np.where(after < 0, len(ids), after - places)
        far[places] = step
        fits = (step <= most) & ((step > most >> 1) | (level == LEAST_LEVEL))
        yield most >> 1, places[fits], step[fits]


def _agree(ids: np.ndarray, at: int, step: int, end: int) -> int:
    """First place from ``at`` on whose word differs from the one ``step`` on, or end - step."""
    size = 64
    while at + step < end:
        stop = min(at + size, end - step)
        unlike = ids[at:stop] != ids[at + step : stop + step]
        if unlike.any():
            return at + int(unlike.argmax())
        at, size = stop, size * 2
    return at


def _agree_back(ids: np.ndarray, at: int, step: int, begin: int) -> int:
    """First place of the stretch before ``at`` whose words equal those ``step`` on."""
    size = 64
    while at > begin:
        start = max(at - size, begin)
        unlike = ids[start:at] != ids[start + step : at + step]
        if unlike.any():
            return at - int(unlike[::-1].argmax())
        at, size = start, size * 2
    return at


def runs_of(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """All runs as (text, start in ids, length, period), by text, start and period.

    ``ids`` holds the texts, text t at begins[t]..ends[t]-1, followed by a mark found nowhere else.
    """
    found = set()
    longest = int((ends - begins).max(initial=0))
    if longest < LEAST_WORDS:
        return []
    for stride, places, step in steps(ids, longest):
        head = np.ones(len(places), bool)  # neighbours with one step overlap, so they lie in one stretch: its first one is enough
        head[1:] = (step[1:] != step[:-1]) | (np.diff(places) != stride)
        for at, period in zip(places[head].tolist(), step[head].tolist()):
            text = int(np.searchsorted(begins, at, side="right")) - 1
            end = _agree(ids, at, period, int(ends[text])) + period
            start = _agree_back(ids, at, period, int(begins[text]))
            if end - start >= max(LEAST_WORDS, REPEATS * period):
                found.add((text, start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def _collapse(texts: pa.Array) -> tuple[list[list[dict]], pa.Array]:
    """Runs of each text, and its words without what repeats, joined by one space."""
    split = pc.ascii_split_whitespace(texts)
    flat, offsets = split.flatten(), np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()
    full = np.asarray(pc.not_equal(flat, ""))
    before = np.concatenate([[0], np.cumsum(full)])
    bounds = before[offsets]
    words = flat.filter(pa.array(full)) if not full.all() else flat
    coded = words.dictionary_encode()
    counts = np.diff(bounds)
    texts_n, total = len(counts), int(bounds[-1])
    begins = bounds[:-1] + np.arange(texts_n)
    ends = begins + counts
    ids = np.empty(total + texts_n, np.int64)
    ids[ends] = len(coded.dictionary) + np.arange(texts_n)
    word = np.ones(len(ids), bool)
    word[ends] = False
    ids[word] = np.asarray(coded.indices)
    keep = word.copy()
    listed: list[list[dict]] = [[] for _ in range(texts_n)]
    for text, start, length, period in runs_of(ids, begins, ends):
        listed[text].append({"start": start - int(begins[text]), "length": length, "period": period})
        keep[start + period : start + length] = False
    kept = keep[word]
    lists = np.concatenate([[0], np.cumsum(kept)])[bounds]
    left = words if kept.all() else words.filter(pa.array(kept))
    return listed, pc.binary_join(pa.ListArray.from_arrays(pa.array(lists, pa.int32()), left), " ")


def _portions(texts: pa.Array, words_at_once: int) -> Iterator[pa.Array]:
    """Neighbouring texts with about so many words together."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64) // 4 + 1
    part = np.cumsum(sizes) // words_at_once
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for begin, end in zip(cuts, cuts[1:]):
        yield texts.slice(begin, end - begin)


def collapse_runs(docs: DataFrame, text: str = "text", words_at_once: int = WORDS_AT_ONCE) -> DataFrame:
    """The rows with ``runs``, all periodic runs of words of the text, and ``collapsed``, its words without the repeats.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch of words with smallest period q, of at least max(6, 4q) words, that cannot be
    extended; runs come by start, then period, with the start as a word number. Words of a run behind its first q are dropped; the
    others are joined by one space. Null and empty texts have no runs and collapse to an empty text. Repeated rows are treated
    alike. Columns named runs or collapsed are replaced, all others stay. A text is handled as a whole, however long, in memory of some
    hundred bytes a word; the suffix arrays of shorter ones are made for ``words_at_once`` words together, which changes no result.
    """
    others = [c for c in docs.columns if c not in {"runs", "collapsed"}]
    read = docs.select(*[F.col(f"`{c}`") for c in others])
    schema = T.StructType([*read.schema.fields, *T._parse_datatype_string(FOUND).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column(others.index(text)), "")
            at = 0
            for portion in _portions(texts, words_at_once):
                listed, left = _collapse(portion)
                rows = batch.slice(at, len(portion))
                at += len(portion)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(listed, kind), left], names=[*others, "runs", "collapsed"])

    return read.mapInArrow(run, schema)


def strongest(runs):
    """The run of greatest length / period, compared exactly; of equals the one of smallest start, then period. Null if there is none."""
    return F.reduce(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with periods planted into about a tenth of the texts, chosen by the CRC-32 of the decimal id.

    With h the CRC-32, g = h / 10 and n words, texts of h % 10 = 0 get for each word i >= a = g % n the word a + (i - a) % p, where
    p = 1 + (n - a) / (3 + g % 8), all divisions rounded down; their words are joined by one space. Rows without an id, and texts without words, stay.
    """
    word = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    h = F.crc32(F.col(doc_id).cast("string"))
    g, n = F.floor(h / 10), F.size("_words")
    a = F.lit(F.pmod(g, n))
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    replaced = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", source(i).cast("int"))), " ")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    return (
        docs.withColumn("_words", F.when(chosen, word))
        .withColumn(text, F.when(chosen & (n > 0), replaced).otherwise(F.col(text)))
        .drop("_words")
    )
