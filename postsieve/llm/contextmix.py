"""A byte-level language model by online logistic context mixing, and the unigram base score next to it.

Bytes are binary paths in Huffman trees, one tree per previous byte. Each bit has several predictors: the previous byte, and
hashed contexts (three bytes, the word so far, the word so far with the word before it) with the counts of that bit in all
training documents. Their log odds are added with weights from a set that a gate chooses by how often the hashed contexts were
seen; each document starts from the same weights and refines them every few bytes.

Everything is worked out from the bytes of many texts at once, in arrays. Learning reads the training texts twice: for counts of
words and byte pairs, then for the counts of the slots. Words stay a distributed table that grows with the corpus; slots grow
with its square root up to ``MOST_BITS``, the size that a task can hold. What goes to every task is the trees, the slot
tables (6 bytes a slot) and the most frequent words.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import bytes_of
from postsieve.session import cut_lineage

END, START = 0xFE, 0xFF  # bytes that UTF-8 never uses
SPACE = np.isin(np.arange(256), [*range(0x09, 0x0E), 0x20])
BLANK = SPACE | np.isin(np.arange(256), [END, START])  # bytes behind which a word begins
LEAST_BITS, MOST_BITS = 20, 24
HASHED = 3  # predictors with slots, beside the previous byte
GATES = 1 << HASHED
UNIT = 1024.0
SURE = 8  # counts from which a context is trusted
STEP = 8  # bytes after which a document's weights move; later steps are a part of what was read
LATER = 16
LANES = 4  # sums that neighbouring steps go to in turn, as one sum after the other would wait for each
BLOCK = 1 << 16  # counts that are summed together


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each behind three START and before an END; where the texts begin; their lengths with the END."""
    raw = np.frombuffer(b"\xff\xff\xff" + b"\xfe\xff\xff\xff".join(texts) + b"\xfe", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return raw, np.cumsum(lengths + 3) - lengths, lengths


def byte_pairs(raw: np.ndarray) -> np.ndarray:
    """Previous byte and byte at every place; the first place has no meaning."""
    pair = raw.astype(np.uint16)
    pair[1:] |= raw[:-1].astype(np.uint16) << np.uint16(8)
    return pair


def stirred(h: np.ndarray, factor: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(factor)
    return h ^ (h >> np.uint32(13))


def contexts(raw: np.ndarray, first: np.ndarray, about: int = 1 << 18) -> list[np.ndarray]:
    """Hash of the hashed contexts at every place, one array per predictor. A text's first word has no word before it.

    Worked out for some texts of ``about`` as many bytes at a time, as it takes some hundred bytes a byte.
    """
    out = [np.empty(len(raw), np.uint32) for _ in range(HASHED)]
    begin = first - 3
    number = begin // about  # texts that begin in one stretch go together
    cuts = np.append(begin[np.flatnonzero(np.diff(number, prepend=-1))], len(raw))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        some = first[np.searchsorted(first, lo) : np.searchsorted(first, hi)] - lo
        for whole, piece in zip(out, contexts_of_some(raw[lo:hi], some), strict=True):
            whole[lo:hi] = piece
    return out


def contexts_of_some(raw: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    b = raw.astype(np.uint32)
    near = np.zeros(len(b), np.uint32)
    near[3:] = (b[:-3] << np.uint32(16)) | (b[1:-2] << np.uint32(8)) | b[2:-1]
    ends = np.flatnonzero(BLANK[raw])
    begin = np.append(0, ends[:-1] + 1)
    size = ends - begin + 1
    place = np.arange(len(b)) - np.repeat(begin, size)
    # Hash of the word so far: a sum of bytes times powers from the word's beginning on.
    power = np.cumprod(np.full(int(size.max()) + 1, 0x2C9277B5, np.uint32), dtype=np.uint32)
    term = b * power[place]
    sums = np.cumsum(term, dtype=np.uint32) - term
    word = (sums[ends] - sums[begin]) ^ (size.astype(np.uint32) * np.uint32(0x27D4EB2F))
    so_far = (sums - np.repeat(sums[begin], size)) ^ (place.astype(np.uint32) * np.uint32(0x27D4EB2F))
    # The last word that is not blank, if it is of the same text.
    number = np.arange(len(ends))
    last = np.append(-1, np.maximum.accumulate(np.where(size > 1, number, -1))[:-1])
    text = np.zeros(len(ends), np.int64)
    opening = np.searchsorted(begin, first)
    text[opening] = opening
    before = np.where(last >= np.maximum.accumulate(text), word[last], np.uint32(0))
    both = so_far * np.uint32(0xC2B2AE3D) + np.repeat(stirred(before, 0x85EBCA6B), size)
    return [stirred(near, 0xC2B2AE35), stirred(so_far, 0x9E3779B1), stirred(both, 0x2C1B3C6D)]


@dataclass
class Trees:
    """Paths of all (previous byte, byte): node * 2 + bit of every step in one array, with start and length per pair."""

    start: np.ndarray
    length: np.ndarray
    step: np.ndarray

    @classmethod
    def build(cls, bigrams: np.ndarray) -> Trees:
        counts = bigrams.reshape(256, 256)
        general = counts.sum(axis=0)
        codes: dict[int, list[tuple[int, ...]]] = {}
        start, length, path_steps = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), []
        for prev in range(256):
            seen = counts[prev].sum() > 0
            if (prev if seen else -1) not in codes:
                codes[prev if seen else -1] = huffman((counts[prev] if seen else general) + general / (general.sum() + 1.0) + 1e-3)
            for symbol, path in enumerate(codes[prev if seen else -1]):
                start[prev << 8 | symbol], length[prev << 8 | symbol] = len(path_steps), len(path)
                path_steps.extend(prev << 9 | n for n in path)
        return cls(start, length, np.array(path_steps, np.int64))

    @cached_property
    def nodes(self) -> np.ndarray:
        """``stirred_nodes`` of every step."""
        return stirred_nodes(self.step)

    @cached_property
    def sign(self) -> np.ndarray:
        """1 for a step to a one, -1 for a step to a zero."""
        return (self.step & 1).astype(np.float32) * np.float32(2) - np.float32(1)

    def paths(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``step`` of the steps of all these bytes, the byte that each belongs to, and the number of steps of each byte."""
        size = self.length.take(pairs)
        ends = np.cumsum(size)
        owner = owners(ends)
        at = (self.start.take(pairs) - (ends - size)).take(owner)
        at += np.arange(len(owner))
        return at, owner, size


def owners(ends: np.ndarray) -> np.ndarray:
    """Number of the group that each element is in, from the ends of groups without gaps; no group is empty."""
    mark = np.zeros(int(ends[-1]) if len(ends) else 0, np.int8)
    mark[ends[:-1]] = 1
    return np.cumsum(mark, dtype=np.int64)


def huffman(weights: np.ndarray) -> list[tuple[int, ...]]:
    """Path of each symbol from the root: inner node * 2 + bit."""
    heap = [(float(w), i, None) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    n = len(heap)
    up = {}
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        up[a[1]], up[b[1]] = (n, 0), (n, 1)
        heapq.heappush(heap, (a[0] + b[0], n, None))
        n += 1
    paths = []
    for symbol in range(len(weights)):
        path, at = [], symbol
        while at in up:
            at, bit = up[at]
            path.append((at - len(weights)) * 2 + bit)
        paths.append(tuple(reversed(path)))
    return paths


def stirred_nodes(step: np.ndarray) -> np.ndarray:
    return (step >> 1).astype(np.uint32) * np.uint32(0x9E3779B1)


def slots_of(context: np.ndarray, owner: np.ndarray, nodes: np.ndarray, bits: int) -> np.ndarray:
    """Slot of every step of bytes with this context; ``nodes`` are stirred."""
    h = context.take(owner)
    h ^= nodes
    h *= np.uint32(0x85EBCA77)
    h >>= np.uint32(32 - bits)
    return h.astype(np.int64)


def summed(place: np.ndarray, values: np.ndarray, many: int) -> np.ndarray:
    """Sums of the values by place, each a number from 0 to ``many`` - 1 in each of the LANES that ``lanes`` adds."""
    out = np.zeros(LANES * many)
    np.add.at(out, place, values.astype(np.float64))
    return out.reshape(LANES, many).sum(axis=0)


def lanes(place: np.ndarray, many: int) -> np.ndarray:
    """Places for ``summed``, neighbours in different lanes."""
    lane = np.arange(len(place))
    lane &= LANES - 1
    lane *= many
    lane += place
    return lane


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Slot table: log odds of a one in halves of 1 / UNIT; odd where the context was seen often."""
    zero, one = counts[..., 0], counts[..., 1]
    odds = np.clip(np.log((one + 0.4) / (zero + 0.4)), -11.0, 11.0)
    return (np.round(odds * UNIT).astype(np.int16) * 2 + ((zero + one) >= SURE)).astype(np.int16)


@dataclass
class Model:
    trees: Trees
    first: np.ndarray  # log odds by node, for the previous byte
    tables: list[np.ndarray]  # log_odds by slot, one array per hashed context
    rate: float = 0.1
    start_weights: tuple[float, ...] = (0.0, 0.4, 0.35, 0.35)  # per predictor, before a document refines them
    limit: int = 1 << 14  # bytes of one step that are in memory at once

    @cached_property
    def first_of_steps(self) -> np.ndarray:
        return self.first.take(self.trees.step >> 1)

    def score(self, texts: list[bytes], ended: bool = True) -> np.ndarray:
        """log10 probability of each text, with its end or, if not ``ended``, as a beginning. No text's score depends on the others."""
        n = len(texts)
        order = sorted(range(n), key=lambda i: -len(texts[i]))  # longest first, so that those not yet at their end lead
        raw, first, lengths = lay_out([texts[i] for i in order])
        lengths = lengths - (not ended)
        pair, hashes = byte_pairs(raw), contexts(raw, first)
        weights = [np.full(n * GATES, w, np.float32) for w in self.start_weights]
        moved = [np.full(n * GATES, 1.0) for _ in weights]
        total, lo = np.zeros(n), 0
        while left := int(np.searchsorted(-lengths, -lo)):  # texts with more than lo bytes
            hi = lo + max(STEP, lo // LATER)
            size = np.minimum(lengths[:left], hi) - lo
            grads = [np.zeros(left * GATES) for _ in weights]
            many = max(1, self.limit // (hi - lo))
            for a in range(0, left, many):  # texts whose bits of this step are in memory at once
                self._mix(a, first[a : a + many][: left - a] + lo, size[a : a + many], pair, hashes, weights, grads, total)
            for w, m, grad in zip(weights, moved, grads, strict=True):
                m[: len(grad)] += grad * grad
                w[: len(grad)] += (self.rate * grad / np.sqrt(m[: len(grad)])).astype(np.float32)
            lo = hi
        out = np.zeros(n)
        out[order] = -total / np.log(10.0)
        return out

    def _mix(self, a, start, size, pair, hashes, weights, grads, total) -> None:
        """Add the losses of ``size`` bytes from ``start`` on of the texts from number ``a`` on, and the slopes of the weights."""
        ends = np.cumsum(size)
        text = owners(ends)
        at = (start - (ends - size))[text] + np.arange(len(text))
        path, owner, steps = self.trees.paths(pair.take(at))
        nodes = self.trees.nodes.take(path)
        bits_of_text = np.add.reduceat(steps, ends - size)
        x, seen = [self.first_of_steps.take(path)], np.zeros(len(path), np.int16)
        for k, (c, table) in enumerate(zip(hashes, self.tables, strict=True)):
            value = table.take(slots_of(c.take(at), owner, nodes, len(table).bit_length() - 1))
            seen |= (value & np.int16(1)) << np.int16(k)
            x.append(value * np.float32(0.5 / UNIT))
        gate = np.repeat(np.arange(len(size)) * GATES, bits_of_text)
        gate += seen
        sign = self.trees.sign.take(path)
        own = slice(a * GATES, (a + len(size)) * GATES)
        z = np.zeros(len(path), np.float32)
        for w, xi in zip(weights, x, strict=True):
            z += w[own].take(gate) * xi
        e = np.exp(-np.clip(z * sign, np.float32(-30), np.float32(30)))
        more = e + np.float32(1)
        total[a : a + len(size)] += np.add.reduceat(np.log(more), np.cumsum(bits_of_text) - bits_of_text, dtype=np.float64)
        push = sign * (e / more)
        place = lanes(gate, len(size) * GATES)
        for grad, xi in zip(grads, x, strict=True):
            grad[own] += summed(place, push * xi, len(size) * GATES)


LETTER = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 256)  # numbers of bytes in hashes of words
LETTER[ord("A") : ord("Z") + 1] = LETTER[ord("a") : ord("z") + 1]
POWER = np.int64(0x5851F42D4C957F2D)
END_WORD = 0


def words_of(texts: list[bytes], about: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, in lower case, END_WORD after each text; their number per text.

    A hash is the sum of the numbers of a word's bytes times powers, wrapped, and so not of its place. Texts of ``about`` as many bytes
    are worked out at a time, as that takes some ten numbers a byte.
    """
    hashes, sizes, at = [], [], 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) <= about):
            held += len(texts[to]) + 1
            to += 1
        raw = np.frombuffer(b" ".join(texts[at:to]) + b" ", np.uint8)
        ends = np.flatnonzero(SPACE[raw])
        size = np.diff(ends, prepend=-1)
        power = np.full(int(size.max()), POWER)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        place = np.arange(len(raw))
        place -= np.repeat(ends - size + 1, size)
        sums = LETTER.take(raw)
        sums *= power.take(place)
        sums[ends] = 0
        np.cumsum(sums, out=sums)
        word = np.diff(sums.take(ends), prepend=0)
        word ^= (size - 1) * np.int64(0x27D4EB2F165667C5)
        last = np.zeros(len(ends), bool)
        last[np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts[at:to]]) - 1)] = True
        # A blank stands for the word before it, if there is one; that behind a text stands for the text's end, too.
        there = np.repeat(size > 1, 1 + last)
        out = np.repeat(word, 1 + last)
        own = np.cumsum(1 + last)[last] - 1
        there[own], out[own] = True, END_WORD
        hashes.append(out[there])
        sizes.append(np.diff(np.cumsum(there)[own], prepend=0))
        at = to
    return (np.concatenate(hashes), np.concatenate(sizes)) if texts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Finder:
    """``np.searchsorted`` in ascending hashes: a table of their first bits tells where to begin, the rest takes a few steps."""

    def __init__(self, known: np.ndarray, bits: int = 18):
        self.known = np.append(known, np.iinfo(np.int64).max)
        self.shift, self.half = 64 - bits, 1 << (bits - 1)
        self.start = np.searchsorted(known >> self.shift, np.arange(-self.half, self.half + 1)).astype(np.int32)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = self.start.take((h >> self.shift) + self.half)
        for _ in range(int(np.diff(self.start).max())):
            at += self.known.take(at) < h
        return at


def portions(batches: Iterator[pa.RecordBatch], column: int = 0, rows: int = 2000, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with their texts: at most ``rows``, and about ``size`` bytes unless one text alone has more."""
    for batch in batches:
        texts, at = bytes_of(batch.column(column)), 0
        while at < len(texts):
            to, held = at, 0
            while to < len(texts) and to - at < rows and (to == at or held + len(texts[to]) <= size):
                held += len(texts[to])
                to += 1
            yield batch.slice(at, to - at), texts[at:to]
            at = to


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key = key[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[begin], np.add.reduceat(n[order], begin) if len(key) else n


def survey(docs: DataFrame, text: str = "text", most: int = 1_000_000) -> DataFrame:
    """Counts of lower-case words by 64-bit hash (the end of a text is END_WORD) and of byte pairs: (pair, key, n), not yet
    summed over tasks. A task holds ``most`` distinct words and as many counts again, then passes them on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, fixed = [], [], 0, 0
        pairs = np.zeros(1 << 16, np.int64)

        def rows(pair: bool, keys, counts):
            for i in range(0, len(keys), 1 << 17):
                some = slice(i, i + (1 << 17))
                yield pa.RecordBatch.from_pydict({"pair": pa.repeat(pair, len(keys[some])), "key": pa.array(keys[some]), "n": pa.array(counts[some])})

        for _, texts in portions(batches):
            raw, first, _ = lay_out(texts)
            pair = byte_pairs(raw)
            inside = raw != START
            pairs += np.bincount(pair[inside], minlength=1 << 16)
            key, n = np.unique(words_of(texts)[0], return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held - fixed > most:
                key, n = added(keys, counts)
                keys, counts, held, fixed = [key], [n], len(key), len(key)
                if fixed > most:
                    yield from rows(False, key, n)
                    keys, counts, held, fixed = [], [], 0, 0
        if keys:
            yield from rows(False, *added(keys, counts))
        full = np.flatnonzero(pairs)
        yield from rows(True, full, pairs[full])

    return cut_lineage(docs.select(text).mapInArrow(run, "pair boolean, key bigint, n bigint"), "survey")


def word_counts(surveyed: DataFrame) -> DataFrame:
    """Counts of words over all tasks: (word, c)."""
    return cut_lineage(surveyed.where("NOT pair").groupBy(F.col("key").alias("word")).agg(F.sum("n").alias("c")), "words")


def slot_bits(size: int) -> int:
    """log2 of the slots a predictor for so many bytes: four times the bytes, twice the slots, from 2^LEAST_BITS to 2^MOST_BITS."""
    return min(MOST_BITS, max(LEAST_BITS, 16 + ((size >> 20).bit_length() + 1) // 2))


def learn(docs: DataFrame, surveyed: DataFrame, text: str = "text") -> Model:
    """Trees and slot tables from all texts. 2^16 sums and the finished tables reach the driver."""
    rows = surveyed.where("pair").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    bigrams = np.zeros(1 << 16)
    bigrams[rows["key"].to_numpy()] = rows["n"].to_numpy()
    trees = Trees.build(bigrams)
    size = int(bigrams.sum())
    bits = slot_bits(size)
    width = 2 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of (predictor, slot, bit) in blocks, in the narrowest type that holds them; all-zero blocks are left out."""
        tables, bit_of_step = [np.zeros(width, np.int32) for _ in range(HASHED)], trees.step & 1

        def rows():
            flat = [t[i : i + BLOCK] for t in tables for i in range(0, width, BLOCK)]
            for some in range(0, len(flat), 64):
                full = [(i, b) for i, b in enumerate(flat[some : some + 64], some) if b.any()]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([i for i, _ in full], pa.int64()),
                    "counts": pa.array([b.astype(np.min_scalar_type(int(b.max()))).tobytes() for _, b in full], pa.binary()),
                })

        read = 0
        for _, texts in portions(batches):
            raw, begin, _ = lay_out(texts)
            pair, hashes = byte_pairs(raw), contexts(raw, begin)
            inside = np.flatnonzero(raw != START)
            for at in (inside[i : i + 200_000] for i in range(0, len(inside), 200_000)):
                path, owner, _ = trees.paths(pair[at])
                nodes, bit = trees.nodes.take(path), bit_of_step.take(path)
                for c, table in zip(hashes, tables, strict=True):
                    slot = slots_of(c.take(at), owner, nodes, bits)
                    slot <<= 1
                    slot |= bit
                    np.add.at(table, slot, np.int32(1))
            read += len(raw)
            if read > 1 << 27:  # long before 32 bits are full
                yield from rows()
                read = 0
                for table in tables:
                    table.fill(0)
        yield from rows()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(counts, f"u{len(counts) // BLOCK}")
                if block in sums:
                    sums[block] += found
                else:
                    sums[block] = found.astype(np.int64)
        for block, counts in sums.items():
            odds = log_odds(counts.reshape(-1, 2))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "odds": pa.array([odds.tobytes()], pa.binary())})

    # A task's tables are passed on whole, whatever it has read: so many bytes a task that the tables stay below them in size.
    tasks = -(-size // (8 << bits)) or 1
    blocks = HASHED * width // BLOCK
    counted = docs.select(text).coalesce(tasks).mapInArrow(count, "block bigint, counts binary").repartition(-(-blocks // 48), "block")
    odds = np.zeros(blocks * BLOCK // 2, np.int16)
    for block, found in counted.mapInArrow(merge, "block bigint, odds binary").toLocalIterator():  # 2^17 bytes a block
        odds[block * BLOCK // 2 : (block + 1) * BLOCK // 2] = np.frombuffer(found, np.int16)
    nodes = np.bincount(trees.step, np.repeat(bigrams, trees.length), 2 << 16)  # every byte takes the steps of its pair
    first = (log_odds(nodes.reshape(-1, 2)) >> 1) / np.float32(UNIT)
    return Model(trees, first.astype(np.float32), list(odds.reshape(HASHED, -1)))


def frequent_words(words: DataFrame, head: int) -> DataFrame:
    """At most ``head`` of the most frequent words. A histogram of the counts tells from which count on, so that few rows are sorted."""
    level = F.floor(F.log2("c") * 16)
    least, n = None, 0
    for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # some 1,000 levels at most
        n += r["n"]
        if n > 2 * head:
            break
        least = r["level"]
    return words.where(level >= least if least is not None else F.lit(False)).orderBy(F.desc("c"), "word").limit(head)


def score_documents(docs: DataFrame, training, key: str = "doc_id", text: str = "text", head: int = 1 << 16) -> DataFrame:
    """Per document: n_tokens, n_known, train_tokens, base_score and score, learned from the rows where ``training`` holds.

    A null text is empty and has the end alone; without training rows no token is known, base_score is 0 and the model knows
    nothing but even chances. Rows stay one to one, repeated and null keys included. The ``head`` most frequent words are sent to
    every task and looked up there; all other words of a text are joined with the counts, so no frequent word is shuffled.
    """
    known_docs = docs.where(training)
    surveyed = survey(known_docs, text)
    model = learn(known_docs, surveyed, text)
    words = word_counts(surveyed)
    train_tokens, vocabulary = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent_words(words, head).toArrow().sort_by("word")  # at most head rows
    known, counts = top["word"].to_numpy(), top["c"].to_numpy().astype(np.float64)
    find = Finder(known)
    below = train_tokens + 0.1 * (vocabulary + 1)
    values = np.log10((counts + 0.1) / below)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in portions(batches, 2, size=4 << 20):
            h, sizes = words_of(texts)
            at = np.minimum(find(h), max(len(known) - 1, 0))
            hit = known[at] == h if len(known) else np.zeros(len(h), bool)
            cuts = np.cumsum(sizes) - sizes
            far = np.add.reduceat((~hit).astype(np.int64), cuts)
            near = np.add.reduceat(np.where(hit, values[at], 0.0), cuts) if len(known) else np.zeros(len(texts))
            yield pa.RecordBatch.from_pydict({
                "row": batch.column(0), key: batch.column(1), "n_tokens": pa.array(sizes), "near_known": pa.array(sizes - far),
                "near_score": pa.array(near, pa.float64()), "score": pa.array(model.score(texts), pa.float64()),
                "far": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(far)), pa.int32()), pa.array(h[~hit], pa.int64())),
            })

    schema = f"row bigint, `{key}` {kind}, n_tokens bigint, near_known bigint, near_score double, score double, far array<bigint>"
    scored = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), key, text).mapInArrow(run, schema), "scored")
    rest = scored.select("row", F.explode("far").alias("word")).join(words, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rest = rest.groupBy("row").agg(
        F.sum(F.log10((c + F.lit(0.1)) / F.lit(float(below)))).alias("far_score"), F.sum((c > 0).cast("bigint")).alias("far_known")
    )
    base = F.col("near_score") + F.coalesce("far_score", F.lit(0.0)) if train_tokens else F.lit(0.0)
    return scored.join(rest, "row", "left").select(
        key, "n_tokens", (F.col("near_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(int(train_tokens)).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score",
    )
