"""Byte-level BPE, encoded and decoded from a tokenizer's vocabulary file.

Merges of one piece are found with a segment tree: leaf i holds the rank of the pair that starts at symbol i, each inner node
the lesser of its two children (the left one on ties), so the root names the leftmost pair of lowest rank. A merge changes
three leaves and their paths to the root; it ends when the root holds no rank. The new pieces of a batch go through trees of one
size together, one row per piece; pieces too long for that have a tree of their own.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from postsieve.llm.common import Memo, map_batches, texts_of

# Fixed value: the pieces of byte-level BPE, as the vocabulary was made with.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 60


def byte_letters() -> dict[int, str]:
    """Letter that stands for each byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class PairTree:
    """Least (rank, position) over the adjacent pairs of a piece, with point updates."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        # One integer per node: rank and position, so that comparing nodes prefers low ranks and then the left.
        self.shift = size.bit_length()
        self.none = NONE << self.shift
        keys = [(r << self.shift) | i for i, r in enumerate(ranks)]
        self.node = [self.none] * size + keys + [self.none] * (size - len(keys))
        for i in range(size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def put(self, i: int, rank: int | None) -> None:
        node, at = self.node, i + self.size
        node[at] = self.none if rank is None else (rank << self.shift) | i
        while at > 1:
            at >>= 1
            least = min(node[2 * at], node[2 * at + 1])
            if node[at] == least:
                break
            node[at] = least

    def best(self) -> int | None:
        """Position of the leftmost pair of lowest rank."""
        top = self.node[1]
        return None if top >= self.none else top & ((1 << self.shift) - 1)


class Bpe:
    """Encoder and decoder of one vocabulary file (JSON of the tokenizers library, byte level, no normalizer)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        back = {c: b for b, c in letters.items()}
        self.first = [vocab[letters[b]] for b in range(256)]
        self.pairs = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.bytes = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: content.encode() for content, i in self.added.items()}
        self.piece = regex.compile(PIECE)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.memo = Memo(lambda piece: np.array(self.merge(piece.encode()), dtype="<u4").tobytes(), most=800_000)
        self.known = self.memo.__getitem__
        keys = np.array([(a << 32) | b for a, b in self.pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.pairs.values()], dtype=np.int64)[order]
        self.merged = np.zeros(len(keys), dtype=np.int64)
        self.merged[[r for r, _ in self.pairs.values()]] = [new for _, new in self.pairs.values()]
        self.first_of = np.array(self.first, dtype=np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.first[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        pairs = self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = PairTree([pairs.get(p, (NONE,))[0] for p in zip(ids, ids[1:], strict=False)])
        rank = lambda i: pairs.get((ids[i], ids[after[i]]), (None,))[0]
        while (i := tree.best()) is not None:
            j = after[i]
            ids[i] = pairs[ids[i], ids[j]][1]
            ids[j] = -1
            after[i] = k = after[j]
            if j < n - 1:
                tree.put(j, None)
            if k < n:
                before[k] = i
                tree.put(i, rank(i))
            else:
                tree.put(i, None)
            if before[i] >= 0:
                tree.put(before[i], rank(before[i]))
        return [x for x in ids if x >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``len(self.merged)`` where there is none."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], len(self.merged))

    def merge_together(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids of pieces of 2 to ``size`` bytes (a power of two), as packed integers: one tree row per piece."""
        n, blank = len(pieces), len(self.merged) * size
        length = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        ids = self.first_of[raw]
        places = np.arange(size)
        keys = np.where(places < length[:, None] - 1, self.ranks_of(ids, np.roll(ids, -1, axis=1)) * size + places, blank)
        tree = np.full((n, 2 * size), blank, np.int64)
        tree[:, size:] = np.where(keys < blank, keys, blank)
        for i in range(size - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
        after = np.broadcast_to(np.arange(1, size + 2), (n, size + 1)).copy()
        before = np.broadcast_to(np.arange(-1, size), (n, size + 1)).copy()
        gone = places >= length[:, None]
        row = np.arange(n)

        def put(row, at, key):
            at = at + size
            tree[row, at] = key
            while at[0] > 1:  # leaves are all on one level
                at = at >> 1
                tree[row, at] = np.minimum(tree[row, 2 * at], tree[row, 2 * at + 1])

        while True:
            top = tree[row, 1]
            more = top < blank
            row, top = row[more], top[more]
            if not len(row):
                break
            i, rank = top % size, top // size
            j = after[row, i]
            k = after[row, j]
            ids[row, i] = self.merged[rank]
            gone[row, j] = True
            after[row, i] = k
            before[row, k] = i
            put(row, j, blank)
            for left, right in ((i, k), (before[row, i], i)):
                real = (left >= 0) & (right < length[row])
                r, a, b = row[real], left[real], right[real]
                if len(r):
                    key = self.ranks_of(ids[r, a], ids[r, b]) * size + a
                    put(r, a, np.minimum(key, blank))
                r, a = row[~real & (left >= 0)], left[~real & (left >= 0)]
                if len(r):
                    put(r, a, blank)
        flat = ids[~gone].astype("<u4").tobytes()
        ends = np.cumsum((~gone).sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into the memo."""
        if len(self.memo) + len(pieces) > self.memo.most:
            self.memo.clear()
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            if len(raw) <= self.memo.longest:
                by_size.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for size, found in by_size.items():
            for at in range(0, len(found), 4096):
                part = found[at : at + 4096]
                self.memo.update(zip([p for p, _ in part], self.merge_together([r for _, r in part], size), strict=True))

    def encode_all(self, texts: list[str], step: int = 256) -> list[bytes]:
        """``encode`` of each text; the new pieces of ``step`` texts are merged together."""
        out = []
        for at in range(0, len(texts), step):
            part = texts[at : at + step]
            if self.special and any(t in text for t in self.added for text in part):
                out.extend(map(self.encode, part))
                continue
            pieces = [self.piece.findall(t) for t in part]
            self.learn(set().union(*pieces) - self.memo.keys())
            out.extend(b"".join(map(self.known, p)) for p in pieces)
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special and any(t in text for t in self.added) else [text]
        found = []
        for part in parts:
            if part in self.added:
                found.append(np.array([self.added[part]], dtype="<u4").tobytes())
            else:
                found.extend(map(self.known, self.piece.findall(part)))
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def bpe(path: str) -> Bpe:
    """One encoder per vocabulary and Python worker."""
    return Bpe(path)


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """Ids of every whole text: the key, ``ids`` (binary, little-endian unsigned 32-bit) and, if asked for, ``decoded``.

    ``path`` must be readable on every executor. Null texts count as empty and give no ids; rows are kept one to one, repeated
    and null keys included; other columns are not carried. Memory per task is one Arrow batch and a bounded memo of pieces.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = bpe(path)
        Memo.leave_only(model.memo)
        ids = model.encode_all(texts_of(batch.column(1)))
        columns = {key: batch.column(0), "ids": pa.array(ids, pa.binary())}
        if decoded:
            columns["decoded"] = pa.array([model.decode(i) for i in ids], pa.string())
        return pa.RecordBatch.from_pydict(columns)

    return map_batches(docs.select(key, text), run, f"`{key}` {kind}, ids binary" + ", decoded string" * decoded)


def decode_ids(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of id columns as made by ``encode_texts``; null ids give an empty text."""
    kind = tokens.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = bpe(path)
        texts = [model.decode(i or b"") for i in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_pydict({key: batch.column(0), "text": pa.array(texts, pa.string())})

    return map_batches(tokens.select(key, ids), run, f"`{key}` {kind}, text string")
