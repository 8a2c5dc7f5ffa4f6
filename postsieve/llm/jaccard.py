"""Exact Jaccard self-join of word n-gram sets by prefix trees, and the groups that its links form.

1. Every text becomes a sorted set of 64-bit shingle hashes; equal sets are one node from then on.
2. In the order of hashes, two sets that link share at least l shingles among the first of each, if ``opening`` takes l more than
   it must. A set is filed under its opening. Two sets in files of few sets are candidates if they share l of these, less the files
   of many sets that one of them is in. A set leaves the files of many sets, unless it is in l of that kind: then its partners may
   be in no other. Candidates that hang together make a block.
3. In a block, sets go into a trie in one global order of shingles, frequent ones first. A probe walks it once, shares the
   overlap of common beginnings, and leaves a subtree when what remains of both sides cannot reach the bound.

Copies are filed once per task, and what a task files in one place beyond ``FEW`` sets is spread, so copies by the million are no
hot group; a block above ``block`` sets is first compared with one of its sets, and only what does not link there is compared further, in pairs of chunks of like sizes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import WORD, Memo, bytes_of
from postsieve.llm.components import components
from postsieve.session import cut_lineage

FEW = 8  # sets of a file up to which all of them are candidates
PIECE_BYTES = 4 << 20  # bytes of text that a task turns into sets at once
CLASS_STEP = 1.26  # ratio of the sizes that bound a size class of a large block: at 0.8 and more a set meets its own class and its two neighbours
_words = Memo(xxhash.xxh3_64_intdigest, most=200_000)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers per seed."""
    x = (x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; with fewer words the whole sequence is one; without words none."""
    words = text.lower().split()  # on bytes both work on ASCII alone
    if not words:
        return np.zeros(0, np.uint64)
    k = min(n, len(words))
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h ^ w[i : len(w) - k + 1 + i], i)
    return np.unique(h)


def set_id(h: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)


def overlap(size: int, num: int, den: int) -> int:
    """Shingles that a set of this size shares with any set it links to, at least."""
    return (num * size + den - 1) // den


def spare(size: int, num: int, den: int) -> int:
    """Shingles that linked sets share in their openings, the smaller one being of this size."""
    return min(max(1, size // 4), overlap(size, num, den))


def opening(size: int, num: int, den: int) -> tuple[int, int]:
    """How many first shingles a set is filed under so that linked sets share one, and so that they share ``spare``.

    Of the shingles that two sets share, at least ``overlap`` minus l come behind the l-th one in either set, so the l-th is among
    the first size - overlap + l. Linked sets hence share ``spare`` of the smaller size in their openings.
    """
    must = size - overlap(size, num, den)
    return must + 1, must + spare(size, num, den)


def needed(size: int, num: int, den: int) -> int:
    """Shingles shared in the openings of a set of this size and of any set it links to, at least."""
    return spare(overlap(size, num, den), num, den)


class Groups:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up, self.left = list(range(n)), n

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        self.left -= 1
        return True


class _Node:
    """A stretch of shingle ranks that all sets below begin with, sizes of those sets, and sets that end here."""

    __slots__ = ("ends", "label", "least", "most", "next")

    def __init__(self, label: np.ndarray, size: int):
        self.label, self.least, self.most, self.next, self.ends = label, size, size, {}, []


class PrefixTree:
    """Trie of sorted rank arrays with stretches instead of single steps."""

    def __init__(self, num: int, den: int):
        self.root, self.num, self.den = _Node(np.zeros(0, np.int64), 1 << 60), num, den
        self.root.most = 0

    def add(self, ranks: np.ndarray, item: int) -> None:
        node, at, size = self.root, 0, len(ranks)
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            if at == size:
                node.ends.append(item)
                return
            below = node.next.get(first := int(ranks[at]))
            if below is None:
                node.next[first] = leaf = _Node(ranks[at:], size)
                leaf.ends.append(item)
                return
            n = min(len(below.label), size - at)
            same = below.label[:n] == ranks[at : at + n]
            n = n if same.all() else int(same.argmin())
            if n < len(below.label):  # cut the stretch where the two part
                top = _Node(below.label[:n], below.least)
                top.most = below.most
                below.label = below.label[n:]
                top.next[int(below.label[0])] = below
                node.next[first] = below = top
            node, at = below, at + n

    def matches(self, ranks: np.ndarray, mark: np.ndarray) -> Iterator[int]:
        """Items whose sets reach the bound with this one; ``mark`` is 1 at its ranks. May be stopped at any time."""
        num, den, size = self.num, self.den, len(ranks)
        stack = [(self.root, 0, 0)]
        while stack:
            node, shared, depth = stack.pop()
            for item in node.ends:
                if den * shared >= num * (size + depth - shared):
                    yield item
            for below in node.next.values():
                overlap = shared + int(mark[below.label].sum())
                deep = depth + len(below.label)
                mine = size - int(np.searchsorted(ranks, below.label[-1], side="right"))
                reach = overlap + min(mine, below.most - deep)
                if (num + den) * reach >= num * (size + below.least):
                    stack.append((below, overlap, deep))


def linked_groups(sets: list[np.ndarray], num: int, den: int, first: int = 0) -> list[tuple[int, int]]:
    """Links of a block, as many as are needed to connect what is connected: pairs of positions. The first sets are not compared
    with each other, only with those after them.
    """
    groups, links = Groups(len(sets)), []
    if len(sets) == 2:
        a, b = sets
        both = len(np.intersect1d(a, b, assume_unique=True))
        return [(0, 1)] if den * both >= num * (len(a) + len(b) - both) else []
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    ranks = np.split(rank[inverse], np.cumsum([len(s) for s in sets])[:-1])
    tree, mark = PrefixTree(num, den), np.zeros(len(values), np.int32)
    for i, r in enumerate(ranks):
        r = np.sort(r)
        mark[r] = 1
        for j in tree.matches(r, mark) if i >= max(first, 1) else ():
            if groups.join(i, j):
                links.append((j, i))
                if groups.left == len(sets) - i:
                    break  # the sets in the tree are all one group with this one
        mark[r] = 0
        tree.add(r, i)
    return links


def pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``PIECE_BYTES`` of text, as batches are bounded by rows, and texts may be long."""
    for batch in batches:
        if batch.num_rows:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            cuts = [0, *(np.flatnonzero(np.diff(sizes // PIECE_BYTES)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                yield batch.slice(begin, end - begin)


def text_sets(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of (key, row_key, n_shingles, set_id); without words set_id is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memo.leave_only(_words)
        for batch in pieces(batches, 2):
            sizes, ids = [], []
            for t in bytes_of(batch.column(2)):
                h = shingles(t, n)
                sizes.append(len(h))
                ids.append(set_id(h) if len(h) else None)
            yield pa.RecordBatch.from_pydict({
                key: batch.column(0), "row_key": batch.column(1), "n_shingles": pa.array(sizes, pa.int64()), "set_id": pa.array(ids, pa.int64()),
            })

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, row_key(key, text), text).mapInArrow(run, f"`{key}` {kind}, row_key bigint, n_shingles bigint, set_id bigint")


def row_key(key: str = "doc_id", text: str = "text"):
    return F.xxhash64(F.col(key), F.col(text)).alias("row_key")


def candidate_links(docs: DataFrame, n: int, num: int, den: int, text: str = "text") -> DataFrame:
    """Pairs of set ids (a, b) that hold all candidates together."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(at, a, info, file): a set in a file. What is beyond ``FEW`` sets of a file in one piece goes to any place, and names its file."""
        seen = set()
        for batch in pieces(batches, 0):
            keys, ids, infos = [], [], []
            for t in bytes_of(batch.column(0)):
                h = shingles(t, n)
                if not len(h) or (one := set_id(h)) in seen:
                    continue
                seen.add(one)
                first, whole = opening(len(h), num, den)
                keys.append(h[:whole])
                ids.append(np.full(whole, one, np.int64))
                infos.append(2 * needed(len(h), num, den) + (np.arange(whole) < first))
            if not keys:
                continue
            keys, ids, infos = np.concatenate(keys), np.concatenate(ids), np.concatenate(infos)
            order = np.argsort(keys, kind="stable")
            keys, ids, infos = keys[order], ids[order], infos[order]
            begin = _starts(keys)
            spread = np.arange(len(keys)) - begin > FEW
            at = np.where(spread, _mix(keys ^ _mix(ids.view(np.uint64), 29), 31), keys).view(np.int64)
            columns = [pa.array(at), pa.array(ids), pa.array(infos), pa.array(keys.view(np.int64), mask=~spread)]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "a", "info", "file"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by place: pairs (a, b) from files of few sets, with what they must and do share; (file, a, info) from others.

        ``info`` is twice the number of shared shingles that the set can count on, plus one if the file must suffice alone.
        """
        held, full = None, None
        for batch in chain(batches, [None]):
            if batch is None:
                if held is None:
                    return
                rows = held
            elif not batch.num_rows:
                continue
            else:
                named = batch.column(3)
                rows = np.stack([batch.column(0).to_numpy(), *(c.to_numpy() for c in batch.columns[1:3]),
                                 pc.coalesce(named, batch.column(0)).to_numpy(), pc.is_valid(named).to_numpy(zero_copy_only=False)])
                rows = rows if held is None else np.concatenate([held, rows], axis=1)
            begin = _starts(rows[0])
            number = np.unique(begin, return_counts=True)[1]
            many = np.repeat(number > FEW, number) | (rows[0] == full if full is not None else False)
            held, full = None, int(rows[0][-1]) if many[-1] else None
            if batch is not None and not many[-1]:  # the last file may go on in the next batch
                cut = begin[-1]
                held, rows, many, begin = rows[:, cut:], rows[:, :cut], many[:cut], begin[:cut]
            many = many | (rows[4] == 1)
            lone = np.flatnonzero(~many)
            met = [(lone[:-k][same], lone[k:][same]) for k in range(1, FEW) for same in [begin[lone[:-k]] == begin[lone[k:]]]]
            left, right = (np.concatenate(c) for c in zip(*met, strict=True))
            pairs = np.stack([rows[1][left], rows[1][right], rows[2][left] >> 1, rows[2][right] >> 1])[:, rows[1][left] != rows[1][right]]
            turn = pairs[0] > pairs[1]
            pairs[:, turn] = pairs[:, turn][[1, 0, 3, 2]]
            pairs, shared = np.unique(pairs, axis=1, return_counts=True)
            if not pairs.shape[1] and not many.any():
                continue
            a = np.concatenate([pairs[0], rows[1][many]])
            paired = np.arange(len(a)) < pairs.shape[1]
            fill = lambda x: pa.array(np.concatenate([x, np.zeros(int(many.sum()), np.int64)]), mask=~paired)  # noqa: B023, E731
            columns = [
                pa.array(np.concatenate([pairs[0], rows[3][many]]), mask=paired), pa.array(a), pa.array(np.concatenate([pairs[2], rows[2][many]])),
                fill(pairs[1]), fill(pairs[3]), fill(shared),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "a", "info", "b", "b_info", "shared"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (file, a, b): one of each file and batch with b null, and the others of it with that one."""
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = (c.to_numpy() for c in batch.columns)
            keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
            heads = ids[first]
            near = np.unique(np.stack([ids, heads[at]])[:, ids != heads[at]], axis=1)
            keys = np.concatenate([keys.view(np.uint64), _mix(near[0].view(np.uint64), 23)]).view(np.int64)
            own, head = np.concatenate([heads, near[0]]), np.concatenate([heads, near[1]])
            same = np.arange(len(own)) < len(heads)  # b is a there, and null in the shuffle, which makes these rows smaller
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own), pa.array(head, mask=same)], names=["file", "a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, top = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, a = (c.to_numpy() for c in batch.columns[:2])
            b = pc.coalesce(batch.column(2), batch.column(1)).to_numpy()
            start = np.append(True, files[1:] != files[:-1])
            tops = b[np.maximum.accumulate(np.where(start, np.arange(len(files)), 0))]
            if last == files[0]:
                tops[: int(np.argmax(start[1:])) + 1 if start[1:].any() else len(tops)] = top
            last, top = files[-1], tops[-1]
            pairs = np.concatenate([np.stack([a, b]), np.stack([b, tops])], axis=1)
            pairs = np.unique(np.sort(pairs[:, pairs[0] != pairs[1]], axis=0), axis=1)
            if pairs.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filed = docs.select(text).mapInArrow(file, "at bigint, a bigint, info bigint, file bigint")
    placed = filed.repartition(tasks, "at").sortWithinPartitions("at").mapInArrow(
        split, "file bigint, a bigint, info bigint, b bigint, b_info bigint, shared bigint"
    )
    placed = cut_lineage(placed, "files")
    common = placed.where("b IS NULL").repartition("a").groupBy("a", "file").agg(F.max("info").alias("info"))
    common = cut_lineage(common.withColumn("files", F.count("*").over(Window.partitionBy("a"))), "common-files")
    stay = common.where((F.col("info") % 2 == 1) & (F.col("files") >= F.shiftright("info", 1)))
    pairs = placed.where("b IS NOT NULL").groupBy("a", "b").agg(F.max("info").alias("info"), F.max("b_info").alias("b_info"), F.sum("shared").alias("shared"))
    common_of = common.select("a", "files").distinct()
    pairs = pairs.join(common_of, "a", "left").join(common_of.select(F.col("a").alias("b"), F.col("files").alias("b_files")), "b", "left")
    short = lambda need, files: F.col(need) - F.coalesce(F.col(files), F.lit(0))
    rare = pairs.where(F.col("shared") >= F.greatest(short("info", "files"), short("b_info", "b_files")))
    gathered = stay.select("file", "a").mapInArrow(gather, "file bigint, a bigint, b bigint")
    linked = gathered.repartition(tasks, "file").sortWithinPartitions("file").mapInArrow(link, "a bigint, b bigint")
    return rare.select("a", "b").unionByName(linked)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Per element of a sorted array the place where its like begin."""
    return np.maximum.accumulate(np.where(np.append(True, keys[1:] != keys[:-1]), np.arange(len(keys)), 0))


def exact_links(sets: DataFrame, docs: DataFrame, blocks: DataFrame, n: int, num: int, den: int, text: str, key: str, block: int) -> DataFrame:
    """True links (a, b) inside the candidate blocks (node, root), enough to connect what is connected."""
    holders = sets.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("row_key").alias("row_key"), F.min("n_shingles").alias("size"))
    members = blocks.join(holders, blocks["node"] == holders["set_id"]).select("set_id", "row_key", "root", "size")
    texts = docs.select(row_key(key, text), F.col(text).alias("t"))
    sizes = blocks.groupBy("root").agg(F.count("*").alias("n"), F.min("node").alias("pivot"))
    full = cut_lineage(texts.join(members, "row_key").join(sizes, "root").select("root", "n", "pivot", "set_id", "size", "t"), "block-texts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block; repeated rows of a set are met once."""
        held, ids, groups, first = None, [], [], 0

        def ended():
            found = linked_groups(groups, num, den, first if first < len(groups) else 0) if len(groups) > 1 else []
            if found:
                yield pa.RecordBatch.from_pydict({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

        for batch in pieces(batches, 3):
            rows = zip(*(c.to_pylist() for c in batch.columns[:3]), bytes_of(batch.column(3)), strict=True)
            for at, second, one, t in rows:
                if at != held:
                    yield from ended()
                    held, ids, groups, first = at, [], [], 0
                if not ids or ids[-1] != one:
                    ids.append(one)
                    groups.append(shingles(t, n))
                    first += not second
        yield from ended()

    def versus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, None
        for batch in pieces(batches, 1):
            out = []
            for t, p in zip(bytes_of(batch.column(1)), bytes_of(batch.column(2)), strict=True):
                if p != last:
                    last, other = p, shingles(p, n)
                out.append(bool(linked_groups([shingles(t, n), other], num, den)))
            yield pa.RecordBatch.from_pydict({"set_id": batch.column(0), "linked": pa.array(out)})

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = lambda df: df.repartition(tasks, "at").sortWithinPartitions("at", "second", "set_id").mapInArrow(compare, "a bigint, b bigint")
    small = run(full.where(F.col("n") <= block).select(F.col("root").alias("at"), F.lit(False).alias("second"), "set_id", "t"))
    large = full.where(F.col("n") > block)
    pivots = large.where("set_id = pivot").select("root", F.col("t").alias("p")).dropDuplicates(["root"])
    tested = large.join(pivots, "root").select("set_id", "t", "p").mapInArrow(versus, "set_id bigint, linked boolean")
    tested = cut_lineage(tested, "pivot-links")
    to_pivot = large.select("set_id", "pivot").join(tested.where("linked"), "set_id").select(F.col("set_id").alias("a"), F.col("pivot").alias("b"))
    # Sets that link to the pivot are one group; only pairs with a loose set are left. Sizes of linked sets are close: so the sets go
    # to size classes, large classes to chunks of bounded weight, and chunks only meet chunks of classes within reach.
    log_step = math.log(CLASS_STEP)
    reach = int(math.log(den / num) / log_step) + 1
    rest = large.join(tested.distinct(), "set_id").withColumn("class", F.floor(F.log(F.col("size")) / log_step + 1e-9).cast("int"))
    weight = F.sum(F.col("size") + 500)
    classes = cut_lineage(rest.groupBy("root", "class").agg(F.ceil(weight / F.lit(block * 2000)).alias("chunks")), "classes")
    rest = rest.join(classes, ["root", "class"]).withColumn("chunk", F.pmod(F.xxhash64("set_id"), "chunks"))
    opened = rest.where("NOT linked").select("root", "class", "chunk").distinct().withColumn("open", F.lit(True))
    every = classes.select("root", "class", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"))
    every = every.join(opened, ["root", "class", "chunk"], "left").select(
        "root", F.col("class").alias("far_class"), F.col("chunk").alias("far_chunk"), F.coalesce("open", F.lit(False)).alias("open")
    )
    near = rest.withColumn("far_class", F.explode(F.sequence(F.col("class") - reach, F.col("class") + reach)))
    met = near.join(every, ["root", "far_class"]).where(~F.col("linked") | F.col("open"))
    own, far = F.struct("class", "chunk"), F.struct(F.col("far_class").alias("class"), F.col("far_chunk").alias("chunk"))
    pairs = met.select(F.xxhash64("root", F.least(own, far), F.greatest(own, far)).alias("at"), (own > far).alias("second"), "set_id", "t")
    return small.unionByName(run(pairs)).unionByName(to_pivot)


def near_copies(
    docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, key: str = "doc_id", text: str = "text", block: int = 500,
) -> DataFrame:
    """Per row: key, row_key, n_shingles, component_id (least key reachable by links), keep (one row_key per group).

    Sets link when ``den`` * intersection >= ``num`` * union. Null texts and texts without words have no shingles, are linked with
    nothing, form their own component and are kept. Repeated rows are copies. Rows without a key take part; a group in which no
    row has a key has a null component_id. Links are exact up to collisions of 64-bit hashes.
    """
    sets = cut_lineage(text_sets(docs, n, key, text), "sets")
    blocks = cut_lineage(components(candidate_links(docs, n, num, den, text)), "blocks")
    links = exact_links(sets, docs, blocks, n, num, den, text, key, block)
    roots = components(links)
    per_set = sets.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min(key).alias("least"), F.min(F.struct(F.col(key).isNull(), key, "row_key")).alias("first"))
    grouped = per_set.join(roots, per_set["set_id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "set_id"))
    per_group = cut_lineage(grouped.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first")["row_key"].alias("kept")), "groups")
    known = cut_lineage(grouped.select("set_id", "root").join(per_group, "root").select("set_id", "component_id", "kept"), "set-groups")
    return sets.join(known, "set_id", "left").select(
        key, "row_key", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("set_id").isNull() | (F.col("row_key") == F.col("kept"))).alias("keep"),
    )


def one_of_each_group(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near copies: of each group the row with the least key stays; texts without words all stay."""
    has_words = F.coalesce(F.col(text), F.lit("")).rlike(WORD)
    found = near_copies(docs, n, num, den, key, text)
    kept = found.where("keep AND n_shingles > 0").select(F.col("row_key").alias("_row_key")).distinct()
    keyed = docs.where(has_words).select(F.struct("*").alias("row"), row_key(key, text).alias("_row_key"), F.col(key).alias("k"), F.md5(text).alias("m"))
    rows = keyed.join(kept, "_row_key").dropDuplicates(["_row_key", "k", "m"]).select("row.*")  # two documents with one key hash both stay
    return rows.unionByName(docs.where(~has_words))
