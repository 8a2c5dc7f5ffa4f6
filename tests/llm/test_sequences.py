"""WARC archives, periodic runs and conversation repair, against brute-force versions."""

import gzip
import hashlib
import random
import zlib
from functools import cache
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postsieve.llm import dialogue, periodic, queries, warc
from postsieve.session import scratch_path

# --- WARC


def pages(spark):
    rows = [
        (4, "http://b/\r\nq", "x" * 200), (2, "http://a/", "x" * 200), (3, None, None), (None, "u", "é" * 60), (5, "u", "é" * 60), (6, "", ""),
        (7, "k", "short"), (8, "k", "short"), (9, "z", "\r\n\r\nWARC/1.1\r\n\r\n" * 50), (2, "again", "x" * 200), (None, "n", "q" * 200),
        (10, "long", "ab\n" * 400_000), (11, "i", "日本" * 50), (11, "i", "日本" * 50),
    ]
    return rows, spark.createDataFrame([(*r, "own", 1) for r in rows], "page_id bigint, url string, html string, payload string, first int")


def stored(spark, frame):
    whole, split = scratch_path(spark, "whole"), scratch_path(spark, "split")
    warc.write_archives(frame, whole)
    return whole, split, warc.normalise(spark, whole, split)


def test_archives_hold_every_page(spark):
    rows, frame = pages(spark)
    _, _, index = stored(spark, frame)
    found = warc.read_records(index).collect()
    told = sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in found), key=str)
    first = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    want = []
    for i, url, html in rows:
        data, held = (html or "").encode(), first.get(html)
        again = held is not None and held != i
        want.append((i, url, "revisit" if again else "response", held if again else None, len(data), hashlib.sha256(data).hexdigest()))
    assert told == sorted(want, key=str)
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest


def test_whole_streams_become_members(spark):
    _, frame = pages(spark)
    whole, split, index = stored(spark, frame.coalesce(1))
    places = sorted((r.archive, r.offset, r.length) for r in index.collect())
    whole_texts, split_texts = [], []
    for file in sorted(Path(whole).glob("*.gz")):
        inflate = zlib.decompressobj(31)
        whole_texts.append(inflate.decompress(file.read_bytes()))
        assert not inflate.unused_data  # one member
    for file in sorted(Path(split, "archives").glob("*.warc.gz")):
        data = file.read_bytes()
        split_texts.append(gzip.decompress(data))
        mine = [(o, n) for a, o, n in places if a.endswith(file.name)]
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))] and sum(n for _, n in mine) == len(data)
        for o, n in mine:
            record = gzip.decompress(data[o : o + n])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert sorted(filter(None, whole_texts)) == sorted(filter(None, split_texts))
    assert not list(Path(split, "archives").glob("*.gz.*"))  # no attempt's file is left


def test_an_archive_of_members_is_read_too(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(record.format(i).encode()) for i in range(3)))
    index = warc.normalise(spark, str(tmp_path), scratch_path(spark, "split"))
    assert [r.record_id for r in index.orderBy("offset").collect()] == [f"<urn:page:{i}>" for i in range(3)]


@pytest.mark.parametrize("cut", [1, 30])
def test_damaged_archives_are_named(spark, tmp_path, cut):
    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 300\r\n\r\n" + bytes(random.Random(1).randbytes(300)) + b"\r\n\r\n")
    (tmp_path / "broken.warc.gz").write_bytes(whole[:-cut])
    with pytest.raises(Exception, match="broken.warc.gz"):
        warc.normalise(spark, str(tmp_path), scratch_path(spark, "split"))


def test_no_pages_no_records(spark):
    _, _, index = stored(spark, pages(spark)[1].limit(0))
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_hot_payloads_are_split(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROWS_PER_TASK", 50)
    frame = spark.range(1000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, F.lit("p" * 100)).otherwise(F.repeat(F.lit("q"), F.col("id").cast("int") + 100)).alias("html"))
    found = warc.with_revisits(frame)
    assert found.count() == 1000 and found.where("refers_to = 1").count() == 665 and found.where("refers_to is null").count() == 335


def test_query_of_archives(spark):
    found = queries.QUERIES["op11_warc"](spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert found.count() == n == found.select("page_id").distinct().count()


# --- periodic runs


def brute_runs(w):
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and not any(w[i + r : j + q] == w[i : j + q - r] for r in range(1, q)):
                found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_words(rng):
    letters = "abcdefgh"[: rng.choice([1, 2, 3, 8])]
    w = [rng.choice(letters) for _ in range(rng.randint(0, 90))]
    if w and rng.random() < 0.6:
        a = rng.randrange(len(w))
        p = rng.randint(1, max(1, (len(w) - a) // 4))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    return w


def test_wavelet_successors():
    rng = random.Random(3)
    values = list(range(500))
    rng.shuffle(values)
    np = periodic.np
    tree = periodic.WaveletMatrix(np.array(values), 500)
    lo = np.array([rng.randrange(500) for _ in range(400)])
    hi = np.array([rng.randint(at, 500) for at in lo])
    x = np.array([rng.randrange(501) for _ in range(400)])
    want = [min((v for v in values[i:j] if v >= y), default=-1) for i, j, y in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


def test_suffix_array_orders_blocks():
    rng = random.Random(4)
    np = periodic.np
    ids = np.array([rng.randrange(3) for _ in range(300)] + [9])
    order, blocks = periodic.suffix_blocks(ids, 5)
    assert [ids[i:].tolist()[:32] for i in order] == sorted(ids[i:].tolist()[:32] for i in range(301))
    for level, (places, lo, hi) in blocks.items():
        for s, i, j in zip(places, lo, hi):
            block = ids[s : s + 2**level].tolist()
            assert sorted(order[i:j]) == [t for t in range(301) if ids[t : t + 2**level].tolist() == block]


def test_all_runs_are_found(spark):
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(600)]
    rows = [(i, rng.choice([" ", "\t\n", "  "]).join(w)) for i, w in enumerate(texts)]
    found = {r.doc_id: r for r in periodic.collapse_runs(spark.createDataFrame(rows, "doc_id int, text string"), words_at_once=500).collect()}
    for i, w in enumerate(texts):
        runs = brute_runs(w)
        assert [tuple(r) for r in found[i].runs] == runs
        assert found[i].collapsed == brute_collapse(w, runs)


def test_hard_texts_of_runs(hard, empty):
    found = periodic.collapse_runs(hard.withColumnRenamed("size", "runs"))
    assert found.count() == hard.count() and found.where("runs is null or collapsed is null").count() == 0
    long = found.where("doc_id = 8").first()
    assert [tuple(r) for r in long.runs] == [(0, 12_000, 4)] and long.collapsed == "so it goes on" and long.ids == "own"
    assert periodic.collapse_runs(empty).count() == 0


def test_query_of_runs_against_brute_force(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op12_runs"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        w = [x.decode() for x in (d.text or "").encode().split()]
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) > 1500:  # the plain version is quadratic
            continue
        runs, row = brute_runs(w), found[d.doc_id]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (row.start, row.length, row.period) == (best or (None,) * 3) and row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert (row.n_runs, row.runs_sha256) == (len(runs), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)))
        assert row.collapsed_sha256 == sha(brute_collapse(w, runs))


# --- conversations

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_audit(rows):
    """Least cost, then least audit, by trying every cost from 0 on. Rows are (initial, must go, truncated)."""

    @cache
    def least(i, state, cost):
        if cost < 0:
            return None
        ways = [""] if i == len(rows) and cost == 0 and state in ("", "a") else []

        def way(edit, rest):
            if rest is not None:
                ways.append(edit + rest)

        made = [x for x in "ua" if (state, x) in NEXT]
        for x in made:
            way("I", least(i, x, cost - 2))
        if i < len(rows):
            initial, must_go, cut = rows[i]
            way("D", least(i + 1, state, cost - 3))
            if not must_go:
                for x in made:
                    way("R", least(i + 1, x, cost - 2 - cut))
                if (state, initial) in NEXT:
                    way("K", least(i + 1, NEXT[state, initial], cost - cut))
        return min(ways, default=None)

    cost = 0
    while (found := least(0, "", cost)) is None:
        cost += 1
    return cost, found


def brute_repair(talk):
    """The contract row by row; rows are (turn, role, text) in order, nulls replaced."""
    seen, marked, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in talk:
        full = text.rstrip(" \t\n\r\x0b\x0c")
        fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        marked.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = brute_audit(marked)
    out, state, at = [], "", 0
    name = {"u": "user", "a": "assistant"}
    for edit in audit:
        made = next(x for x in "ua" if (state, x) in NEXT)
        if edit == "I":
            out.append(f"{name[made]}:")
            state = made
            continue
        _, role, text = talk[at]
        at += 1
        if edit != "D":
            out.append(f"{role if edit == 'K' else name[made]}:{text}")
            state = role[0] if edit == "K" else made
    turns = [t for t, _, _ in talk if t is not None]
    initials = "".join(r[:1] or "-" for _, r, _ in talk)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **faults,
        "illegal": sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1)),
        "cost": cost, "audit": audit, "repaired": "\n".join(out),
    }


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))


def test_shared_ends_against_brute_force():
    rng = random.Random(6)
    drawn = ["".join(rng.choice("suaoSUAOx") if rng.random() < 0.4 else "ua"[i % 2] for i in range(rng.randint(0, 9))) for _ in range(1500)]
    shared = dialogue.SharedEnds()
    for ending in sorted(drawn):
        rows = [("-" if x in "xoO" else x.lower(), x == "x", x.isupper()) for x in ending[::-1]]
        assert shared.repair(ending) == brute_audit(rows)
    assert shared.made == 1 + len({e[:n] for e in drawn for n in range(1, len(e) + 1)})  # one node for each distinct end


def test_conversations_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for conv in [None, *range(150)]:
        for i in range(rng.randint(1, 7)):
            turn = rng.choice([i, i, i, i + 5, None, 0])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "No", " \t", None, "Why?  ", "日本。", "A", "ok!"]), rng.choice([0, 1, 1, 1, 2])))
    talks = spark.createDataFrame([(*r, "own") for r in rows], "conv_id bigint, turn bigint, role string, text string, copies int, at string")
    found = {r.conv_id: r.asDict() for r in dialogue.repair(talks).collect()}
    by_conv = {}
    for conv, turn, role, text, copies in rows:
        clean = (turn, " " if role is None else role, " " if text is None else text)
        by_conv.setdefault(conv, []).extend([clean] * copies)
    assert set(found) == set(by_conv)
    for conv, talk in by_conv.items():
        want = brute_repair(in_order(talk))
        assert {k: found[conv][k] for k in want} == want
        assert found[conv]["repaired_sha256"] == hashlib.sha256(want["repaired"].encode()).hexdigest()


def test_query_of_conversations_against_brute_force(spark):
    found = {r.conv_id: r.asDict() for r in queries.QUERIES["op13_conversations"](spark, "/root/testdata/sf0.01").collect()}
    talks = {}
    for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect():
        role, text = (" " if x is None else x for x in (r.role, r.text))
        h = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        text = "" if h == 1 else text.translate(str.maketrans("", "", ".!?")) if h == 2 else text
        talks.setdefault(r.conv_id, []).extend([(r.turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1))
    assert set(found) == set(talks)
    for conv, talk in talks.items():
        want = brute_repair(in_order(talk))
        sha = hashlib.sha256(want.pop("repaired").encode()).hexdigest()
        assert found[conv] == {"conv_id": conv, **want, "repaired_sha256": sha}


def test_one_long_conversation_and_none(spark):
    long = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat("id", F.lit(".")).alias("text"))
    found = dialogue.repair(long.withColumn("copies", F.when(F.col("turn") == 100, 40).otherwise(1))).first()
    assert (found.duplicate, found.illegal, found.cost, found.gaps) == (39, 39, 117, 0) and found.audit.count("D") == 39 and len(found.audit) == 30_039
    assert dialogue.repair(long.limit(0)).count() == 0
