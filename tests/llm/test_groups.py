"""Near copies, fingerprints and nearest neighbours against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from helpers import words
from pyspark.sql import functions as F

from postsieve.llm import annhash, fingerprint, jaccard
from postsieve.llm.components import components


def brute_groups(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and den * both >= num * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d is None, d or 0, len(s), least.get(root(i)) or 0) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))))


def plain(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in df.collect())


def copies(seed, n=120):
    """Texts of every length with copies that differ in a few words, chains of copies, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 12, 25, 60, 150, 400]))]
            if rng.random() < 0.3:
                w += passage
        texts.append(" ".join(w))
    return list(enumerate(texts))


@pytest.mark.parametrize(("n", "num", "den", "block"), [(3, 90, 100, 500), (5, 80, 100, 500), (2, 60, 100, 4)])
def test_groups_as_by_brute_force(spark, n, num, den, block):
    rows = copies(n * 7)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = jaccard.near_copies(df, n, num, den, block=block)
    assert plain(found) == brute_groups(rows, n, num, den)


def test_large_block_is_compared_in_chunks(spark):
    rng = random.Random(4)
    base = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 6, 9])):
            w[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert plain(jaccard.near_copies(df, 3, 90, 100, block=8)) == brute_groups(rows, 3, 90, 100)


def test_hard_rows(hard, empty):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert plain(jaccard.near_copies(hard)) == brute_groups(rows, 3, 90, 100)
    assert jaccard.near_copies(empty).collect() == []
    kept = jaccard.one_of_each_group(hard, 3, 90, 100)
    assert kept.columns == hard.columns
    blank = [t for _, t in rows if not words(t)]
    texts = [r["text"] for r in kept.collect()]
    assert sum(not words(t) for t in texts) == len(blank)
    assert sorted(t for t in texts if words(t)) == sorted({t for _, t in rows if words(t)})


def test_close_pairs_share_enough_of_their_openings():
    rng = np.random.default_rng(3)
    for size in (1, 2, 4, 5, 10, 19, 20, 33, 80, 500):
        for num in (30, 80, 90):
            for _ in range(60):
                a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
                lost = rng.integers(0, int(len(a) * (100 - num) / (100 + num)) + 1)
                b = np.unique(np.concatenate([a[rng.permutation(len(a))[lost:]], rng.integers(0, 2**63, rng.integers(0, lost + 1)).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= num * (len(a) + len(b) - both):
                    (one, more), (other, further) = (jaccard.opening(len(x), num, 100) for x in (a, b))
                    assert len(np.intersect1d(a[:one], b[:other])) >= 1
                    least = max(jaccard.needed(len(x), num, 100) for x in (a, b))
                    assert len(np.intersect1d(a[:more], b[:further])) >= least


def test_sets_of_common_shingles_are_found(spark):
    """Documents made of passages that many share: each of their files is full, and copies among them are still found."""
    rng = random.Random(8)
    passages = [[f"p{i}_{j}" for j in range(40)] for i in range(12)]
    rows = []
    for i in range(240):
        w = sum(rng.sample(passages, 3), [])
        rows.append((i, " ".join(w)))
        if i % 6 == 0:
            w[rng.randrange(len(w))] = "other"
            rows.append((1000 + i, " ".join(w)))
    rows += [(2000 + i, " ".join([*passages[0], *(f"q{i}_{j}" for j in range(200))])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert plain(jaccard.near_copies(df, 5, 80, 100)) == brute_groups(rows, 5, 80, 100)


def test_trie_finds_exactly_the_links():
    rng = random.Random(9)
    sets = [np.unique(np.array([rng.randrange(40) for _ in range(rng.randint(1, 30))], np.uint64)) for _ in range(80)]
    order = np.arange(40)
    tree = jaccard.PrefixTree(60, 100)
    for i, s in enumerate(sets):
        mark = np.zeros(40, np.int32)
        ranks = order[s.astype(int)]
        mark[ranks] = 1
        found = sorted(tree.matches(ranks, mark))
        want = [j for j in range(i) if 100 * len(np.intersect1d(s, sets[j])) >= 60 * len(np.union1d(s, sets[j]))]
        assert found == want
        tree.add(ranks, i)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(7, 7), (500, 400)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert len({got[i] for i in range(100, 161)}) == 1
    assert len({got[i] for i in range(40)}) == 1
    assert got[400] == got[500]
    assert len(set(got.values())) == 3
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_fingerprints_add_up():
    parts = fingerprint.paragraphs("One. Two!\nThree three? One. 四")
    assert "".join(parts) == "One. Two!\nThree three? One. 四"
    whole = fingerprint.Fingerprint(parts)
    assert str(whole) == str(fingerprint.Fingerprint(parts[::-1]))
    assert str(whole - fingerprint.Fingerprint(parts[:2]) + fingerprint.Fingerprint(parts[:2])) == str(whole)
    assert str(fingerprint.Fingerprint.parse(str(whole))) == str(whole)
    assert whole.likeness(whole) == 1.0
    assert str(whole) != str(fingerprint.Fingerprint([*parts, parts[0]]))
    a = fingerprint.Fingerprint([f"p{i}" for i in range(400)])
    b = fingerprint.Fingerprint([f"p{i}" for i in range(200, 600)])
    assert abs(a.likeness(b) - 0.5) < 0.15


def test_copies_are_counted():
    a, b = (fingerprint.Fingerprint(fingerprint.paragraphs(t * 32_768)) for t in ("a.\n", "b.\n"))
    assert a.count == b.count and str(a) != str(b) and a.likeness(b) < 0.1
    held = Counter()
    first = fingerprint.Fingerprint(["x", "y", "x"], held)
    assert str(first + fingerprint.Fingerprint(["x", "z"], held)) == str(fingerprint.Fingerprint(["z", "x", "x", "y", "x"]))
    assert str(fingerprint.Fingerprint(["x", "x", "x"]) - fingerprint.Fingerprint(["x"], Counter(x=2))) == str(fingerprint.Fingerprint(["x", "x"]))


def likeness(s, t):
    a, b = Counter(fingerprint.paragraphs(s)), Counter(fingerprint.paragraphs(t))
    return 2 * (a & b).total() / ((a + b).total() or 1)


def test_likeness_against_the_multisets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    line = "The same line again.\n"
    more = {10**6 + i: line * (10 + i) + f"Another {i}.\n" * i for i in range(40)}
    texts.update(more)
    ids = sorted(texts, reverse=True)
    frame = docs.unionByName(spark.createDataFrame(list(more.items()), "doc_id bigint, text string"))
    errors = []
    for r in fingerprint.compare_edits(frame).collect():
        t, after = texts[r["doc_id"]], texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        if min(len(fingerprint.paragraphs(x)) for x in (t, after, r["edited"])) >= 30:
            errors += [abs(r["near_edited"] - likeness(t, r["edited"])), abs(r["near_next"] - likeness(t, after))]
    assert len(errors) > 300 and sum(e > 0.1 for e in errors) <= len(errors) / 50 and max(errors) < 0.2


def test_edits_against_the_next_document(spark):
    rng = random.Random(2)
    rows = [(i * 3, "".join(rng.choice("ab. \né") for _ in range(rng.randint(0, 90)))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    texts, ids = dict(rows), sorted((d for d, _ in rows), reverse=True)
    got = {r["doc_id"]: r for r in fingerprint.compare_edits(df).collect()}
    assert len(got) == len(rows)
    for i, d in enumerate(ids):
        t, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        of = lambda s: str(fingerprint.Fingerprint(fingerprint.paragraphs(s)))
        assert (got[d]["n_chars"], got[d]["edited"]) == (len(t), edited)
        assert (got[d]["fingerprint"], got[d]["edited_fingerprint"]) == (of(t), of(edited))
        assert 0.0 <= got[d]["near_edited"] <= 1.0
        assert (t == after) <= (got[d]["near_next"] == 1.0)


def test_edits_of_hard_rows(spark, hard, empty):
    got = fingerprint.compare_edits(hard).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in hard.collect())
    assert fingerprint.compare_edits(empty).collect() == []
    lone = fingerprint.compare_edits(hard.where("doc_id = 4")).first()
    assert (lone["edited"], lone["near_next"]) == ("A A", 1.0)
    prints = fingerprint.fingerprints(hard)
    assert prints.count() == hard.count()


def vectors(spark, x, extra=()):
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    return spark.createDataFrame([*rows, *extra], "vec_id bigint, embedding array<float>, label int")


def test_nearest_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 24))
    x = (centres[rng.integers(0, 12, 900)] + 0.4 * rng.standard_normal((900, 24))).astype(np.float32)
    x[100:200] = 8 * x[100]  # one vector many times
    x[300] *= 5
    bad = [(2000, None, 0), (2020, [0.0] * 24, 0), (2040, [1.0, None] * 12, 0), (2060, [float("nan")] * 24, 0), (2080, [1.0], 0), (None, [1.0] * 24, 0)]
    got = annhash.nearest(vectors(spark, x, bad).repartition(5), F.col("vec_id") % 20 == 0, k=10, shard_rows=200, block_rows=20).collect()
    found, hits = {}, 0
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact = x.astype(np.float64)
    assert sorted(found) == list(range(0, 900, 20))
    for q, rows in found.items():
        rows.sort()
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(900), -scores))[:10]
        assert [r[0] for r in rows] == list(range(1, 11))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        hits += len(set(best) & {v for _, v, _ in rows})
    assert hits / (10 * len(found)) >= 0.95
    assert [v for _, v, _ in found[120]] == [v for v in range(100, 111) if v != 120][:10]


def test_few_vectors(spark):
    x = np.eye(4, 3, dtype=np.float32) + 1
    got = annhash.nearest(vectors(spark, x), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2, 3]
    assert annhash.nearest(vectors(spark, x[:0]), F.col("vec_id") == 0).collect() == []


def test_probing_returns_every_code_in_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (300, 8)).astype(np.uint16)
    asked = codes[:40] ^ (rng.random((40, 8)) < 0.4).astype(np.uint16)
    for radius in (0, 3, 20, 55, 64):
        hits = annhash.Index(codes).within(asked, radius)
        assert (hits == (annhash.hamming(asked[:, None, :], codes[None]) <= radius)).all()
