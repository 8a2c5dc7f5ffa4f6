"""Personal data, language, language model: exact parts against brute force, learned parts on held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import words
from pyspark.sql import functions as F

from postsieve.llm import contextmix, langid, pii
from postsieve.llm.common import hashed_share

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def brute_spans(text):
    number = lambda s: re.sub("[^0-9]", "", s)

    def checked(digits):
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(sum(divmod(t, 10)) for t in twice) % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(number(s)) <= 19 and checked(number(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(number(s)) <= 15),
    }
    return [(k, *m.span()) for k, (pattern, ok) in kinds.items() for m in re.finditer(pattern, text) if ok(m[0])]


def test_pattern_spans_as_by_plain_patterns():
    rng = random.Random(3)
    letters = [*"a.@-+ 0123456789()%_\n", "é", "1.2.3.4", "+1 (555) 010-9999", "4111111111111111", "a@b.co", "4111-1111 1111 1111", "  ", "١"]
    for _ in range(6000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_long_runs_do_not_backtrack():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1 " * 100_000, "a@" * 100_000, "@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)
        pii.windows(text)


@pytest.fixture(scope="module")
def field():
    """Trained on made-up sentences with one span each."""
    rng = random.Random(1)
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    samples = []
    for i in range(160):
        card = next(c for c in (f"4{digit(15)}" for _ in range(999)) if pii.luhn(c))
        spans = [f"joe.{i}@mail{i % 9}.example.com", f"{i}.{rng.randint(0, 255)}.7.{rng.randint(0, 255)}", card, f"+1 ({digit(3)}) 555-{digit(4)}"]
        samples += pii.train_windows(f"some words here {spans[i % 4]} and then some more of them", rng)
    return pii.train(samples)


def test_field_adds_what_patterns_miss(field):
    def added(text):
        base, spans = pii.find(text, field)
        assert set(base) <= set(spans)
        return [(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base]

    card = "4111111111111111"
    assert added(f"call +1 (269) 555-3296 {card} now") == [("phone", "+1 (269) 555-3296")] or ("card", card) in added(f"call +1 (269) 555-3296 {card} now")
    assert ("phone", "(743) 555-3824") in added("call (743) 555-3824 now")
    assert added("write to joe [at] example [dot] org today") == [("email", "joe [at] example [dot] org")]
    for clean in ("on 2024-01-02 03:04:05", "card 4111111111111112 fails", 'n = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "meet me at noon", "1 2 3"):
        assert added(clean) == [], clean


def test_best_split_is_the_best_of_all(field):
    """Dynamic programming against all splits of short windows."""
    for text in ("+1 (269) 555-3296 4", "a@b.co 1.2.3.4", "555-1234567"):
        ends = pii.borders(text, 0, len(text))
        segments = [(i, j, k, s[k]) for j, row in enumerate(field.scores(text, ends)) for i, _, s in row for k in range(4)]

        def best(at):
            if at == len(ends) - 1:
                return 0.0
            return max([best(at + 1), *(s + best(j) for i, j, _, s in segments if i == at and s > 0)])  # noqa: B023

        found = field.best(text, ends)
        total = sum(max(s for i, j, k, s in segments if (pii.KINDS[k], ends[i], ends[j]) == f) for f in found)
        assert math.isclose(total, best(0), abs_tol=1e-9)


def test_spans_of_hard_rows(hard, empty, field):
    got = pii.detect(hard, field)
    assert got.count() == hard.count()
    assert pii.detect(empty, field).collect() == []
    assert pii.fit(empty).weights == {}
    cleaned = pii.redact(hard, field)
    assert cleaned.schema.names == hard.schema.names
    assert cleaned.where("n_chars <> length(text)").count() == 0


def test_redaction(spark, field):
    df = spark.createDataFrame([(1, "to a@b.co, 1.2.3.4"), (2, None)], "n_chars int, text string")
    assert [tuple(r) for r in pii.redact(df, field).orderBy("text").collect()] == [(None, None), (16, "to [EMAIL], [IP]")]


def test_language_on_held_out_rows(documents):
    bucket = langid.bucket_of("doc_id", 4)
    model = langid.train(documents, bucket != 2, per_lang=100)
    found = langid.identify(documents.where(bucket == 2), model, carry=["lang"]).where("lang IS NOT NULL")
    right, n, sure = found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.avg("score")).first()
    assert n > 20
    assert right > 0.97
    assert abs(sure - right) < 0.1
    assert (model.weights == 0).mean() > 0.3  # the penalty leaves a sparse model


def test_n_gram_slots_by_hand():
    one = langid.gram_slots("Ab")
    assert len(one) == 2 + 3 + 2  # a, b; _a, ab, b_; _ab, ab_
    assert (langid.gram_slots("ab, AB!")[:2] == one[:2]).all()
    assert len(langid.gram_slots("ab ab")) == 2 * len(one)
    assert len(langid.gram_slots("12 !? ٣")) == 0


def test_language_of_hard_rows(hard, empty):
    model = langid.train(hard, F.lit(True))
    got = {r["text"]: (r["lang_pred"], r["score"]) for r in langid.identify(hard, model, carry=["text"]).collect()}
    for text, (lang, score) in got.items():
        assert 0.0 <= score <= 1.0
        assert (lang == "und") == (not any(map(str.isalpha, text or "")))
    nothing = langid.train(empty, F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(hard, nothing).collect()} == {"und"}
    assert langid.identify(empty, model).collect() == []


def test_base_score_by_hand(documents):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    counts = Counter()
    for d, t in texts.items():
        if zlib.crc32(str(d).encode()) % 10:
            counts.update([*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    got = contextmix.score_documents(documents, ~held, head=50).collect()  # a short head, so that most words are joined
    assert len(got) == len(texts)
    for r in got:
        tokens = [*words(texts[r["doc_id"]]), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


@pytest.fixture(scope="module")
def small_model(spark):
    df = spark.createDataFrame([("abab ab",), ("ba ab",), ("b",)] * 4, "text string")
    return contextmix.learn(df, contextmix.survey(df))


def test_probabilities_sum_to_one(small_model):
    """Over all bytes that may follow a start, whatever the context."""
    trees = small_model.trees
    for prev in (contextmix.START, ord("a"), ord("q")):
        pairs = prev << 8 | np.arange(256)
        assert math.isclose(sum(0.5 ** int(n) for n in trees.length[pairs]), 1.0)
    one = [small_model.score([bytes([b])], ended=False)[0] for b in range(256) if b not in (contextmix.START,)]
    assert 0.9 < sum(10.0**s for s in one) <= 1.0 + 1e-3


def test_model_prefers_what_it_has_seen(small_model):
    score = lambda t: float(small_model.score([t])[0])
    assert score(b"abab ab") > score(b"qzqz qz")
    assert score(b"ab ab") > score(b"ab ab ab")
    many = [b"ab " * 900, b"", b"ba", b"xyz \n\t ab"]
    assert np.allclose(small_model.score(many), [small_model.score([m])[0] for m in many], rtol=1e-5)
    again = small_model.score([b"zq " * n for n in (8, 800)])
    assert again[1] / 800 > again[0] / 8  # weights are refined inside a document


def test_words_are_predicted_from_the_words_before(spark):
    """Each of two words follows its own word only; a model within words cannot tell the right order from the wrong one."""
    df = spark.createDataFrame([("red apple blue river " * 5,)] * 20, "text string")
    model = contextmix.learn(df, contextmix.survey(df))
    right, wrong = (float(model.score([t])[0]) for t in (b"red apple blue river red apple", b"red river blue apple red river"))
    assert right > wrong + 3.0


def test_weights_move_every_few_bytes(small_model):
    """A model that never moves its weights gives a repeated text the same price each time; here it falls within the first words."""
    cost = lambda n: -float(small_model.score([b"zq " * n])[0])
    assert contextmix.STEP <= 8
    assert cost(12) - cost(8) < cost(8) - cost(4)


def test_scores_do_not_depend_on_how_much_is_in_memory(small_model):
    many = [b"ab " * 900, b"", b"ba ab abab " * 40, b"xyz \n\t ab"]
    small = contextmix.Model(small_model.trees, small_model.first, small_model.tables, limit=10)
    assert np.allclose(small.score(many), small_model.score(many), rtol=1e-5)


def test_held_out_bits_per_byte(documents):
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    rows = contextmix.score_documents(documents.withColumn("n", F.octet_length("text")), ~held).join(documents.select("doc_id", "text"), "doc_id").where(held)
    bits = -rows.agg(F.sum("score")).first()[0] * math.log2(10) / rows.agg(F.sum(F.octet_length("text"))).first()[0]
    assert bits < 3.6


def test_scores_of_hard_rows(hard, empty):
    got = contextmix.score_documents(hard, F.col("doc_id").isNotNull()).collect()
    assert len(got) == hard.count()
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in got)
    assert contextmix.score_documents(empty, F.lit(True)).collect() == []
    untrained = contextmix.score_documents(hard, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in untrained} == {(0, 0, 0.0)}


def test_contexts_by_hand():
    """Two places share a hash exactly when they share the three bytes, the word so far, or that and the word before in its text."""
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "b", "ab", " ", "\n", "é"]) for _ in range(rng.randint(0, 12))).encode() for _ in range(60)]
    raw, first, lengths = contextmix.lay_out(texts)
    got = contextmix.contexts(raw, first)
    want = [{}, {}, {}]
    for t, begin, n in zip(texts, first, lengths, strict=True):
        assert raw[begin : begin + n].tobytes() == t + b"\xfe"
        for i in range(n):
            past = t[:i].replace(b"\n", b" ")
            so_far = past.rsplit(b" ", 1)[-1]
            before = past[: len(past) - len(so_far)].split()[-1:]
            for seen, key, h in zip(want, [(b"\xff\xff\xff" + t[:i])[-3:], so_far, (so_far, *before)], got, strict=True):
                seen.setdefault(key, set()).add(int(h[begin + i]))
    for seen in want:
        assert all(len(h) == 1 for h in seen.values())
        assert len(set.union(*seen.values())) == len(seen) > 20


def test_slot_counts_by_hand(spark):
    """Counts of every predictor over several tasks against a plain count, byte by byte."""
    texts = ["ab ab\nba", "", None, "ab ba", "é ab"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    model = contextmix.learn(df, contextmix.survey(df))
    bits = contextmix.slot_bits(100)
    counts = [Counter() for _ in range(contextmix.HASHED)]
    nodes = Counter()
    for t in texts:
        raw, first, lengths = contextmix.lay_out([(t or "").encode()])
        pair, hashes = contextmix.byte_pairs(raw), contextmix.contexts(raw, first)
        for i in range(first[0], first[0] + lengths[0]):
            for step in model.trees.step[model.trees.start[pair[i]] :][: model.trees.length[pair[i]]]:
                nodes[int(step)] += 1
                for c, h in zip(counts, hashes, strict=True):
                    one = contextmix.stirred_nodes(np.array([step]))
                    c[int(contextmix.slots_of(h[i : i + 1], np.array([0]), one, bits)[0]) * 2 + int(step & 1)] += 1
    for c, table in zip(counts, model.tables, strict=True):
        dense = np.zeros((1 << bits, 2), np.int64)
        np.add.at(dense.reshape(-1), list(c), list(c.values()))
        assert (contextmix.log_odds(dense) == table).all()
    dense = np.zeros((1 << 16, 2), np.int64)
    np.add.at(dense.reshape(-1), list(nodes), list(nodes.values()))
    assert np.allclose(contextmix.log_odds(dense) >> 1, model.first * contextmix.UNIT)


def test_words_in_arrays():
    """Hashes are equal exactly where the words are, whatever texts they stand in; bytes that UTF-8 never uses are letters."""
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"aAbB \n\t\r\xc3\xa9\xfe\xff") for _ in range(rng.randint(0, 25))) for _ in range(500)]
    want = [w for t in texts for w in (*t.lower().split(), b"")]
    for about in (1, 300, 1 << 18):
        got, sizes = contextmix.words_of(texts, about)
        assert sizes.tolist() == [len(t.split()) + 1 for t in texts]
        assert len(set(zip(want, got.tolist(), strict=True))) == len(set(want)) == len(set(got.tolist()))
        assert {w for w, h in zip(want, got.tolist(), strict=True) if h == contextmix.END_WORD} == {b""}
    assert [len(a) for a in contextmix.words_of([])] == [0, 0]


def test_finder_as_binary_search():
    rng = np.random.default_rng(2)
    known = np.unique(np.append(rng.integers(-(1 << 63), 1 << 63, 3000), [-(1 << 63), -1, 0, 1, 2, 3, (1 << 63) - 1]))
    h = np.concatenate([known, known[:-1] + 1, rng.integers(-(1 << 63), 1 << 63, 3000)])
    for some in (known, known[:1], known[:0]):
        assert (contextmix.Finder(some, 10)(h) == np.searchsorted(some, h)).all()


def test_words_are_counted_over_portions(spark):
    """A survey that passes its counts on often has the sums of one that holds them all."""
    df = spark.createDataFrame([(" ".join(f"w{(i * j) % 97}" for j in range(i % 40)),) for i in range(5000)], "text string").repartition(2)
    sums = [sorted(map(tuple, contextmix.word_counts(contextmix.survey(df, most=n)).collect())) for n in (10, 1_000_000)]
    assert sums[0] == sums[1] and len(sums[0]) == 98


def test_slots_grow_with_the_corpus():
    sizes = [contextmix.slot_bits(n) for n in (0, 1 << 27, 1 << 29, 1 << 31, 1 << 33)]
    assert sizes == sorted(sizes) and sizes[0] == contextmix.LEAST_BITS < sizes[2] < sizes[4]


def test_frequent_words_are_the_most_frequent(spark):
    rng = random.Random(8)
    rows = [(i, int(rng.paretovariate(0.7))) for i in range(3000)]
    words = spark.createDataFrame(rows, "word bigint, c bigint")
    for head in (10, 200, 5000):
        got = [tuple(r) for r in contextmix.frequent_words(words, head).collect()]
        assert got == sorted(rows, key=lambda r: (-r[1], r[0]))[: len(got)]
        assert len(got) == len(rows) if head > len(rows) else 0 < len(got) <= head
    assert contextmix.frequent_words(words.where("false"), 10).collect() == []


def test_share_by_hash(spark):
    df = spark.range(20_000)
    assert df.where(hashed_share("id", 20_000, 50_000)).count() == 20_000
    assert 800 < df.where(hashed_share("id", 20_000, 1000)).count() < 1200
    assert df.where(hashed_share("id", 0, 10)).count() == 20_000
