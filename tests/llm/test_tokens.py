"""BPE and the ORC token store against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postsieve.llm import bpe, orcstore
from postsieve.session import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_model():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_model():
    return Tokenizer.from_file(WORD)


def noise(letters, n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


LETTERS = ["a", "B", " ", "  ", "\n", "é", "日本", "😀", "'s", "'LL", "1", "e", "́", "the", "ing", "\x00", " ", " ", "!?", "\x1c", "Σ", "İ", "hello"]


@pytest.mark.parametrize("letters", [LETTERS, [*LETTERS, "<|endoftext|>"]])
def test_ids_and_texts_as_in_the_library(byte_model, letters):
    texts = [*noise(letters, 1500), "", "a" * 3000, " " * 500]
    model = bpe.bpe(BYTE)
    for text, ids in zip(texts, model.encode_all(texts), strict=True):
        want = byte_model.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert model.decode(ids) == byte_model.decode(want, skip_special_tokens=False)
        assert model.encode(text) == ids


def test_tree_names_leftmost_lowest_pair():
    tree = bpe.PairTree([5, 2, 7, 2, 9])
    assert tree.best() == 1
    tree.put(1, None)
    assert tree.best() == 3
    tree.put(0, 1)
    assert tree.best() == 0
    for i in range(5):
        tree.put(i, None)
    assert tree.best() is None


def test_single_and_joint_merges_agree():
    model = bpe.bpe(BYTE)
    pieces = [p.encode() for p in {w for t in noise(LETTERS, 400, 5) for w in model.piece.findall(t)} if 1 < len(p.encode()) <= 16]
    assert [np.frombuffer(b, "<u4").tolist() for b in model.merge_together(pieces, 16)] == [model.merge(p) for p in pieces]


def test_broken_bytes_decode_to_marks():
    model = bpe.bpe(BYTE)
    ids = np.array([model.first[b] for b in "é".encode()[:1]], "<u4").tobytes()
    assert model.decode(ids) == "�"


def test_hard_rows_round_trip(hard, empty):
    got = bpe.encode_texts(hard, BYTE, decoded=True)
    pairs = lambda rows: sorted(((r[0] is None, r[0] or 0, r[1] or "") for r in rows))
    assert pairs(got.select("doc_id", "decoded").collect()) == pairs(hard.select("doc_id", "text").collect())
    assert pairs(bpe.decode_ids(got, BYTE).collect()) == pairs(hard.select("doc_id", "text").collect())
    assert bpe.encode_texts(empty, BYTE).collect() == []


@pytest.mark.parametrize("letters", [LETTERS, [*map(chr, range(256)), "'s", "'LL", "the", " "], [*LETTERS, "<|endoftext|>"]])
def test_pieces_as_in_the_library(word_model, letters):
    ids = orcstore.piece_ids(WORD).ids
    for text in noise(letters, 1500, 3):
        assert np.frombuffer(ids(text), "<i4").tolist() == word_model.encode(text, add_special_tokens=False).ids, repr(text)


def stored(spark, docs):
    path = scratch_path(spark, "tokens")
    orcstore.write_tokens(orcstore.tokenize(orcstore.in_order(docs), WORD), path)
    return path


def test_files_hold_all_documents_in_order(spark, hard, word_model):
    path = stored(spark, hard)
    got = orcstore.document_starts(spark, path).orderBy("start").collect()
    texts = {}
    for r in hard.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    start = 0
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda d: (d is not None, d))
    for r in got:
        wants = [[*word_model.encode(t, add_special_tokens=False).ids, 2] for t in texts[r["doc_id"]]]
        assert r["start"] == start
        assert (r["n_tokens"], r["ids_crc32"]) in [(len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for w in wants]
        start += r["n_tokens"]
    assert len(got) == hard.count()


def test_lookup_by_id_prunes_by_metadata(spark, capsys):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("document "), "id").alias("text"))
    path = stored(spark, docs)
    found = orcstore.read_documents(spark, path, [7, 4000])
    assert sorted(r["doc_id"] for r in found.collect()) == [7, 4000]
    found.explain("formatted")
    assert "PushedFilters: [In(doc_id" in capsys.readouterr().out


def test_empty_table(spark, empty):
    path = stored(spark, empty)
    assert orcstore.document_starts(spark, path).collect() == []
