"""Fixtures of hard rows, shared by the tests of this folder."""

import re

HARD = [None, "", " \t\n", "word", "A a", "The  end.\n\nThe end.", "é́ 日本 😀 ١", "x" * 30_000, "so it goes on " * 3_000, "0" * 20_000, "it's 12,000.50 <|endoftext|> we'll"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, size string, row string, h string"


def hard_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and keys, and columns named like inner ones."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "own", "own", "own", "own") for i, t in enumerate(HARD)]
    rows += [rows[3], rows[5], (None, "no key here", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None), (3, "another text with a used key", "en", "s0", 1, "", "", "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
