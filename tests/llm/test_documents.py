"""Mixing, pages, and the pipeline as a whole."""

import hashlib
import math
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from helpers import words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postsieve.llm import jaccard, mixing, pii, queries, sitetree

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_values_as_sql(spark, name):
    ok, note = compare(spark, duck(SF), SF, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, note


def brute_targets(sizes):
    weights = {s: float((3, 1, 2)[i % 3]) for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, total, full = dict(weights), 1.5 * sum(sizes.values()), {}
    while left:
        share = {s: (total - sum(full.values())) * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] > 2.0 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 2.0 * sizes[s]
            del left[s]
    return full


def test_targets_by_repeated_sharing(spark):
    rng = np.random.default_rng(2)
    for _ in range(6):
        sizes = {f"s{i}" if i else None: int(rng.integers(0, 1000) ** 2 // 500) for i in range(int(rng.integers(1, 12)))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in sizes)


def test_mix_comes_near_its_targets_and_repeats(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 4) END").alias("source"),
        F.expr("repeat('word ', cast(id * 7919 % 90 AS int))").alias("text"),
    )
    runs = [mixing.mix_sources(d).select("doc_id", "_mix.*").orderBy("doc_id").collect() for d in (docs, docs.repartition(9))]
    assert runs[0] == runs[1]
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    taken, targets = defaultdict(int), {}
    for r in runs[0]:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert all(0.0 <= p <= 1.0 for p in r["positions"])
        taken[source[r["doc_id"]]] += r["taken"]
        targets[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - t) <= 45 for s, t in targets.items())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(len(r["positions"]) for r in runs[0])


def test_curriculum_follows_the_schedule(spark):
    """Words of a source placed up to time u come near the integral of its weight."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("concat('s', id % 3)").alias("source"), F.lit("a b c d").alias("text"))
    rows = mixing.mix_sources(docs, carry=["source"]).collect()
    for i, k in enumerate(mixing.SLOPES):
        mine = [r["_mix"] for r in rows if r["source"] == f"s{i}"]
        for u in (0.25, 0.5, 0.75):
            placed = sum(m["size"] for m in mine for p in m["positions"] if p < u)
            assert abs(placed - mine[0]["target"] * ((1 - k) * u + k * u * u)) < 10


def test_mix_of_hard_rows(hard, empty):
    rows = mixing.mix_sources(hard).collect()
    assert len(rows) == hard.count()
    sizes = sorted(r["_mix"]["size"] for r in rows)
    assert sizes == sorted(len(words(r["text"])) for r in hard.collect())
    assert mixing.mix_sources(empty).collect() == []
    assert mixing.mixed_documents(hard).columns == hard.columns


PAGES = {
    "<body><div id=cookie-notice>x</div><main><header><h1>T &amp; &nbsp; u</h1></header><p>a<br>b <i>c</i>d<p>e</main>": "T & u\na b cd\ne",
    "<article><h1>x</h1><div class='comments'><p>no</p></div><p>y<script>z</article></script>w</p></article><footer>f</footer>": "x\nyw",
    "plain &lt;text": "plain <text",
    "<p hidden>x</p><p>a < b</p><ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table>": "a < b\n1\n2\na\nb\nc",
    "<nav>n</nav><article><p><b>one<br></article><aside>s</aside>": "one",
    "<article>cut &am": "cut &am",
    "<title>t</title><style>p{}</style><form>f</form><div class='ad banner'>x</div><header>h</header>": "",
    "": "", None: "",
    "<div>" * 3000 + "deep": "deep",
}


WRAPPED = {
    "<div id='wrapper' class='with-sidebar'><main><p>a</p></main></div><footer>f</footer>": "a",
    "<div class='no-sidebar'><p>a</p></div>": "a",
    "<div class='page-with-ads'><div class='search-results'><article><p>a</p></article></div></div>": "a",
    "<form id='aspnetForm'><div class='header'>h</div><div class='body'><p>The text of it all</p></div><div class='sidebar'>s</div></form>": "The text of it all",
    "<form><main><p>a</p></main></form><div>some more text</div>": "a",
    "<header><article><h1>a</h1><p>b</p></article></header>": "a\nb",
    "<div class='widget'><p>Nearly all of the text of a page</p></div><a href='/'>home</a>": "Nearly all of the text of a page\nhome",
    "<article><p>a</p><div class='related-work'><p>b</p></div><div class='social-policy'><p>c</p></div></article>": "a\nb\nc",
    "<head><title>t</title><body><p>a</p>": "a",
    # What is furniture stays cut, also where it uses article tags or is longer than the article.
    "<article><p>a</p></article><div id='comments'><article>one</article><article>two</article></div>": "a",
    "<p>A page without marks</p><aside><article>teaser</article></aside>": "A page without marks",
    "<form><p>The text</p><div class='sidebar'>More words than the text has</div></form>": "The text",
    "<nav>menu</nav><form>f</form><footer>foot</footer><div class='share'>xyz</div>": "",
}


def test_what_holds_the_text_is_not_cut_for_its_name_or_tag(spark):
    assert {p: sitetree.main_text(p) for p in WRAPPED} == WRAPPED
    rows = [(i, "https://h.example/", p) for i, p in enumerate(WRAPPED)]
    got = sitetree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == dict(enumerate(WRAPPED.values()))


def test_doubtful_names_are_left_to_the_style_tree(spark):
    page = "<body><div class='cookie-notice'>We use cookies</div><div class='post-related-work'><p>Story {0} of the day</p></div></body>"
    rows = [(i, "https://a.example/", page.format(i)) for i in range(12)]
    got = sitetree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == {i: f"Story {i} of the day" for i in range(12)}


def test_main_text_of_pages(spark):
    rows = [(i, f"https://h.example/{i}", p) for i, p in enumerate(PAGES)] + [(None, None, None), (0, "no host", "<p>z</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((r["page_id"] is None, r["page_id"] or 0, r["text"], r["n_chars"]) for r in sitetree.extract(df).collect())
    want = [(False, i, t, len(t)) for i, t in enumerate(PAGES.values())] + [(True, 0, "", 0), (False, 0, "z", 1)]
    assert got == sorted(want)
    assert sitetree.extract(df.where("false")).collect() == []


def test_branches_that_never_change_go_where_the_site_repeats_them(spark):
    page = "<body><div class='top'>Welcome to the site</div><div class='story'><p>Story {0} of the day</p><p>Told {0} times</p></div></body>"
    rows = [(i, f"https://a.example/{i}", page.format(i)) for i in range(12)] + [(99, "https://b.example/", page.format(5))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in sitetree.extract(df).collect()}
    assert got[3] == "Story 3 of the day\nTold 3 times"
    assert got[99].startswith("Welcome")  # one page tells nothing about its site


def test_copies_of_an_article_do_not_make_it_furniture(spark):
    page = "<body><div class='top'>t{}</div><article><div class='body'><p>The same words</p></div></article></body>"
    rows = [(i, "https://a.example/", page.format(i)) for i in range(40)]
    got = sitetree.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r["text"] for r in got.collect()} == {"The same words"}


def test_pages_of_the_test_tables(spark):
    """The generator puts each article between article tags."""
    df = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in sitetree.extract(df).collect()}
    for r in df.collect():
        assert got[r["page_id"]] == sitetree.main_text(r["html"])
        assert "<" not in got[r["page_id"]] or "&lt;" in r["html"]


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        kept[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
        if name == "language_id":
            assert docs.where(~F.coalesce("text", F.lit("")).rlike(r"\p{L}")).count() == 0
        if name == "jaccard_join":
            groups = jaccard.near_copies(before, 5, 80, 100)
            assert docs.count() == groups.select("component_id").distinct().count()
            assert jaccard.near_copies(docs, 5, 80, 100).where("doc_id <> component_id").count() == 0
        if name == "pii":
            assert all(not pii.base_spans(r["text"]) for r in docs.collect())
            assert docs.count() == before.count()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = sorted((r["doc_id"], hashlib.md5(bytes(r["ids"])).hexdigest()) for r in docs.collect())
    want = sorted(
        (r["doc_id"], hashlib.md5(np.array(model.encode(r["text"], add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for r in kept["mixing"].collect()
    )
    assert ids == want
    assert corpus_pipeline.run(spark, SF).count() == len(ids)


@pytest.mark.parametrize("name", ["language_id", "jaccard_join", "pii", "mixing", "bpe"])
def test_stages_on_hard_and_empty_tables(spark, hard, empty, name):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, hard, SF)
    if name != "bpe":
        assert got.columns == hard.columns
    got.collect()
    assert stage(spark, empty, SF).collect() == []
