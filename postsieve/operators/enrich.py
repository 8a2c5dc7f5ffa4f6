"""Resumable enrichment: which posts are pending, what their answers say, how the state moves on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.functions import coerce, text
from postsieve.functions.answers import single_place, validate_answer
from postsieve.operators.dedupe import SEQ, dedupe_keep_last
from postsieve.operators.ingest import drop_blank_content
from postsieve.operators.skew import hot_keys, skew_join
from postsieve.schemas import EXTRACT_FAILURES, dtype_of
from postsieve.session import cut_lineage


def content_hash(post_id: Column, content: Column) -> Column:
    """Hash of the text, only for posts without an id."""
    return F.when(text.is_blank(post_id), text.sha1_16(content)).otherwise("")


def enrichment_key(post_id: Column, content: Column) -> Column:
    by_id = F.concat(F.lit("id:"), text.strip(post_id))
    return F.when(text.is_blank(post_id), F.concat(F.lit("c:"), text.sha1_16(content))).otherwise(by_id)


def with_key(df: DataFrame) -> DataFrame:
    pid = F.col("post_id") if "post_id" in df.columns else F.lit(None).cast("string")
    return df.withColumns({"key": enrichment_key(pid, F.col("content")), "content_hash": content_hash(pid, F.col("content"))})


def seen_keys(extracted: DataFrame) -> DataFrame:
    """Distinct keys of posts that already have a result."""
    usable = ~text.is_blank(F.col("post_id")) | (F.coalesce("content", F.lit("")) != "")
    return with_key(extracted.where(usable)).select("key").distinct()


def hot_post_keys(posts: DataFrame) -> DataFrame:
    """Keys of posts with very many versions, counted on the id column alone (keys made of text are unique)."""
    with_id = posts.where(~text.is_blank(F.col("post_id")))
    return hot_keys(with_id.select(F.concat(F.lit("id:"), text.strip(F.col("post_id"))).alias("key")), ["key"])


def text_key(content: Column) -> Column:
    """What stands for a text where only equality counts: its SHA-256, so that texts need not be moved to be compared."""
    return F.sha2(content, 256)


def pending_posts(
    posts: DataFrame, extracted: DataFrame, failures: DataFrame, retry_failed: bool = False
) -> DataFrame:
    """Latest row per text that has neither a result nor, unless retried, a recorded failure.

    Which rows these are is found from keys and hashes of texts alone, and written. Only then do the rows come in, with one shuffle of texts at most: few
    pending rows are broadcast by the size of their table.
    """
    keyed = with_key(drop_blank_content(posts)).withColumn("_text", text_key(F.col("content")))
    latest = keyed.groupBy("_text").agg(F.max(F.struct(SEQ, "key")).alias("_last")).select("_text", "_last.*")
    done = seen_keys(extracted)
    if not retry_failed:
        done = done.unionByName(failures.select("key")).distinct()
    todo = skew_join(latest, done, ["key"], "left_anti", [SEQ], hot=hot_post_keys(posts))
    number = F.coalesce(F.col(SEQ).cast("string"), F.lit(""))  # plain equality, so that the rank below needs no second shuffle
    mine = ["_text", "_number", "key"]
    todo = cut_lineage(todo.withColumn("_number", number).select(*mine), "todo")
    rows = keyed.withColumn("_number", number).join(todo, mine)
    one = W.partitionBy(*mine).orderBy(SEQ)  # rows may be repeated whole
    found = rows.withColumn("_rank", F.row_number().over(one)).where("_rank = 1")
    return found.select(*posts.columns, "key", "content_hash")


def join_llm_response(pending: DataFrame, responses: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Attach the recorded answer; ``response`` stays NULL where there is none.

    Of several answers to one key the latest by ``answer_seq`` counts; a table without that column has one answer per key.
    """
    last = F.max_by("response", "answer_seq") if "answer_seq" in responses.columns else F.max("response")
    answers = responses.groupBy("key").agg(last.alias("response"))
    return skew_join(pending.drop("response"), answers, ["key"], "left", [SEQ], hot=hot)


def with_place(answered: DataFrame) -> DataFrame:
    """Adds ``answer`` and ``place``: the accepted single place, NULL for a failure.

    The generator keeps later filters on ``place`` from being moved below the validation and repeating it.
    """
    judged = answered.withColumn("_answer", validate_answer(F.col("response")))
    both = F.struct(F.col("_answer").alias("answer"), single_place(F.col("_answer")).alias("place"))
    return judged.select(*answered.columns, F.inline(F.array(both)))


def extracted_rows(accepted: DataFrame) -> DataFrame:
    """Output rows of accepted answers; name and address are lists of none or one."""
    lists = {}
    for name in ("hashtags", "comments"):
        if name not in accepted.columns:
            lists[name] = coerce.empty_list()
        elif not dtype_of(accepted, name).startswith("array"):
            lists[name] = coerce.to_list(F.col(name))
        else:
            lists[name] = F.coalesce(F.col(name), coerce.empty_list())
    return (
        accepted.where("place is not null")
        .withColumns(lists)
        .select(
            "content", "likes", "hashtags", "comments", "date", "search_tag", "post_id",
            coerce.wrap(F.col("place.restaurant_name")).alias("restaurant_name"),
            coerce.wrap(F.col("place.address")).alias("address"),
            F.col("answer.is_ad").alias("model_is_ad"),
            F.col("answer.confidence").alias("model_confidence"),
            SEQ,
        )
    )


def merge_extracted(old: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Previous and new results, the latest per text. New rows win over old ones of the same text."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new_rows.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    ranked = both.withColumns({"_order": F.struct("_new", SEQ), "_text": text_key(F.col("content"))})
    return dedupe_keep_last(ranked, ["_text"], "_order").drop("_new", "_order", "_text")


def merge_fail_log(old: DataFrame, answered: DataFrame, now: Column) -> DataFrame:
    """Next failure table.

    Keys that succeeded leave; keys that failed get one more attempt than before and the new time; a key with
    both outcomes in one run stays as failed. All inputs of the final union are unique per key.
    """
    outcome = answered.groupBy("key").agg(
        F.max(F.col("place").isNull()).alias("failed"),
        F.max_by(
            F.struct("post_id", "content_hash", "search_tag"), F.when(F.col("place").isNull(), F.col(SEQ))
        ).alias("last"),
    )
    old = old.select(*EXTRACT_FAILURES.names)
    merged = old.alias("o").join(outcome.alias("n"), "key", "full_outer")
    failed = F.coalesce("n.failed", F.lit(False))
    kept = F.col("n.failed").isNull()

    def pick(old_col: str, new_col: Column) -> Column:
        return F.when(failed, F.coalesce(new_col, F.lit(""))).otherwise(F.col(f"o.{old_col}")).alias(old_col)

    return merged.where(failed | kept).select(
        "key",
        pick("post_id", F.col("n.last.post_id")),
        pick("content_hash", F.col("n.last.content_hash")),
        F.when(failed, F.coalesce("o.attempts", F.lit(0)) + 1).otherwise(F.col("o.attempts")).alias("attempts"),
        F.when(failed, now).otherwise(F.col("o.last_ts")).alias("last_ts"),
        pick("sample_tag", F.col("n.last.search_tag")),
    )


def read_fail_log(raw: DataFrame, seq: str | None = None) -> DataFrame:
    """Failure table from loose input: blank keys dropped, last row per key, missing attempts are 1."""
    typed = raw.where(~text.is_blank(F.col("key"))).select(
        "key",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("post_id", "content_hash")],
        F.coalesce(F.nullif(F.col("attempts").try_cast("int"), F.lit(0)), F.lit(1)).alias("attempts"),
        F.col("last_ts").try_cast("timestamp").alias("last_ts"),
        F.coalesce(F.col("sample_tag").cast("string"), F.lit("")).alias("sample_tag"),
        *([seq] if seq else []),
    )
    latest = dedupe_keep_last(typed, ["key"], seq or "last_ts")
    return latest.drop(seq) if seq else latest
