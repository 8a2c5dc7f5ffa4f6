"""Model answers: prompt text, and validation of recorded responses as VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsieve.functions.text import strip

# The answer contract a prompt has to state; field names are those validate_answer reads.
ANSWER_FIELDS = '{"place_count": 0, "places": [{"restaurant_name": "", "address": ""}], "is_ad": false, "confidence": 0.0}'

PROMPT = (
    "Name the real restaurant in this post, judging by its text alone. Do not build names from hashtags or "
    "handles. For guides and lists answer place_count 0.\n\n[post]\n{content}\n\n"
    "Answer with one JSON object only: " + ANSWER_FIELDS
)


def build_prompt(content: Column, template: str = PROMPT, max_chars: int | None = None) -> Column:
    """Fill the template; ``{content}`` marks where the post goes: whole, unless the caller's model takes only so many characters."""
    before, after = template.split("{content}")
    body = F.coalesce(content, F.lit(""))
    return F.concat(F.lit(before), body if max_chars is None else F.substring(body, 1, max_chars), F.lit(after))


def outer_json(response: Column) -> Column:
    """Text from the first opening to the last closing brace, NULL when there is none."""
    return F.nullif(F.regexp_extract(response, r"(?s)\{.*\}", 0), F.lit(""))


def _text(item: Column, field: str) -> Column:
    return strip(F.coalesce(F.try_variant_get(item, f"$.{field}", "string"), F.lit("")))


def validate_answer(response: Column) -> Column:
    """Struct of place_count, places, is_ad, confidence with every field repaired to a safe value."""
    answer = F.try_parse_json(outer_json(response))
    items = F.coalesce(
        F.try_variant_get(answer, "$.places", "array<variant>"), F.array().cast("array<variant>")
    )
    objects = F.filter(items, lambda p: F.try_variant_get(p, "$", "map<string,variant>").isNotNull())
    places = F.transform(
        objects,
        lambda p: F.struct(
            _text(p, "restaurant_name").alias("restaurant_name"), _text(p, "address").alias("address")
        ),
    )
    confidence = F.coalesce(F.try_variant_get(answer, "$.confidence", "double"), F.lit(0.0))
    return F.struct(
        F.coalesce(F.try_variant_get(answer, "$.place_count", "int"), F.lit(0)).alias("place_count"),
        places.alias("places"),
        F.coalesce(F.try_variant_get(answer, "$.is_ad", "boolean"), F.lit(False)).alias("is_ad"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)).alias("confidence"),
    )


def single_place(answer: Column) -> Column:
    """The one place of an answer that claims exactly one and names it, else NULL."""
    return F.when((answer["place_count"] == 1) & (F.size(answer["places"]) > 0), F.get(answer["places"], 0))
