"""Text clean-up and extraction as column expressions.

Regular expressions spell out the white-space class instead of using ``\\s``: the JVM class misses several
Unicode blanks (no-break space, ideographic space) which posts contain.
"""

from __future__ import annotations

from functools import reduce
from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as a trim set and as the inside of a character class.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SP = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Zero-width characters dropped before matching.
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"

# Characters that NFC and NFKC leave alone and that never combine with a neighbour:
# ASCII, Latin-1 letters, common typographic marks, Hangul syllables, CJK ideographs, pictographs.
# tests/test_functions.py proves this against the Unicode tables.
STABLE = (
    r"\x00-\x7f\xc0-\xff\u2013\u2014\u2018-\u201e\u2022\u2600-\u27bf\uac00-\ud7a3\u4e00-\u9fff"
    r"\x{1F300}-\x{1FAFF}"
)

# Code points with the Emoji property outside the pictograph block (Unicode emoji-data).
EMOJI_BMP = (
    r"\xa9\xae\u203c\u2049\u2122\u2139\u2194-\u2199\u21a9\u21aa\u231a\u231b\u2328\u23cf\u23e9-\u23f3"
    r"\u23f8-\u23fa\u24c2\u25aa\u25ab\u25b6\u25c0\u25fb-\u25fe\u2600-\u2604\u260e\u2611\u2614\u2615\u2618"
    r"\u261d\u2620\u2622\u2623\u2626\u262a\u262e\u262f\u2638-\u263a\u2640\u2642\u2648-\u2653\u265f\u2660"
    r"\u2663\u2665\u2666\u2668\u267b\u267e\u267f\u2692-\u2697\u2699\u269b\u269c\u26a0\u26a1\u26a7\u26aa"
    r"\u26ab\u26b0\u26b1\u26bd\u26be\u26c4\u26c5\u26c8\u26ce\u26cf\u26d1\u26d3\u26d4\u26e9\u26ea"
    r"\u26f0-\u26f5\u26f7-\u26fa\u26fd\u2702\u2705\u2708-\u270d\u270f\u2712\u2714\u2716\u271d\u2721\u2728"
    r"\u2733\u2734\u2744\u2747\u274c\u274e\u2753-\u2755\u2757\u2763\u2764\u2795-\u2797\u27a1\u27b0\u27bf"
    r"\u2934\u2935\u2b05-\u2b07\u2b1b\u2b1c\u2b50\u2b55\u3030\u303d\u3297\u3299"
)
EMOJI_ASTRAL = (
    r"\x{1F004}\x{1F0CF}\x{1F170}\x{1F171}\x{1F17E}\x{1F17F}\x{1F18E}\x{1F191}-\x{1F19A}"
    r"\x{1F1E6}-\x{1F202}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F23A}\x{1F250}\x{1F251}\x{1F300}-\x{1FAFF}"
)

# Few ranges without any of them, nor the keycap mark: most characters of any script.
NO_EMOJI = (
    r"\x00-\xa8\xaa-\xad\xaf-\u203b\u2b56-\u302f\u3031-\u303c\u303e-\u3296\u3298\u329a-\x{1F003}\x{1FB00}-\x{10FFFF}"
)

ROWS_AT_ONCE = 256  # texts that are Python strings at a time


def strip(col: Column, extra: str = "") -> Column:
    """Trim Unicode blanks (and ``extra`` characters) on both sides."""
    return F.btrim(col, F.lit(BLANKS + extra))


def lstrip(col: Column, extra: str = "") -> Column:
    return F.ltrim(col, F.lit(BLANKS + extra))


def rstrip(col: Column) -> Column:
    return F.rtrim(col, F.lit(BLANKS))


def is_blank(col: Column) -> Column:
    return col.isNull() | (strip(col) == "")


def contains_any(lowered: Column, words: list[str]) -> Column:
    """Does a lower-cased text hold any of the words as a substring?

    A chain of byte searches beats one large alternation several times over, since most bytes are dismissed by one
    comparison. Words that hold another listed word add nothing and are left out.
    """
    lows = list(dict.fromkeys(w.lower() for w in words))
    lean = [w for w in lows if not any(o != w and o in w for o in lows)]
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in lean])


def unicode_form(col: Column, form: str) -> Column:
    """Unicode normalisation to a composed form (NFC or NFKC).

    Spark has no such built-in, so an Arrow function does it. Only texts holding a character that could
    change are handed over; all others cross to Python as NULL and keep their own value.
    """

    @F.arrow_udf("string")
    def normalise(texts: pa.Array) -> pa.Array:
        parts = [texts.slice(i, ROWS_AT_ONCE) for i in range(0, len(texts), ROWS_AT_ONCE)]
        done = [pa.array([t if t is None else normalize(form, t) for t in part.to_pylist()], pa.string()) for part in parts]
        return pa.concat_arrays(done) if done else texts

    unsettled = F.when(col.rlike(f"[^{STABLE}]"), col)
    return F.coalesce(normalise(unsettled), col)


def normalize_nfkc(col: Column) -> Column:
    """NULL to empty, NFKC, zero-width characters dropped."""
    return F.translate(F.coalesce(unicode_form(col, "NFKC"), F.lit("")), ZERO_WIDTH, "")


def normalize_nfc(col: Column) -> Column:
    return unicode_form(col, "NFC")


def strip_username(text: Column, username: Column) -> Column:
    """Drop a leading author handle, or else a leading Latin token, with the separators behind it."""
    body = lstrip(F.coalesce(text, F.lit("")))
    named = (F.coalesce(username, F.lit("")) != "") & F.lower(body).startswith(F.lower(username))
    after_name = lstrip(F.substr(body, F.length(username) + 1), ":·•-|")
    after_token = F.regexp_replace(body, rf"^[A-Za-z0-9._]{{2,30}}\b[{SP}:·•\-|]+", "")
    return F.when(named, after_name).otherwise(after_token)


def strip_relative_time(text: Column) -> Column:
    """Drop a trailing age such as ``3시간 전``, ``2w`` or ``5 days``."""
    body = rstrip(F.coalesce(text, F.lit("")))
    # Units of the age suffix. It starts with the first digit of a run; blanks before it fall to the strip.
    age = (
        rf"(?iU)(?<!\d)\d++[{SP}]*+(?:(?:초|분|시간|일|주|개월|년)[{SP}]*전?"
        rf"|[smhdw]"
        rf"|hour|hours|hr|hrs|minute|minutes|min|mins|day|days|week|weeks)$"
    )
    # Most texts end in a character that ends no unit.
    may_end = F.substring(body, -1, 1).rlike("(?iU)[초분간일주월년전smhdwrenyk]")
    return strip(F.when(may_end, F.regexp_replace(body, age, "")).otherwise(body))


def _find_all(col: Column, pattern: str) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.contains(col, F.lit("#")), F.regexp_extract_all(col, F.lit(pattern), F.lit(0))).otherwise(none)


def hashtags_strict(col: Column) -> Column:
    """Tags ending at a blank, another ``#``, a comma or a backslash."""
    return _find_all(F.coalesce(col, F.lit("")), rf"#[^{SP}#,\\]+")


def hashtags_loose(col: Column) -> Column:
    """Tags ending at a blank only: punctuation stays and glued tags are one tag."""
    return _find_all(F.coalesce(col, F.lit("")), rf"#[^{SP}]+")


def fold_tag(tag: Column) -> Column:
    return F.ltrim(F.lower(tag), F.lit("#"))


def fold_tags(tags: Column) -> Column:
    return F.transform(tags, fold_tag)


def remove_emoji(col: Column) -> Column:
    """Drop emoji, including keycaps, joined sequences and their variation marks."""
    one = f"[{EMOJI_BMP}{EMOJI_ASTRAL}]"
    tail = r"[\ufe0f\x{1F3FB}-\x{1F3FF}\x{E0020}-\x{E007F}]*"
    # A joiner goes with the emoji before it when another follows; a repeated group would recurse per member.
    # The look-ahead dismisses most characters, of any script, by a few ranges instead of the whole list; a text without any of them has no emoji.
    pattern = rf"[0-9#*]\ufe0f?\u20e3|(?=[^{NO_EMOJI}]){one}{tail}(?:\u200d(?={one}))?"
    return F.when(col.rlike(f"[^{NO_EMOJI}]"), F.regexp_replace(col, pattern, "")).otherwise(col)


def remove_emoji_list(items: Column) -> Column:
    return F.transform(items, remove_emoji)


def post_id_from_url(url: Column) -> Column:
    """Segment after ``/p/``; NULL when the address has none."""
    return F.nullif(F.regexp_extract(url, r"/p/([^/?#]+)/", 1), F.lit(""))


# Path segments which are pages of the site, not handles.
NOT_HANDLES = ["p", "reel", "explore", "stories"]


def handle_from_href(href: Column) -> Column:
    """Lower-cased last path segment, NULL when it is a page of the site or missing."""
    last = F.lower(F.regexp_extract(href, r"/([^/]+)/$", 1))
    return F.when((last != "") & ~last.isin(NOT_HANDLES), last)


def first_handle(hrefs: Column) -> Column:
    """First usable handle of a list of links, empty when there is none."""
    found = F.filter(F.transform(hrefs, handle_from_href), lambda h: h.isNotNull())
    return F.coalesce(F.get(found, 0), F.lit(""))


def parse_like_count(col: Column) -> Column:
    """``1.2k``, ``3M``, ``2.5천``, ``3만``, ``1,234`` to a number; NULL when there is no digit."""
    number = r"(\d+(?:\.\d+)?)"
    latin = rf"{number}[{SP}]*([kKmM])"
    korean = rf"{number}[{SP}]*(천|만)"
    plain = r"(\d{1,3}(?:,\d{3})+|\d+)"
    scale_latin = F.when(F.lower(F.regexp_extract(col, latin, 2)) == "k", 1000.0).otherwise(1000000.0)
    scale_korean = F.when(F.regexp_extract(col, korean, 2) == "천", 1000.0).otherwise(10000.0)

    def scaled(pattern: str, scale: Column) -> Column:
        return (F.regexp_extract(col, pattern, 1).try_cast("double") * scale).try_cast("bigint")

    return (
        F.when(col.rlike(latin), scaled(latin, scale_latin))
        .when(col.rlike(korean), scaled(korean, scale_korean))
        .when(col.rlike(plain), F.replace(F.regexp_extract(col, plain, 1), F.lit(","), F.lit("")).try_cast("bigint"))
    )


def estimate_likes(comment_count: Column, tag_count: Column, post_id: Column) -> Column:
    """Guess from comments and tags; the jitter of 1..10 comes from the id, so a rerun gives the same."""
    digest = F.substring(F.md5(F.coalesce(post_id, F.lit(""))), 1, 6)
    jitter = F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(10)) + 1
    return comment_count.cast("bigint") * 5 + tag_count.cast("bigint") * 2 + jitter


def extract_road_address(address: Column) -> Column:
    """First Korean road address in the text, else the trimmed text."""
    road = F.regexp_extract(address, rf"[가-힣]+[{SP}][가-힣]+[{SP}][가-힣0-9\-]+(?:로|길)[{SP}]*\d+(?:-\d+)?", 0)
    return F.when(address.isNull(), F.lit("")).when(road != "", road).otherwise(strip(address))


def norm_name(name: Column) -> Column:
    """Lower case without any white space."""
    return F.translate(F.lower(F.coalesce(name, F.lit(""))), BLANKS, "")


def name_contains(query: Column, candidate: Column) -> Column:
    """Is the query a non-empty part of the candidate, ignoring case and blanks?"""
    q, c = norm_name(query), norm_name(candidate)
    return (q != "") & F.contains(c, q)


def sha1_16(col: Column) -> Column:
    return F.substring(F.sha1(F.coalesce(col, F.lit(""))), 1, 16)
