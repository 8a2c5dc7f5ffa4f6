"""Table schemas and the step that brings loose input to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _A = T.StringType(), T.LongType(), T.ArrayType(T.StringType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


POSTS_CSV = _schema(
    ("post_id", _S), ("content", _S), ("likes", _S), ("hashtags", _S), ("comments", _S), ("date", _S),
    ("search_tag", _S),
)
POSTS_RAW = _schema(
    ("post_id", _S), ("content", _S), ("likes", _S), ("hashtags", _A), ("comments", _A), ("date", _S),
    ("search_tag", _S), ("ingest_seq", _L),
)
EXTRACTED = T.StructType(POSTS_RAW.fields + _schema(("restaurant_name", _A), ("address", _A)).fields)
EXTRACT_FAILURES = _schema(
    ("key", _S), ("post_id", _S), ("content_hash", _S), ("attempts", T.IntegerType()),
    ("last_ts", T.TimestampType()), ("sample_tag", _S),
)
LLM_RESPONSE = _schema(("key", _S), ("response", _S))
GAZETTEER_ADDRESS = _schema(("road_address", _S), ("lat", T.DoubleType()), ("lng", T.DoubleType()), ("region", _S))
GAZETTEER_PLACE = _schema(
    ("place_name", _S), ("category_group_code", _S), ("road_address_name", _S), ("address_name", _S),
    ("lat", T.DoubleType()), ("lng", T.DoubleType()), ("rank", T.IntegerType()),
)

# Names a text column may have, in order of preference.
CONTENT_NAMES = ["content", "본문", "text", "caption"]
ALIASES = {"restaurant name": "restaurant_name"}


def pick_content_col(df: DataFrame) -> str:
    """Name of the text column: first known name present, else the first column."""
    return next((name for name in CONTENT_NAMES if name in df.columns), df.columns[0])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Refuse a frame that lacks a column, while planning."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; present: {df.columns[:20]}")
    return df


def conform(df: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """Rename aliases, add an empty address where none exists, check required columns."""
    renames = {old: new for old, new in ALIASES.items() if old in df.columns and new not in df.columns}
    out = df.withColumnsRenamed(renames)
    if "address" not in out.columns:
        out = out.withColumn("address", F.lit(""))
    return require(out, *required)


def dtype_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
