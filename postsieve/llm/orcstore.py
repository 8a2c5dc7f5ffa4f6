"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids, global document order."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.llm.common import Memo, map_batches, texts_of


# Fixed value: the pieces of the word vocabulary, for lower-case text of code points below U+0100.
_LETTER, _NUMBER, _BLANK = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")


class PieceIds(Memo):
    """Ids of texts from the tokenizers library, which sees every distinct piece once while it is remembered.

    Exact for vocabularies that drop white space: no token reaches over it, and ASCII white space stops every normalization. In
    texts of Latin-1 normalization is lower-casing alone, so these are cut as the tokenizer cuts them; others at white space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.special = [t.content for t in model.get_added_tokens_decoder().values()]
        encode = model.encode
        self.packed = lambda text: np.array(encode(text, add_special_tokens=False).ids, dtype="<i4").tobytes()
        super().__init__(self.packed, most=800_000)

    def pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [w.decode() for w in text.encode().split()]
        return LATIN_PIECE.findall(text.lower())

    def ids(self, text: str) -> bytes:
        if any(t in text for t in self.special):
            return self.packed(text)
        return b"".join(map(self.__getitem__, self.pieces(text)))


@lru_cache(maxsize=4)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def tokenize(docs: DataFrame, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of (doc_id, n_tokens, ids), each with the end id; a null text is empty, so it has the end id alone."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, end = piece_ids(path).ids, np.array([end_id], dtype="<i4").tobytes()
        found = [ids(t) + end for t in texts_of(batch.column(1))]
        sizes = np.array([len(b) // 4 for b in found], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), dtype="<i4")))
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0).cast(pa.int64()), "n_tokens": pa.array(sizes), "ids": ids})

    return map_batches(docs.select(key, text), run, "doc_id bigint, n_tokens bigint, ids array<int>")


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in ranges of ids, sorted inside each; a hash of the text orders and spreads repeated and null ids."""
    tie = F.xxhash64(text)
    return docs.select(key, text).repartitionByRange(key, tie).sortWithinPartitions(key, tie)


def write_tokens(tokens: DataFrame, path: str, stripe_mb: int = 64, rows_per_index: int = 1000) -> None:
    """Write tokens that are ``in_order``: files cover ranges of ids in the order of their names, rows are sorted inside them.

    Stripes are read in parallel; the row index and the Bloom filter let a reader skip row groups by document id. Rows without
    an id come first; repeated ids follow each other in the order of their content, and may share several files.
    """
    (
        tokens.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
        .option("orc.create.index", "true").option("orc.row.index.stride", rows_per_index)
        .option("orc.stripe.size", stripe_mb << 20).option("orc.compress", "zstd").orc(path)
    )


def read_documents(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of a token table; a list of ids is pushed down to the row indexes and Bloom filters."""
    stored = spark.read.schema("doc_id bigint, n_tokens bigint, ids array<int>").orc(path)
    return stored if doc_ids is None else stored.where(F.col("doc_id").isin(doc_ids))


def check_sums(tokens: DataFrame) -> DataFrame:
    """Rows of (file, doc_id, n_tokens, ids_crc32) from the stored ids."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(2)
        flat = np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False), dtype="<u4")
        ends = np.cumsum(np.array(ids.value_lengths().fill_null(0)))
        sums, counts, start = [], [], 0
        for end in ends.tolist():
            sums.append(zlib.crc32(flat[start:end]))
            counts.append(end - start)
            start = end
        return pa.RecordBatch.from_pydict({
            "file": batch.column(0), "doc_id": batch.column(1), "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
        })

    named = tokens.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "doc_id", "ids")
    return map_batches(named, run, "file string, doc_id bigint, n_tokens bigint, ids_crc32 bigint")


def document_starts(spark: SparkSession, path: str) -> DataFrame:
    """Per document what the files hold: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Files follow each other by part number (longer names beyond 99,999 parts). File totals come from the short ``n_tokens`` column; only they, one row per file, are summed in one place. Running sums go
    over the narrow rows of one file each.
    """
    stored = read_documents(spark, path)
    files = stored.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")).agg(F.sum("n_tokens").alias("ids_in_file"))
    earlier = W.orderBy(F.length("file"), "file").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("ids_in_file").over(earlier), F.lit(0)).alias("file_start"))
    before = W.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    rows = check_sums(stored).withColumn("inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return rows.join(starts, "file").select("doc_id", (F.col("file_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
