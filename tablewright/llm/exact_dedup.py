"""Exact duplicates by recipes of content-defined chunks.

A text, with A-Z lowered, is cut where its own characters say so, so equal passages give equal
chunks wherever they stand. A chunk's identifier is its SHA-256 digest; identifiers are verified
by comparing the bytes of all chunks that share one. The recipe of a text is the list of its
identifiers in order, and texts are equal when their recipes are. So a text is moved once, in
pieces, one copy per task and piece, for the verification; all later steps move identifiers.

Everything is built-in expressions; there is no Python on the executors.

Defined cases: a null text counts as empty and an empty text has the empty recipe, so all of them
are one group. Of rows with the same text and the same doc_id one stays. A null doc_id is smaller
than any other. Extra columns are allowed and passed on by `drop_copies`. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import ascii_lower, documents, keep_rows, staged, text_of

#: A cut falls behind such a window of characters, once a chunk has its least length.
WINDOW = r"(?<=[bcdfgmpvt][ .,!\n][aeiost][^n][aeio][cdlmr])"
LEAST, MOST = 64, 4096


def chunks_of(text: Column, least: int = LEAST, most: int = MOST, window: str = WINDOW) -> Column:
    """The content-defined chunks of a text in order; put together they are the text."""
    pattern = (rf"(?s).{{{least},{most}}}?(?:{window}|\z)|.{{1,{most}}}")
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: row_id, the key, text_sha256, recipe (chunk identifiers in order).

    `row_id` tells rows apart that share a key; it holds for one execution, so stage the table."""
    lowered = docs.select(F.col(f"`{key}`").alias("doc_id"), ascii_lower(text_of(text)).alias("_text"))
    return lowered.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id",
        F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("_text")),
                    lambda c: F.unhex(F.sha2(c.cast("binary"), 256))).alias("recipe"))


def chunk_store(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per chunk identifier: chunk_id, chunk (its text), uses, verified (all chunks under
    this identifier have the same bytes)."""
    pieces = (docs.select(ascii_lower(text_of(text)).alias("_text"))
              .select(F.explode(chunks_of(F.col("_text"))).alias("chunk"))
              .withColumn("chunk_id", F.unhex(F.sha2(F.col("chunk").cast("binary"), 256))))
    return (pieces.groupBy("chunk_id")
            .agg(F.min("chunk").alias("chunk"), F.max("chunk").alias("_last"), F.count("*").alias("uses"))
            .select("chunk_id", "chunk", "uses", (F.col("chunk") == F.col("_last")).alias("verified")))


def equal_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: row_id, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest key stays. A recipe holding an identifier that failed
    its verification is compared by the digests of whole texts besides."""
    made = staged(recipes(docs, text, key), "recipes")
    unverified = staged(chunk_store(docs, text).where(~F.col("verified")).select("chunk_id"), "unverified")
    if not unverified.isEmpty():
        doubtful = (made.select("row_id", F.explode("recipe").alias("chunk_id"))
                    .join(unverified, "chunk_id", "left_semi").select("row_id").distinct()
                    .withColumn("_doubt", F.lit(True)))
        apart = F.array(F.unhex(F.col("text_sha256")))
        made = staged(made.join(doubtful, "row_id", "left").withColumn(
            "recipe", F.when(F.col("_doubt"), F.concat(F.col("recipe"), apart)).otherwise(F.col("recipe"))
        ).drop("_doubt"), "recipes")
    groups = staged(
        made.groupBy("recipe").agg(F.max(F.struct("doc_id", "row_id")).alias("stays"),
                                   F.count("*").alias("group_size")), "groups")
    return made.join(groups, "recipe").select(
        "row_id", "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("stays.row_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, in their columns.

    Where keys are not unique, rows are matched by key and text, and repeated rows are reduced to
    one by their own values."""
    decided = staged(equal_groups(docs, text, key).withColumnRenamed("text_sha256", "digest"), "decided")
    return keep_rows(docs, decided, key, F.sha2(ascii_lower(text_of(text)).cast("binary"), 256))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the row that stays of its equal texts, and the size of the group."""
    return equal_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
OP8_SQL = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
"""
