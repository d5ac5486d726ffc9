"""Exact duplicates: 128-bit content hash, smallest id stays, bytes compared inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import join_groups, staged


#: Hashes of groups that are broadcast at most: 16 bytes each.
BROADCAST_GROUPS = 500_000


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _annotated(docs: DataFrame, content_hash: Callable[[Column], Column]) -> DataFrame:
    """Each row of docs as the struct __row, with keep_id, group_size, text_sha256. What isn't used is pruned before the shuffle."""
    rows = docs.select(F.struct("*").alias("__row"), "doc_id", normalised(F.col("text")).alias("__norm"))
    rows = rows.withColumns({"__hash": content_hash(F.col("__norm")), "text_sha256": F.sha2(F.col("__norm"), 256)})
    same = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    groups = staged(rows.select("doc_id", "__hash").groupBy("__hash").agg(*same), "exact-groups")
    total, many = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0)), F.count_if(F.col("group_size") > 1)).first()
    repeated = groups.filter("group_size > 1").select("__hash")
    texts = rows.select("doc_id", "__hash", "__norm")
    if many <= BROADCAST_GROUPS:
        texts = texts.join(F.broadcast(repeated), "__hash", "left_semi")
    by_bytes = texts.groupBy("__hash", "__norm").agg(*same)
    collided = staged(by_bytes.groupBy("__hash").count().filter("count > 1").select("__hash"), "collisions")
    found = join_groups(rows.drop("__norm"), groups, "__hash", "group_size", total, F.coalesce(F.col("doc_id").cast("string"), F.monotonically_increasing_id().cast("string")))
    keep = ["__row", "doc_id", "keep_id", "group_size", "text_sha256"]
    if collided.limit(1).count():
        apart = rows.join(collided, "__hash", "left_semi")
        own = apart.select("doc_id", "__hash", "__norm").groupBy("__hash", "__norm").agg(*same)
        found = found.join(collided, "__hash", "left_anti").select(keep).unionByName(apart.join(own, ["__hash", "__norm"]).select(keep))
    return found.select(keep)


def duplicate_groups(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by their hash. Inside groups of more than one row the bytes are compared by grouping on (hash,
    bytes), whose map-side combine leaves one row for each text and map task before the shuffle, however many
    copies there are; texts that no other has the hash of don't move. (Beyond BROADCAST_GROUPS groups of copies, too
    many to tell every task which they are, all texts are grouped so.) Rows then find their group by the hash
    alone; only rows whose hash is shared by different texts are matched by hash and bytes.

    Null text is an empty text. The smallest non-null doc_id of a group stays; a null doc_id stays only if
    the group has no other. Rows that repeat both doc_id and text are one document: all carry the same
    decision. Columns besides doc_id and text are not read. An empty table gives an empty result.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return _annotated(docs, content_hash).select("doc_id", "keep_id", "group_size", kept, "text_sha256")


def drop_exact_duplicates(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """docs, with all its columns: of the rows of a text one with the smallest doc_id stays (see duplicate_groups), also of rows that repeat it."""
    kept = _annotated(docs, content_hash).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    again = docs.groupBy("doc_id").count().filter("count > 1")
    if again.limit(1).count():
        kept = kept.dropDuplicates(["doc_id", "text_sha256"])
    return kept.select("__row.*")
