"""Exact duplicates: groups by 128-bit content hash, confirmed by comparing bytes.

Three steps, none of which brings the rows of a group together:

1. One scan hashes every whole text. Only ids, hashes and sizes are kept.
2. Rows are counted per hash, with the best row of each group by a partial aggregate.
3. The texts of hashes that occur more than once are grouped by hash *and* bytes, again with a
   partial aggregate, so copies meet in the map tasks and one text per group and task moves. The
   scan tells most others by a bitmap of these hashes, of a fixed size whatever the number of rows, so
   they do not move. A hash with two byte strings is a collision; its texts get groups of
   their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SPACES, bitmap, in_bitmap, quoted, small, without, written


def normalised(text: Column) -> Column:
    """The text without white space characters; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[{SPACES}]+", "")


def content_hash(content: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(content.cast("binary")))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of=content_hash,
) -> DataFrame:
    """One row per row of `docs`: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting white space; null counts as empty, so empty and
    blank texts are one group. Of a group the row with the most code points in the original text,
    then the smallest id, stays; a null id comes after all others. `group_size` counts rows.
    Rows repeated with the same id and size as the kept one are that same document and are all
    marked kept. An empty table gives no rows; other columns are left out. `hash_of` maps the
    normalised text to the grouping hash.
    """
    return _marked(docs, id_col, text_col, hash_of).select(
        F.col("doc").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that `exact_duplicates` keeps.

    Of rows repeated with one id and text, one stays. Null and empty texts are one group. An empty
    table gives no rows.
    """
    marked = written(_marked(docs, id_col, text_col, content_hash).select("doc", "content", "kept"), "marked")
    unique = without(docs, marked.filter("not kept").select("doc", "content").distinct(), id_col, text_col)
    repeated = marked.filter("kept").groupBy("doc", "content").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return unique
    repeated = written(repeated.select("doc", "content"), "repeated")
    text = F.xxhash64(quoted(text_col).cast("string"))
    key = F.struct(quoted(id_col).alias("id"), text.alias("text"))
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), key.alias("key"))
    same = F.col("key.id").eqNullSafe(F.col("doc")) & (F.col("key.text") == F.col("content"))
    one = rows.join(repeated, same, "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
    return without(unique, repeated, id_col, text_col).unionByName(one)


def _marked(docs: DataFrame, id_col: str, text_col: str, hash_of) -> DataFrame:
    rows = docs.select(quoted(id_col).alias("doc"), quoted(text_col).cast("string").alias("text"))
    content = normalised(F.col("text"))
    hashed = written(
        rows.select(
            "doc",
            F.xxhash64("text").alias("content"),
            hash_of(content).alias("hash"),
            F.sha2(content.cast("binary"), 256).alias("sha"),
            F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("points"),
        ),
        "hashed",
    )
    best = F.min(F.struct((-F.col("points")).alias("fewer"), F.col("doc").isNull().alias("no_id"), "doc"))
    several = written(
        hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "several"
    )
    texts = rows.select(content.alias("content"), hash_of(content).alias("hash"))
    maybe = texts.filter(in_bitmap(F.col("hash"), bitmap(several)))
    several = small(several)
    candidates = maybe.join(several, "hash", "left_semi")
    # grouping by the content itself compares bytes
    distinct = candidates.groupBy("hash", "content").agg(F.lit(1).alias("one"))
    collided = written(
        distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "collided"
    )
    # texts of one hash with different bytes are told apart by their SHA-256
    if collided.isEmpty():
        marked = hashed.withColumn("part", F.lit(""))
    else:
        part = F.when(F.col("apart").isNotNull(), F.col("sha")).otherwise(F.lit(""))
        apart = small(collided).withColumn("apart", F.lit(True))
        marked = hashed.join(apart, "hash", "left").withColumn("part", part)
    groups = (
        marked.join(several, "hash", "left_semi")
        .groupBy("hash", "part")
        .agg(F.count(F.lit(1)).alias("size"), best.alias("best"))
        .filter("size > 1")
    )
    joined = marked.join(small(written(groups, "groups")), ["hash", "part"], "left")
    alone = F.col("size").isNull()
    keep = F.when(alone, F.col("doc")).otherwise(F.col("best.doc"))
    is_best = F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("points") == -F.col("best.fewer"))
    return joined.select(
        "doc",
        "content",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | is_best).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
