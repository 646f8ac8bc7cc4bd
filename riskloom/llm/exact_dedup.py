"""Exact duplicates, with the most frequent texts taken out before the shuffle."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.texts import fresh, hash_value, parted_by
from riskloom.session import stage

#: Counters of the frequent-items summary. A digest in more than 1/HEAVY_COUNTERS
#: of the rows (about) is sure to be among them.
HEAVY_COUNTERS = 4096
#: Winners that may be broadcast: at most HEAVY_KEPT rows of 80 bytes.
HEAVY_KEPT = 1024


def normalised(text):
    """The text with A-Z in lower case and every other character as it is.

    ``lower`` does the same on pure ASCII and is much faster than ``translate``;
    a text is ASCII when it has as many bytes as characters.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def text_digest(text):
    return F.sha2(normalised(text).cast("binary"), 256)


def heavy_digests(digests: DataFrame, counters: int = HEAVY_COUNTERS, kept: int = HEAVY_KEPT) -> DataFrame:
    """``(text_sha256, heavy, heavy_size)`` of the frequent digests, exactly counted; ``heavy`` is the row that stays.

    A Misra-Gries summary (Spark's frequent-items sketch keeps decrementing
    counters and is merged from the partitions) proposes at most ``kept``
    digests. The proposals are then counted over all rows: the summary's own
    counts are bounds, and only the verified ones are used. A digest that
    occurs once is of no use here and is left out.
    """
    proposed = digests.select(F.expr(f"approx_top_k(text_sha256, {kept}, {counters})").alias("top")) \
        .select(F.explode("top.item").alias("text_sha256"))
    # The largest struct has the largest id; a null id is smaller than any.
    return digests.join(F.broadcast(proposed), "text_sha256", "left_semi").groupBy("text_sha256").agg(
        F.max(F.struct("doc_id", "row")).alias("heavy"), F.count(F.lit(1)).alias("heavy_size")).filter("heavy_size > 1")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. Texts are equal
    when identical after lower-casing A-Z; a null text counts as empty. The
    largest ``doc_id`` stays (null ids are smallest). Of rows repeated with the
    same id and text exactly one has ``kept``; an empty table gives no rows.

    Digests are written once, each with a number of its own that tells repeated rows apart, so every text is
    read and hashed once. All rows of frequent digests are decided in the map task against the broadcast
    winner, however many have one id or none; they never enter the shuffle. The others meet by digest.
    """
    digests = stage(docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("text_sha256"),
                                F.monotonically_increasing_id().alias("row")), "digests")
    heavy = stage(heavy_digests(digests), "heavy")
    marked = digests.join(F.broadcast(heavy), "text_sha256", "left")
    decided = marked.filter("heavy_size IS NOT NULL").select(
        "doc_id", F.col("heavy.doc_id").alias("keep_id"), F.col("heavy_size").alias("group_size"),
        (F.col("row") == F.col("heavy.row")).alias("kept"), "text_sha256")
    group = Window.partitionBy("text_sha256")
    newest = group.orderBy(F.col("doc_id").desc_nulls_last(), F.col("row").desc())
    met = marked.filter("heavy_size IS NULL").select(
        "doc_id", F.max("doc_id").over(group).alias("keep_id"), F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(newest) == 1).alias("kept"), "text_sha256")
    return decided.unionByName(met)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row that repeats an id together with its text is returned once. Only rows whose text may occur more than
    once are moved.
    """
    def row_key(doc_id, digest):
        return F.concat_ws("|", doc_id.cast("string"), digest)

    name, value = fresh("_row_key", docs.columns), fresh("_value", docs.columns)
    copies = exact_duplicates(docs, id_col, text_col).filter("group_size > 1").groupBy(
        row_key(F.col("doc_id"), F.col("text_sha256")).alias(name), hash_value("text_sha256").alias(value)).agg(F.max("kept").alias("kept"))
    copies = stage(copies, "copies")
    digest = text_digest(F.col(text_col))
    doubtful, others = parted_by(docs.withColumn(value, hash_value(digest)), value, copies)
    # The join leaves the rows by key, so dropping repeated ones needs no further shuffle.
    keyed = doubtful.withColumn(name, row_key(F.col(id_col), digest))
    kept = keyed.join(copies.filter("NOT kept").select(name), name, "left_anti").dropDuplicates([name])
    return others.select(*docs.columns).unionByName(kept.select(*docs.columns))
