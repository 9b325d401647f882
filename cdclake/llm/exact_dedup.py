"""Exact duplicates by skew-safe combining.

Documents are equal when their texts are identical without ASCII white space.
The winner of a group is found in three steps, and each compares whole contents,
not only digests:

1. every map task reduces its own rows to one row per digest, salt and content;
2. salted groups are merged, so a group of any size is spread over many tasks;
3. the few salt winners of a group are merged into the group's winner.

Steps 1 and 2 are one hash aggregation whose keys include the salt, step 3 is the
next.  Only then are the documents, without their texts, joined to the winners by
digest.  Where two contents share a digest, their documents are joined by content.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.session import materialized

#: What is deleted from a text before it is compared.
WHITE_SPACE = " \t\n\x0b\x0c\r"

#: More than any distance of two 64-bit ids; a rank is ``code points * _STEP + _TOP - id``.
_STEP = Decimal(2 * 10**19)
_TOP = Decimal(2**63)


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the one with the most code points stays, then the smallest id.
    A null text is an empty one; all empty texts are one group.  A null id loses
    every tie, and rows without an id that win share the verdict.  An id names one
    document: rows that repeat an id and its text get the same verdict and each
    counts in ``group_size``.  Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rank = F.length(text).cast("decimal(10,0)") * F.lit(_STEP) + F.coalesce(
        F.lit(_TOP) - F.col(id_col).cast("decimal(20,0)"), F.lit(Decimal(0))
    )
    content = F.translate(text, WHITE_SPACE, "")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        content.alias("content"),
        digest(content).alias("digest"),
        sha256(content).alias("text_sha256"),
        rank.cast("decimal(38,0)").alias("rank"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("salt"),
    )

    winners = _merge(rows)
    classes = winners.groupBy("digest").agg(
        F.max("rank").alias("rank"), F.sum("n").alias("n"), F.count("*").alias("contents")
    )
    classes = materialized(classes, "exact-groups")
    narrow = rows.select("doc_id", "digest", "text_sha256")
    plain = classes.filter("contents = 1").drop("contents")
    result = _verdict(narrow.join(plain, "digest"))

    shared = classes.filter("contents > 1").select("digest")
    if shared.isEmpty():
        return result
    clashing = rows.join(shared, "digest")
    by_content = materialized(_merge(clashing), "exact-clashes")
    return result.unionByName(_verdict(clashing.drop("rank").join(by_content, ["digest", "content"])))


def _merge(rows: DataFrame) -> DataFrame:
    """The winner's rank and the number of rows of every content."""
    salted = rows.groupBy("digest", "salt", "content").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
    return salted.groupBy("digest", "content").agg(F.max("rank").alias("rank"), F.sum("n").alias("n"))


def _verdict(joined: DataFrame) -> DataFrame:
    below = F.col("rank") % F.lit(_STEP)
    keep_id = F.when(below > 0, (F.lit(_TOP) - below).cast("long"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
