"""Exact dedup by distributed MSD radix partitioning.

Texts are split by their successive bytes. A round takes the next chunk of
bytes of every text that still shares all earlier bytes with another one, and
splits each group by it. A text leaves when it is alone in its group
(singleton) or when its bytes have ended; texts that end in one group are
equal, byte by byte, so no digest decides equality. Chunks grow by `growth`
per round, so a text of n bytes takes about log(n) rounds.

Groups are counted with a map-side partial aggregate and the counts are joined
back by the chunk, so a group that holds a third of all rows is never gathered
in one task: adaptive execution splits the rows' side of that join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import rows_exist, staged

FIRST_WIDTH = 64
GROWTH = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null stays null."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _head(text: Column, width: int) -> Column:
    """The first `width` bytes of the normalised text, without normalising all of it."""
    return F.substring(ascii_lower(F.substring(text, 1, width)).cast("binary"), 1, width)


def _count_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of two rows and more, each with its size and a number of its own.

    They are written first: a join with a table, unlike one with an aggregate on
    the same key, lets adaptive execution split the rows of a large group. The
    join is by merge at every size, since groups grow with the rows.
    """
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return staged(groups.withColumn("next_group", F.monotonically_increasing_id()), "radix-groups").hint("merge")


def radix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    first_width: int = FIRST_WIDTH, growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, and `carry` columns as struct `row`.

    Texts are equal when identical after lower-casing A-Z only; of equal texts
    the row with the largest id stays. A null text counts as empty, so nulls
    and empty texts are one group. Null ids rank lowest; in a group without any
    id `keep_id` is null. Of rows equal in id and text exactly one is kept. An
    empty table gives an empty result; other columns, whatever their names, are
    read only when listed in `carry`.
    """
    others = [F.col(c) for c in carry or [] if c != text_col] or [F.lit(0).alias("none")]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct(*others).alias("row"))
    rest = ["text", "row"] if carry else []
    wanted = F.lit(bool(carry))
    normal = ascii_lower(F.coalesce("text", F.lit("")))
    width, depth = first_width, 0
    keyed = rows.withColumn("chunk", _head(F.coalesce("text", F.lit("")), width))
    keyed = keyed.withColumn("text_sha256", F.sha2(normal, 256))
    groups = _count_groups(keyed.select("chunk"), ["chunk"])
    left = [_alone(keyed.join(groups, "chunk", "left"), rest)]
    shared = keyed.join(groups, "chunk").select(
        "doc_id", F.monotonically_increasing_id().alias("tag"), "text_sha256", "text", "row", *_fate(width)
    )
    ended = []
    while True:
        shared = staged(shared, "radix-rows")
        left.append(_alone(shared, rest))
        ended.append(shared.where("size is not null and not live").withColumn("round", F.lit(len(ended))))
        live = shared.where("live")
        if not rows_exist(live):
            break
        depth, width = depth + width, width * growth
        chunk = F.substring(normal.cast("binary"), depth + 1, width).alias("chunk")
        groups = _count_groups(live.select("group_no", chunk), ["group_no", "chunk"])
        found = live.drop("size", "live").withColumn("chunk", chunk).join(groups, ["group_no", "chunk"], "left")
        shared = found.select(
            "doc_id", "tag", "text_sha256", F.when(wanted | _goes_on(width), F.col("text")).alias("text"), "row", *_fate(width)
        )
    result = reduce(DataFrame.unionByName, [*left, _copies(reduce(DataFrame.unionByName, ended), rest)])
    if not carry:
        return result
    whole = F.struct(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in carry])
    return result.withColumn("row", whole).drop("text")


def _alone(rows: DataFrame, rest: list[str]) -> DataFrame:
    """Rows without an equal stay."""
    size = F.lit(1).cast("long").alias("group_size")
    return rows.where("size is null").select("doc_id", F.col("doc_id").alias("keep_id"), size, F.lit(True).alias("kept"), "text_sha256", *rest)


def _goes_on(width: int) -> Column:
    """Whether a row shares this chunk with another row and its bytes may go on after it."""
    return F.col("size").isNotNull() & (F.octet_length("chunk") == width)


def _fate(width: int) -> list[Column]:
    return [F.col("next_group").alias("group_no"), F.col("size"), _goes_on(width).alias("live")]


def _copies(ended: DataFrame, rest: list[str]) -> DataFrame:
    """Of each ended group the row with the largest (id, tag) stays."""
    key = ["round", "group_no"]
    best = staged(ended.groupBy(*key).agg(F.max(F.struct("doc_id", "tag")).alias("best")), "radix-kept").hint("merge")
    return ended.join(best, key).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("tag") == F.col("best.tag")).alias("kept"), "text_sha256", *rest,
    )
