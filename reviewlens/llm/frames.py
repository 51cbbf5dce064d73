"""Spark helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.session import written

#: Rows without an id come after all others.
LAST = (1 << 63) - 1
#: What tells documents apart; rows are grouped and joined on both, so null ids are spread too.
IDENTITY = ["ord", "tag"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str | Column] = ()
) -> DataFrame:
    """Columns doc_id, text, ord and tag, whatever else the input holds; with ``carry``, those columns as
    one struct ``carried``.

    Documents are ordered by (ord, tag): the id, nulls last, then a 64-bit hash of the text. So rows
    that repeat an id have a fixed order too, and rows equal in id and text are one document. Among a
    million different texts of one id, two share a tag with a chance of 3 in 100 million.
    """
    text = F.col(text_col).cast("string")
    key = F.col(id_col).cast("bigint")
    return docs.select(
        key.alias("doc_id"),
        text.alias("text"),
        F.coalesce(key, F.lit(LAST)).alias("ord"),
        F.xxhash64(text).alias("tag"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )


def unsized(df: DataFrame) -> DataFrame:
    """``df`` for a join that broadcasts neither side. Spark takes rows that ``explode`` made to be as large as those
    before it, and so may send a table of many times its threshold through the driver."""
    return df.hint("merge")


#: Bits of the map that ``flagged`` broadcasts, 2 MB as rows, whatever the input.
SLOTS = 1 << 23


def flagged(docs: DataFrame, wanted: DataFrame, on: Sequence[str] = IDENTITY) -> DataFrame:
    """``docs`` with a column ``flagged``, true where (ord, tag), or ``on``, is in ``wanted`` and for perhaps a few more.

    Texts that a later join on IDENTITY has nothing for need not be shuffled for it. The filter is a bit
    map of fixed size over hashes; in a very large corpus it flags all, which costs the shuffle alone.
    """
    slot = F.pmod(F.xxhash64(*on), F.lit(SLOTS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))
    words = wanted.groupBy(F.shiftright(slot, 6).alias("slot_word")).agg(F.bit_or(bit).alias("slot_bits"))
    words = F.broadcast(written(words, "slots"))  # SLOTS / 64 rows at most
    joined = docs.withColumn("slot_word", F.shiftright(slot, 6)).join(words, "slot_word", "left")
    hit = F.coalesce(F.col("slot_bits").bitwiseAND(bit) != 0, F.lit(False))
    return joined.withColumn("flagged", hit).drop("slot_word", "slot_bits")
