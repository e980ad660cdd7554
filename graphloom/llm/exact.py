"""Exact dedup: two-pass Bloom filtering finds possibly repeated hashes; only those rows shuffle.

Method (DataFrame functions only)

1. The texts are read once into a digest (id, sha256, 64-bit hash) that all later steps use.
2. First pass: each hash sets two slots of a bit table; the slots set twice or more are kept as 4 KB bitmaps
   (``bitmap_construct_agg``). Counting is map-side combined, so a hot slot is one row per task. The bit table has at
   most ``max_bits`` bits, so what is broadcast is at most ``max_bits / 8`` bytes (32 MB by default) at any input size;
   a fuller table lets more rows shuffle and changes no result.
3. Second pass: a row whose two slots are both in the bitmaps is possibly repeated. Only such rows shuffle, by sha256;
   the others are their own group and pass straight through.
4. Groups are pre-aggregated, and rows get their group back by a join that broadcasts the (at most 1,000) hot groups.

Cases: null text equals empty text; equal rows with equal ids share one verdict; null ids sort before all others;
an empty table gives an empty result; text is compared unchanged, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import docs_of, join_groups, stage

BUCKET_BITS = 32768


def _slots(h: F.Column, bits: int) -> list[F.Column]:
    return [F.pmod(h, F.lit(bits)) + 1, F.pmod(F.xxhash64(h), F.lit(bits)) + 1]


def repeated_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap) of the slots that two or more rows of ``hashes`` (column h) set."""
    slots = hashes.select(F.explode(F.array(*_slots(F.col("h"), bits))).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def mark_maybe_repeated(digest: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """``digest`` with boolean ``maybe``: false means that no other row has this hash."""
    tests, out = [], digest
    for i, slot in enumerate(_slots(F.col("h"), bits)):
        out = out.withColumn(f"_s{i}", slot).withColumn(f"_b{i}", F.bitmap_bucket_number(f"_s{i}"))
        out = out.join(F.broadcast(bitmaps.select(F.col("bucket").alias(f"_b{i}"), F.col("bitmap").alias(f"_m{i}"))), f"_b{i}", "left")
        at = F.bitmap_bit_position(f"_s{i}")
        byte = F.conv(F.hex(F.substring(F.col(f"_m{i}"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
    return out.select(*digest.columns, (tests[0] & tests[1]).alias("maybe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the largest id stays."""
    rows = docs_of(docs, id_col, text_col)
    sha = F.sha2(F.col("text"), 256)
    digest = stage(rows.select("doc_id", sha.alias("text_sha256"), F.xxhash64("text").alias("h")), "digest")
    bits = BUCKET_BITS
    while bits < min(max_bits, 16 * digest.count()):
        bits *= 2
    marked = mark_maybe_repeated(digest, stage(repeated_filter(digest, bits), "bloom"), bits)
    alone = marked.filter("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = marked.filter("maybe").select("doc_id", "text_sha256")
    groups = stage(maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    again = join_groups(maybe, groups, "text_sha256", "group_size")
    return alone.unionByName(again.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
