"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.llm.common import number_rows


def interleaved_shards(docs: DataFrame, n_shards: int = 24, seed: int = 11, by: str = "source") -> DataFrame:
    """Deal rows into ``n_shards`` shards that all have the table's mixture of ``by``.

    Rows are shuffled by a seeded MD5 (64 bits) within each source and ranked there; a
    row's place is its fractional rank (rank + phase) / rows of its source, with
    a phase in [0, 1) from the source's MD5 (20 bits) so that rare sources don't all meet
    in the middle.  The rows in that order are cut into equal runs: shard counts
    differ by one at most, and each source's share of a shard by about one row.

    Both rankings are range-partitioned sorts of narrow rows (no text), so a
    source with a third of all rows is spread over many tasks.

    Returns doc_id, size (UTF-8 bytes of the text, null: 0, plus 8), text_crc32,
    law ('rows'), shard, slot (gapless from 0 in each shard) and grown_shard
    (null: counts, not keys, decide).  A null source is a source of its own; null
    ids and texts are rows like others; repeated rows each get a place.  An empty
    table gives an empty result.  Other columns are not carried.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("stratum"),
        F.left(F.md5(F.concat_ws(" ", F.lit(seed), F.col("doc_id"), text).cast("binary")), F.lit(16)).alias("shuffled"))
    ranked, total = number_rows(rows, ["stratum", "shuffled", "doc_id"], "at")
    strata = ranked.groupBy("stratum").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    drawn = F.left(F.md5(F.concat_ws(" ", F.lit(seed), F.col("stratum")).cast("binary")), F.lit(5))
    phase = F.conv(drawn, 16, 10).cast("double") / F.lit(float(1 << 20))
    placed = ranked.join(strata, "stratum").withColumn(
        "fraction", (F.col("at") - F.col("first") + phase) / F.col("n"))
    cut, total = number_rows(placed.drop("at", "first", "n", "stratum"), ["fraction", "shuffled", "doc_id"], "place")
    n = max(total, 1)
    start = F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")
    return (cut.withColumn("shard", F.expr(f"cast(place * {n_shards}L div {n}L as int)"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("place") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
