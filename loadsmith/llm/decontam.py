"""Benchmark decontamination: a broadcast hash set of benchmark word windows.

DataFrame and SQL functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsmith.llm.common import text_key

#: Words of a window; an item with fewer words is one window of its own length.
WINDOW = 10
#: Windows up to which the set is broadcast (about 200 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 500_000
#: What parts words, each character by itself: Java looks such a class up in one table, but tries ranges one by one.
_GAPS = "".join(f"\\x{c:02X}" for c in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)))
_WORD = f"[^{_GAPS}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; an empty array for null.

    lower() equals the A-Z mapping on texts of ASCII only and is much faster there.
    """
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: win (the words), anchor (its longest word), off (the anchor's place), items."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    w = w.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    wins = (w.select("item", "w", F.explode(starts).alias("s"))
            .select("item", F.slice("w", F.col("s"), F.lit(window)).alias("win"))
            .groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items")))
    longest = F.reduce(F.transform("win", lambda x: F.length(x)), F.lit(0), lambda a, x: F.greatest(a, x))
    off = F.array_position(F.transform("win", lambda x: F.length(x)), longest).cast("int") - 1
    return (wins.withColumn("off", off)
            .select("win", "items", "off", F.expr("win[off]").alias("anchor")))


def window_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every occurrence of a benchmark window: k1, k2 (the text), start, n (words), items.

    A document word equal to some window's anchor (the window's longest word, so a
    rare one) is looked up in the broadcast set; the window around it is then
    compared word by word, so a hit is exact.
    """
    wins = benchmark_windows(benchmark, window)
    anchors = wins.groupBy("anchor").agg(
        F.collect_list(F.struct("off", "win", "items")).alias("candidates"))
    if wins.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        anchors = F.broadcast(anchors)
    placed = (docs.select(*text_key(), words(F.col("text")).alias("w"))
              .select("k1", "k2", "w", F.posexplode("w").alias("pos", "word")))
    near = placed.join(anchors, F.col("word") == F.col("anchor"))
    tried = (near.select("k1", "k2", "w", "pos", F.explode("candidates").alias("c"))
             .withColumn("start", F.col("pos") - F.col("c.off")).where("start >= 0"))
    return (tried.where(F.expr("slice(w, start + 1, size(c.win)) = c.win"))
            .select("k1", "k2", "start", F.size("c.win").alias("n"), F.col("c.items").alias("items")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per distinct text with hits: k1, k2, hit (places of hit words), items (sorted ids)."""
    spans = (window_hits(docs, benchmark, window).groupBy("k1", "k2")
             .agg(F.collect_set(F.struct("start", "n")).alias("spans"),
                  F.flatten(F.collect_set("items")).alias("items")))
    hit = F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.n - 1))))")
    return spans.select("k1", "k2", hit.alias("hit"), F.sort_array(F.array_distinct("items")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or wordless text has no words, hits or items (items_sha256 is that of
    the empty string), nor has any document if the benchmark is empty or
    wordless.  Windows of an item without id hit words but are listed nowhere.  Repeated rows are judged alike and each returned; null ids are
    kept.  Texts and spans are compared exactly, equal texts share one verdict
    (two 64-bit hashes name a text).  Other columns are not carried.
    """
    found = contamination(docs, benchmark, window).select(
        "k1", "k2", F.size("hit").cast("long").alias("_hit"), F.col("items").alias("_items"))
    rows = docs.select("doc_id", *text_key(), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(found, ["k1", "k2"], "left")
    n_hit = F.coalesce(F.col("_hit"), F.lit(0).cast("long"))
    items = F.coalesce(F.col("_items"), F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages; the columns stay as they are.

    Hit words are cut out, each with what separates it from the next word, and the
    rest of the text stays as it is; a document that loses at least ``share`` of its words is
    dropped.  Documents without hits, null and empty texts among them, are returned unchanged, all
    documents if the benchmark is empty.  Repeated rows are each judged; columns of any name are
    kept; an empty table gives an empty result.
    """
    columns = docs.columns
    names = [f"d{i}" for i in range(len(columns))]
    text = names[columns.index("text")]
    found = contamination(docs, benchmark, window).select("k1", "k2", "hit")
    tagged = docs.select(*text_key(), *(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names))).join(
        F.broadcast(found) if found.limit(100_001).count() <= 100_000 else found, ["k1", "k2"], "left")
    # A word with what follows it, in the text as it is (A-Z are letters there).
    gap = r"\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"
    pieces = F.expr(f"regexp_extract_all({text}, '[^{gap}]+[{gap}]*', 0)")
    lead = F.expr(f"regexp_extract({text}, '^[{gap}]*', 0)")
    kept = F.expr("filter(transform(pieces, (p, i) -> if(array_contains(hit, i), null, p)), p -> p is not null)")
    cut = (tagged.withColumn("pieces", F.when(F.col("hit").isNotNull(), pieces))
           .withColumn("rest", F.concat(lead, F.array_join(kept, "")))
           .where(F.col("hit").isNull() | (F.size("hit") < F.lit(share) * F.size("pieces"))))
    return cut.select(*(F.when(F.col("hit").isNull(), F.col(n)).otherwise(F.col("rest")).alias(c)
                        if n == text else F.col(n).alias(c) for n, c in zip(names, columns)))
