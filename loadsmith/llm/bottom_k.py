"""Document fingerprints: bottom-k sketches of word-shingle hashes.

DataFrame and SQL functions only; no Python runs on the executors.  A sketch is the
sorted array of the ``k`` least distinct shingle hashes of a text (48 bits of an
MD5, as 12 hexadecimal digits, so that text order is number order).  Sketches of
parts merge into the sketch of the whole, whatever the parts: the ``k`` least of
their union.  From two sketches follow estimates of resemblance and containment,
from one that of the number of distinct shingles; with fewer than ``k`` shingles
all three are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.llm.common import text_key

#: Hashes of a sketch: the standard error of a resemblance is at most 1 / (2 sqrt(K)), 0.044.
K = 128
#: Words of a shingle; a text with fewer words is one shingle of its own length.
SHINGLE = 5
DIGITS = 12
#: Rows of a stretch of the document order that one task reads at a time, and the most stretches.
STRETCH_ROWS, STRETCHES = 2000, 128 * 128
_SPACE = " \t\n\x0b\x0c\r"


def spaced_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; an empty array for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]+"))


def sketch_of_words(words: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The sketch of a word array: empty without words."""
    def hashed(at: Column) -> Column:
        return F.substring(F.md5(F.array_join(F.slice(words, at, F.lit(shingle)), " ")), 1, DIGITS)

    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (shingle - 1), F.lit(1)))
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
        least(F.array_distinct(F.transform(starts, hashed)), k))


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return least(F.array_union(a, b), k)


def resemblance(a: Column, b: Column, together: Column) -> Column:
    """Estimated intersection over union of two shingle sets, from their sketches and ``merged(a, b)``.

    Two empty sets resemble each other fully, an empty and another one not at all.
    """
    both = F.size(F.array_intersect(F.array_intersect(together, a), b))
    return F.when(F.size(together) == 0, F.lit(1.0)).otherwise(both / F.size(together))


def containment(a: Column, b: Column, together: Column) -> Column:
    """Estimated share of the first set that the second holds; 1 for an empty first set."""
    own = F.array_intersect(together, a)
    return F.when(F.size(a) == 0, F.lit(1.0)).when(F.size(own) == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(own, b)) / F.size(own))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    place = (F.conv(F.element_at(sketch, -1), 16, 10).cast("double") + 1) / float(16 ** DIGITS)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / place)


def sketch_texts(docs: DataFrame, text: str = "text", name: str = "sketch", k: int = K,
                 shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the sketch of each whole text as column ``name`` (replaced if it is there).

    Null, empty and wordless texts have an empty sketch; equal texts equal ones.
    All other columns stay; an empty table gives an empty result.
    """
    # The lambda binds the word array, which would else be split anew for each shingle.
    words = F.array(spaced_words(F.col(f"`{text}`")))
    return docs.withColumn(name, F.transform(words, lambda w: sketch_of_words(w, k, shingle))[0])


def merge_sketches(sketches: DataFrame, by: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of rows: columns ``by`` and ``sketch``.

    Every task keeps the ``k`` least of each group before rows move, so a group of any
    size is small after its first stage.  Null group values form a group; groups whose
    sketches are all empty or null get an empty one.
    """
    names = [f"g{i}" for i in range(len(by))]
    keyed = sketches.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(by, names)), F.col(f"`{sketch}`").alias("s"))
    hashes = keyed.select(*names, F.explode_outer("s").alias("h")).distinct()
    first = hashes.withColumn("r", F.row_number().over(Window.partitionBy(*names).orderBy(F.asc_nulls_last("h"))))
    whole = first.where(F.col("r") <= k).groupBy(*names).agg(F.sort_array(F.collect_list("h")).alias("s"))
    return whole.select(*(F.col(n).alias(c) for c, n in zip(by, names)), F.col("s").alias(sketch))


def stretch_bounds(docs: DataFrame) -> list[int]:
    """First ids of stretches of about ``STRETCH_ROWS`` rows in doc_id order: ids of the table, ascending.

    They only deal the rows to tasks: no result depends on them.
    """
    n = docs.count()
    parts = min(max(n // STRETCH_ROWS, 1), STRETCHES)
    least_id, cuts = docs.agg(
        F.min("doc_id"), F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.0],
                                             max(10_000, 10 * parts))).first()
    return [] if least_id is None else sorted({least_id, *cuts})


def beside_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch: each document with the one that follows it.

    The order is that of doc_id (rows that share an id: of a hash of the text); the
    first follows the last, and a single document itself.  Rows without doc_id have no
    place in it: nothing follows them (null) and they follow nothing.  The table is dealt to
    stretches of the order, each stretch's first rows also to the end of the one
    before, so every row moves once and no task sees more than a stretch.
    """
    bounds = stretch_bounds(docs)
    k1, k2 = text_key()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), k1, k2)
    stray = F.struct((-1 - F.pmod(F.col("k1"), F.lit(1024))).cast("int").alias("at"), F.lit(0).alias("turn"),
                     F.lit(False).alias("guest"))
    places = F.array(stray)
    if bounds:
        own, opens = _stretch_of(F.col("doc_id"), bounds)
        last = len(bounds) - 1
        here = F.struct(own.alias("at"), F.lit(0).alias("turn"), F.lit(False).alias("guest"))
        before = F.when(F.col("doc_id") == bounds[0], F.struct(
            F.lit(last).alias("at"), F.lit(1).alias("turn"), F.lit(True).alias("guest"))).otherwise(F.struct(
                (own - 1).alias("at"), F.lit(0).alias("turn"), F.lit(True).alias("guest")))
        places = F.when(F.col("doc_id").isNull(), places).when(opens, F.array(here, before)).otherwise(F.array(here))
    dealt = rows.withColumn("place", F.explode(places)).select(
        "doc_id", "text", "k1", "k2", "place.at", "place.turn", "place.guest").repartition("at")
    follow = Window.partitionBy("at").orderBy("turn", "doc_id", "k1", "k2")
    paired = sketch_texts(dealt).select(
        "doc_id", "text", "sketch", "guest",
        F.lead("text").over(follow).alias("next_text"), F.lead("sketch").over(follow).alias("next_sketch"))
    alone = F.col("doc_id").isNull()
    return paired.where(~F.col("guest")).select(
        "doc_id", "text", "sketch", F.when(~alone, F.col("next_text")).alias("next_text"),
        F.when(~alone, F.col("next_sketch")).alias("next_sketch"))


def _stretch_of(doc_id: Column, bounds: list[int]) -> tuple[Column, Column]:
    """Number of the stretch that holds an id, and whether the id is the stretch's first one."""
    width = 128
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]

    def literal(values, kind: str) -> Column:
        return F.from_json(F.lit(str(values)), kind)

    coarse = F.size(F.filter(literal([g[0] for g in groups], "array<bigint>"), lambda b: b <= doc_id))
    group = F.element_at(literal(groups, "array<array<bigint>>"), F.greatest(coarse, F.lit(1)))
    fine = F.size(F.filter(group, lambda b: b <= doc_id))
    own = (F.greatest(coarse, F.lit(1)) - 1) * width + F.greatest(fine, F.lit(1)) - 1
    return own.cast("int"), F.array_contains(group, doc_id)


def fingerprint_edits(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_chars, edited, sketch, edited_sketch, next_sketch, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) characters replaced by as
    many first ones (or all) of the next document; ``near_*`` are estimated
    resemblances.  Null texts count as empty.  A row without doc_id has no next
    document: its edited text is its first half and its ``near_next`` that to an
    empty text.  Repeated rows are rows of their own, each followed by the next; other
    columns are not carried; an empty table gives an empty result.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    none = F.array().cast("array<string>")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    texts = beside_next(docs).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "sketch",
        F.coalesce("next_sketch", none).alias("next_sketch"))
    both = sketch_texts(texts, "edited", "edited_sketch", k, shingle)
    both = both.select("*", merged(F.col("sketch"), F.col("edited_sketch"), k).alias("with_edited"),
                       merged(F.col("sketch"), F.col("next_sketch"), k).alias("with_next"))
    return both.select(
        "doc_id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), F.col("with_edited")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), F.col("with_next")).alias("near_next"))
