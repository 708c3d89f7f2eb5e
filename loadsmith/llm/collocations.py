"""Phrase collocations by marginalising the longest windows.

Every word opens one window: itself and the words that lead it on, up to ``longest``,
inside its piece; a shorter window is padded.  Only these longest windows are counted.
Spark's ROLLUP over the window's columns sums them to all shorter prefixes at once: the
number of occurrences of each phrase of one word to ``longest``, and of all words of a
language, without a separate n-gram explosion per length.

Most windows are rare and can't matter: a phrase that occurs often holds no rare shorter one.
So a window ends before the first word that makes it a rare phrase.  Hashes of the phrases
of two, three, ... words are counted first, one length after the other (combined per task), and only of
phrases whose two parts of one word less are frequent; the frequent ones set bits of a bitmap of fixed
size.  A false bit only keeps a window longer than it needed to be; counts of phrases
that reach the least count stay exact at every size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.llm.common import bound_batches, mixed, tidy
from loadsmith.session import materialize

#: Bits of the bitmap of frequent phrases (16 MB), and bytes of texts that a task counts before it gives out the counts.
BITS, CHUNK_BYTES = 1 << 27, 6 << 20
#: Phrases are counted by the upper 40 bits of their hashes: fewer bytes to shuffle than 64 bits.
KEPT_FROM = np.uint64(24)
#: Shares of a language's phrases that are ranked apart first.
SHARES = 64
_ENDS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(46 if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def spaced_pieces(text: bytes) -> bytes:
    """A text with A-Z lower-cased, one kind of space between words and ``.`` as a word after each piece."""
    return text.translate(_LOWER).replace(b".", b" . ") + b" ."


class _Chunk:
    """The words of many documents as numbers: code (place of the word in spelled), end (that of ``.``), lang
    (place in langs)."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        words = pc.split_pattern(pa.array(texts, pa.binary()), " ")
        encoded = words.values.dictionary_encode()
        self.spelled = encoded.dictionary.to_pylist()
        code = encoded.indices.to_numpy()
        names = pa.array(langs, pa.string()).dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        lang = np.repeat(names.indices.to_numpy(), np.diff(words.offsets.to_numpy()))
        real = code != self.spelled.index(b"") if b"" in self.spelled else np.ones(len(code), bool)
        self.code, self.lang, self.end = code[real], lang[real], self.spelled.index(b".")
        self.hash = np.fromiter(map(xxhash.xxh3_64_intdigest, self.spelled), np.uint64, len(self.spelled))

    def phrases(self, bitmap: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For 2 words to ``longest``, at each place: a hash of the phrase that starts there and its language; whether it
        lies in one piece and both its parts of one word less are frequent; whether it is so itself."""
        salt = mixed(np.fromiter((xxhash.xxh3_64_intdigest(n) for n in self.langs), np.uint64, len(self.langs)))
        at, frequent = self.hash[self.code] + salt[self.lang], self.code != self.end
        for size in range(2, longest + 1):
            at = mixed(at[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.hash[self.code[size - 1:]])
            may_be = frequent[:-1] & frequent[1:]
            bit = (at >> KEPT_FROM).view(np.int64) % (8 * len(bitmap))
            frequent = may_be & (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1)
            yield at, may_be, frequent


def _chunks(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[_Chunk]:
    texts, langs, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
            if text := text.as_py():
                texts.append(spaced_pieces(text))
                langs.append(lang.as_py())
                size += len(text)
                if size >= most_bytes:
                    yield _Chunk(texts, langs)
                    texts, langs, size = [], [], 0
    if texts:
        yield _Chunk(texts, langs)


def frequent_phrases(texts: DataFrame, longest: int, least: int, bits: int = BITS,
                     chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Bitmap (by hash) of the phrases of 2 to ``longest`` words that occur at least ``least`` times in a language."""
    bitmap = np.zeros(bits // 64, np.int64)
    for size in range(2, longest + 1):
        shorter = texts.sparkSession.sparkContext.broadcast(bitmap.view(np.uint8))
        counts = texts.mapInArrow(tidy(_phrase_counter(shorter, size, chunk_bytes)), "phrase long, n int")
        often = counts.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        bit = F.pmod(F.col("phrase"), F.lit(bits))
        cells = often.groupBy((bit / 64).cast("int").alias("cell")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(phrase, {bits}) % 64 as int))")).alias("bits")).toArrow()
        bitmap = bitmap.copy()
        bitmap[cells.column("cell").to_numpy()] |= cells.column("bits").to_numpy()
        shorter.unpersist()
    return bitmap.view(np.uint8)


def _phrase_counter(shorter, size: int, chunk_bytes: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            *_, (at, may_be, _) = chunk.phrases(shorter.value, size)
            hashes, n = np.unique((at[may_be] >> KEPT_FROM).view(np.int64), return_counts=True)
            for cut in range(0, len(hashes), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[cut:cut + 100_000]), pa.array(n[cut:cut + 100_000].astype(np.int32))],
                    names=["phrase", "n"])

    return counted


def _windows(chunk: _Chunk, bitmap: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
    """(lang, columns, n): the distinct windows that are padded after 1, 2, ... words, and how often they occur."""
    start, lang, columns = np.nonzero(chunk.code != chunk.end)[0], None, []
    key = chunk.lang[start].astype(np.int64)
    longer = chunk.phrases(bitmap, longest)
    for j in range(longest):
        # A prefix's number stands for the language and all words before; only distinct ones are spelled.
        key = key * len(chunk.spelled) + chunk.code[start + j]
        seen, key = np.unique(key, return_inverse=True)
        at = seen // len(chunk.spelled)
        lang = at if lang is None else lang[at]
        columns = [c[at] for c in columns] + [seen % len(chunk.spelled)]
        on = np.zeros(len(start), bool)
        if j + 1 < longest:
            # A word that another follows in its piece has a place in these shorter columns.
            *_, frequent = next(longer)
            there = start < len(frequent)
            on[there] = frequent[start[there]]
        n = np.bincount(key[~on], minlength=len(seen))
        ended = np.nonzero(n)[0]
        yield lang[ended], [c[ended] for c in columns], n[ended]
        start, key = start[on], key[on]


def longest_windows(texts: DataFrame, longest: int, bitmap: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, w1 to w``longest`` ('' pads), n: the windows, counted per chunk of a task."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            spelled, langs = pa.array(chunk.spelled, pa.binary()).cast(pa.string()), pa.array(chunk.langs, pa.string())
            for lang, columns, n in _windows(chunk, shared.value, longest):
                for at in range(0, len(n), 50_000):
                    cut = slice(at, at + 50_000)
                    words = [spelled.take(pa.array(c[cut])) for c in columns]
                    words += [pa.array([""]).take(pa.array(np.zeros(len(words[0]), np.int64)))] * (longest - len(words))
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(lang[cut])), *words, pa.array(n[cut].astype(np.int64))],
                        names=["lang", *(f"w{j}" for j in range(1, longest + 1)), "n"])

    cols = ", ".join(f"w{j} string" for j in range(1, longest + 1))
    return texts.mapInArrow(tidy(windows), f"lang string, {cols}, n long")


def phrase_counts(texts: DataFrame, longest: int, least: int, bits: int = BITS,
                  chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, phrase, size, f: every phrase with f >= ``least``; size 0 and phrase '' stand for all words of a language."""
    windows = longest_windows(texts, longest, frequent_phrases(texts, longest, least, bits, chunk_bytes), chunk_bytes)
    names = [f"w{j}" for j in range(1, longest + 1)]
    # Summed as they are first: ROLLUP multiplies rows by its levels, so it gets each distinct window once.
    windows = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    view = f"windows_{uuid.uuid4().hex}"
    windows.createOrReplaceTempView(view)
    sums = texts.sparkSession.sql(
        f"SELECT lang, {', '.join(names)}, sum(n) AS f, grouping_id() AS level FROM {view} "
        f"GROUP BY lang, ROLLUP ({', '.join(names)})")
    texts.sparkSession.catalog.dropTempView(view)
    # A level sums the windows over all columns after the first ``size`` ones; padded prefixes are no phrases.
    sums = sums.withColumn("size", F.lit(longest) - F.log2(F.col("level") + 1).cast("int"))
    ends = F.element_at(F.array(F.lit("."), *names), F.col("size") + 1)
    kept = sums.where((F.col("size") == 0) | ((ends != "") & (F.col("f") >= least)))
    return kept.select("lang", F.array_join(F.array(*names), " ").alias("phrase"), "size", "f")


def mine_phrases(docs: DataFrame, longest: int = 3, least: int = 10, first: int = 2000,
                 cover: tuple[int, int] = (50, 100), bits: int = BITS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language.

    Candidates are the phrases of 2 to ``longest`` words inside pieces that occur at
    least ``least`` times in texts of their language (null: ``und``).  The score is that of the
    lowest-scoring cut, floor(1000000 a a / (l r)), in exact decimals (counts to 10^15); equal cuts
    go to the shortest first part.  Candidates that lie inside a longer one with at least
    the share ``cover`` of their occurrences are left out.  Order: score and a
    descending, phrase in byte order.  Null and empty texts have no words; repeated
    rows count each; an empty table gives an empty result; other columns are not
    carried.  ``bits`` (a multiple of 64) and ``chunk_bytes`` bound memory; no result depends on them.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    counts = materialize(phrase_counts(texts, longest, least, bits, chunk_bytes), "phrase-counts")
    phrases = counts.where("size > 0").select("lang", "phrase", "f")
    candidates = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    parts = cuts.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("p1"),
                        F.expr("substring_index(phrase, ' ', k - size)").alias("p2"))
    left = phrases.select("lang", F.col("phrase").alias("p1"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("p2"), F.col("f").alias("r"))
    wide = "cast({} as decimal(15, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * {wide.format('a')} * {wide.format('a')}) div "
                   f"({wide.format('l')} * {wide.format('r')})").cast("long")
    lowest = (parts.join(left, ["lang", "p1"]).join(right, ["lang", "p2"]).withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    spans = candidates.where("size > 2").select(
        "lang", "a", "size", F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(2, size - 1)")).alias("len"))
    inner = spans.select("lang", "a", F.explode(F.expr(
        "transform(sequence(1, size - len + 1), i -> array_join(slice(w, i, len), ' '))")).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("top"))
    num, den = cover
    left_over = lowest.join(covered, ["lang", "phrase"], "left").where(
        F.col("top").isNull() | (F.col("top") * den < F.col("a") * num))
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    # A language may hold most phrases: each of its shares gives its first ones, and those are ranked.
    best = [F.desc("cut.score"), F.desc("a"), "phrase"]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    few = left_over.withColumn("place", F.row_number().over(
        Window.partitionBy("lang", share).orderBy(*best))).where(F.col("place") <= first)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(
        F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
