"""Substring dedup on a compacted De Bruijn graph of word k-mers.

A k-mer is a window of ``k`` words and an edge of the graph.  Holding one row per
k-mer would be several times the corpus, so k-mers travel as super-k-mers: a run
of consecutive k-mers with the same minimizer (the k-mer's least hashed
``SEED_WORDS``-gram).  Equal k-mers have equal minimizers, so

1. super-k-mers whose minimizer occurs once hold no repeated k-mer and are dropped;
2. super-k-mers that occur again as a whole are repeated edges; where one is
   always followed by the same other one and as often, the two compact into one
   path, by joins over the links between them;
3. k-mers of the remaining ones (where repeated passages end in different
   surroundings) are counted singly, against those and against one occurrence of
   every repeated super-k-mer with the same minimizer.

What comes out are spans of k-mer starts in source coordinates, exact up to
128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.llm.common import as_signed, in_slices, mixed, small_enough, text_key, tidy, word_hashes, word_memory
from loadsmith.session import materialize

K, SEED_WORDS = 35, 8
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class SpanHashes:
    """Hash pairs of any spans of a word sequence, from running sums (modulo 2^64)."""

    def __init__(self, h: np.ndarray):
        self.sums, self.back = [], []
        for i, base in enumerate(_BASES):
            h = h if i == 0 else mixed(h ^ np.uint64(0x5851F42D4C957F2D))
            power = np.full(len(h) + 1, base, np.uint64)
            power[0] = 1
            inverse = np.full(len(h) + 1, pow(base, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            self.back.append(np.cumprod(inverse))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(power)[:-1])]))

    def of(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        size = (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        return [mixed((s[end] - s[start]) * b[start] + size) for s, b in zip(self.sums, self.back)]


def super_kmers(h: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """First k-mer start, last + 1, minimizer and hash pair of each super-k-mer of hashed words."""
    spans, seed = SpanHashes(h), min(SEED_WORDS, k)
    at = np.arange(len(h) - seed + 1)
    grams = spans.of(at, at + seed)[0]
    where = sliding_window_view(grams, k - seed + 1).argmin(axis=1) + np.arange(len(h) - k + 1)
    lo = np.concatenate([[0], np.nonzero(np.diff(where))[0] + 1])
    hi = np.append(lo[1:], len(where))
    return lo, hi, grams[where[lo]], spans.of(lo, hi + k - 1)


def one_of_each(docs: DataFrame) -> DataFrame:
    """k1, k2, text, weight: one row per distinct text, with weight 2 if there are more.

    Copies repeat every k-mer of their text, so one of them, counted twice, stands
    for any number.  (Rows that repeat id and text may stay; they change no verdict.)
    """
    keyed = docs.where("text is not null").select(*text_key(), "doc_id", "text")
    copied = materialize(keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
                         .where("n > 1").select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "first"), "copied")
    marked = keyed.join(small_enough(copied), F.expr("k1 = c1 and k2 = c2"), "left")
    return marked.where("c1 is null or doc_id <=> first").select(
        "k1", "k2", "text", F.when(F.col("c1").isNull(), 1).otherwise(2).alias("weight"))


def super_kmer_rows(texts: DataFrame, k: int = K) -> DataFrame:
    """k1, k2 (the text), weight, lo, hi, m (minimizer), e (the whole super-k-mer).

    Equal super-k-mers have equal minimizers, so (m, e) is a hash of 128 bits.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_memory()
        for batch in batches:
            own = [batch.column(i).to_numpy() for i in (0, 1, 3)]
            parts, held = [], 0
            for i, text in enumerate(batch.column(2).cast(pa.binary())):
                words = text.as_py().split()
                if len(words) >= k:
                    lo, hi, m, e = super_kmers(word_hashes(words, known), k)
                    parts.append((*(np.full(len(lo), x[i]) for x in own), lo.astype(np.int32), hi.astype(np.int32),
                                  as_signed(m), as_signed(e[0])))
                    held += len(lo)
                if held > 50_000:
                    yield batch_of(parts)
                    parts, held = [], 0
            if parts:
                yield batch_of(parts)

    def batch_of(parts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)],
                                          names=["k1", "k2", "weight", "lo", "hi", "m", "e"])

    return texts.mapInArrow(tidy(rows), "k1 long, k2 long, weight int, lo int, hi int, m long, e long")


def linked(repeated: DataFrame) -> DataFrame:
    """k1, k2, lo, hi, times, on: whether a repeated super-k-mer and its next are one path.

    ``repeated`` has every occurrence with the count ``n``.  Two neighbours join if
    their link occurs as often as each of them: then no occurrence of one goes on
    with anything else, and the path has no branch between them.
    """
    order = Window.partitionBy("k1", "k2").orderBy("lo")
    pairs = repeated.withColumns({c: F.lead(s).over(order) for c, s in (("lo_", "lo"), ("m_", "m"), ("e_", "e"), ("n_", "n"))})
    pairs = pairs.select("k1", "k2", "lo", "hi", "n", "weight", F.when(
        F.expr("lo_ = hi and n = n_"), F.struct(F.xxhash64("m", "e", "m_", "e_").alias("a"),
                                                F.xxhash64("e_", "e", "m").alias("b"))).alias("link"))
    often = materialize(pairs.where("link is not null").groupBy("link").agg(F.sum("weight").alias("both")), "graph-links")
    return pairs.join(often, "link", "left").select(
        "k1", "k2", "lo", "hi", F.col("n").alias("times"), F.expr("coalesce(both = n, false)").alias("on"))


def compacted(runs: DataFrame) -> DataFrame:
    """(k1, k2, spans): per text the paths that the linked super-k-mers make, in order of place."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for held in batch.column(2):
                out, open_ = [], False
                for r in held.as_py():
                    if open_:
                        out[-1]["hi"] = r["hi"]
                    else:
                        out.append({"lo": r["lo"], "hi": r["hi"], "times": r["times"]})
                    open_ = r["on"]
                spans.append(out)
            kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("times", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)],
                                             names=["k1", "k2", "spans"])

    per_text = runs.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set(F.struct("lo", "hi", "times", "on"))).alias("held"))
    return per_text.mapInArrow(merge, "k1 long, k2 long, spans array<struct<lo: int, hi: int, times: long>>")


def _of_texts(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The texts that ``places`` names, with their places.

    The keys of those texts are broadcast if they are few (counted), so that only
    these texts are shuffled.
    """
    return texts.join(small_enough(places.select("k1", "k2")), ["k1", "k2"], "left_semi").join(places, ["k1", "k2"])


def single_kmers(texts: DataFrame, places: DataFrame, k: int = K) -> DataFrame:
    """w1, w2, k1, k2, s, weight: each k-mer of the given places (k1, k2, todo: lo, hi, weight)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_memory()
        for batch in batches:
            for key1, key2, text, todo in zip(*(batch.column(i) for i in range(4))):
                spans = SpanHashes(word_hashes(text.as_py().encode().split(), known))
                at = [np.arange(t["lo"], t["hi"]) for t in todo.as_py()]
                weight = np.concatenate([np.full(len(a), t["weight"]) for a, t in zip(at, todo.as_py())])
                at = np.concatenate(at)
                w = spans.of(at, at + k)
                for p, a, b, n in in_slices([at, as_signed(w[0]), as_signed(w[1]), weight]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a), pa.array(b), *(pa.array(np.full(len(p), x.as_py())) for x in (key1, key2)),
                         pa.array(p, pa.int32()), pa.array(n, pa.int32())],
                        names=["w1", "w2", "k1", "k2", "s", "weight"])

    return (_of_texts(texts.drop("weight"), places).select("k1", "k2", "text", "todo")
            .mapInArrow(tidy(rows), "w1 long, w2 long, k1 long, k2 long, s int, weight int"))


def repeated_spans(docs: DataFrame, k: int = K) -> DataFrame:
    """(k1, k2, spans: lo, hi, times): per distinct text, the k-mer starts that occur again anywhere.

    A span is a run of starts; its k-mers cover the words from lo to hi + k - 2.
    ``times`` is how often a compacted path occurs, all copies of a text counted as
    two; null for k-mers found singly.
    """
    texts = one_of_each(docs)
    rows = materialize(super_kmer_rows(texts, k), "super-kmers")
    again = materialize(rows.groupBy("m").agg(F.sum("weight").alias("c")).where("c > 1").select("m"), "minimizers")
    rows = materialize(rows.join(again, "m"), "shared-minimizers")
    edges = materialize(rows.groupBy("m", "e").agg(F.sum("weight").alias("n")).where("n > 1"), "repeated-edges")
    counted = materialize(rows.join(edges, ["m", "e"], "left"), "edges")
    repeated, ends = counted.where("n is not null"), counted.where("n is null")
    ends_m = materialize(ends.select("m").distinct(), "end-minimizers")
    one = (repeated.join(ends_m, "m", "left_semi").groupBy("m", "e")
           .agg(F.min(F.struct("k1", "k2", "lo", "hi")).alias("o"))
           .select("o.k1", "o.k2", "o.lo", "o.hi", F.lit(2).alias("weight")))
    places = (ends.select("k1", "k2", "lo", "hi", F.lit(1).alias("weight")).unionByName(one).groupBy("k1", "k2")
              .agg(F.collect_list(F.struct("lo", "hi", "weight")).alias("todo")))
    singles = materialize(single_kmers(texts, materialize(places, "places"), k), "kmers")
    found = materialize(singles.groupBy("w1", "w2").agg(F.sum("weight").alias("c")).where("c > 1").select("w1", "w2"),
                        "repeated-kmers")
    single = singles.where("weight = 1").join(found, ["w1", "w2"]).select(
        "k1", "k2", F.col("s").alias("lo"), (F.col("s") + 1).alias("hi"), F.lit(None).cast("long").alias("times"),
        F.lit(False).alias("on"))
    return materialize(compacted(linked(repeated).unionByName(single)), "spans")


def _mark(words: int, spans: list, k: int) -> np.ndarray:
    """Which words the k-mers that start in the spans cover."""
    edge = np.zeros(words + 1, np.int64)
    for s in spans:
        edge[s["lo"]] += 1
        edge[min(s["hi"] + k - 1, words)] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, k: int = K) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256.

    Words are runs of anything but ASCII white space, unchanged.  Every word that a
    ``k``-word window covers whose word sequence also starts anywhere else, in the
    same document too, is removed; all windows are judged on the input.  A null
    text has no words, fewer than ``k`` words no window, and no kept words give the
    hash of the empty string.  Repeated rows are copies of each other; null ids
    are kept; an empty table gives an empty result.  Other columns are not carried.
    """
    joined = _with_spans(docs.select("doc_id", *text_key(), "text"), docs, k).select("doc_id", "text", "spans")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, sha = [], [], []
            for text, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
                words = (text.as_py() or b"").split()
                kept = words
                if spans.is_valid:
                    gone = _mark(len(words), spans.as_py(), k)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                total.append(len(words))
                removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(digests, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def _by_spans(rows: DataFrame, docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose text has no spans, which aren't shuffled, and the others with the spans of their text."""
    spans = repeated_spans(docs, k)
    keys = small_enough(spans.select("k1", "k2"))
    return rows.join(keys, ["k1", "k2"], "left_anti"), _of_texts(rows, spans)


def _with_spans(rows: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``rows`` with the spans of their text; null where there are none."""
    clean, cut = _by_spans(rows, docs, k)
    return clean.withColumn("spans", F.lit(None).cast(cut.schema["spans"].dataType)).unionByName(cut)


def cut_repeats(docs: DataFrame, k: int = K, most: float = 1.0) -> DataFrame:
    """``docs`` with the repeated words cut out of the texts; the columns stay as they are.

    The words that stay are joined by one space; texts without repeats, null and empty ones
    among them, are returned unchanged and don't go through Python.  A document that loses ``most``
    or more of its words is dropped.  Repeated rows are copies of each other; columns of any
    name are kept; an empty table gives an empty result.
    """
    columns = docs.columns
    at = columns.index("text")
    names = [f"d{i}" for i in range(len(columns))]
    renamed = docs.select(*text_key(), *(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)))
    clean, cut = _by_spans(renamed, docs, k)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                out, stay = [], []
                for text, spans in zip(part.column(at), part.column(len(names))):
                    words = text.as_py().encode().split()
                    gone = _mark(len(words), spans.as_py(), k)
                    stay.append(gone.sum() < most * len(words))
                    out.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
                arrays = [pa.array(out, pa.string()) if i == at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(arrays, names=names).filter(pa.array(stay, pa.bool_()))

    made = cut.select(*names, "spans").mapInArrow(tidy(texts), cut.select(*names).schema)
    return clean.select(*names).unionByName(made).select(*(F.col(n).alias(c) for n, c in zip(names, columns)))
