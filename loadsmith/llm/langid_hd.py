"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1/-1.  A letter n-gram is the product
(binding) of its letters' vectors, each rotated (permuted) by its place; a text
is the sum (bundle) of its n-grams, a language the sum of its texts.  A document
gets the language whose prototype has the highest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadsmith.llm.common import tidy

#: Length of the vectors, letters of an n-gram, and the seed of the letter vectors.
DIMENSION, NGRAM, SEED = 512, 3, 2024
#: Languages whose prototypes are broadcast (DIMENSION doubles each); more are refused.
MAX_LANGUAGES = 10_000
#: Characters of a text worked on at once, and n-gram vectors remembered in a task.
_SLICE, _REMEMBERED = 1 << 20, 1 << 15
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself for a letter, a space for anything else."""
    to = np.full(0x110000, _SPACE, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            to[c] = c
    return to


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the letter n-grams of a whole text (lower case, runs of non-letters one space)."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, counts, tail = [], [], np.full(1, _SPACE, np.uint32)
    letters = 0
    for at in range(0, len(text), _SLICE):
        points = np.frombuffer(text[at:at + _SLICE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        points = _letters()[points]
        letters += int((points != _SPACE).sum())
        points = np.concatenate([tail, points])
        points = points[~((points == _SPACE) & np.concatenate([[False], points[:-1] == _SPACE]))]
        if at + _SLICE >= len(text) and points[-1] != _SPACE:
            points = np.append(points, np.uint32(_SPACE))
        if len(points) >= NGRAM:
            p = points.astype(np.int64)
            code = (p[:-2] << 42) | (p[1:-1] << 21) | p[2:]
            code, n = np.unique(code, return_counts=True)
            codes.append(code)
            counts.append(n)
        tail = points[-(NGRAM - 1):]
    if not letters or not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    code, where = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(where, np.concatenate(counts)).astype(np.int64)


class NgramVectors:
    """Vectors of n-grams, made when first met; at most ``_REMEMBERED`` are kept."""

    def __init__(self, dimension: int, seed: int):
        self.dimension, self.seed = dimension, seed
        self.letter: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.rows = np.zeros((1024, dimension), np.float32)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letter:
            rng = np.random.default_rng([self.seed, point])
            self.letter[point] = rng.integers(0, 2, self.dimension).astype(np.float32) * 2 - 1
        return self.letter[point]

    def _vector(self, code: int) -> np.ndarray:
        a, b, c = code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF
        return np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)

    def places(self, codes: np.ndarray) -> np.ndarray:
        if len(self.row) + len(codes) > _REMEMBERED:
            self.row.clear()
            self.letter.clear()
        out = np.empty(len(codes), np.int64)
        for i, code in enumerate(codes.tolist()):
            at = self.row.get(code)
            if at is None:
                at = self.row[code] = len(self.row)
                if at >= len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[at] = self._vector(code)
            out[i] = at
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, any number of them."""
        total = np.zeros(self.dimension)
        for at in range(0, len(codes), 4096):
            place = self.places(codes[at:at + 4096])
            total += counts[at:at + 4096].astype(np.float32) @ self.rows[place]
        return total


def learn_prototypes(labelled: DataFrame, dimension: int = DIMENSION, seed: int = SEED) -> DataFrame:
    """One row (lang, prototype: array<double>) per language of the rows with text and lang.

    Every labelled row counts.  A document's n-gram counts are scaled to length 1
    before they are added, so that very long texts don't outweigh the rest.  As
    bundling is linear, a task sums the scaled counts of a language first and
    bundles them once.  Tasks send one vector per language they meet; sums are
    taken by (lang, component).
    """
    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(where, np.concatenate([w for _, w in parts]))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes, counts = ngram_counts(text.as_py())
                if len(codes):
                    sums.setdefault(lang, []).append((codes, counts / np.linalg.norm(counts)))
                    if len(sums[lang]) >= 1000:
                        sums[lang] = [merged(sums[lang])]
        vectors = NgramVectors(dimension, seed)
        for lang, parts in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimension, pa.string()), pa.array(range(dimension), pa.int32()),
                 pa.array(vectors.bundle(*merged(parts)), pa.float64())], names=["lang", "at", "x"])

    parts = (labelled.where("lang is not null and text is not null").select(F.col("lang").cast("string"), "text")
             .mapInArrow(tidy(partial), "lang string, at int, x double"))
    return (parts.groupBy("lang", "at").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))),
                                             lambda s: s["x"]).alias("prototype")))


class _Judge:
    """Languages of texts by the highest cosine with the prototypes."""

    def __init__(self, langs: list[str], proto: np.ndarray, dimension: int, seed: int):
        self.langs, self.proto, self.dimension = langs, proto, dimension
        self.vectors = NgramVectors(dimension, seed)

    def judge(self, texts) -> tuple[list[str], list[float]]:
        best, score = [], []
        for text in texts:
            codes, counts = ngram_counts(text.as_py())
            bundle = self.vectors.bundle(codes, counts) if len(codes) and self.langs else np.zeros(self.dimension)
            norm = np.linalg.norm(bundle)
            if norm:
                cosines = self.proto @ (bundle / norm)
                i = int(np.argmax(cosines))
                best.append(self.langs[i])
                score.append(float(min(max(cosines[i], 0.0), 1.0)))
            else:
                best.append("und")
                score.append(0.0)
        return best, score


def _shared_judge(prototypes: DataFrame, dimension: int, seed: int):
    """The judge of the learned prototypes, broadcast; at most ``MAX_LANGUAGES`` of them."""
    learned = prototypes.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(learned) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = [r["lang"] for r in learned]
    matrix = np.array([r["prototype"] for r in learned]).reshape(len(names), dimension)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return prototypes.sparkSession.sparkContext.broadcast((names, matrix / np.where(norms, norms, 1)))


def predict_languages(docs: DataFrame, prototypes: DataFrame, dimension: int = DIMENSION,
                      seed: int = SEED) -> DataFrame:
    """``docs`` with lang_pred and score (the highest cosine, from 0 to 1) of every whole text.

    A text that is null or has no letter is 'und' with score 0, and so is every
    text if nothing was learned; ties go to the first language in order.  Input
    columns of these two names are replaced; repeated rows are each judged.
    """
    shared = _shared_judge(prototypes, dimension, seed)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at_text = kept.index("text")
    named = docs.select(*(F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(kept)))
    schema = StructType([*named.schema]).add("lang_pred", "string").add("score", "double")

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(*shared.value, dimension, seed)
        for batch in batches:
            best, score = judge.judge(batch.column(at_text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return named.mapInArrow(tidy(predicted), schema).select(
        *(F.col(f"d{i}").alias(c) for i, c in enumerate(kept)), "lang_pred", "score")


def held_out() -> F.Column:
    """Whether a document is kept from learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_languages(docs: DataFrame, dimension: int = DIMENSION, seed: int = SEED) -> DataFrame:
    """Learn from the labelled rows that aren't held out, then judge every row by its text alone.

    Returns doc_id, held_out, lang_pred, score.  A null doc_id has no remainder
    and so is not held out.  An empty table gives an empty result.
    """
    learned = learn_prototypes(docs.where(~held_out()), dimension, seed)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict_languages(rows, learned, dimension, seed).drop("text")


def keep_known_languages(docs: DataFrame, dimension: int = DIMENSION, seed: int = SEED) -> DataFrame:
    """``docs`` without the texts whose language is 'und': no letter (null and empty texts too), or nothing was learned.

    The cosine decides nothing here: at this dimension that of a clean short text
    is within the noise (about 1 / sqrt(dimension)).  Nonsense made of letters stays.
    Only texts go to Python, and only verdicts come back.  Repeated rows are each judged, all
    columns stay as they are, whatever their names; an empty table gives an empty result.
    """
    shared = _shared_judge(learn_prototypes(docs.where(~held_out()), dimension, seed), dimension, seed)

    @F.arrow_udf("boolean")
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _Judge(*shared.value, dimension, seed)
        for batch in texts:
            yield pa.array([lang != "und" for lang in judge.judge(batch)[0]], pa.bool_())

    return docs.where(known(F.col("text")))
