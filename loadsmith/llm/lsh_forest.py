"""Near-duplicate documents with a MinHash LSH forest.

Every distinct shingle set gets one MinHash signature.  A tree of the forest is
an order of the signature's values; sets that agree on a tree's first ``DEPTH``
values share a region of it.  Regions are sorted by the values that follow, so
that neighbours have the longest common prefixes; a crowded region is split at
deeper values first.  Neighbours are verified on the full sets and their links
give first components.  Then every pair of a region that is still in different
components is compared too, by signature and then on the full sets in small
regions, on the full sets in blocks in large ones, so no region is cut short.

Two sets of similarity 0.8 share none of the 35 regions with a probability of
(1 - 0.8^5)^35, about one in a million; more similar ones far less often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.llm.common import as_signed, mixed, small_enough, text_key, tidy, word_hashes, word_memory
from loadsmith.llm.components import connected_components
from loadsmith.session import materialize

DEPTH, TREES = 5, 35
VALUES = DEPTH * TREES
#: Values after the prefix that order a region; trees whose neighbours make the first links.
DEEPER, FIRST_TREES = 4, 12
#: Members beyond which a region is split at deeper values for the first links.
CROWDED = 10_000
#: Rows of a region up to which it is compared pair by pair, and rows of a block of a larger one.
SMALL, BLOCK = 64, 512
#: Signature agreement below which a pair isn't verified: 5 standard deviations below a similarity of 0.8.
LEAST_AGREEMENT = 0.65
#: The least threshold that trees, depth and least agreement are made for; lower ones are refused.
LEAST_THRESHOLD = (80, 100)
_MULTIPLIERS = (np.random.default_rng(7).integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)
                | np.uint32(1))


def shingle_set(text: bytes | None, n: int, known) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``n``-word shingles of a whole text (A-Z lower-cased).

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h, n_here = word_hashes(words, known), min(n, len(words))
    total = h[:len(h) - n_here + 1].copy()
    for j in range(1, n_here):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - n_here + 1 + j]
    return np.unique(mixed(total ^ np.uint64(n_here * 0xA5A5A5A5A5A5)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of each of ``VALUES`` hash functions over the set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(least, (_MULTIPLIERS[:, None] * low[None, at:at + 2048]).min(axis=1), out=least)
    return least


def document_sets(docs: DataFrame, n: int) -> DataFrame:
    """Per row: doc_id, k1 and k2 (the text), n_shingles, cls (a 128-bit hash of the set, null if empty), sig."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_memory()
        for whole, at in ((b, at) for b in batches for at in range(0, b.num_rows, 2000)):
            batch, sizes, classes, signatures = whole.slice(at, 2000), [], [], []
            for text in batch.column(3).cast(pa.binary()):
                s = shingle_set(text.as_py(), n, known)
                sizes.append(len(s))
                classes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signatures.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(signatures, pa.binary())], names=["doc_id", "k1", "k2", "n_shingles", "cls", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *text_key(), "text").mapInArrow(
        tidy(features), f"doc_id {kind}, k1 long, k2 long, n_shingles long, cls binary, sig binary")


def forest(classes: DataFrame) -> DataFrame:
    """A row per class and tree: tree, region (hash of tree and prefix), deep (the values that follow), cls."""
    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, VALUES)
                m = len(sig)
                prefix = sig.reshape(m, TREES, DEPTH).astype(np.uint64)
                region = np.broadcast_to(mixed(np.arange(1, TREES + 1, dtype=np.uint64))[None], (m, TREES)).copy()
                for j in range(DEPTH):
                    region = mixed(region ^ prefix[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
                after = (np.arange(TREES)[:, None] * DEPTH + DEPTH + np.arange(DEEPER)[None]) % VALUES
                deep = np.ascontiguousarray(sig[:, after].astype(">u4")).tobytes()
                width = 4 * DEEPER
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(TREES, dtype=np.int32), m)),
                     pa.array(as_signed(np.ascontiguousarray(region)).ravel()),
                     pa.array([deep[i:i + width] for i in range(0, len(deep), width)], pa.binary()),
                     part.column(0).take(pa.array(np.repeat(np.arange(m), TREES)))],
                    names=["tree", "region", "deep", "cls"])

    return classes.select("cls", "sig").mapInArrow(planted, "tree int, region long, deep binary, cls binary")


def neighbour_pairs(members: DataFrame) -> DataFrame:
    """(a, b): neighbours in the sorted regions of the first trees; crowded regions split at deeper values."""
    region = F.when(F.col("size") > CROWDED, F.xxhash64("region", F.expr("substring(deep, 1, 8)"))).otherwise(
        F.col("region"))
    rows = members.where(F.col("tree") < FIRST_TREES).withColumn("part", region)
    nearby = rows.withColumn("next", F.lead("cls").over(Window.partitionBy("part").orderBy("deep", "cls")))
    return nearby.where("next is not null").select(
        F.least("cls", "next").alias("a"), F.greatest("cls", "next").alias("b")).distinct()


def undecided(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of regions that still hold several components: tree, region, cls, root, main, n, lefts, rights.

    ``main`` is the region's most frequent component.  All other members (in
    ``lefts`` blocks of ``BLOCK`` rows) have to face all members (``rights`` blocks).
    """
    rooted = (members.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")).select("tree", "region", "cls", "root"))
    by_root = rooted.groupBy("tree", "region", "root").agg(F.count(F.lit(1)).alias("n"))
    regions = by_root.groupBy("tree", "region").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("top"))
    regions = regions.where("roots > 1").select(
        "tree", "region", "n", F.col("top.root").alias("main"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("rights"),
        F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("lefts"))
    return materialize(rooted.join(regions, ["tree", "region"]), "undecided")


def small_pairs(open_rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): pairs of a region of at most ``SMALL`` rows, in different components, whose signatures
    may mean a link; each pair in the first tree where the two meet."""
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        tree, main, out = int(rows["tree"].iloc[0]), rows["main"].iloc[0], []
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint32).reshape(-1, VALUES)
        cls, root = rows["cls"].to_list(), rows["root"].to_list()
        for i in range(len(cls)):
            if root[i] == main:
                continue
            same = sig[i] == sig
            for j in np.nonzero(same.mean(axis=1) >= LEAST_AGREEMENT)[0]:
                if root[i] == root[j] or root[j] != main and cls[i] > cls[j]:
                    continue
                if int(same[j].reshape(TREES, DEPTH).all(axis=1).argmax()) == tree:
                    out.append((min(cls[i], cls[j]), max(cls[i], cls[j])))
        return pd.DataFrame(out, columns=["a", "b"])

    signed = open_rows.where(F.col("n") <= SMALL).select("tree", "region", "cls", "root", "main").join(
        classes.select("cls", "sig"), "cls")
    return signed.groupBy("tree", "region").applyInPandas(compare, "a binary, b binary")


def crowded_links(open_rows: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(a, b): links between the components of regions over ``SMALL`` rows, enough to join what links join.

    Every left row faces every right row in some block, on the full sets; a block
    gives only links that join two components it hasn't joined yet, so at most one
    less than it has rows.
    """
    num, den = threshold
    crowd = open_rows.where(F.col("n") > SMALL).withColumn(
        "spread", F.pmod(F.xxhash64("cls", "tree"), F.lit(1 << 30)).cast("int")).join(sets, "cls")
    row = ["tree", "region", "cls", "root", "shingles"]
    right = crowd.select(*row, F.lit(False).alias("left"), (F.col("spread") % F.col("rights")).alias("j"),
                         F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"))
    left = crowd.where("root <> main").select(
        *row, F.lit(True).alias("left"), (F.col("spread") % F.col("lefts")).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        cls, root, is_left = rows["cls"].to_list(), rows["root"].to_list(), rows["left"].to_numpy(bool)
        up = {r: r for r in root}

        def top(r):
            while up[r] != r:
                up[r] = up[up[r]]
                r = up[r]
            return r

        sizes = np.array([len(s) for s in rows["shingles"]])
        both = common_shingles([s for s, x in zip(rows["shingles"], is_left) if x],
                               [s for s, x in zip(rows["shingles"], is_left) if not x])
        lefts, rights, out = np.nonzero(is_left)[0], np.nonzero(~is_left)[0], []
        linked = both * den >= (sizes[lefts][:, None] + sizes[rights][None] - both) * num
        for i, j in zip(*np.nonzero(linked)):
            a, b = top(root[lefts[i]]), top(root[rights[j]])
            if a != b:
                up[a] = b
                out.append((cls[lefts[i]], cls[rights[j]]))
        return pd.DataFrame(out, columns=["a", "b"])

    return (left.unionByName(right).groupBy("tree", "region", "i", "j")
            .applyInPandas(link, "a binary, b binary"))


def common_shingles(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many shingles each left set shares with each right set."""
    both = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return both
    shingles, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    for at in range(0, len(shingles), width):
        a, b = np.searchsorted(place, [at, at + width])
        has = np.zeros((len(left) + len(right), width), np.float32)
        has[row[a:b], place[a:b] - at] = 1
        both += (has[:len(left)] @ has[len(left):].T).astype(np.int64)
    return both


def verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets reach the threshold (in exact integers)."""
    num, den = threshold
    one = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(two, "b").withColumn("both", both)
            .where(F.col("both") * den >= (F.size("sa") + F.size("sb") - F.col("both")) * num).select("a", "b"))


def class_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cls, shingles) of the wanted classes (cls, rep), from the texts of their representatives."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_memory()
        for batch in batches:
            found = [shingle_set(t.as_py(), n, known) for t in batch.column(0).cast(pa.binary())]
            for at in range(0, len(found), 500):
                part = found[at:at + 500]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in part], pa.binary()),
                     pa.array([as_signed(s) for s in part], pa.list_(pa.int64()))], names=["cls", "shingles"])

    ids = small_enough(wanted.select("rep").distinct())
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["rep"]), "left_semi").select("text")
    made = texts.mapInArrow(tidy(sets), "cls binary, shingles array<long>").dropDuplicates(["cls"])
    return made.join(wanted.select("cls"), "cls", "left_semi")


def near_duplicate_rows(docs: DataFrame, shingle_words: int, threshold: tuple[int, int]) -> DataFrame:
    """Per row: doc_id, k1, k2, n_shingles, root (the component; null for an empty set), component_id."""
    if threshold[0] * LEAST_THRESHOLD[1] < LEAST_THRESHOLD[0] * threshold[1]:
        raise ValueError(f"threshold {threshold} is below {LEAST_THRESHOLD}: pairs would be lost")
    rows = materialize(document_sets(docs, shingle_words), "sets")
    classes = materialize(rows.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")
    trees = forest(classes)
    crowds = trees.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(trees.join(crowds, "region"), "forest")
    clustered = members.select("cls").distinct()
    sets = materialize(class_sets(docs, classes.join(clustered, "cls").select("cls", "rep"), shingle_words),
                       "shingles")
    links = materialize(verified(neighbour_pairs(members), sets, threshold), "near-links")
    roots = connected_components(links)
    open_rows = undecided(members, roots)
    more = verified(small_pairs(open_rows, classes), sets, threshold).unionAll(
        crowded_links(open_rows, sets, threshold))
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = materialize(connected_components(stars.unionAll(more)), "components")
    reps = roots.join(classes.select(F.col("cls").alias("node"), "rep"), "node")
    named = reps.join(reps.groupBy("root").agg(F.min("rep").alias("component")), "root")
    of_class = classes.select("cls", "rep").join(
        named.select(F.col("node").alias("cls"), "root", "component"), "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("root"), F.coalesce("component", "rep").alias("component"))
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return rows.drop("sig").join(of_class, "cls", "left").select(
        "doc_id", "k1", "k2", "n_shingles", "root", component.alias("component_id"))


def near_duplicates(docs: DataFrame, shingle_words: int = 2, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 times the intersection of their shingle sets is
    at least 80 times the union; a component is what links reach, named by its
    smallest doc_id; kept is doc_id = component_id.  Null and wordless texts have
    an empty set and are linked with nothing.  Equal sets are one class: any
    number of copies costs one signature.  Repeated rows, and null ids, are
    documents of their class like others; a null id names a component only if it
    has no other id.  An empty table gives an empty result.
    """
    return near_duplicate_rows(docs, shingle_words, threshold).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` with one document of each component; the columns stay as they are.

    The one that stays has the smallest doc_id (null last, then the smallest hash of
    the text); rows that repeat both its id and its text are reduced to one.
    Documents without words, null texts among them, all stay.  Columns of any name are kept; an
    empty table gives an empty result.
    """
    rows = materialize(near_duplicate_rows(docs, shingle_words, threshold).where("root is not null").select(
        F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "k1", "k2").alias("me"), "root"), "judged")
    first = rows.groupBy("root").agg(F.min("me").alias("first"))
    judged = (rows.groupBy("root", "me").agg(F.count(F.lit(1)).alias("n")).join(first, "root")
              .select("me", "n", (F.col("me") == F.col("first")).alias("stays")))
    gone = judged.where(~F.col("stays")).select("me")
    again = judged.where("stays and n > 1").select("me")
    k1, k2 = text_key()
    names = [f"d{i}" for i in range(len(docs.columns))]
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", k1, k2).alias("me"),
                        *(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)))
    left = named.join(small_enough(gone), "me", "left_anti")
    if not again.isEmpty():
        twice = small_enough(again)
        left = left.join(twice, "me", "left_anti").unionByName(
            left.join(twice, "me", "left_semi").dropDuplicates(["me"]))
    return left.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names)))
