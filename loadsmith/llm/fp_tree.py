"""Ranked lexical search by branch and bound over document FP-trees.

Each document becomes its restricted term vector: the terms that some item asks for,
with their numbers.  Written once, the vectors are read in batches, and each batch of
documents becomes one FP-tree: vectors ordered from the most frequent term down share
trie paths, a node that holds few documents is a page.  A node keeps, over its subtree,
the highest number of occurrences of each term and the least length factor m.  As a
term's part of a score rises with its occurrences and falls with m, they give an upper
bound of every score below the node.  Each item walks the tree depth first, best child
first, and leaves out nodes whose bound can't enter its best list, which a task keeps
from tree to tree; on pages scores are exact, in 64-bit integers.  The tasks' lists meet
in one ranking window.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.llm.common import table_rows_in_blocks
from loadsmith.session import materialize, scratch_path

#: Items and characters of items searched in one pass over the documents.
BLOCK_ITEMS, BLOCK_CHARS = 4096, 1 << 24
#: Documents of a page (a node that is not split), and term entries of one tree at most (one document at least).
PAGE, TREE_ENTRIES = 48, 1 << 20
#: Stands for a missing doc_id inside a search: it comes after all others.
_NO_ID = (1 << 63) - 1
_PLAIN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_PLAIN).split() if text else []


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, n (its terms with repeats), terms (ascending numbers of its
    vocabulary terms), tfs (their occurrences)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, sizes, offsets, terms, tfs = [], [], [0], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary())):
                    words = terms_of(text.as_py())
                    if words:
                        found = Counter(t for t in map(known.get, words) if t is not None)
                        order = sorted(found)
                        ids.append(doc_id)
                        sizes.append(len(words))
                        terms.extend(order)
                        tfs.extend(map(found.__getitem__, order))
                        offsets.append(len(terms))
                ends = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                    names=["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(vectors, "doc_id long, n long, terms array<int>, tfs array<long>")


def part_of_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """The FP-tree of a batch of documents.

    ``terms`` are frequency ranks (0: the most frequent), ascending per document.
    Nodes stand in preorder; a node covers the documents ``first`` to ``last`` of
    ``order`` and its subtree ends before ``after``.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 page: int = PAGE):
        self.page = page
        paths = terms.astype(">u4").tobytes()
        ends = (4 * offsets).tolist()
        keys = [paths[a:b] for a, b in zip(ends, ends[1:])]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        sizes = np.diff(offsets)[order]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(offsets[order] - self.offsets[:-1], sizes) + np.arange(self.offsets[-1])
        self.terms, self.tfs = terms[take], tfs[take]
        self.ids, self.m = ids[order], m[order]
        self.first, self.last, self.after, self.children = [], [], [], []
        self._grow(0, len(order), 0)
        self.first, self.last = np.array(self.first), np.array(self.last)
        self._summarise()

    def _grow(self, first: int, last: int, depth: int) -> int:
        """Add the node of the documents ``first`` to ``last``, which share their first ``depth`` terms."""
        me = len(self.first)
        self.first.append(first)
        self.last.append(last)
        self.children.append([])
        self.after.append(me + 1)
        cuts = [first]
        while last - first > self.page and len(cuts) == 1:  # a path without a branch stays one node
            place = self.offsets[first:last] + depth
            inside = place < self.offsets[first + 1:last + 1]
            if not inside.any():  # equal vectors: dealt to pages as they come
                cuts = list(range(first, last, self.page))
                break
            term = np.where(inside, self.terms[np.minimum(place, len(self.terms) - 1)], -1)
            cuts = [first, *(first + 1 + np.nonzero(term[1:] != term[:-1])[0]).tolist()]
            depth += 1
        if len(cuts) > 1:
            for a, b in self._joined(cuts, last):
                self.children[me].append(self._grow(a, b, depth if b - a > self.page else 0))
        self.after[me] = len(self.first)
        return me

    def _joined(self, cuts: list[int], last: int) -> list[tuple[int, int]]:
        """The branches, with small neighbouring ones joined to one page."""
        out: list[tuple[int, int]] = []
        for a, b in zip(cuts, [*cuts[1:], last]):
            if out and b - out[-1][0] <= self.page:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        return out

    def _summarise(self) -> None:
        """Subtree maxima of occurrences by term, least m and least id: pages first, then their ancestors."""
        nodes = len(self.first)
        leaves = [i for i in range(nodes) if not self.children[i]]
        docs_of = np.concatenate([[0], np.cumsum((self.last - self.first)[leaves])])
        leaf_of = np.repeat(np.array(leaves), np.diff(docs_of))
        entry_leaf = np.repeat(leaf_of, np.diff(self.offsets))
        key = entry_leaf.astype(np.int64) << 32 | self.terms
        sort = np.argsort(key, kind="stable")
        starts = np.nonzero(np.diff(key[sort], prepend=-1))[0] if len(key) else np.zeros(0, np.int64)
        peak = np.maximum.reduceat(self.tfs[sort], starts) if len(key) else self.tfs
        at = key[sort][starts]
        sums = [(at >> 32, at & 0xFFFFFFFF, peak)]
        self.least_m, self.least_id = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        for i in range(nodes):
            self.least_m[i] = self.m[self.first[i]:self.last[i]].min()
            self.least_id[i] = self.ids[self.first[i]:self.last[i]].min()
        for i in range(nodes):
            if self.children[i]:
                a, b = np.searchsorted(sums[0][0], [i, self.after[i]])  # preorder: the subtree's leaves lie together
                sort = np.argsort(sums[0][1][a:b], kind="stable")
                term, most = sums[0][1][a:b][sort], sums[0][2][a:b][sort]
                begin = np.nonzero(np.diff(term, prepend=-1))[0]
                sums.append((np.full(len(begin), i), term[begin], np.maximum.reduceat(most, begin)))
        node, term, most = (np.concatenate(x) for x in zip(*sums))
        sort = np.argsort(term, kind="stable")
        self.of_node, self.of_term, self.peak = node[sort], term[sort], most[sort]


class Searcher:
    """The best lists of the items, kept from tree to tree."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], k: int):
        self.items, self.k = items, k  # per item: its terms, ascending, and their weights times repeats
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]  # (-score, id), sorted
        self.scored = 0

    def search(self, tree: Tree) -> None:
        for i in range(len(self.items)):
            self._item(tree, i)

    def _item(self, tree: Tree, i: int) -> None:
        terms, weights = self.items[i]
        a, b = np.searchsorted(tree.of_term, terms), np.searchsorted(tree.of_term, terms, side="right")
        bound = np.zeros(len(tree.first), np.int64)
        for at, to, w in zip(a.tolist(), b.tolist(), weights.tolist()):
            node = tree.of_node[at:to]  # each node once a term
            bound[node] += w * part_of_score(tree.peak[at:to], tree.least_m[node])
        stack = [0]
        while stack:
            node = stack.pop()
            if not self._may_enter(i, int(bound[node]), int(tree.least_id[node])):
                continue
            if tree.children[node]:
                stack.extend(sorted(tree.children[node], key=bound.__getitem__))
            else:
                self._page(tree, i, int(tree.first[node]), int(tree.last[node]), terms, weights)

    def _may_enter(self, i: int, bound: int, least_id: int) -> bool:
        best = self.best[i]
        return bound > 0 and (len(best) < self.k or (-bound, least_id) < best[-1])

    def _page(self, tree: Tree, i: int, first: int, last: int, terms: np.ndarray, weights: np.ndarray) -> None:
        a, b = tree.offsets[first], tree.offsets[last]
        place = np.searchsorted(terms, tree.terms[a:b])
        hit = np.nonzero(terms[np.minimum(place, len(terms) - 1)] == tree.terms[a:b])[0]
        doc = np.repeat(np.arange(last - first), np.diff(tree.offsets[first:last + 1]))[hit]
        score = np.zeros(last - first, np.int64)
        np.add.at(score, doc, weights[place[hit]] * part_of_score(tree.tfs[a + hit], tree.m[first + doc]))
        self.scored += last - first
        best = self.best[i]
        good = np.nonzero(score > 0 if len(best) < self.k else score >= -best[-1][0])[0]
        if len(good):
            best.extend(zip((-score[good]).tolist(), tree.ids[first + good].tolist()))
            best.sort()
            del best[self.k:]


def trees_of(batch: pa.RecordBatch, rank: np.ndarray, n_docs: int, n_terms: int, page: int,
             most: int) -> Iterator[Tree]:
    """FP-trees of the documents of a batch that hold any of the terms."""
    listed = batch.column(2)
    offsets = listed.offsets.to_numpy().astype(np.int64)
    terms = rank[listed.values.to_numpy()[offsets[0]:offsets[-1]]]
    tfs = batch.column(3).values.to_numpy()[batch.column(3).offsets[0].as_py():][:len(terms)].astype(np.int64)
    offsets = offsets - offsets[0]
    ids = batch.column(0).fill_null(_NO_ID).to_numpy()
    m = np.array([75 + (25 * n * n_docs) // n_terms for n in batch.column(1).to_pylist()], np.int64)
    doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
    sort = np.lexsort((terms, doc))
    terms, tfs = terms[sort], tfs[sort]
    keep = np.nonzero(np.diff(offsets) > 0)[0]
    at = 0
    while at < len(keep):
        full = np.searchsorted(offsets, offsets[keep[at]] + most, side="right") - 1
        to = max(int(np.searchsorted(keep, full)), at + 1)
        rows = keep[at:to]
        a, b = offsets[rows[0]], offsets[rows[-1] + 1]
        ends = np.concatenate([[a], offsets[rows + 1]]) - a
        yield Tree(ids[rows], m[rows], ends, terms[a:b], tfs[a:b], page)
        at = to


def search_block(docs: DataFrame, items: list, k: int, page: int = PAGE, tree_entries: int = TREE_ENTRIES) -> DataFrame:
    """item_id, place (the item's place in the block), doc_id, score: each task's best of each item."""
    spark = docs.sparkSession
    wanted = [Counter(terms_of(r["text"].encode() if r["text"] else None)) for r in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    vectors = materialize(term_vectors(docs, vocabulary), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        held[r["t"]] = r["count"]
    by_frequency = np.argsort(-held, kind="stable")
    rank = np.empty(len(vocabulary), np.int64)
    rank[by_frequency] = np.arange(len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()]
    asked = []
    for terms in wanted:
        own = sorted((int(rank[t]), weight[t] * n) for t, n in ((vocabulary[w], n) for w, n in terms.items()) if held[t])
        asked.append((np.array([t for t, _ in own], np.int64), np.array([w for _, w in own], np.int64)))
    shared = spark.sparkContext.broadcast((asked, rank, [r["item_id"] for r in items]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, rank, names = shared.value
        searcher = Searcher(asked, k)
        for batch in batches:
            for tree in trees_of(batch, rank, n_docs, n_terms, page, tree_entries):
                searcher.search(tree)
        found = [(names[i], i, x if x != _NO_ID else None, -s) for i, best in enumerate(searcher.best) for s, x in best]
        for at in range(0, len(found), 50_000):
            part = list(zip(*found[at:at + 50_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(part, (kind, pa.int32(), pa.int64(), pa.int64()))],
                names=["item_id", "place", "doc_id", "score"])

    text_ids = bool(items) and isinstance(items[0]["item_id"], str)
    kind = pa.string() if text_ids else pa.int64()
    return vectors.mapInArrow(
        searched, f"item_id {'string' if text_ids else 'long'}, place int, doc_id long, score long")


def rank_documents(docs: DataFrame, benchmark: DataFrame, k: int = 20, page: int = PAGE,
                   tree_entries: int = TREE_ENTRIES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item.

    Every benchmark row is an item of its own, also one that repeats an id or text or
    has no id; an item without terms, or whose terms no document holds, gives no rows.  Every
    document row counts, repeated ones too; null and termless texts count nowhere.
    Equal scores go by ascending doc_id; a row without doc_id takes part and comes last among
    equals.  Empty tables give an empty result; other columns are not carried.  Items are
    searched in blocks (``BLOCK_ITEMS``, ``BLOCK_CHARS``), so what the driver and the
    tasks hold of them is bounded; ids are whole numbers (an item's may be text).
    ``page`` and ``tree_entries`` size the trees; no result depends on them.
    """
    spark = docs.sparkSession
    ids = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"item_id {ids}, rank int, doc_id long, score long"
    out = scratch_path(spark, "ranked")
    best = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    wrote = False
    asked = benchmark.select(F.col("item_id").cast("string" if ids == "string" else "long").alias("item_id"), "text")
    for items in table_rows_in_blocks(asked, "text", BLOCK_ITEMS, BLOCK_CHARS):
        found = search_block(docs, items, k, page, tree_entries).withColumn("rank", F.row_number().over(best))
        (found.where(F.col("rank") <= k).select(F.col("item_id").cast(ids).alias("item_id"), "rank", "doc_id", "score")
         .write.mode("append").parquet(out))
        wrote = True
    return spark.read.schema(schema).parquet(out) if wrote else spark.createDataFrame([], schema)
