import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import ascii_lower, documents, rows

from loadsmith.llm import fp_tree
from loadsmith.llm.fp_tree import Searcher, Tree, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [ascii_lower(t) for t in TERM.findall(text or "")]


def plain(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in counts:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def fixture(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "of", "Été", "ÉTÉ", "straße", "x1", "9", "word", "東京"] + [f"w{i}" for i in range(60)]
    weights = [40, 30] + [200 / (i + 5) for i in range(len(words) - 2)]
    texts = [None, "", "...", "THE the The", "w1_w2-w3"]
    texts += [rng.choice([" ", ", ", "\x7f"]).join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200]))) for _ in range(n)]
    texts += [texts[20]] * 45 + [" ".join(rng.choices(words, weights, k=20_000))]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(25)]
    items += [(100, None), (101, "?!"), (None, "w1 w2 w2"), (3, "w5 THE"), (3, "w5 THE"), (200, "nowhere found")]
    return texts, items


@pytest.mark.parametrize("page, entries", [(48, 1 << 20), (4, 1 << 20), (1, 300)])
def test_against_plain_python(spark, page, entries):
    texts, items = fixture(page)
    ids = [None if i % 40 == 7 else 1000 - i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids).selectExpr("*", "'clash' as terms", "1 as n", "2 as item_id", "3 as rank")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 as doc_id", "6 as place")
    assert rows(rank_documents(docs.repartition(3), bench, page=page, tree_entries=entries)) == plain(list(zip(ids, texts)), items)


def test_items_in_blocks_and_as_text(spark, monkeypatch):
    monkeypatch.setattr(fp_tree, "BLOCK_ITEMS", 4)
    texts, items = fixture(9, 40)
    items = [(str(i), t) for i, t in items]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = documents(spark, texts)
    assert rows(rank_documents(docs, bench, 3)) == plain(list(enumerate(texts)), items, 3)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert rank_documents(documents(spark, []), bench).collect() == []
    assert rank_documents(documents(spark, [None, "..."]), bench).collect() == []
    assert rank_documents(documents(spark, ["some words"]), bench.limit(0)).collect() == []


def tree_of(vectors, page):
    offsets = np.cumsum([0, *map(len, vectors)])
    terms_, tfs = (np.array([x[j] for v in vectors for x in v], np.int64) for j in (0, 1))
    rng = random.Random(2)
    m = np.array([75 + rng.randrange(100) for _ in vectors], np.int64)
    return Tree(np.arange(len(vectors)), m, offsets, terms_, tfs, page)


def test_tree_shares_paths_bounds_hold_and_nodes_are_left_out():
    rng = random.Random(1)
    vectors = [sorted((t, rng.randint(1, 9)) for t in range(40) if rng.random() < 1 / (1 + t / 4)) or [(0, 1)] for _ in range(2000)]
    tree = tree_of(vectors, 8)
    own = {int(i): dict(vectors[int(i)]) for i in tree.ids}
    for node in range(len(tree.first)):
        ids = tree.ids[tree.first[node]:tree.last[node]]
        peak = Counter()
        for i in ids:
            for t, n in own[int(i)].items():
                peak[t] = max(peak[t], n)
        here = tree.of_node == node
        assert dict(zip(tree.of_term[here].tolist(), tree.peak[here].tolist())) == dict(peak)
        assert tree.least_m[node] == tree.m[tree.first[node]:tree.last[node]].min() and tree.least_id[node] == ids.min()
        if kids := tree.children[node]:
            assert [tree.first[kids[0]], tree.last[kids[-1]]] == [tree.first[node], tree.last[node]]
    searcher = Searcher([(np.array([20, 25, 30, 35]), np.array([3000, 4000, 5000, 6000]))], 20)
    searcher.search(tree)
    assert len(searcher.best[0]) == 20 and searcher.scored < 1200
