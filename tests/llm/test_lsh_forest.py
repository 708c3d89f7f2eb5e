import random
from collections import Counter

import numpy as np
import pytest
from helpers import SPACED, ascii_lower, documents, rows

from loadsmith.llm import lsh_forest
from loadsmith.llm.components import connected_components
from loadsmith.llm.lsh_forest import drop_near_duplicates, near_duplicates


def shingles(text, n):
    w = SPACED.findall(ascii_lower(text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain(texts, ids, n=2, num=80, den=100):
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(texts)):
        groups.setdefault(find(i), []).append(ids[i])
    names = {g: min((x for x in members if x is not None), default=None) for g, members in groups.items()}
    out = []
    for i, s in enumerate(sets):
        component = names[find(i)] if s else ids[i]
        out.append((ids[i], len(s), component, ids[i] == component))
    return sorted(out, key=repr)


def near_copy(rng, words, edits):
    w = words.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 9)}"
    return " ".join(w)


def fixture(rng, groups=25, hot=150):
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(30, 120))) for _ in range(groups)]
    texts = [near_copy(rng, b, rng.randrange(0, 1 + len(b.split()) // 12)) for b in base for _ in range(rng.randint(1, 9))]
    big = " ".join(f"w{rng.randrange(400)}" for _ in range(100))
    texts += [near_copy(rng, big, rng.randrange(0, 9)) for _ in range(hot)] + [big] * hot
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(60)) for _ in range(60)]
    return texts + [None, "", " \t\n", "one", "One", "one two", "ONE TWO", "É x", "é x", "one two", "x " * 5000, "x x"]


@pytest.mark.parametrize("n,small,block", [(2, 64, 512), (5, 8, 16)])
def test_against_brute_force(spark, monkeypatch, n, small, block):
    monkeypatch.setattr(lsh_forest, "SMALL", small)
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    monkeypatch.setattr(lsh_forest, "CROWDED", 40)
    rng = random.Random(n)
    texts = fixture(rng)
    rng.shuffle(texts)
    ids = [None if i % 40 == 7 else i if i % 11 else 3 * i for i in range(len(texts))]
    docs = documents(spark, texts, ids).selectExpr("*", "1 as k1", "2 as cls", "3 as kept")
    got = rows(near_duplicates(docs, n), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain(texts, ids, n)


def test_whole_table_has_every_link(spark):
    """All pairs of the table that an inverted index of rare shingles can reach, verified on sets."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = rows(near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain([r["text"] for r in docs], [r["doc_id"] for r in docs])


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2))
    same = np.mean(lsh_forest.signature(s[:2000]) == lsh_forest.signature(s[500:2500]))
    assert abs(same - 1500 / 2500) < 0.12


def test_common_shingles():
    rng = np.random.default_rng(2)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(n)] for n in (7, 9))
    got = lsh_forest.common_shingles(left, right, width=16)
    assert got.tolist() == [[len(set(a) & set(b)) for b in right] for a in left]


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert drop_near_duplicates(documents(spark, [])).collect() == []


def test_stage_keeps_one_of_each_group(spark):
    rng = random.Random(9)
    texts = fixture(rng, groups=8, hot=20)
    ids = [None if i % 30 == 7 else i for i in range(len(texts))]
    docs = documents(spark, texts + [texts[0]] * 2, ids + [ids[0]] * 2).selectExpr("*", "1 as _me", "'c' as root")
    docs = docs.withColumnRenamed("_me", "me")
    left = drop_near_duplicates(docs, 5)
    assert left.columns == docs.columns
    want = plain(texts, ids, 5)
    wordless = sum(not shingles(t, 5) for t in texts)
    components = {c for _, n, c, _ in want if n and c is not None}
    got = [r for r in left.collect() if shingles(r["text"], 5)]
    assert {r["doc_id"] for r in got if r["doc_id"] is not None} == components
    assert all(v == 1 for v in Counter(r["doc_id"] for r in got if r["doc_id"] is not None).values())
    assert left.count() - len(got) == wordless


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loops = [(5000, 5000), (6000, 6001), (6001, 6000), (6001, 6002), (6000, 6002)]
    df = spark.createDataFrame(chain + star + loops, "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(300)} == {1000}
    assert got[6002] == got[6001] == got[6000] == 6000 and 5000 not in got
    assert connected_components(df.limit(0)).collect() == []


def test_thresholds_below_the_forests_are_refused(spark):
    docs = documents(spark, ["a b c d", "a b c e"])
    for find in (near_duplicates, drop_near_duplicates):
        for low in [(60, 100), (7, 9)]:
            with pytest.raises(ValueError, match="below"):
                find(docs, threshold=low)
