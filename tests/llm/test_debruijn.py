import hashlib
import random

import numpy as np
import pytest
from helpers import SPACED, documents, rows

from loadsmith.llm import debruijn
from loadsmith.llm.debruijn import SpanHashes, cut_repeats, remove_repeats, repeated_spans, super_kmers


def plain(texts, k):
    words = [SPACED.findall(t or "") for t in texts]
    count = {}
    for w in words:
        for s in range(len(w) - k + 1):
            key = tuple(w[s:s + k])
            count[key] = count.get(key, 0) + 1
    out = []
    for w in words:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            if count[tuple(w[s:s + k])] > 1:
                gone[s:s + k] = [True] * k
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def fixture(rng, k):
    def words(n, alphabet=60):
        return [f"w{rng.randrange(alphabet)}" for _ in range(n)]

    passages = [words(n) for n in (k - 1, k, k + 1, 2 * k, 5 * k)]
    texts = [None, "", " \n", "a", " ".join(["x"] * (3 * k)), " ".join(["x", "y"] * k), " ".join(["x", "y", "z"] * 3 * k)]
    for _ in range(60):
        t = words(rng.randrange(0, 4 * k))
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 2 + 1)
            t += p[a:a + rng.randrange(1, len(p) + 1)] + words(rng.randrange(0, k))
        texts.append("  ".join(t) if rng.random() < 0.2 else " ".join(t) + "\n")
    texts += [" ".join(words(12 * k))] * 40 + [" ".join(words(9 * k, 2)) for _ in range(8)]
    base = words(10 * k)
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randrange(0, 5)):
            near[rng.randrange(len(near))] = f"n{rng.randrange(10 ** 6)}"
        texts.append(" ".join(near))
    texts.append(" ".join(words(8000, 3000)) + " " + " ".join(base))
    texts.append(texts[-1].replace(" ", "\t"))
    return texts


@pytest.mark.parametrize("k,broadcast", [(35, True), (9, True), (12, False), (3, True)])
def test_against_brute_force(spark, monkeypatch, k, broadcast):
    if not broadcast:
        monkeypatch.setattr(debruijn, "small_enough", lambda df: df)
    rng = random.Random(k)
    texts = fixture(rng, k)
    ids = [None if i % 19 == 4 else i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids).selectExpr("*", "1 as k1", "2 as spans", "3 as lo")
    want = sorted(((i, *p) for i, p in zip(ids, plain(texts, k))), key=repr)
    assert rows(remove_repeats(docs, k)) == want


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = df.collect()
    want = sorted(((r["doc_id"], *p) for r, p in zip(data, plain([r["text"] for r in data], 35))), key=repr)
    assert rows(remove_repeats(df)) == want


def test_super_kmers_partition_the_kmers_and_agree_on_equal_ones():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    h = np.concatenate([h, h[100:200], h[:50]])
    lo, hi, m, _ = super_kmers(h, 20)
    assert lo[0] == 0 and hi[-1] == len(h) - 19 and (lo[1:] == hi[:-1]).all()
    of = np.repeat(m, hi - lo)
    assert (of[100:181] == of[400:481]).all()


def test_span_hashes_depend_on_content_only():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    twice = SpanHashes(np.concatenate([h, h]))
    a, b = np.array([3, 0, 17]), np.array([40, 1, 18])
    for x, y in zip(twice.of(a, b), twice.of(a + 300, b + 300)):
        assert (x == y).all()
    assert len({int(v) for v in twice.of(np.arange(250), np.arange(250) + 30)[0]}) == 250


def test_paths_are_compacted(spark):
    """A passage between different surroundings is one path and not a row per super-k-mer."""
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(1500)]
    texts = [" ".join([f"a{rng.random()}"] * 1 + passage + [f"z{rng.random()}"]) for _ in range(3)]
    spans = [s for r in repeated_spans(documents(spark, texts)).collect() for s in r["spans"] if s["times"] is not None]
    assert len(spans) == 3 and all(s["times"] == 3 and s["hi"] - s["lo"] > 1300 for s in spans)


def test_empty_table(spark):
    assert remove_repeats(documents(spark, [])).collect() == []
    assert cut_repeats(documents(spark, [])).collect() == []


def test_stage_cuts_words_and_keeps_the_rest(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"start  of one\n{passage} end one", f"other start {passage} other end", passage, "clean  text\n here", None, "",
             "clean  text\n here"]
    docs = documents(spark, texts, [0, 1, 2, None, 4, 5, 3]).selectExpr("*", "'c' as spans", "'d' as k1")
    left = cut_repeats(docs)
    assert left.columns == docs.columns
    assert rows(left, "doc_id", "text") == sorted([
        (0, "start of one end one"), (1, "other start other end"), (None, texts[3]), (4, None), (5, ""), (3, texts[3])], key=repr)
