import hashlib
import random
import re

import pytest
from helpers import SPACED, documents, rows
from pyspark.sql import functions as F

from loadsmith.llm import bottom_k
from loadsmith.llm.queries import op11_bottom_k


def shingles(text, n=5):
    w = SPACED.findall(text or "")
    return {hashlib.md5(" ".join(w[i:i + n]).encode()).hexdigest()[:12] for i in range(max(len(w) - n + 1, 1))} if w else set()


def sketch(text, k=128):
    return sorted(shingles(text))[:k]


def likeness(a, b, k=128):
    u = sorted({*a, *b})[:k]
    return len({*u} & {*a} & {*b}) / len(u) if u else 1.0


def plain(docs):
    """docs: (doc_id, text) in the order of the operator, without null ids."""
    out = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = sketch(text), sketch(edited), sketch(after)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b),
                    likeness(a, b), likeness(a, c)))
    return out


def texts(rng, n):
    words = ["a", "Ab", "été", "𝒳y", "z", "the", "of", "x."]
    made = [None, "", " \t\n", "one", "one two", " nbsp  kept"]
    made += [rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=rng.choice([3, 4, 5, 6, 40, 400]))) for _ in range(n)]
    made.append(" ".join(rng.choices(words + [str(i) for i in range(3000)], k=30_000)))
    return made


def run(spark, tmp_dir, docs):
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    return op11_bottom_k(spark, tmp_dir)


@pytest.mark.parametrize("stretch", [2000, 7, 1])
def test_against_plain_python(spark, tmp_dir, monkeypatch, stretch):
    monkeypatch.setattr(bottom_k, "STRETCH_ROWS", stretch)
    rng = random.Random(3)
    made = texts(rng, 60)
    made += made[5:25]
    ids = rng.sample(range(-50, 500), len(made))
    docs = documents(spark, made, ids).selectExpr("*", "'clash' as sketch", "1 as at", "2 as guest", "3 as k1", "4 as turn")
    assert rows(run(spark, tmp_dir, docs.repartition(5))) == sorted(plain(sorted(zip(ids, made))), key=repr)


def test_many_stretches_need_groups_of_bounds(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(bottom_k, "STRETCH_ROWS", 1)
    made = [f"document number {i} of them all and more words here {i}" for i in range(300)]
    assert rows(run(spark, tmp_dir, documents(spark, made, [3 * i for i in range(300)]))) == sorted(
        plain([(3 * i, t) for i, t in enumerate(made)]), key=repr)


def test_one_row_no_rows_no_ids(spark, tmp_dir):
    one = documents(spark, ["alone here"], [7])
    assert rows(run(spark, f"{tmp_dir}/1", one)) == plain([(7, "alone here")])
    assert op_rows(spark, f"{tmp_dir}/0", documents(spark, [])) == []
    got = op_rows(spark, f"{tmp_dir}/n", documents(spark, ["some words stand here", None, "next one"], [None, None, 4]))
    cut = hashlib.sha256(b"some words ").hexdigest()
    assert [(r[0], r[2]) for r in got if r[1] == 21] == [(None, cut)] and len(got) == 3


def op_rows(spark, where, docs):
    return rows(run(spark, where, docs))


def test_repeated_rows_follow_one_another(spark, tmp_dir):
    made = ["same text of several words here", "same text of several words here", "other text"]
    got = op_rows(spark, tmp_dir, documents(spark, made, [1, 1, 2]))
    assert got == sorted(plain(list(zip([1, 1, 2], made))), key=repr)


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(5)
    words = [str(i) for i in range(4000)]
    parts = [" ".join(rng.choices(words, k=rng.choice([0, 3, 50, 900]))) for _ in range(40)]
    groups = [None if i % 7 == 0 else i % 3 for i in range(40)]
    df = spark.createDataFrame(list(zip(groups, parts)), "g int, text string")
    merged = bottom_k.merge_sketches(bottom_k.sketch_texts(df), ["g"])
    want = {g: sorted(set().union(*(shingles(p) for x, p in zip(groups, parts) if x == g)))[:128] for g in set(groups)}
    assert {r["g"]: r["sketch"] for r in merged.collect()} == want
    full = {g: len(set().union(*(shingles(p) for x, p in zip(groups, parts) if x == g))) for g in set(groups)}
    counted = merged.select("g", bottom_k.distinct_shingles(F.col("sketch")).alias("n")).collect()
    assert all(abs(r["n"] - full[r["g"]]) < 0.35 * full[r["g"]] for r in counted)
    pair = spark.createDataFrame([("a b c d e f g h", "a b c d e f g h i j"), ("", "x"), ("", "")], "a string, b string")
    both = bottom_k.sketch_texts(bottom_k.sketch_texts(pair, "a", "sa"), "b", "sb")
    a, b = F.col("sa"), F.col("sb")
    u = bottom_k.merged(a, b)
    got = both.select(bottom_k.resemblance(a, b, u), bottom_k.containment(a, b, u), bottom_k.containment(b, a, u),
                      bottom_k.distinct_shingles(b)).collect()
    assert [tuple(r) for r in got] == [(4 / 6, 1.0, 4 / 6, 6.0), (0.0, 1.0, 0.0, 1.0), (1.0, 1.0, 1.0, 0.0)]


def test_no_python_in_the_plan(spark, tmp_dir):
    plan = run(spark, tmp_dir, documents(spark, ["a b c", "d e f"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
