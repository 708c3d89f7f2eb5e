import hashlib
import random
import re

from helpers import ascii_lower, documents, rows
from pyspark.sql import functions as F

from loadsmith.llm import decontam
from loadsmith.llm.decontam import decontaminate, remove_contaminated, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(texts, items, n=10):
    wins = {}
    for item, text in items:
        w = WORD.findall(ascii_lower(text or ""))
        for s in range(max(len(w) - n + 1, 1) if w else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(str(item))
    out = []
    for text in texts:
        w = WORD.findall(ascii_lower(text or ""))
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for s in range(len(w) - size + 1):
                if (got := wins.get(tuple(w[s:s + size]))):
                    hit.update(range(s, s + size))
                    found |= got - {"None"}
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def fixture():
    rng = random.Random(1)
    vocabulary = ["the", "of", "Été", "ÉTÉ", "straße", "x1", "9", "word", "longerword", "a"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(25)]
    items += [(100, None), (101, "..."), (None, "one two THREE"), (7, items[3][1])]
    texts = [None, "", "...", "one, Two-three!", "one two\x7fthree four"]
    for _ in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 15)))]
        if rng.random() < 0.6:
            parts.append(rng.choice(items)[1] or "")
        parts.append("!" + " ".join(rng.choices(vocabulary, k=rng.randint(0, 9))).upper())
        texts.append(rng.choice([" ", "\n-- "]).join(parts))
    texts.append(" ".join(rng.choices(vocabulary, k=30_000)) + " " + items[5][1])
    return texts + texts[5:9], items


def test_against_plain_python(spark):
    texts, items = fixture()
    ids = [None if i % 17 == 3 else i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids).selectExpr("*", "'clash' as items", "1 as k1")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((i, *w) for i, w in zip(ids, plain(texts, items))), key=repr)
    assert rows(decontaminate(docs, bench)) == want


def test_words_part_at_the_same_characters(spark):
    chars = [chr(c) for c in (*range(0x600), *range(0x2000, 0x2100), 0x212A, 0x3000, 0xFEFF, 0xFFFF, 0x1F44D, 0x10FFFF)]
    texts = [f"a{c}b {c}{c} Z{c}" for c in chars] + [None, ""]
    got = documents(spark, texts).select("doc_id", words(F.col("text")).alias("w")).orderBy("doc_id").collect()
    assert [r["w"] for r in got] == [WORD.findall(ascii_lower(t or "")) for t in texts]


def test_word_class_lists_its_characters_singly():
    assert re.fullmatch(r"\[\^(\\x[0-9A-F]{2})+\]\+", decontam._WORD)  # ranges took Spark several times as long
    assert [c for c in map(chr, range(0x250)) if re.match(decontam._WORD, c)] == [c for c in map(chr, range(0x250)) if WORD.match(c)]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    none = hashlib.sha256(b"").hexdigest()
    assert rows(decontaminate(documents(spark, ["a b", None]), bench)) == [(0, 2, 0, 0, none, False), (1, 0, 0, 0, none, False)]
    assert decontaminate(documents(spark, []), bench).collect() == []


def test_stage_cuts_passages_and_keeps_clean_documents(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    clean = "some clean text about other things, with alpha beta in it. " * 3
    texts = [clean, f"({clean}) {passage.upper()}! {clean}", passage, None, "", clean]
    docs = documents(spark, texts, ids=[0, 1, 2, None, 4, 0]).selectExpr("*", "'x' as _hit2", "2 as _left2")
    left = remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    got = rows(left, "doc_id", "text")
    cut = next(t for i, t in got if i == 1)
    assert "alpha beta gamma" not in cut.lower() and "clean text" in cut and cut.startswith("(some")
    assert [g for g in got if g[0] != 1] == sorted([(0, clean), (0, clean), (None, None), (4, "")], key=repr)
