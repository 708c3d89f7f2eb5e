import zlib

import numpy as np
from helpers import documents, rows

from loadsmith.llm.langid_hd import (NgramVectors, identify_languages, keep_known_languages, learn_prototypes,
                                     ngram_counts)

SF = "/root/testdata/sf0.01"


def test_ngrams_of_slices_equal_ngrams_of_the_whole(monkeypatch):
    text = "The naïve Größe -- 12 of  the\n\nÉtat. " * 40 + "end"
    code, count = ngram_counts(text)
    monkeypatch.setattr("loadsmith.llm.langid_hd._SLICE", 7)
    code7, count7 = ngram_counts(text)
    assert code.tolist() == code7.tolist() and count.tolist() == count7.tolist()
    letters = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    grams = [letters[i:i + 3] for i in range(len(letters) - 2)]
    assert sum(count) == len(grams) and len(code) == len(set(grams))


def test_vectors_bind_permuted_letters():
    v = NgramVectors(64, 1)
    codes, counts = ngram_counts("ab")
    assert sorted(codes.tolist()) == sorted([(32 << 42) | (97 << 21) | 98, (97 << 42) | (98 << 21) | 32])
    want = sum(np.roll(v._letter(c >> 42), 2) * np.roll(v._letter((c >> 21) & 0x1FFFFF), 1) * v._letter(c & 0x1FFFFF)
               for c in codes.tolist())
    assert np.allclose(v.bundle(codes, counts), want)


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in identify_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(got) == len(truth)
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in set(out)) for i in truth)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in out]) > 0.95
    # labels of held-out rows, and source, change nothing
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 'zz', lang) as lang",
                            "'q' as source")
    assert rows(identify_languages(other), "doc_id", "lang_pred") == rows(identify_languages(docs), "doc_id", "lang_pred")


def test_edge_rows(spark):
    texts = [None, "", "12 %$ 34", "hello there world", "hello there", "bonjour le monde", "x" * 3_000_000, "hello there world"]
    ids = [0, 1, 2, None, 4, 6, None, None]
    docs = documents(spark, texts, ids, langs=["en", "en", "en", "en", None, "fr", "en", "en"])
    got = rows(identify_languages(docs.selectExpr("*", "'c' as lang_pred", "1 as score", "1 as x")), "doc_id", "lang_pred")
    assert [(0, "und"), (1, "und"), (2, "und")] == [g for g in got if g[1] == "und"]
    assert len(got) == len(texts)
    nothing = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in identify_languages(nothing).collect()} == {"und"}
    assert identify_languages(documents(spark, [])).collect() == []
    assert learn_prototypes(documents(spark, [])).collect() == []


def test_stage_keeps_columns_and_clean_documents(spark):
    texts = ["the cat and the dog", None, "", "%% 12", "le chat et le chien", "the cat and the dog"]
    docs = documents(spark, texts, [0, 2, 3, 4, 6, 0], langs=["en"] * 4 + ["fr", "en"]).selectExpr("*", "'y' as score")
    left = keep_known_languages(docs)
    assert left.columns == docs.columns
    assert rows(left, "doc_id", "text") == [(0, texts[0]), (0, texts[0]), (6, texts[4])]


def test_stage_keeps_clean_one_word_documents(spark):
    """Every single word of the labelled texts is clean, whatever its cosine; letters alone never drop a text."""
    labelled = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    words = sorted({w for r in labelled.limit(200).collect() for w in (r["text"] or "").split() if any(map(str.isalpha, w))})[::5]
    nonsense = ["xqzjkvwpxq", "ζξψωθφχ", "東龍京飛", "deadbeefcafe"]
    none = ["12 %%", "", "--- 3.5 ---"]
    more = spark.createDataFrame([(-1 - i, w, None) for i, w in enumerate(words + nonsense + none)], labelled.schema)
    left = {r["doc_id"]: r["text"] for r in keep_known_languages(labelled.union(more)).where("doc_id < 0").collect()}
    assert left == {-1 - i: w for i, w in enumerate(words + nonsense)}
