"""The operators that return all columns of their input, on inputs whose columns bear their internal names."""

from pyspark.sql import functions as F

from helpers import documents, rows

from loadsmith.llm.debruijn import cut_repeats
from loadsmith.llm.decontam import remove_contaminated
from loadsmith.llm.langid_hd import keep_known_languages, predict_languages, learn_prototypes
from loadsmith.llm.lsh_forest import drop_near_duplicates
from loadsmith.llm.url_trie import judge_urls

NAMES = ["k1", "k2", "_k1", "_k2", "_d1", "_d2", "d0", "d1", "d7", "me", "_me", "no", "n", "root", "first", "stays", "cls", "sig",
         "rep", "spans", "todo", "lo", "hi", "m", "e", "c1", "c2", "weight", "_hit", "hit", "_pieces", "pieces", "_left", "rest",
         "items", "w", "pos", "word", "anchor", "judged", "_judged", "d_lang", "with.dot", "node", "component_id"]
PASSAGE = " ".join(f"passage{i}" for i in range(40))
TEXTS = [f"alpha beta gamma {PASSAGE} one two three", f"delta epsilon {PASSAGE} four five six", "a clean text of its own",
         "a clean text of its own", None, "", "%% 12"]


def wide(spark):
    df = documents(spark, TEXTS, ids=[0, 1, 2, 3, 4, 5, 6])
    return df.select("*", *(F.lit(f"own {n}").alias(n) for n in NAMES))


def unchanged(out, columns):
    assert out.columns == columns
    for r in out.collect():
        assert [r[n] for n in NAMES] == [f"own {n}" for n in NAMES]


def test_stages_keep_columns_of_any_name(spark):
    docs = wide(spark)
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    expected = {
        "language": ([0, 1, 2, 3], keep_known_languages(docs)),
        "near": ([0, 1, 2, 4, 5, 6], drop_near_duplicates(docs)),
        "cut": ([0, 1, 2, 3, 4, 5, 6], cut_repeats(docs)),
        "decontaminated": ([2, 3, 4, 5, 6], remove_contaminated(docs, bench)),
    }
    for ids, out in expected.values():
        unchanged(out, docs.columns)
        assert sorted(r[0] for r in rows(out, "doc_id")) == ids
    assert {t for i, t in rows(expected["cut"][1], "doc_id", "text") if i in (0, 1)} == {
        "alpha beta gamma one two three", "delta epsilon four five six"}
    unchanged(predict_languages(docs, learn_prototypes(docs)).drop("lang_pred", "score"), docs.columns)


def test_urls_keep_columns_of_any_name(spark):
    pages = wide(spark).withColumn("url", F.lit("http://a.org/x"))
    out = judge_urls(pages, [("allow", "org", "/")])
    unchanged(out.drop("host", "path", "rule", "verdict"), pages.columns)
    assert {tuple(r) for r in out.select("host", "path", "rule", "verdict").collect()} == {("a.org", "/x", "org/", "allow")}


def test_stages_take_empty_tables(spark):
    docs = wide(spark).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (keep_known_languages(docs), drop_near_duplicates(docs), cut_repeats(docs), remove_contaminated(docs, bench)):
        assert out.columns == docs.columns and out.collect() == []
