import zlib
from collections import Counter

from helpers import documents

from loadsmith.llm.sharding import interleaved_shards


def test_counts_mixture_and_slots(spark):
    n, k = 3000, 24
    sources = ["hot" if i % 3 else f"s{i % 40}" if i % 7 else None for i in range(n)]
    texts = [None if i % 50 == 0 else "" if i % 50 == 1 else f"text é {i % 100}" for i in range(n)]
    docs = documents(spark, texts, ids=[None if i % 90 == 5 else i // 2 for i in range(n)], sources=sources)
    got = interleaved_shards(docs.selectExpr("*", "1 as shard", "2 as at", "3 as fraction"), k).collect()
    assert len(got) == n
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(k)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(k):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    key = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert key == Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
                          for r in docs.collect())
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_every_shard_has_the_mixture(spark):
    n, k = 2400, 24
    docs = documents(spark, [f"t{i}" for i in range(n)], sources=["hot" if i % 3 else f"s{i % 8}" for i in range(n)])
    by_id = {r["doc_id"]: r["source"] for r in docs.collect()}
    whole = Counter(by_id.values())
    shares = {}
    for r in interleaved_shards(docs, k).collect():
        shares.setdefault(r["shard"], Counter())[by_id[r["doc_id"]]] += 1
    for share in shares.values():
        for source, all_ in whole.items():
            assert abs(share[source] - all_ / k) <= 2


def test_same_rows_same_shards_and_empty_table(spark):
    docs = documents(spark, [f"t{i}" for i in range(100)])
    a, b = ({r["doc_id"]: (r["shard"], r["slot"]) for r in interleaved_shards(d).collect()}
            for d in (docs, docs.repartition(7)))
    assert a == b
    assert interleaved_shards(documents(spark, [])).collect() == []
    assert len(interleaved_shards(documents(spark, ["a", "b"])).collect()) == 2
