"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.llm.common import table

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_topk_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.topk_mtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op2_langid_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.langid_hd import identify_languages

    return identify_languages(table(spark, sf_dir, "documents"))


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.lsh_forest import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from loadsmith.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op5_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.html_consensus import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.debruijn import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from loadsmith.llm.wordpiece_count import count_tokens, marked_vocabulary

    first, later = marked_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model")))
    return count_tokens(table(spark, sf_dir, "documents"), first, later)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.decontam import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.url_trie import judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.sharding import interleaved_shards

    return interleaved_shards(table(spark, sf_dir, "documents"))


def op11_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.bottom_k import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("sketch", "").alias("fingerprint"), F.array_join("edited_sketch", "").alias("edited_fingerprint"),
        "near_edited", "near_next")


def op12_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.fp_tree import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_rollup_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsmith.llm.collocations import mine_phrases

    return mine_phrases(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_topk_mtree, op2_langid_hd, op3_lsh_forest, op4_best_fit_packing, op5_html_consensus, op6_debruijn_dedup,
    op7_wordpiece_counts, op8_decontaminate, op9_url_trie, op10_interleave, op11_bottom_k, op12_fp_tree_search,
    op13_rollup_phrases)}

ORACLE = {
    "op1_topk_mtree": """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
""",
    "op6_debruijn_dedup": r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
    SELECT r, s, md5(array_to_string(list_slice(w, s, s + 34), ' ')) AS h
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
again AS (SELECT r, s FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS pos FROM again),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
    SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
    FROM words ANTI JOIN gone USING (r, pos) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
    sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""",
    "op8_decontaminate": r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
    SELECT DISTINCT item_id, list_slice(w, s, s + least(10, len(w)) - 1) AS win, least(10, len(w)) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
hits AS (
    SELECT d.r, p.s, wins.n, wins.item_id
    FROM (SELECT DISTINCT n FROM wins) AS sizes, d, unnest(range(1, len(d.w) - sizes.n + 2)) AS p(s)
    JOIN wins ON wins.n = sizes.n AND wins.win = list_slice(d.w, p.s, p.s + sizes.n - 1)),
spots AS (SELECT r, count(DISTINCT spot) AS n_hit
    FROM (SELECT r, unnest(range(s, s + n)) AS spot FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(spots.n_hit, 0) AS n_hit,
    coalesce(items.n_items, 0) AS n_items, sha256(coalesce(items.listed, '')) AS items_sha256,
    coalesce(spots.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (r) LEFT JOIN items USING (r)
""",
    "op9_url_trie": r"""
WITH p AS (
    SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(url, '://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM pages),
r AS (
    SELECT *, CASE
        WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
        WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/' END AS rule
    FROM p)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
""",
    "op10_interleave": r"""
WITH RECURSIVE bits AS (
    SELECT i, 0 AS step, i AS c FROM (SELECT unnest(range(256)) AS i)
    UNION ALL
    SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
d AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b, coalesce('=' || source, '') AS stratum,
        left(md5(concat_ws(' ', '11', doc_id, coalesce(text, ''))), 16) AS shuffled
    FROM documents),
f AS (
    SELECT doc_id, b, shuffled, (row_number() OVER (PARTITION BY stratum ORDER BY shuffled, doc_id NULLS FIRST) - 1
        + CAST(CAST('0x' || left(md5('11 ' || stratum), 5) AS BIGINT) AS DOUBLE) / 1048576)
        / count(*) OVER (PARTITION BY stratum) AS fraction
    FROM d),
p AS (
    SELECT doc_id, b, row_number() OVER (ORDER BY fraction, shuffled, doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM f),
s AS (SELECT *, (place * 24) // n AS shard FROM p)
SELECT doc_id, CAST(octet_length(b) + 8 AS BIGINT) AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(b), '..'), lambda x: CAST('0x' || x AS BIGINT)),
        lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32,
    'rows' AS law, CAST(shard AS INTEGER) AS shard, place - (shard * n + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s, crc
""",
    "op11_bottom_k": r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER o AS after, first_value(coalesce(text, '')) OVER o AS first
    FROM documents WINDOW o AS (ORDER BY doc_id)),
e AS (
    SELECT doc_id, t, coalesce(after, first) AS nx,
        left(t, length(t) - length(t) // 2) || left(coalesce(after, first), length(t) // 2) AS e FROM d),
w AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS tw, regexp_extract_all(e, '[^\x20\x09-\x0D]+') AS ew,
        regexp_extract_all(nx, '[^\x20\x09-\x0D]+') AS nw FROM e),
s AS (
    SELECT doc_id, t, e,
        list_slice(list_sort(list_distinct(list_transform(range(1, CASE WHEN len(tw) = 0 THEN 1 ELSE greatest(len(tw) - 4, 1) + 1 END),
            lambda i: substr(md5(array_to_string(list_slice(tw, i, i + 4), ' ')), 1, 12)))), 1, 128) AS a,
        list_slice(list_sort(list_distinct(list_transform(range(1, CASE WHEN len(ew) = 0 THEN 1 ELSE greatest(len(ew) - 4, 1) + 1 END),
            lambda i: substr(md5(array_to_string(list_slice(ew, i, i + 4), ' ')), 1, 12)))), 1, 128) AS b,
        list_slice(list_sort(list_distinct(list_transform(range(1, CASE WHEN len(nw) = 0 THEN 1 ELSE greatest(len(nw) - 4, 1) + 1 END),
            lambda i: substr(md5(array_to_string(list_slice(nw, i, i + 4), ' ')), 1, 12)))), 1, 128) AS c
    FROM w),
u AS (
    SELECT *, list_slice(list_sort(list_distinct(a || b)), 1, 128) AS ab, list_slice(list_sort(list_distinct(a || c)), 1, 128) AS ac
    FROM s)
SELECT doc_id, length(t) AS n_chars, sha256(e) AS edited_sha256, array_to_string(a, '') AS fingerprint,
    array_to_string(b, '') AS edited_fingerprint,
    CASE WHEN len(ab) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect(ab, a), b))::DOUBLE / len(ab) END AS near_edited,
    CASE WHEN len(ac) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect(ac, a), c))::DOUBLE / len(ac) END AS near_next
FROM u
""",
    "op12_fp_tree_search": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, list_transform(regexp_extract_all(coalesce(text, ''),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
b AS (
    SELECT row_number() OVER () AS q, item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'))) AS term FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
words AS (SELECT r, unnest(w) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM b) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, c GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 75 + (25 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0),
s AS (
    SELECT b.q, b.item_id, m.r, m.doc_id, CAST(sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m))) AS BIGINT) AS score
    FROM b JOIN tf USING (term) JOIN wt USING (term) JOIN m ON m.r = tf.r GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
""",
    "op13_rollup_phrases": r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS (
    SELECT lang, size, phrase, count(*) AS f FROM (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
            lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS phrase
        FROM w, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
    GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
    SELECT lang, phrase, size, f AS a, k, array_to_string(list_slice(w, 1, k), ' ') AS p1,
        array_to_string(list_slice(w, k + 1, size), ' ') AS p2
    FROM cand, (SELECT unnest([1, 2]) AS k) WHERE k < size),
scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.size, a, l.f AS l, r.f AS r,
        CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score, k
    FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = p1 JOIN f r ON r.lang = cuts.lang AND r.phrase = p2
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, part, max(f) AS top FROM (
        SELECT lang, f, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS part
        FROM cand WHERE size = 3) GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r,
    t.n, s.score
FROM scored s JOIN total t ON t.lang = s.lang LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.phrase AND s.size = 2
WHERE 100 * coalesce(i.top, 0) < 50 * s.a
QUALIFY rank <= 2000
""",
}
