import random
import re
from collections import Counter

import pytest
from helpers import ascii_lower, documents, rows

from loadsmith.llm.collocations import mine_phrases


def plain(texts, langs, longest=3, least=10, first=2000):
    f, n = Counter(), Counter()
    for text, lang in zip(texts, langs):
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    by_lang = {}
    for (lang, p), a in cands.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (x, q), b in cands.items()):
            continue
        cuts = [((10**6 * a * a) // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(((lang, r, p.decode(), -a, le, ri, n[lang], -s) for lang, found in by_lang.items()
                   for r, (s, a, p, le, ri) in enumerate(sorted(found)[:first], 1)), key=repr)


def fixture(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "OF", "Été", "ÉTÉ", "a", "b", "c\x00d", "e f", "東", "\x1f", "-"]
    pieces = [" ", "\t", "  ", " ", " ", ". ", ", ", "\n", "!? ", " . "]
    texts = [None, "", "...", "the the the the the " * 6]
    for _ in range(n):
        texts.append("".join(w + rng.choice(pieces) for w in rng.choices(words, [9, 8, 7, 3, 2, 2, 2, 1, 1, 1, 1, 1], k=rng.randint(1, 60))))
    texts += ["new york city hall"] * 12 + ["new york city"] * 3 + ["old york, new york"] * 8
    return texts, [rng.choice(["en", "fr", None, "und"]) for _ in texts]


@pytest.mark.parametrize("chunk, bits, longest", [(6 << 20, 1 << 27, 3), (700, 1 << 27, 3), (700, 64, 3), (6000, 1 << 10, 4), (6000, 1 << 10, 2)])
def test_against_plain_python(spark, chunk, bits, longest):
    texts, langs = fixture(longest, 150)
    docs = documents(spark, texts, langs=langs).selectExpr("*", "'x' as w1", "1 as phrase", "2 as a", "3 as n")
    assert rows(mine_phrases(docs.repartition(3), longest, bits=bits, chunk_bytes=chunk)) == plain(texts, langs, longest)


def test_first_phrases_in_byte_order_of_ties(spark):
    texts = [f"{a} {b}." * 10 for a, b in (("z", "y"), ("é", "d"), ("b", "c"), ("Ａ", "q"), ("𝒳", "q2"))]
    got = rows(mine_phrases(documents(spark, texts), first=4))
    assert got == plain(texts, ["en"] * 5, first=4)
    assert [g[2] for g in sorted(got, key=lambda g: g[1])] == ["b c", "z y", "é d", "Ａ q"]


def test_a_hot_word_and_a_very_long_text(spark):
    texts = ["hot word " * 20_000, "hot word", "cold hot word here " * 15]
    assert rows(mine_phrases(documents(spark, texts))) == plain(texts, ["en"] * 3)


def test_empty_tables(spark):
    assert mine_phrases(documents(spark, [])).collect() == []
    assert mine_phrases(documents(spark, [None, "", " . "])).collect() == []
