import random

from helpers import documents, rows
from tokenizers import Tokenizer
from tokenizers.models import WordPiece

from loadsmith.llm.wordpiece_count import (PieceAutomaton, count_tokens, marked_vocabulary,
                                           sentencepiece_vocabulary)


def reference(first, later):
    vocab = {w: i for i, w in enumerate(dict.fromkeys(["[UNK]", *first, *("##" + p for p in later)]))}
    model = Tokenizer(WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10_000, continuing_subword_prefix="##"))
    return lambda word: model.encode(word).tokens


def test_automaton_counts_like_greedy_longest_match():
    rng = random.Random(5)
    for trial in range(40):
        first = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 8))}
        later = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 8))}
        automaton, plain = PieceAutomaton(first, later), reference(first, later)
        for _ in range(150):
            word = "".join(rng.choices("abcd" if trial % 5 == 0 else "abc", k=rng.randint(1, 14)))
            tokens = plain(word)
            assert automaton.count(word) == (None if tokens == ["[UNK]"] else len(tokens)), (first, later, word)


def test_real_vocabulary_and_edge_rows(spark):
    import public_tokenizers

    first, later = sentencepiece_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model")))
    plain = reference(first, later)
    texts = [None, "", " \n\t", "The cat sat.", "naïve Straße 東京 x\u00a0y", "a" * 30_000, "w " * 5000, "The cat sat."]
    df = documents(spark, texts, ids=[0, 1, 2, None, 4, 5, 6, None]).selectExpr("*", "1 as n_words")
    got = rows(count_tokens(df, first, later))
    want = []
    for i, t in zip([0, 1, 2, None, 4, 5, 6, None], texts):
        words = (t or "").replace("\n", " ").replace("\t", " ").split(" ")
        pieces = [PieceAutomaton.count(AUTOMATON(first, later), w) if len(w) > 9000 else
                  (None if plain(w) == ["[UNK]"] else len(plain(w))) for w in words if w]
        want.append((i, len(pieces), pieces.count(None), sum(1 if p is None else p for p in pieces)))
    assert got == sorted(want, key=repr)


def AUTOMATON(first, later, made={}):
    if not made:
        made[0] = PieceAutomaton(first, later)
    return made[0]


def test_empty_table_and_empty_vocabulary(spark):
    assert count_tokens(documents(spark, []), ["a"], []).collect() == []
    assert rows(count_tokens(documents(spark, ["a b"]), [], [])) == [(0, 2, 2, 2)]


def marked_reference(first, later):
    """WordPiece over the untrimmed vocabulary: every word begins with the mark."""
    plain = reference(["▁" + p for p in first], later)
    return lambda word: plain("▁" + word)


def test_bare_mark_begins_words_without_a_first_piece():
    rng = random.Random(6)
    for trial in range(40):
        first = {"", *("".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 8)))}
        later = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 8))}
        automaton, plain = PieceAutomaton(first, later), marked_reference(first, later)
        for _ in range(150):
            word = "".join(rng.choices("abcd" if trial % 5 == 0 else "abc", k=rng.randint(1, 14)))
            tokens = plain(word)
            assert automaton.count(word) == (None if tokens == ["[UNK]"] else len(tokens)), (first, later, word)


def test_query_spells_digits_and_unspaced_scripts(spark, tmp_path):
    import public_tokenizers

    from loadsmith.llm.queries import op7_wordpiece_counts

    plain = marked_reference(*marked_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model"))))
    words = ["2024", "3.5%", "ñandú", "ça", "ß", "Être", "東京" * 2000, "한국어", "مرحبا", "The", "naïve", "\U0001F9FF"]
    documents(spark, words).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_words"], r["n_unknown"], r["n_tokens"]) for r in op7_wordpiece_counts(spark, str(tmp_path)).collect()}
    tokens = {i: plain(w) for i, w in enumerate(words)}
    assert got == {i: (1, int(t == ["[UNK]"]), len(t)) for i, t in tokens.items()}
    assert got[0] == (1, 0, 5) and got[6][1] == 0 and got[6][2] > 4000
