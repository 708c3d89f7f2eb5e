import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import documents
from tokenizers import Tokenizer

from loadsmith.llm.packing import PackingPlan, best_fit_decreasing, configurations, cut, encoder, lower_bound, pack

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def loads(plan, counts):
    """Sequences as lists of lengths, from the plan's runs."""
    firsts = np.array([r[0] for r in plan.runs])
    out = defaultdict(list)
    for rank in range(plan.total):
        f, s, per = plan.runs[int(np.searchsorted(firsts, rank, side="right")) - 1]
        out[s + (rank - f) // per].append(plan.length_at(rank))
    assert Counter(n for x in out.values() for n in x) == Counter(counts)
    return out


@pytest.mark.parametrize("kind", ["uniform", "large", "small", "one", "twos", "few", "thirds"])
def test_plan_places_everything_and_is_near_the_bound(kind):
    rng = random.Random(kind)
    draw = {"uniform": lambda: rng.randint(1, 1023), "large": lambda: rng.randint(300, 1023), "small": lambda: rng.randint(1, 90),
            "one": lambda: 700, "twos": lambda: rng.choice([512, 511, 2]), "few": lambda: rng.choice([600, 424, 300]),
            "thirds": lambda: rng.choice([341, 342, 340, 700, 10])}[kind]
    counts = Counter(draw() for _ in range(6000))
    plan = PackingPlan(counts)
    sequences = loads(plan, counts)
    assert all(sum(x) <= 1024 for x in sequences.values())
    assert len(sequences) == plan.n_sequences
    plain = best_fit_decreasing(list(Counter(counts).elements()))
    assert lower_bound(counts) <= plan.n_sequences <= plain * 1.02 + 20


def test_plan_size_does_not_follow_the_data():
    rng = random.Random(1)
    base = Counter(rng.randint(1, 1023) for _ in range(5000))
    runs = [len(PackingPlan({n: c * times for n, c in base.items()}).runs) for times in (10, 1000)]
    assert runs[1] < 2 * runs[0] + 1000


def test_configurations_cover_most_of_the_demand():
    made = configurations([700, 500, 324, 200], [100, 100, 100, 100], 1024)
    for times, c in made:
        assert times > 0 and sum([700, 500, 324, 200][g] * a for g, a in c.items()) <= 1024
    assert PackingPlan({}).n_sequences == 0


def test_cut():
    assert cut(1) == [(0, 1)] and cut(1024) == [(0, 1024)]
    assert cut(1025) == [(0, 1), (1, 1024)] and cut(2048) == [(0, 1024), (1024, 1024)]


def test_ids_equal_the_tokenizer_s():
    model, ids = Tokenizer.from_file(PATH), encoder(PATH)
    rng = random.Random(2)
    signs = list("aZ é ß²¼ªº¹_1\n\t  '.,0₂٣  \x1c\x85東👍🏽İ́") + ["'s", "'re", " the", "<|endoftext|>", "   ", "\r\n", "naïve"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(chr(c) for c in range(a, a + 40)) for a in range(0, 0x2C0, 20)]
    texts += [f"x'{w} '{w} {w}'s '{w.upper()}" for w in ("s", "t", "re", "ve", "m", "ll", "d", "r", "l", "sé")]
    for at in range(0, len(texts), 100):
        for text, got in zip(texts[at:at + 100], ids(texts[at:at + 100])):
            assert np.frombuffer(got, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "Lowercase"}},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
    {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Digits", "individual_digits": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}]}}])
def test_other_settings_of_the_file_are_kept(tmp_dir, change):
    other = json.loads(Tokenizer.from_file(PATH).to_str()) | change
    path = f"{tmp_dir}/other.json"
    with open(path, "w") as f:
        json.dump(other, f)
    model = Tokenizer.from_file(path)
    texts = ["The Year 2024's END", "", "12345 abc", "  two  spaces"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(path)(texts)] == [
        model.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_cut_only_where_the_tokenizer_cuts():
    model, ids = Tokenizer.from_file(PATH), encoder(PATH)
    chars = [chr(c) for c in (*range(0x250), *range(0x2B0, 0x3000, 11), 0x180E, 0x3000, 0xFEFF, 0x1F44D, *range(0x1FFE, 0x2030))]
    texts = [f"ab {c} cd{c} ef {c}gh 1{c}x'{c}s{c}'s\n{c}\n\n y  {c}  {c}{c}.{c} \t{c} " for c in chars] + ["", " ", "\n", "  a", "a  "]
    want = [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == want


def test_only_doubtful_words_go_through_the_whole_tokenizer(monkeypatch):
    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(self.inner, name)

        @classmethod
        def from_file(cls, path):
            return cls(Tokenizer.from_file(path))

    asked = []
    monkeypatch.setattr("tokenizers.Tokenizer", Counting)
    encoder.cache_clear()
    ids = encoder(PATH)
    encoder.cache_clear()
    got = ids(["plain words, naïve words; слова 12.", "an – rare", "an – rare end", "it's"] * 3 + ["it's plain"])
    assert sorted(asked) == [" – rare", "'s"]
    model = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in got[-3:]] == [
        model.encode(x).ids for x in ("an – rare end", "it's", "it's plain")]


def test_round_trip_and_edge_rows(spark):
    model = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    words = [w.strip() for w in "the quick brown fox jumps over a lazy dog and naïve Größe 12345 ".split()]
    texts = [None, "", "a", " ".join(rng.choices(words, k=20_000))]
    texts += [" ".join(rng.choices(words, k=rng.randint(0, 1500))) for _ in range(150)] + [""] * 40 + ["same text here"] * 60
    ids = [None if i % 70 == 9 else i for i in range(len(texts))]
    docs = documents(spark, texts, ids).selectExpr("*", "'c' as piece", "1 as length", "2 as _uid")
    got = pack(docs, PATH).collect()
    want = Counter()
    for i, t in zip(ids, texts):
        tokens = np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (at, n) in enumerate(cut(len(tokens))):
            want[i, k, at, n, zlib.crc32(tokens[at:at + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    lengths = [r["length"] for r in got]
    assert len(sequences) <= best_fit_decreasing(lengths) * 1.02 + 5


def test_empty_table(spark):
    assert pack(documents(spark, []), PATH).collect() == []
