"""Best-fit packing of token sequences by the linear grouping scheme.

Only how many pieces there are of each length (at most ``capacity`` numbers)
reaches the driver.  There the large lengths are rounded up within groups of
equal cardinality, the few resulting sizes are packed by optimised
configurations (column generation), and small lengths are best-fitted into what
the substituted actual lengths leave.  The plan is a list of runs of ranks, whose
number depends on the capacity and not on the data; each piece finds its place
from its rank in the order of lengths.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loadsmith.llm.common import in_slices, number_rows, tidy
from loadsmith.session import materialize

CAPACITY, END_ID, GROUPS = 1024, 2, 128
#: Lengths over this share of the capacity are large.
LARGE_SHARE = 1 / 8
#: The only settings of a tokenizer file with which words may be encoded singly.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: Kinds of bytes in the byte-level pattern.  Next to an unsure byte nothing is cut.
_UNSURE, _LETTER, _DIGIT, _OTHER, _SPACE, _BREAK, _APOSTROPHE = range(7)
#: First bytes of UTF-8 characters that are letters, but for these two.
_LETTER_LEADS, _SIGNS = (*range(0xC3, 0xCA), 0xD0, 0xD1), (b"\xc3\x97", b"\xc3\xb7")
#: Bytes of text whose words are looked up together.
_TOGETHER = 1 << 20
#: Words whose ids a worker remembers (about 200 bytes each), and the bytes of the longest.
_REMEMBERED, _LONGEST = 150_000, 48


def _kind(byte: int) -> int:
    """Kind of a byte; a continuation byte counts as a letter until ``_kinds`` has seen its first byte."""
    char = chr(byte)
    if byte >= 0x80:
        return _LETTER if byte < 0xC0 or byte in _LETTER_LEADS else _UNSURE
    if char.isalnum():
        return _DIGIT if char.isdigit() else _LETTER
    if char == " " or char == "'":
        return _SPACE if char == " " else _APOSTROPHE
    if 0x1C <= byte <= 0x1F:  # white space to some
        return _UNSURE
    return _BREAK if char.isspace() else _OTHER


def _cut_between(pair: int) -> bool:
    """Whether the pattern always cuts between two bytes of these kinds (white space in a row is seen to apart)."""
    a, b = divmod(pair, 8)
    if _UNSURE in (a, b) or max(a, b) > _APOSTROPHE or a == _SPACE:
        return False
    if a == _BREAK or b in (_SPACE, _BREAK):
        return not (a == _BREAK and b in (_SPACE, _BREAK))
    if a == _APOSTROPHE and b == _LETTER:  # perhaps a contraction
        return False
    return (_OTHER if a == _APOSTROPHE else a) != (_OTHER if b == _APOSTROPHE else b)


_KINDS = bytes(map(_kind, range(256)))
_CUTS = bytes(pair < 64 and _cut_between(pair) for pair in range(256))
#: Printable stand-ins of bytes in byte-level vocabularies; line feeds part the words here.
_UNPRINTED = [b for b in range(256) if not chr(b).isprintable() or chr(b) == " "]
_STAND_INS = np.array([256 + _UNPRINTED.index(b) if b in _UNPRINTED and b != 10 else b for b in range(256)], "<u2")


def _kinds(data: bytes) -> np.ndarray:
    """Kind of each byte of UTF-8 text."""
    kinds = np.frombuffer(data.translate(_KINDS), np.uint8).copy()
    raw = np.frombuffer(data, np.uint8)
    first = np.flatnonzero((kinds == _UNSURE) & (raw >= 0xC0))
    for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        first = first[raw[first] >= least]
        kinds[first + k] = _UNSURE
    for sign in _SIGNS:
        at = data.find(sign)
        while at >= 0:
            kinds[at:at + 2] = _UNSURE
            at = data.find(sign, at + 2)
    return kinds


def word_starts(kinds: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where words start, given the kinds of bytes and where the texts start that are not empty.

    Of white space in a row the pattern leaves the last for what follows, if
    anything does.  A word of sure bytes without apostrophe is one of the
    pattern's; any other holds whole words of it.
    """
    cut = np.zeros(len(kinds), np.uint8)
    pairs = (kinds[:-1] << 3) | kinds[1:]
    cut[1:] = np.frombuffer(pairs.tobytes().translate(_CUTS), np.uint8)
    cut[texts] = 2
    space = (kinds == _SPACE) | (kinds == _BREAK)
    again = np.flatnonzero(space[:-2] & space[1:-1]) + 1
    again = again[(cut[again] == 0) & (cut[again + 1] < 2) & ~space[again + 1] & (kinds[again + 1] != _UNSURE)]
    cut[again] = 1
    return np.flatnonzero(cut)


class _Known:
    """Ids by word, in two generations: when one is full, the older is forgotten."""

    def __init__(self, most: int):
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.most = most // 2

    def ids(self, words: list[bytes], learn: Callable[[list[int]], list[bytes]]) -> list[bytes]:
        """The ids of different words; ``learn`` gives those of the numbered words that are not known."""
        found = list(map(self.recent.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i in missing:
            found[i] = self.older.get(words[i])
        new = [i for i in missing if found[i] is None]
        for i, ids in zip(new, learn(new)):
            found[i] = ids
        if len(self.recent) + len(missing) > self.most:
            self.older, self.recent = self.recent, {}
        self.recent.update((words[i], found[i]) for i in missing if len(words[i]) <= _LONGEST)
        return found


def cuts_words(tokenizer: dict) -> bool:
    """Whether a tokenizer file's settings make the ids of a text those of its words by the byte-level pattern."""
    first, model = tokenizer.get("pre_tokenizer") or {}, tokenizer.get("model") or {}
    return (tokenizer.get("normalizer") is None and {k: first.get(k) for k in _BYTE_LEVEL} == _BYTE_LEVEL
            and model.get("type") == "BPE" and not model.get("dropout"))


@lru_cache(maxsize=1)
def encoder(path: str) -> Callable[[pa.Array | list[str]], list[memoryview]]:
    """Texts -> bytes of their ids (little-endian unsigned 32-bit), as the tokenizer file at ``path`` encodes them.

    A byte-level BPE never merges across the words its pattern cuts, so equal
    words get equal ids and are encoded once.  Words are cut where the pattern is sure to cut;
    those that may hold more than one of its words, as next to rare characters, go through
    the whole tokenizer.  So do texts with a special token's string, and all texts if
    the file's settings are other ones.  A worker keeps its encoder, and the words it
    has met, from task to task.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
    model = Tokenizer.from_file(path)
    bpe = model.model
    singly = cuts_words(json.loads(model.to_str()))
    special = [t.content.encode() for t in model.get_added_tokens_decoder().values()]
    known = _Known(_REMEMBERED)

    def encode(words: list[bytes], whole: np.ndarray) -> list[bytes]:
        """Ids of words, of which some need the whole tokenizer."""
        texts = [w.decode() for w, odd in zip(words, whole) if odd]
        odd_ids = iter(model.encode_batch_fast(texts, add_special_tokens=False))
        plain = b"\n".join(w for w, odd in zip(words, whole) if not odd)
        plain_words = iter(_STAND_INS[np.frombuffer(plain, np.uint8)].tobytes().decode("utf-16-le").split("\n"))
        return [array("I", next(odd_ids).ids if odd else [t.id for t in bpe.tokenize(next(plain_words))]).tobytes()
                for odd in whole]

    def ids(texts: pa.Array | list[str]) -> list[memoryview]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = texts.fill_null("").cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = bytes(memoryview(texts.buffers()[2])[ends[0]:ends[-1]]) if ends[-1] > ends[0] else b""
        if not data:
            return [memoryview(b"")] * len(texts)
        ends = ends - ends[0]
        kinds = _kinds(data) if singly else np.full(len(data), _UNSURE, np.uint8)
        for token in special:
            if token in data:
                for i in np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)):
                    kinds[ends[i]:ends[i + 1]] = _UNSURE
        starts = word_starts(kinds, ends[:-1][np.diff(ends) > 0])
        bounds = np.append(starts, len(data))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        places = words.indices.to_numpy()
        odd = np.flatnonzero((kinds == _UNSURE) | (kinds == _APOSTROPHE) | (kinds == _BREAK))
        whole = np.zeros(len(words.dictionary), bool)
        whole[places[np.searchsorted(starts, odd, side="right") - 1]] = True
        distinct = words.dictionary.to_pylist()
        values = known.ids(distinct, lambda new: encode([distinct[i] for i in new], whole[new]))
        out = pa.array(values, pa.large_binary()).take(words.indices)
        at = np.frombuffer(out.buffers()[1], np.int64)[np.searchsorted(bounds, ends)].tolist()
        stored = memoryview(out.buffers()[2])
        return [stored[a:b] for a, b in zip(at, at[1:])]

    return ids


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first may be shorter than ``capacity``."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32.  A null text is empty."""
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            first = 0
            while first < batch.num_rows:  # one text at least
                before = int(sizes[first - 1]) if first else 0
                after = max(int(np.searchsorted(sizes, before + _TOGETHER, side="right")), first + 1)
                for i, data in enumerate(ids(batch.column(1).slice(first, after - first)), first):
                    total = len(data) // 4 + 1
                    for k, (at, n) in enumerate(cut(total, capacity)):
                        rows.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(n)
                        value = zlib.crc32(data[4 * at:4 * (at + n)])
                        crc.append(zlib.crc32(end, value) if at + n == total else value)
                first = after
            for r, p, s, n, c in in_slices([rows, piece, start, length, crc]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(r)), pa.array(p, pa.int32()),
                     *(pa.array(x, pa.int64()) for x in (s, n, c))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        tidy(pieces), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Whole numbers of configurations (size -> how many) for most of the demand.

    Solves the fractional problem by column generation (an unbounded knapsack
    prices new configurations) and rounds down; the caller packs the few left over.
    """
    m, s = len(sizes), np.array(sizes)
    fits = capacity // s
    columns = [{g: int(fits[g])} for g in range(m)]
    inverse = np.diag(1.0 / fits)
    x = np.array(demand, float) / fits
    for _ in range(40 * m):
        y = inverse.sum(axis=0)
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        order = np.argsort(s)
        low, value = s[order], y[order]
        for c in range(int(low[0]), capacity + 1):
            best[c] = best[c - 1]
            k = np.searchsorted(low, c, side="right")
            gain = best[c - low[:k]] + value[:k]
            j = int(np.argmax(gain))
            if gain[j] > best[c] + 1e-12:
                best[c], pick[c] = gain[j], order[j]
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(m), capacity
        while c > 0:
            if pick[c] < 0:
                c -= 1
                continue
            column[pick[c]] += 1
            c -= int(s[pick[c]])
        d = inverse @ column
        rows = np.nonzero(d > 1e-9)[0]
        if not len(rows):
            break
        out = rows[np.argmin(x[rows] / d[rows])]
        step = x[out] / d[out]
        x -= step * d
        x[out] = step
        inverse[out] /= d[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(d[others], inverse[out])
        columns[out] = {int(g): int(n) for g, n in enumerate(column) if n}
    return [(int(n + 1e-6), columns[i]) for i, n in enumerate(x) if n >= 1 - 1e-6]


class PackingPlan:
    """Where pieces go, by their rank in descending order of length.

    ``runs``: (first rank, first sequence, pieces per sequence), in order of
    rank; the piece of rank r in a run from f goes to sequence + (r - f) // per.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS):
        self.capacity = capacity
        self.lengths = sorted(counts, reverse=True)
        self.starts = np.concatenate([[0], np.cumsum([counts[n] for n in self.lengths])]).astype(np.int64)
        self.total = int(self.starts[-1])
        self.runs: list[tuple[int, int, int]] = []
        self.n_sequences = 0
        #: What is left -> runs (first sequence, how many) of sequences with so much room.
        self.room: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []
        large = int(sum(counts[n] for n in self.lengths if n > capacity * LARGE_SHARE))
        if large:
            self._pack_large(large, groups)
        for i, n in enumerate(self.lengths):
            if n <= capacity * LARGE_SHARE:
                self._best_fit(n, int(self.starts[i]), int(self.starts[i + 1]))
        self.runs.sort()

    def length_at(self, rank: int) -> int:
        return self.lengths[int(np.searchsorted(self.starts, rank, side="right")) - 1]

    def _leave(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.room:
                self.room[room] = []
                insort(self.rooms, room)
            self.room[room].append((first, n))

    def _pack_large(self, large: int, groups: int) -> None:
        size = -(-large // groups)
        merged: list[list[int]] = []  # rounded size, first rank, last rank + 1
        for first in range(0, large, size):
            n, last = self.length_at(first), min(first + size, large)
            if merged and merged[-1][0] == n:
                merged[-1][2] = last
            else:
                merged.append([n, first, last])
        at = [g[1] for g in merged]
        plan = configurations([g[0] for g in merged], [g[2] - g[1] for g in merged], self.capacity)
        for times, config in plan:
            times = min([times] + [(merged[g][2] - at[g]) // a for g, a in config.items()])
            if times:
                self._substitute(times, config, at)
        for g in range(len(merged)):  # what rounding down left over, larger first
            for rank in range(at[g], merged[g][2]):
                n = self.length_at(rank)
                self._best_fit(n, rank, rank + 1)

    def _substitute(self, times: int, config: dict[int, int], at: list[int]) -> None:
        """Give ``times`` sequences the actual pieces of a configuration; note the room each has left."""
        first, breaks, slots = self.n_sequences, {0, times}, []
        for g, per in config.items():
            self.runs.append((at[g], first, per))
            lo, hi = np.searchsorted(self.starts, [at[g], at[g] + times * per])
            for j in range(per):
                slots.append((at[g] + j, per))
                for b in self.starts[lo:hi].tolist():
                    breaks.add(min(max(-(-(b - at[g] - j) // per), 0), times))
            at[g] += times * per
        cuts = sorted(breaks)
        for a, b in zip(cuts, cuts[1:]):
            used = sum(self.length_at(start + a * per) for start, per in slots)
            self._leave(self.capacity - used, first + a, b - a)
        self.n_sequences += times

    def _best_fit(self, n: int, rank: int, end: int) -> None:
        """Put pieces of length ``n`` with ranks from ``rank`` to ``end`` where least room is left."""

        while rank < end:
            i = bisect_left(self.rooms, n)
            if i == len(self.rooms):
                opened = -(-(end - rank) // (self.capacity // n))
                self._leave(self.capacity, self.n_sequences, opened)
                self.n_sequences += opened
                continue
            room = self.rooms[i]
            first, many = self.room[room].pop()
            if not self.room[room]:
                del self.room[room]
                del self.rooms[i]
            per = room // n
            filled = min(many, (end - rank) // per)
            if filled:
                self.runs.append((rank, first, per))
                self._leave(room - per * n, first, filled)
                rank += filled * per
            if filled < many and rank < end:  # the last sequence gets fewer
                self.runs.append((rank, first + filled, per))
                self._leave(room - (end - rank) * n, first + filled, 1)
                rank, filled = end, filled + 1
            self._leave(room, first + filled, many - filled)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         groups: int = GROUPS) -> DataFrame:
    """Pack the ids of all texts into sequences of at most ``capacity``.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  A
    text's ids are followed by ``end_id``; only longer ones are cut.  Pieces of
    full length are sequences of their own (negative ids).  A null text is empty
    and still has its end id; repeated rows are packed as often as they occur; an
    empty table gives an empty result.  Texts travel to one task each and the
    shuffled rows have no text.
    """
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id)
                         .withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in
              pieces.where(F.col("length") < capacity).groupBy("length").count().collect()}
    plan = PackingPlan(counts, capacity, groups)
    firsts, sequences, pers = (np.array(x, np.int64) for x in (zip(*plan.runs) if plan.runs else ([], [], [])))
    shared = spark.sparkContext.broadcast((firsts, sequences, pers))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sequence, per = shared.value
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            run = np.searchsorted(first, rank, side="right") - 1
            where = sequence[run] + (rank - first[run]) // per[run]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where, pa.int64())],
                                             names=[*batch.schema.names, "sequence_id"])

    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    short = (pieces.where(F.col("length") < capacity)
             .select(*own, (-F.col("length")).alias("_down"), F.xxhash64("ids_crc32", "_uid").alias("_tie"), "_uid"))
    ranked, _ = number_rows(short, ["_down", "_tie", "_uid"], "_rank")
    ranked = ranked.select(*own, "_rank")
    dealt = ranked.mapInArrow(placed, StructType([*ranked.schema.fields, StructField("sequence_id", LongType())]))
    before = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    full = pieces.where(F.col("length") == capacity).select(
        *own, (-F.col("_uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(dealt.select(*own, "sequence_id", "offset"))


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing of these lengths needs fewer sequences."""
    total = sum(n * c for n, c in counts.items())
    return max(-(-total // capacity), sum(c for n, c in counts.items() if 2 * n > capacity))


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> int:
    """Sequences that plain best-fit decreasing needs; for comparison in tests."""
    rooms: list[int] = []

    opened = 0
    for n in sorted(lengths, reverse=True):
        i = bisect_left(rooms, n)
        if i < len(rooms):
            room = rooms.pop(i)
        else:
            room, opened = capacity, opened + 1
        insort(rooms, room - n)
    return opened


__all__ = ["pack", "token_pieces", "PackingPlan", "configurations", "lower_bound", "cut", "encoder"]
