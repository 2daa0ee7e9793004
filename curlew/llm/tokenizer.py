"""Byte-level BPE over a whole corpus by speculation and verification (problem 7).

A text is cut into pre-tokens by the tokenizer's pattern. For each distinct
pre-token greedy longest match proposes tokens; it is right if and only if every
token is its own encoding and every adjacent pair is compatible, that is, no merge
that BPE would have done earlier crosses the border between the two. The test
unrolls both tokens along that border and runs over all pairs of a batch at once in
numpy. Only pre-tokens that fail go through exact merging.

Word frequencies are heavy-headed, so a worker keeps what it has encoded and a
batch costs one lookup for each word. The vocabulary (fixed size, about 1 MB) is
read once on the driver and broadcast.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curlew.session import importable

# Fixed value: the byte-level vocabularies' published pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that a worker remembers; beyond it the memory starts afresh (the result is the same).
REMEMBERED = 400_000
#: Longer words (bytes) aren't remembered.
LONG_WORD = 200
#: Bytes of an Arrow batch, and of the texts that a worker handles together.
BATCH_BYTES, PART_BYTES = 64 << 20, 4 << 20
NO_LIMIT = np.iinfo(np.int64).max
NO_RANK = 1 << 60
#: Bytes up to which scanning a word for its lowest pair is quicker than a heap.
SHORT = 48
#: Under so many new words the vectorised test costs more than exact merging.
FEW = 5


def default_path(name: str = "byte_bpe_50k") -> str:
    """The place of a public tokenizer's rank file; any other path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """The tables that speculation and verification need, derived from the ranks alone."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.left, self.right = np.arange(size), np.arange(size)
        own = np.zeros(size, bool)
        pairs = []
        for token, rank in ranks.items():
            if len(token) == 1:
                own[rank] = True
                continue
            parts = merge(token, ranks, below=rank)
            if len(parts) == 2:
                a, b = (ranks[p] for p in parts)
                self.left[rank], self.right[rank], own[rank] = a, b, True
                pairs.append((a * size + b, rank))
        pairs.sort()
        self.size, self.own = size, own
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        # Any two tokens that are a third when put together, whether or not it comes about by them.
        joins = sorted((a * size + b, rank) for token, rank in ranks.items() for i in range(1, len(token)) if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None)
        self.join_keys = np.array([k for k, _ in joins], np.int64)
        self.join_ranks = np.array([r for _, r in joins], np.int64)
        self.width = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.of_bytes = np.array([ranks.get(bytes([i, j]), NO_RANK) for i in range(256) for j in range(256)], np.int64)
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                lengths.setdefault(token[:3], set()).add(len(token))
        #: Lengths of the tokens of three bytes or more that begin with these three, longest first.
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}

    def rank_of_pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that merges a and b, NO_LIMIT where none does."""
        if not len(self.pair_keys):
            return np.full(len(a), NO_LIMIT)
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_LIMIT)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that a and b are when put together, NO_RANK where they are none."""
        if not len(self.join_keys):
            return np.full(len(a), NO_RANK)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == key, self.join_ranks[at], NO_RANK)

    def merge_all(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Exact BPE of many words side by side: in each round every word does its next merge, the lowest rank, leftmost first."""
        out: list[tuple[int, ...]] = [()] * len(words)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ids, owner = self.of_byte[flat], np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        # What each token becomes with the next one of its word; a word's last token has none.
        rank = np.full(len(ids), NO_RANK)
        if len(ids) > 1:
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.of_bytes[flat[:-1] * 256 + flat[1:]], NO_RANK)
        while len(ids):
            begins = np.r_[True, owner[1:] != owner[:-1]]
            starts = np.flatnonzero(begins)
            lowest, of_word = np.minimum.reduceat(rank, starts), np.cumsum(begins) - 1
            if (done := lowest == NO_RANK).any():
                leave = done[of_word]
                ready, at = ids[leave].tolist(), 0
                for w, n in zip(owner[starts[done]].tolist(), np.diff(np.r_[starts, len(ids)])[done].tolist()):
                    out[w] = tuple(ready[at : at + n])
                    at += n
                ids, owner, rank = ids[~leave], owner[~leave], rank[~leave]
                continue
            hit = np.flatnonzero(rank == lowest[of_word])
            hit = hit[np.r_[True, of_word[hit[1:]] != of_word[hit[:-1]]]]
            ids[hit] = rank[hit]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            hit -= np.arange(len(hit))  # one token has gone for each word before
            # Both pairs of a new token have changed.
            left = np.r_[hit, hit[hit > 0] - 1]
            inside = left[left + 1 < len(ids)]
            rank[left] = NO_RANK
            inside = inside[owner[inside] == owner[inside + 1]]
            rank[inside] = self.join(ids[inside], ids[inside + 1])
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each adjacent pair, whether BPE leaves the border between a and b alone."""
        result = np.ones(len(a), bool)
        open_, a, b = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NO_LIMIT)
        while len(open_):
            crossed = self.rank_of_pair(a, b) < limit
            result[open_[crossed]] = False
            # Undo the younger of the two border tokens; when neither can be undone, no merge crosses.
            undo_a = a > b
            inner_a, inner_b = self.right[a], self.left[b]
            stuck_a, stuck_b = inner_a == a, inner_b == b
            use_a = np.where(undo_a, ~stuck_a, stuck_b & ~stuck_a)
            limit_a, limit_b = a, b + 1
            new_a, new_b = np.where(use_a, inner_a, a), np.where(use_a, b, inner_b)
            limit = np.where(use_a, limit_a, limit_b)
            go = ~crossed & ~(stuck_a & stuck_b)
            open_, a, b, limit = open_[go], new_a[go], new_b[go], limit[go]
        return result


def merge(word: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """Exact BPE: merge the pair of lowest rank, leftmost first, until none is left (of a rank under ``below``)."""
    return merge_short(word, ranks, NO_RANK if below is None else below) if len(word) <= SHORT else merge_long(word, ranks, below)


def merge_short(word: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """By scanning the few pairs of a short word for the lowest rank."""
    get = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    order = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while order:
        lowest = min(order)
        if lowest >= below:
            break
        i = order.index(lowest)
        parts[i] += parts.pop(i + 1)
        del order[i]
        if i:
            order[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
        if i < len(order):
            order[i] = get(parts[i] + parts[i + 1], NO_RANK)
    return parts


def merge_long(word: bytes, ranks: dict[bytes, int], below: int | None) -> list[bytes]:
    """With a heap of pairs, for words without natural end."""
    n = len(word)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None and (below is None or rank < below):
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j] = False
        end[i], after[i] = stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            push(before[i])
        push(i)
    return [word[i : end[i]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts; remembers words within a worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.vocabulary, self.split = Vocabulary(ranks), regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.length: dict[str, int] = {}
        self.long: list[str] = []
        self.merged = 0

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        rank_of, lengths_of, out, i, n = self.vocabulary.ranks.get, self.vocabulary.lengths.get, [], 0, len(word)
        while i < n:
            for length in lengths_of(word[i : i + 3], ()):
                if i + length <= n and (rank := rank_of(word[i : i + length])) is not None:
                    break
            else:
                length = 2
                if (rank := rank_of(word[i : i + 2])) is None or i + 1 == n:
                    length, rank = 1, rank_of(word[i : i + 1])
            out.append(rank)
            i += length
        return out

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Speculate on every word, verify all adjacent pairs together, merge what failed; a few words don't repay the test and are merged."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        if len(words) < FEW:
            self.merged += len(words)
            return [tuple(map(self.vocabulary.ranks.__getitem__, merge(w, self.vocabulary.ranks))) for w in raw]
        guesses = [self.propose(w) for w in raw]
        sizes = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter(chain.from_iterable(guesses), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(guesses)), sizes)
        wrong = np.zeros(len(guesses), bool)
        wrong[owner[~self.vocabulary.own[flat]]] = True
        border = np.flatnonzero(owner[1:] == owner[:-1])
        wrong[owner[border[~self.vocabulary.compatible(flat[border], flat[border + 1])]]] = True
        self.merged += int(wrong.sum())
        out, ranks = list(map(tuple, guesses)), self.vocabulary.ranks
        short, long = [], []
        for i in np.flatnonzero(wrong).tolist():
            (short if len(raw[i]) <= SHORT else long).append(i)
        for i, ids in zip(short, self.vocabulary.merge_all([raw[i] for i in short])):
            out[i] = ids
        for i in long:
            out[i] = tuple(ranks[p] for p in merge(raw[i], ranks))
        return out

    def learn(self, texts: list[str | None], may_forget: bool = True) -> list[list[str]]:
        """The pre-tokens of each text (null and empty texts have none), all of them known afterwards.

        Words of an earlier call may be forgotten before, unless ``may_forget`` is off.
        """
        split = [self.split(t) if t else [] for t in texts]
        if may_forget and len(self.known) > REMEMBERED:
            self.known, self.length = {}, {}
        new = list(set(chain.from_iterable(split)).difference(self.known))
        if new:
            ids = self.encode_words(new)
            self.known.update(zip(new, ids))
            self.length.update(zip(new, map(len, ids)))
            self.long += [w for w in new if len(w) > LONG_WORD]
        return split

    def sizes(self, words: list[str]) -> list[int]:
        """The number of tokens of each known word."""
        return list(map(self.length.__getitem__, words))

    def counts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text; forgets nothing."""
        return [sum(self.sizes(words)) for words in self.learn(texts, may_forget=False)]

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def forget_long(self) -> None:
        for w in self.long:
            self.known.pop(w, None), self.length.pop(w, None)
        self.long = []

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        split, get = self.learn(texts), self.known.__getitem__
        ids = [np.fromiter(chain.from_iterable(map(get, words)), np.int32) for words in split]
        self.forget_long()
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), np.fromiter(map(len, ids), np.int64, len(ids))


_ENCODERS: dict[int, Encoder] = {}


def encoder(broadcast) -> Encoder:
    """This worker's encoder of a broadcast vocabulary."""
    key = broadcast.value["key"]
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(broadcast.value["ranks"])
    return _ENCODERS[key]


def small_batches(spark: SparkSession) -> None:
    """Ready a session for Python stages: workers find this package, and Arrow batches are bounded by bytes where that bound, Spark's default, was lifted."""
    importable(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("-1", str((1 << 31) - 1), str((1 << 63) - 1)):
        spark.conf.set(key, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``PART_BYTES`` of text, so that a worker holds few words at once; a longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PART_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def share_vocabulary(spark: SparkSession, path: str | None = None):
    """Broadcast the ranks of a tokenizer file (fixed size)."""
    small_batches(spark)
    path = path or default_path()
    ranks = load_ranks(path)
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{path} has no token for bytes {missing[:5]}; this operator needs a byte-level vocabulary")
    return spark.sparkContext.broadcast({"key": path, "ranks": ranks})


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., ids): the token ids of each text, without special tokens.

    Null and empty texts have no ids: an empty list. Rows stay as they are, repeats
    included, and other columns are dropped before Python sees them. There is no
    shuffle: texts stream through the workers in Arrow batches.
    """
    broadcast = share_vocabulary(df.sparkSession, path)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(broadcast)
        for batch in chain.from_iterable(slices(b, len(keep)) for b in batches):
            flat, sizes = coder.encode_batch(batch.column(len(keep)).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))], names=[*keep, ids])

    return df.select(*keep, df[text].cast("string").alias("_text")).mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str = "text", path: str | None = None, keep: tuple[str, ...] = ("doc_id",), name: str = "n_tokens") -> DataFrame:
    """(keep..., n_tokens): the number of tokens of each text; null and empty texts have none."""
    broadcast = share_vocabulary(df.sparkSession, path)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(broadcast)
        for batch in chain.from_iterable(slices(b, len(keep)) for b in batches):
            _, sizes = coder.encode_batch(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes)], names=[*keep, name])

    return df.select(*keep, df[text].cast("string").alias("_text")).mapInArrow(run, schema)
