"""Splitting oversized texts at natural boundaries (problem 9).

A text is seen as pre-tokens of the tokenizer, whose token counts are known, and as
units between natural breaks (paragraphs, turns, list items, lines, sentences). For
each break the words of the units before it are compared with those after it; where
that lexical cohesion has a deep valley, the topic changes. A piece ends at the
deepest valley of the window that its size allows, and the next one begins so that
it repeats a given number of tokens. Where a window holds no natural break, the cut
falls between words, and inside a word only if the word alone is too large.

Each text is worked on by itself in a streamed Arrow batch: no shuffle, no memory
beyond one text and its pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curlew.llm.tokenizer import Encoder, encoder, share_vocabulary, slices

# Natural breaks: the position after each match begins a new unit. Later kinds win at the same position.
SENTENCE = regex.compile(r"(?:[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？]+)")
LINE = regex.compile(r"\n+(?=[^\n])|\r+(?=[^\r\n])")
LIST_ITEM = regex.compile(r"(?m)^[ \t]*(?=(?:[-*•–]|\d{1,3}[.)]|[A-Z]\d{2,4}\t)[ \t]*\S)")
TURN = regex.compile(r"(?m)^(?=(?:\[\d{1,2}:\d{2}(?::\d{2})?\][ \t]*)?\p{L}[\p{L}\p{N} ._-]{0,30}+:[ \t])")
PARAGRAPH = regex.compile(r"\n[ \t]*\n\s*(?=\S)")
KINDS = ("character", "word", "sentence", "line", "list item", "turn", "paragraph", "end")
#: Hashed words of the cohesion vectors, and sentences on either side of a break.
WIDTH, BLOCK = 256, 6
#: Units whose cohesion is computed together, which bounds memory for very long texts.
UNITS_AT_ONCE = 4096


def breaks(text: str) -> tuple[list[int], list[int]]:
    """Positions of the natural breaks of ``text`` and their kinds (index in KINDS); a place may be listed several times, or lie at its ends."""
    places, kinds = [m.end() for m in SENTENCE.finditer(text)], []
    kinds += [2] * len(places)
    if "\n" in text or "\r" in text:
        for kind, pattern, at_end in ((3, LINE, True), (4, LIST_ITEM, False), (5, TURN, False), (6, PARAGRAPH, True)):
            places += [m.end() for m in pattern.finditer(text)] if at_end else [m.start() for m in pattern.finditer(text)]
            kinds += [kind] * (len(places) - len(kinds))
    return places, kinds


class Cells(dict):
    """The cell of each pre-token in cohesion vectors; -1 for words of under four letters, digits and signs."""

    def __missing__(self, word: str) -> int:
        plain = word.strip().lower()
        cell = zlib.crc32(plain.encode("utf-8", "surrogatepass")) % WIDTH if len(plain) > 3 and plain.isalpha() else -1
        if len(self) > 200_000:
            self.clear()
        self[word] = cell
        return cell


CELLS = Cells()


def depths(cells: np.ndarray, unit_of: np.ndarray, units: int) -> np.ndarray:
    """Depth of the cohesion valley at the start of each unit (0 for the first): how far it lies under the peaks around it."""
    valid = cells >= 0
    cosine = np.ones(units)
    for low in range(0, units, UNITS_AT_ONCE):
        high = min(units, low + UNITS_AT_ONCE)
        a, b = max(0, low - BLOCK), min(units, high + BLOCK)
        here = valid & (unit_of >= a) & (unit_of < b)
        counts = np.bincount((unit_of[here] - a) * WIDTH + cells[here], minlength=(b - a) * WIDTH)
        running = np.zeros((b - a + 1, WIDTH), np.float32)  # whole numbers, and exact: no block of texts has 2**24 words
        np.cumsum(counts.reshape(b - a, WIDTH), axis=0, out=running[1:])
        at = np.arange(low, high) - a
        left = running[at] - running[np.maximum(0, at - BLOCK)]
        right = running[np.minimum(b - a, at + BLOCK)] - running[at]
        dot = lambda x, y: np.einsum("ij,ij->i", x, y).astype(float)
        norm = np.sqrt(dot(left, left) * dot(right, right))
        cosine[low:high] = np.divide(dot(left, right), norm, out=np.zeros(high - low), where=norm > 0)
    # The peak on a side is where cohesion, going that way, first falls.
    place = np.arange(units)
    falls_left, falls_right = np.r_[True, cosine[:-1] < cosine[1:]], np.r_[cosine[1:] < cosine[:-1], True]
    peak_left = np.maximum.accumulate(np.where(falls_left, place, 0))
    peak_right = np.minimum.accumulate(np.where(falls_right, place, units - 1)[::-1])[::-1]
    depth = (cosine[peak_left] - cosine) + (cosine[peak_right] - cosine)
    depth[0] = 0.0
    return depth


def apart(words: list[str], sizes: list[int], coder: Encoder, limit: int) -> tuple[list[str], list[int], list[int]]:
    """Words, their sizes, and which places lie inside a word: words that are too large alone come apart between their tokens.

    Tokens that are right side by side are right without what stands before and
    after, so the sizes hold for any run of them. Places inside a character are none.
    """
    atoms: list[str] = []
    atom_sizes: list[int] = []
    inner: list[int] = []
    for w, n in zip(words, sizes):
        if n <= limit:
            atoms.append(w), atom_sizes.append(n)
            continue
        starts = (np.frombuffer(w.encode("utf-8", "surrogatepass"), np.uint8) & 0xC0) != 0x80
        ends = np.cumsum(coder.vocabulary.width[np.array(coder.known[w])])
        tokens = np.flatnonzero(np.r_[starts[ends[:-1]], True]) + 1
        characters = np.cumsum(starts)[ends[tokens - 1] - 1].tolist()
        inner += range(len(atoms) + 1, len(atoms) + len(tokens))
        atoms += [w[i:j] for i, j in zip([0, *characters], characters)]
        atom_sizes += np.diff(tokens, prepend=0).tolist()
    return atoms, atom_sizes, inner


def pieces(text: str, words: list[str], coder: Encoder, limit: int, overlap: int, least_fill: float = 0.5) -> list[tuple[int, int, int, int, str]]:
    """[(start, end, tokens, tokens repeated from the piece before, kind of the cut at its end)] of a text with known pre-tokens, in characters."""
    sizes = coder.sizes(words)
    whole = sum(sizes)
    if whole <= limit:
        return [(0, len(text), whole, 0, "end")]
    atoms, inner = words, []
    if max(sizes) > limit:
        atoms, sizes, inner = apart(words, sizes, coder, limit)
    n = len(atoms)
    start_of, total = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    np.cumsum(np.fromiter(map(len, atoms), np.int64, n), out=start_of[1:])
    np.cumsum(sizes, out=total[1:])
    kind = np.ones(n + 1, np.int64)
    kind[inner] = 0

    def tokens_of(begin: int, end: int) -> int:
        """Tokens of a piece as a text of its own: only blanks at its end and an apostrophe cut off a word can differ from the sum."""
        if kind[begin] == 0 and atoms[begin][0] == "'":
            return coder.count(text[start_of[begin] : start_of[end]])
        solid = end
        while solid > begin and atoms[solid - 1].isspace():
            solid -= 1
        return int(total[solid] - total[begin]) + (coder.count(text[start_of[solid] : start_of[end]]) if solid < end else 0)

    places, kinds = breaks(text)
    if places:
        # A break inside a pre-token (before the space of the next word) moves to where the next one starts.
        np.maximum.at(kind, np.searchsorted(start_of, places), kinds)
        kind[[0, n]] = 1
    is_break = kind >= 2
    is_break[0] = is_break[n] = False
    unit_of = np.cumsum(is_break[:n])
    unit_start = np.flatnonzero(is_break)
    depth = np.zeros(n + 1)
    if len(unit_start):
        depth[unit_start] = depths(np.fromiter(map(CELLS.__getitem__, atoms), np.int64, n), unit_of, len(unit_start) + 1)[1:]
    out: list[tuple[int, int, int, int, str]] = []
    begin, done = 0, 0  # where the piece begins, and how far the pieces before it have come
    while True:
        last = int(np.searchsorted(total, total[begin] + limit, side="right")) - 1
        if last >= n:
            tokens = tokens_of(begin, n)
            if tokens <= limit:
                out.append((int(start_of[begin]), len(text), tokens, int(total[done] - total[begin]), "end"))
                return out
            last = n - 1
        if last <= done:  # nothing new fits after the repeated tokens
            if begin < done:
                begin = done
                continue
            last = begin + 1
        end = choose(kind, depth, total, begin, done, last, limit, least_fill)
        tokens = tokens_of(begin, end)
        while tokens > limit and end - 1 > done:  # the border changed the count
            end = choose(kind, depth, total, begin, done, end - 1, limit, least_fill)
            tokens = tokens_of(begin, end)
        if tokens > limit and begin < done:
            begin = done
            continue
        out.append((int(start_of[begin]), int(start_of[end]), tokens, int(total[done] - total[begin]), KINDS[kind[end]]))
        begin, done = max(begin + 1, int(np.searchsorted(total, total[end] - overlap))), end
        if start_of[end] >= len(text):
            return out


def choose(kind: np.ndarray, depth: np.ndarray, total: np.ndarray, begin: int, done: int, last: int, limit: int, least_fill: float) -> int:
    """The end of a piece: the deepest valley among the natural breaks of its window, else the last break, else the last word."""
    low = max(done + 1, int(np.searchsorted(total, total[begin] + least_fill * limit)))
    window = np.arange(low, last + 1)
    window = window[kind[window] >= 2] if len(window) else window
    if len(window):
        order = np.lexsort((window, kind[window], np.round(depth[window], 6)))
        return int(window[order[-1]])
    early = np.arange(done + 1, min(low, last + 1))
    early = early[kind[early] >= 2]
    if len(early):
        return int(early[-1])
    between = np.arange(done + 1, last + 1)
    between = between[kind[between] >= 1]
    return int(between[-1]) if len(between) else last


def split_documents(df: DataFrame, limit: int = 512, overlap: int = 64, text: str = "text", key: str = "doc_id", path: str | None = None, with_text: bool = True) -> DataFrame:
    """(key, piece_no, char_start, char_end, n_tokens, overlap_tokens, cut, piece): the pieces of each text in order.

    No piece has more than ``limit`` tokens. A piece repeats at most ``overlap``
    tokens of the one before, as many as word borders allow; fewer where the next
    word wouldn't fit otherwise. ``cut`` names what a piece ends at. The new parts of
    the pieces, one after another, are the text. A text within the limit is one
    piece; null and empty texts have none. Repeated rows give repeated pieces.
    """
    if limit < 8 or not 0 <= overlap <= limit // 2:
        raise ValueError("limit must be 8 or more and overlap at most half of it")
    broadcast = share_vocabulary(df.sparkSession, path)
    schema = T.StructType([df.schema[key]])
    for name, kind in (("piece_no", "integer"), ("char_start", "long"), ("char_end", "long"), ("n_tokens", "integer"), ("overlap_tokens", "integer"), ("cut", "string")):
        schema = schema.add(name, kind)
    schema = schema.add("piece", "string") if with_text else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(broadcast)
        for batch in chain.from_iterable(slices(b, 1) for b in batches):
            texts = batch.column(1).to_pylist()
            rows, owner, parts = [], [], []
            for i, (body, words) in enumerate(zip(texts, coder.learn(texts))):
                for no, piece in enumerate(pieces(body, words, coder, limit, overlap) if body else []):
                    owner.append(i), rows.append((no, *piece))
                    if with_text:
                        parts.append(body[piece[0] : piece[1]])
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()))]
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), *columns, *([pa.array(parts, pa.string())] if with_text else [])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
            coder.forget_long()

    return df.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
