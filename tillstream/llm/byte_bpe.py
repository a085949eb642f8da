"""Byte-level BPE: texts to token ids and back, by the ranks of a vocabulary file.

Pre-tokenisation uses no regular expression. Every code point gets a class from a table; classes that depend on the next
character (white space that ends a run, the first letter of 're, 've and 'll) are set by comparing neighbours. A small automaton
over the classes says where pieces begin: words, numbers and other signs with one space before them, contractions after
an apostrophe that begins a piece, runs of white space. Each class is a function from states to states; the functions
reachable by composition are few, so a function is a small number and composing two is one look-up. Composition is
associative: texts are laid out in blocks, all blocks are scanned at once, the blocks' totals are scanned the same way,
and every character gets its state. A text longer than `SEGMENT` is scanned in segments, the state being carried over.

The pieces are merged by rank, lowest first and leftmost of equals, through a cache of bounded size: new short pieces
side by side in arrays, long ones each with a heap, so that their time is n log n. Start offsets of the tokens in the text's bytes are kept; decoding places each token's
bytes at its offset.

Rows are worked on by themselves: no shuffle; a lost task is repeated from the input.

Defined cases: null text counts as empty, which has no tokens; bytes that are no valid UTF-8 count as U+FFFD; repeated rows
and null ids are encoded like all others; pieces of any length are merged whole; an empty table gives an empty result;
columns of any other name are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import filled

SEGMENT = 1 << 20
CACHED_PIECES = 500_000
SHORT_PIECE = 48  # bytes; longer pieces are rare, they are merged one by one and not kept
TOGETHER = 2048  # pieces that are merged side by side
BLOCK = 256

# Classes of characters.
LETTER, NUMBER, OTHER, APOSTROPHE, INNER_SPACE, LAST_SPACE, LAST_BLANK, ENDS, BEGINS, EDGE = range(10)
# LAST_BLANK: U+0020 before a character that is no white space; LAST_SPACE: other white space there.
# ENDS: s, t, m, d, each a contraction's whole end; BEGINS: r, v before e, l before l; EDGE: between texts.

# White space as the pattern's \s takes it.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Letters and numbers that Unicode 16.0 added, which an older `unicodedata` doesn't know.
ADDED_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
ADDED_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]

# States: what the character before belongs to.
NOTHING, WORD, DIGITS, SIGNS, SPACE, BLANK, QUOTE, HALF, CLOSED = range(9)
# BLANK: a space that the next piece takes; QUOTE: an apostrophe that begins a piece; HALF: 'r, 'v or 'l of a contraction;
# CLOSED: a whole contraction.


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at the character."""
    if kind == EDGE:
        return NOTHING, True
    if kind == INNER_SPACE:
        return SPACE, state != SPACE
    if kind == LAST_SPACE:
        return SPACE, True
    if kind == LAST_BLANK:
        return BLANK, True
    if kind == NUMBER:
        return DIGITS, state not in (DIGITS, BLANK)
    if kind in (OTHER, APOSTROPHE):
        if state in (SIGNS, BLANK, QUOTE):
            return SIGNS, False
        return (QUOTE if kind == APOSTROPHE else SIGNS), True
    if state == HALF or (state == QUOTE and kind == ENDS):
        return CLOSED, False
    if state == QUOTE and kind == BEGINS:
        return HALF, False
    return WORD, state not in (WORD, BLANK)


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each class's function, compositions (first, then second), functions by state, and where pieces begin."""
    states, kinds = range(CLOSED + 1), range(EDGE + 1)
    letters = [tuple(_step(s, k)[0] for s in states) for k in kinds]
    known = {tuple(states): 0}
    for function in letters:
        known.setdefault(function, len(known))
    queue = list(known)
    while queue:
        first = queue.pop()
        for second in letters:
            both = tuple(second[s] for s in first)
            if both not in known:
                known[both] = len(known)
                queue.append(both)
    functions = sorted(known, key=known.get)
    compose = np.array([[known[tuple(b[s] for s in a)] for b in functions] for a in functions], np.uint16)
    begins = np.array([[_step(s, k)[1] for k in kinds] for s in states])
    return np.array([known[f] for f in letters], np.uint16), compose, np.array(functions, np.uint8), begins


def _scan(numbers: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of a row of functions: blocks side by side, then the blocks' totals, then both."""
    if len(numbers) <= BLOCK:
        return np.array(list(itertools.accumulate(numbers.tolist(), lambda a, b: compose[a, b])), np.uint16)
    blocks = -(-len(numbers) // BLOCK)
    laid = np.zeros(blocks * BLOCK, np.uint16)  # 0 is the identity
    laid[: len(numbers)] = numbers
    laid = np.ascontiguousarray(laid.reshape(blocks, BLOCK).T)
    for i in range(1, BLOCK):
        laid[i] = compose[laid[i - 1], laid[i]]
    before = np.concatenate([np.zeros(1, np.uint16), _scan(laid[-1], compose)[:-1]])
    return compose[before[None, :], laid].T.reshape(-1)[: len(numbers)]


@functools.cache
def _class_table() -> np.ndarray:
    """The class of every code point, before its neighbours are looked at. White space is INNER_SPACE."""
    first = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for kind, added in ((LETTER, ADDED_LETTERS), (NUMBER, ADDED_NUMBERS)):
        for first_point, last_point in added:
            table[first_point : last_point + 1] = kind
    table[SPACES] = INNER_SPACE
    table[ord("'")] = APOSTROPHE
    table[[ord(c) for c in "stmd"]] = ENDS
    return table


def _classes(points: np.ndarray, following: int | None) -> np.ndarray:
    """Classes of the code points; `following` is the one after the last, None at the end of the text."""
    table = _class_table()
    kinds = table[points]
    after = np.append(points[1:], np.uint32(following if following is not None else 0x20)) if len(points) else points
    last = (kinds == INNER_SPACE) & (table[after] != INNER_SPACE)
    kinds[last] = np.where(points[last] == 0x20, LAST_BLANK, LAST_SPACE)
    half = ((points == ord("r")) | (points == ord("v"))) & (after == ord("e")) | (points == ord("l")) & (after == ord("l"))
    kinds[half] = BEGINS
    return kinds


def _begins(kinds: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Where pieces begin among characters of these classes, from a state on; and the state after the last."""
    numbers, compose, functions, begins = _automaton()
    states = functions[_scan(numbers[kinds], compose), state]
    return begins[np.concatenate([[state], states[:-1]]), kinds], int(states[-1])


def piece_starts(text: str, segment: int = SEGMENT) -> np.ndarray:
    """Byte offsets in the UTF-8 text at which pieces begin, and its length at the end."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    state, at, found = NOTHING, 0, []
    for first in range(0, len(points), segment):
        some = points[first : first + segment]
        following = int(points[first + segment]) if first + segment < len(points) else None
        begins, state = _begins(_classes(some, following), state)
        widths = 1 + (some >= 0x80).astype(np.int64) + (some >= 0x800) + (some >= 0x10000)
        ends = at + np.cumsum(widths)
        found.append((ends - widths)[begins])
        at = int(ends[-1])
    return np.concatenate([*found, [at]]).astype(np.int64)


def _by_pair(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs of tokens (first times size plus second) that make a token, and its rank."""
    size, pairs = max(ranks.values()) + 1, {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            first, second = ranks.get(token[:cut]), ranks.get(token[cut:])
            if first is not None and second is not None:
                pairs[first * size + second] = rank
    keys = np.array(sorted(pairs), np.int64)
    return keys, np.array([pairs[key] for key in keys.tolist()], np.int32)


class Vocabulary:
    """Ranks of byte sequences, merging by them, and the way back."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pieces: dict[bytes, bytes] = {}  # ids of pieces met so far, as little-endian 32-bit numbers
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.widths = np.array([len(token) for token in tokens], np.int64)
        self.places = np.cumsum(self.widths) - self.widths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([byte])] for byte in range(256)], np.int32)
        self.pairs, self.merged_rank = _by_pair(self.ranks)

    def _rank_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, the number of tokens where they make none; -1 is no token."""
        none = len(self.widths)
        keys = first.astype(np.int64) * none + second
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        fits = (self.pairs[at] == keys) & (first >= 0) & (second >= 0)
        return np.where(fits, self.merged_rank[at], none).astype(np.int32)

    def _merge_together(self, pieces: list[bytes]) -> None:
        """Ids of many short pieces: in every round each piece joins its pair of lowest rank, leftmost of equals."""
        none, sizes = len(self.widths), np.array([len(piece) for piece in pieces])
        widest = int(sizes.max()) + 1
        tokens = np.full((len(pieces), widest), -1, np.int32)
        inside = np.arange(widest) < sizes[:, None]
        tokens[inside] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self._rank_of(tokens[:, :-1], tokens[:, 1:])
        left, columns = np.arange(len(pieces)), np.arange(widest - 1)
        while len(left):
            at = ranks.argmin(1)
            rows = np.arange(len(left))
            least = ranks[rows, at]
            done = least == none
            if done.any():
                ended = tokens[done]
                data, ends = ended[ended >= 0].astype("<i4").tobytes(), 4 * np.cumsum((ended >= 0).sum(1))
                for nr, start, end in zip(left[done].tolist(), [0, *ends.tolist()], ends.tolist()):
                    self.pieces[pieces[nr]] = data[start:end]
                left, tokens, ranks, at, least = left[~done], tokens[~done], ranks[~done], at[~done], least[~done]
                rows = np.arange(len(left))
            if not len(left):
                return
            tokens[rows, at] = least
            behind = columns[None, :] > at[:, None]
            tokens[:, :-1] = np.where(behind, tokens[:, 1:], tokens[:, :-1])
            tokens[:, -1] = -1
            ranks[:, :-1] = np.where(behind[:, 1:], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            ranks[rows, at] = self._rank_of(tokens[rows, at], tokens[rows, at + 1])
            before = np.maximum(at - 1, 0)
            ranks[rows, before] = np.where(at > 0, self._rank_of(tokens[rows, before], tokens[rows, at]), ranks[rows, before])

    def _learn(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """Makes all the pieces known, but for long ones, whose ids are returned."""
        missing = pieces.difference(self.pieces)
        if len(self.pieces) + len(missing) > CACHED_PIECES:
            self.pieces.clear()
            missing = pieces
        short = sorted((piece for piece in missing if len(piece) <= SHORT_PIECE), key=len)
        for first in range(0, len(short), TOGETHER):
            self._merge_together(short[first : first + TOGETHER])
        long = (piece for piece in missing if len(piece) > SHORT_PIECE)
        return {piece: np.array(self.merged(piece), "<i4").tobytes() for piece in long}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length: a heap of pairs over linked tokens."""
        rank, n = self.ranks.get, len(piece)
        if (whole := rank(piece)) is not None:
            return [whole]
        after, before = list(range(1, n + 2)), list(range(-1, n))  # borders of the tokens, linked
        alive = bytearray(b"\1") * (n + 1)
        heap = []

        def offer(start: int) -> None:
            middle = after[start]
            if middle < n and (found := rank(piece[start : after[middle]])) is not None:
                heapq.heappush(heap, (found, start, middle, after[middle]))

        for start in range(n - 1):
            offer(start)
        while heap:
            _, start, middle, end = heapq.heappop(heap)
            if not (alive[start] and alive[middle] and after[start] == middle and after[middle] == end):
                continue
            alive[middle] = 0
            after[start], before[end] = end, start
            if end < n:
                offer(start)
            if start:
                offer(before[start])
        borders = [i for i in range(n + 1) if alive[i]]
        return [self.ranks[piece[a:b]] for a, b in itertools.pairwise(borders)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text its ids and the byte offset at which each token begins."""
        data = "".join(texts).encode()
        borders = all_starts(texts).tolist()
        pieces = list(map(data.__getitem__, map(slice, borders, borders[1:])))
        long = self._learn(set(pieces))
        known = self.pieces.__getitem__ if not long else (self.pieces | long).__getitem__
        ids = np.frombuffer(b"".join(map(known, pieces)), "<i4")
        ends = np.cumsum(self.widths[ids])
        offsets = ends - self.widths[ids]
        sizes = [len(text) if text.isascii() else len(text.encode()) for text in texts]
        bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        cuts = np.searchsorted(offsets, bounds).tolist()
        return [(ids[a:b], (offsets[a:b] - start).astype(np.int32)) for a, b, start in zip(cuts, cuts[1:], bounds.tolist())]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of the tokens, each placed at its offset from the first one's."""
        if not len(ids):
            return b""
        widths = self.widths[ids]
        placed = offsets.astype(np.int64) - int(offsets[0])
        whole = np.zeros(int(placed[-1] + widths[-1]), np.uint8)
        inside = np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths)
        whole[np.repeat(placed, widths) + inside] = self.bytes[np.repeat(self.places[ids], widths) + inside]
        return whole.tobytes()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One for all tasks of a Python worker."""
    return Vocabulary(path)


def all_starts(texts: list[str]) -> np.ndarray:
    """Where pieces begin in the texts' joined bytes, and their length at the end; short texts are scanned with an edge between."""
    if len(texts) == 1:
        return piece_starts(texts[0])
    points = np.frombuffer(" ".join(texts).encode("utf-32-le"), "<u4")
    edges = np.cumsum([len(text) + 1 for text in texts])[:-1] - 1
    kinds = _classes(points, None)  # an edge is a blank here, so that white space before it has nothing behind
    kinds[edges] = EDGE
    begins, _ = _begins(kinds, NOTHING)
    begins[edges] = False
    widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    widths[edges] = 0
    ends = np.cumsum(widths)
    return np.append((ends - widths)[begins], ends[-1] if len(ends) else 0)


def _groups(part: pd.DataFrame) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of rows whose texts together are about one segment long; longer ones alone."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(part["doc_id"].array, part["text"]):
        text = text.decode(errors="replace")
        if texts and size + len(text) > SEGMENT:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc_id)
        texts.append(text)
        size += len(text) + 1
    if texts:
        yield ids, texts


def _encoded(docs: DataFrame, path: str, schema: str, rows_of: Callable) -> DataFrame:
    """`rows_of(vocabulary, ids, offsets)` of each document's tokens, after its id."""
    names = [field.split()[0] for field in schema.split(", ")]

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for part in parts:
            for doc_ids, texts in _groups(part):
                found = [(i, *rows_of(words, *tokens)) for i, tokens in zip(doc_ids, words.encode(texts))]
                yield pd.DataFrame(found, columns=names).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled(F.col("text")).cast("binary").alias("text"))
    return rows.mapInPandas(encode, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids, offsets (of each token's first byte in the text)."""
    return _encoded(docs, path, "doc_id bigint, ids array<int>, offsets array<int>", lambda words, ids, offsets: (ids, offsets))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """The rows of `encoded` with the bytes their ids stand for as `decoded`."""

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for part in parts:
            part["decoded"] = [words.decode(ids, offsets) for ids, offsets in zip(part["ids"], part["offsets"])]
            yield part.astype({"doc_id": "Int64"})

    return rows.mapInPandas(decode, "doc_id bigint, ids array<int>, offsets array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes in one pass: doc_id, n_tokens, the sha256 of the ids (decimal, joined by commas) and of the decoded bytes."""

    def digests(words: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[int, str, str]:
        listed = ",".join(map(str, ids.tolist())).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(words.decode(ids, offsets)).hexdigest()

    return _encoded(docs, path, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", digests)
