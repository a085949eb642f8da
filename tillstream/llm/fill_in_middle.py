"""Fill-in-the-middle: a text is cut at two unit borders and its middle moved to the end, between sentinels.

Texts are stored as seekable compressed frames: independent zstandard frames of about `frame_bytes` bytes each, with the
number of unit ends, characters and bytes before every frame. A cut is found by searching those cumulative counts, so
only the frames that hold a cut are decompressed to be parted; all others go into the output as they are. The output is
a list of frames too, whose concatenation is one valid zstandard stream. Digests and the restored text are streamed
frame by frame, so memory holds the compressed frames of one text and a single open frame, however long the text is.

A unit is a run of characters that are not white space with the white space before it; white space at the end is one
more. Units end where a character that is not white space (0x20, 0x09-0x0D) is followed by white space or the end. A run of
white space or letters longer than a frame is spread over frames; a unit that has not ended yet does not count.

No row meets another: there is no shuffle, and a lost task is repeated from the stored frames.

Defined cases: null text counts as empty; an empty text and one that holds a sentinel stay as they are (`plain`);
repeated rows and rows that share an id are cut alike; a null id is hashed as an empty id; bytes that are no valid
UTF-8 are kept, characters being the bytes that begin one; an empty table gives an empty result; columns of any other
name are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import filled, written

FRAME_BYTES = 65_536
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_STORE = "doc_id bigint, n_units bigint, n_chars bigint, units array<bigint>, chars array<bigint>, frames array<binary>"
_OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>"
_DIGESTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"


def _chars(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.translate(None, _CONTINUATION))


def _ends(data: bytes) -> int:
    """Unit ends inside the bytes, without one at their very end."""
    return len(data.split()) - (data[-1:] not in _SPACE)


def _breaks(text: bytes, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of each frame: at a unit end where one is near, else at any character."""
    start = 0
    while len(text) - start > size:
        found = _END.search(text, start + size - 1, min(start + 2 * size, len(text)))
        if found:
            end = found.end()
        else:
            end = start + size
            while end < len(text) and 0x80 <= text[end] < 0xC0 and end < start + size + 4:
                end += 1
        yield start, end
        start = end
    if start < len(text):
        yield start, len(text)


def _framed(text: bytes, size: int, packer: zstandard.ZstdCompressor) -> tuple[int, int, list[int], list[int], list[bytes]]:
    """Units and characters of a text, the counts before each of its frames, the frames."""
    units, chars, units_before, chars_before, frames = 0, 0, [], [], []
    for start, end in _breaks(text, size):
        data = text[start:end]
        units_before.append(units)
        chars_before.append(chars)
        frames.append(packer.compress(data))
        at_end = end == len(text) or text[end] in _SPACE
        units += _ends(data) + (data[-1:] not in _SPACE and at_end)
        chars += _chars(data)
    return units + (bool(text) and text[-1:] in _SPACE), chars, units_before, chars_before, frames


def _table(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]
    whole = {name: "Int64" for name, kind in (field.split() for field in schema.split(", ")) if kind == "bigint"}
    return pd.DataFrame(rows, columns=names).astype(whole)


def framed(docs: DataFrame, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> DataFrame:
    """One row per document: doc_id, n_units, n_chars, units and chars before each frame, frames; written once."""

    def compress(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=level, write_checksum=False)
        for part in parts:
            found = [(i, *_framed(text, frame_bytes, packer)) for i, text in zip(part["doc_id"].array, part["text"])]
            yield _table(found, _STORE)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled(F.col("text")).cast("binary").alias("text"))
    return written(rows.mapInPandas(compress, _STORE), "frames")


def _stream(frames: Iterable[bytes]) -> Iterator[bytes]:
    """The plain bytes of frames, one frame at a time."""
    opener = zstandard.ZstdDecompressor()
    return map(opener.decompress, frames)


def _holds(frames: Iterable[bytes], marks: tuple[bytes, ...]) -> bool:
    """Whether one of the marks is in the text, also across frames."""
    tail, reach = b"", max(map(len, marks)) - 1
    for data in _stream(frames):
        window = tail + data
        if any(mark in window for mark in marks):
            return True
        tail = window[-reach:]
    return False


class _Text:
    """One stored text: its frames and the counts before them. Holds at most one open frame."""

    def __init__(self, n_units, n_chars, units, chars, frames, packer) -> None:
        self.n_units, self.n_chars, self.units, self.chars = n_units, n_chars, units, chars
        self.frames, self.packer = list(frames), packer
        self.open = functools.lru_cache(1)(lambda at: zstandard.ZstdDecompressor().decompress(self.frames[at]))

    def place(self, after: int) -> tuple[int, int]:
        """Where unit number `after` ends: a frame and an offset in it. Looks into the one frame that holds the end."""
        if after == 0:
            return 0, 0
        if after == self.n_units:
            return len(self.frames), 0
        at = int(np.searchsorted(self.units, after)) - 1  # the last frame with fewer ends before it
        ends = _END.finditer(self.open(at))
        found = next(itertools.islice(ends, after - int(self.units[at]) - 1, None), None)
        return (at, found.end()) if found else (at + 1, 0)

    def chars_before(self, place: tuple[int, int]) -> int:
        at, offset = place
        if at == len(self.frames):
            return self.n_chars
        return int(self.chars[at]) + (_chars(self.open(at)[:offset]) if offset else 0)

    def between(self, start: tuple[int, int], end: tuple[int, int]) -> list[bytes]:
        """The frames from one place to another: whole ones as they are, parted ones packed anew."""
        (first, skip), (last, stop) = start, end
        if first == last:
            return [self.packer.compress(self.open(first)[skip:stop])] if stop > skip else []
        head = [self.packer.compress(self.open(first)[skip:])] if skip else [self.frames[first]]
        tail = [self.packer.compress(self.open(last)[:stop])] if stop else []
        return head + self.frames[first + 1 : last] + tail


def transformed(store: DataFrame, seed: int = 42, fim_rate: int = 50, spm_rate: int = 80, level: int = LEVEL) -> DataFrame:
    """One row per stored text: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output (frames).

    `fim_rate` percent of the texts are parted and `spm_rate` percent of those take the suffix first, by the sha256 of
    `seed:doc_id`, as are the two cuts. `text_of` reads the output.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]

    def part_row(row, packer, marks):
        doc_id, n_units, n_chars, units, chars, frames, h1, h2, h3, h4 = row
        if n_units == 0 or h3 % 100 >= fim_rate or _holds(frames, (PREFIX, SUFFIX, MIDDLE)):
            return doc_id, n_units, "plain", None, None, list(frames)
        text = _Text(n_units, n_chars, units, chars, frames, packer)
        first, second = (text.place(after) for after in sorted((h1 % (n_units + 1), h2 % (n_units + 1))))
        prefix_chars, middle_end = text.chars_before(first), text.chars_before(second)
        prefix, middle = text.between((0, 0), first), text.between(first, second)
        suffix = text.between(second, (len(text.frames), 0))
        p, s, m = marks
        form = "spm" if h4 % 100 < spm_rate else "psm"
        output = [s, *suffix, p, *prefix, m, *middle] if form == "spm" else [p, *prefix, s, *suffix, m, *middle]
        return doc_id, n_units, form, prefix_chars, middle_end - prefix_chars, output

    def part_all(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=level, write_checksum=False)
        marks = [packer.compress(mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
        for part in parts:
            columns = (part[name].array if name == "doc_id" else part[name].tolist() for name in part.columns)
            yield _table([part_row(row, packer, marks) for row in zip(*columns)], _OUTPUT)

    return store.select("*", *numbers).mapInPandas(part_all, _OUTPUT)


def fill_in_middle(docs: DataFrame, frame_bytes: int = FRAME_BYTES, **choices: int) -> DataFrame:
    """`transformed` of the documents' texts, stored first."""
    return transformed(framed(docs, frame_bytes), **choices)


def text_of(output) -> bytes:
    """The whole text of a list of frames."""
    return b"".join(_stream(output))


def _sections(frames: list[bytes], order: tuple[bytes, ...]) -> Iterator[tuple[int, bytes]]:
    """The stretches of a text in order, each with the number of sentinels before it, one frame at a time.

    `order` are the sentinels as they follow each other; the text begins with the first.
    """
    held, nr = b"", 0
    for data in _stream(frames):
        held += data
        while nr < len(order) and (at := held.find(order[nr])) >= 0:
            yield nr, held[:at]
            held = held[at + len(order[nr]) :]
            nr += 1
        safe = len(held) - (len(order[nr]) - 1 if nr < len(order) else 0)
        if safe > 0:  # a sentinel may go on in the next frame
            yield nr, held[:safe]
            held = held[safe:]
    yield nr, held


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The original text in order, from an output and its form alone; each section is a pass over the frames."""
    if form == "plain":
        yield from _stream(frames)
        return
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        wanted = order.index(mark) + 1
        for nr, data in _sections(frames, order):
            if nr > wanted:
                break
            if nr == wanted:
                yield data


def digests(rows: DataFrame) -> DataFrame:
    """sha256 of every output and of the text restored from it, streamed over the frames; the output is left out."""

    def digest(pieces: Iterable[bytes]) -> str:
        total = hashlib.sha256()
        for piece in pieces:
            total.update(piece)
        return total.hexdigest()

    def digest_all(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            outputs = part["output"].tolist()
            part = part.drop(columns="output").astype({name: "Int64" for name in ("doc_id", "n", "prefix_chars", "middle_chars")})
            part["output_sha256"] = [digest(_stream(output)) for output in outputs]
            part["restored_sha256"] = [digest(restored(output, form)) for output, form in zip(outputs, part["form"])]
            yield part

    return rows.mapInPandas(digest_all, _DIGESTS)
