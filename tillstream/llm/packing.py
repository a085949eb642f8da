"""Packing by concatenation and cutting.

Documents are turned into token ids once and written with their running start inside their partition.
First pass: tokens per partition, summed up to each partition's global offset (one number per partition).
Second pass: each document's stream position is known, and it is cut at multiples of the window; a
document that crosses a boundary gives one record per window it touches. Nothing is sorted or shuffled,
only the last sequence has padding, and a long document is just more pieces.

Token ids go through two caches of bounded size, by space-separated chunk and by word; a full one is emptied.

Defined cases: null text is empty and gives the end token alone; every row is a document, also repeated
rows and null ids; an empty table gives an empty result; columns of any other name are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import filled, written

WINDOW = 4096
END_TOKEN = 2
CACHED_CHUNKS = 500_000
CACHED_WORDS = 500_000
BATCH = 256  # documents whose ids are held in Python at once
_TOKENS = "doc_id bigint, part int, start bigint, doc_tokens bigint, ids binary"
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


# A word of letters that keep their form under the tokenizer's normalisation, with punctuation after it.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%$#&*|]*)")


# A full stop or comma before white space that other punctuation precedes: the run is one piece to the tokenizer.
_TIED = re.compile(r"[^\s0-9A-Za-zÀ-ÖØ-öø-ÿ][.,](?:\s|\Z)")


def _chunks(text: str) -> list[str]:
    """Pieces that the tokenizer treats apart anyway; in lower case where that is all its normalisation does."""
    try:
        text.encode("latin-1")  # letters up to ÿ are in their composed form
    except UnicodeEncodeError:
        return text.replace("\n", " ").split(" ")
    if "<|" in text:  # names of special tokens are told apart by case
        return text.replace("\n", " ").split(" ")
    text = text.lower().replace("\n", " ") + " "
    if not _TIED.search(text):
        text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


class ChunkTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer never joins what a space parts, nor a word and the punctuation after it, and it does not tell case apart. So ids are
    remembered by space-separated chunk, and those of plain chunks are put together from their word in lower case and their
    punctuation. New words are encoded together and told apart by the mark that ends a word's last token.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[number for token, number in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        chunked = [_chunks(text) for text in texts]
        needed = set().union(*chunked)
        missing = needed.difference(self.chunks)
        if missing:
            if len(self.chunks) + len(missing) > CACHED_CHUNKS:
                self.chunks.clear()
                missing = needed
            self._learn(missing)
        known = self.chunks.__getitem__
        return [b"".join(map(known, chunks)) for chunks in chunked]

    def _learn(self, missing: set[str]) -> None:
        plain, words, others = [], set(), []
        for chunk in missing:
            if chunk.isascii() and chunk.isalpha() and chunk.islower():
                words.add(chunk)
                plain.append((chunk, chunk, ""))
                continue
            found = _PLAIN.fullmatch(chunk)
            if found:
                word, after = found[1].lower(), found[2]
                plain.append((chunk, word, after))
                words.add(word)
                if after not in self.words:
                    others.append(after)
            else:
                others.append(chunk)
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words.clear()
            new = words
            others += {after for _, _, after in plain}
        self._encode_words(list(new))
        self.words[""] = b""
        alone = list(set(others))
        for encoded, text in zip(self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), alone):
            ids = np.array(encoded.ids, dtype="<u4").tobytes()
            self.words[text] = ids
            self.chunks[text] = ids
        for chunk, word, after in plain:
            self.chunks[chunk] = self.words[word] + self.words[after]

    def _encode_words(self, words: list[str]) -> None:
        if not words:
            return
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            raise ValueError(f"{len(words)} words gave {len(ends)} ends of words")
        data, at = ids.tobytes(), 0
        for word, end in zip(words, (4 * ends).tolist()):
            self.words[word] = data[at:end]
            at = end


@functools.cache
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One for all tasks of a Python worker."""
    return ChunkTokenizer(path)


def tokenized(docs: DataFrame, tokenizer: str, end: int = END_TOKEN) -> DataFrame:
    """Token ids with the end token, partition and running start inside it; written once."""
    end_bytes = np.array([end], dtype="<u4").tobytes()

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part_id, start = chunk_tokenizer(tokenizer), TaskContext.get().partitionId(), 0
        for part in parts:
            for first in range(0, len(part), BATCH):
                some = part.iloc[first : first + BATCH]
                ids = [one + end_bytes for one in encoder.ids(list(some["text"]))]
                sizes = np.array([len(one) // 4 for one in ids], dtype=np.int64)
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pd.DataFrame(
                    {"doc_id": some["doc_id"].array, "part": part_id, "start": starts, "doc_tokens": sizes, "ids": ids}
                ).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled(F.col("text")).alias("text"))
    return written(rows.mapInPandas(encode, _TOKENS), "packing")


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END_TOKEN, with_ids: bool = True) -> DataFrame:
    """One row per piece: its document, place in the document and in its sequence, crc32 of its ids, the ids."""
    rows = tokenized(docs, tokenizer, end)
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("tokens")).orderBy("part").collect()
    offsets, at = {}, 0
    for row in totals:  # one number per partition
        offsets[row["part"]] = at
        at += row["tokens"]

    def pieces(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for doc_id, number, start, size, ids in part.itertuples(index=False):
            begin, view = offsets[number] + start, memoryview(ids)
            done = 0
            while done < size:
                place = begin + done
                length = min(window - place % window, size - done)
                piece = view[4 * done : 4 * (done + length)]
                row = (doc_id, done, length, zlib.crc32(piece), size, place // window, place % window)
                found.append((*row, np.frombuffer(piece, "<i4")) if with_ids else row)
                done += length
        return pd.DataFrame(found, columns=names).astype({"doc_id": "Int64"})

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for first in range(0, len(whole), BATCH):
                yield pieces(whole.iloc[first : first + BATCH])

    schema = _PIECES + ", ids array<int>" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    return rows.mapInPandas(cut, schema)
