"""Fill-in-the-middle, byte-level BPE and importance resampling against plain forms of the same rules."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from compare import database
from pyspark.sql import functions as F
from tillstream.llm import byte_bpe, fill_in_middle, importance, queries

FOLDER = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, rows, **others):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    return frame.withColumns({name: F.lit(value) for name, value in others.items()})


def cut_by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 80 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), sha(output), sha(text)


@pytest.mark.parametrize("frame_bytes", [1, 3, 16, 1000])
def test_middles_by_frames_of_any_size(spark, rows, frame_bytes):
    some = random.Random(frame_bytes)
    signs = [" ", "\n", "a", "é", "界", "<", "P", ">", "<S>", "M", "x", "\x0b", " ", "\U0001f600", "  "]
    texts = [(i, "".join(some.choices(signs, k=some.randrange(60)))) for i in range(300)]
    texts += [(None, "a b c d"), (None, None), (500, ""), (501, "x" * 1000), (502, " " * 1000), (503, "é" * 900 + " " * 99 + "界 " * 9)]
    texts += [(i, "one two  three\nfour five ") for i in range(600, 640)] + [(600, "one two  three\nfour five ")] * 2
    docs = documents(spark, texts, n=1, form="other", frames="x", output=None, h1=7)
    found = fill_in_middle.digests(fill_in_middle.fill_in_middle(docs, frame_bytes))
    assert rows(found) == sorted((cut_by_hand(*row) for row in texts), key=repr)
    assert {r.form for r in found.collect()} == {"plain", "spm", "psm"}


def test_output_is_one_stream_and_whole_frames_are_passed_on(spark):
    text = " ".join(f"word{i}" for i in range(20_000))
    store = fill_in_middle.framed(documents(spark, [(i, text) for i in range(12)]), 4096)
    frames = {r.doc_id: set(map(bytes, r.frames)) for r in store.collect()}
    for row in fill_in_middle.transformed(store).where("form <> 'plain'").collect():
        whole = fill_in_middle.text_of([bytes(frame) for frame in row.output])
        assert b"".join(fill_in_middle.restored([bytes(frame) for frame in row.output], row.form)) == text.encode()
        assert sum(map(len, (b"<P>", b"<S>", b"<M>"))) + len(text) == len(whole)
        new = [frame for frame in map(bytes, row.output) if frame not in frames[row.doc_id]]
        assert len(new) <= 3 + 4  # the sentinels and both halves of two cut frames
    assert store.where((F.col("n_units") != 20_000) | (F.col("n_chars") != len(text))).count() == 0


def test_middles_of_an_empty_table(spark):
    assert fill_in_middle.digests(fill_in_middle.fill_in_middle(documents(spark, []))).count() == 0


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return path, plain


SIGNS = ["'", "s", "t", "r", "e", "v", "l", "m", "d", "x", " ", "  ", "\n", " ", "1", "²", "!", "é", "界", "\U0001f600", "'re", "'ll", " '", "S", "́", "ⅷ", "\x1c", "　", "\r\n"]


def test_tokens_of_random_texts(tokens):
    path, plain = tokens
    some, words = random.Random(3), byte_bpe.vocabulary(path)
    texts = ["".join(some.choices(SIGNS, k=some.randrange(40))) for _ in range(4000)]
    for first in range(0, len(texts), 100):
        few = texts[first : first + 100]
        for text, (ids, offsets) in zip(few, words.encode(few)):
            assert ids.tolist() == plain.encode_ordinary(text), text
            assert words.decode(ids, offsets) == text.encode()
    for text in texts[:300]:  # the state goes on from segment to segment
        for segment in (1, 2, 3, 7):
            assert (byte_bpe.piece_starts(text, segment) == byte_bpe.piece_starts(text)).all()


@pytest.mark.parametrize("text", ["x" * 30_000, "é" * 9_000, " " * 30_000, "ab" * 20_000, "!?" * 9_000, "abcdeéñ界" * 3_000])
def test_tokens_of_long_pieces(tokens, text):
    assert byte_bpe.vocabulary(tokens[0]).encode([text])[0][0].tolist() == tokens[1].encode_ordinary(text)


def test_classes_are_those_of_the_library():
    """Every code point after a letter and after a number: one piece or two, as merges inside a piece show."""
    import public_tokenizers
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}
    for first in range(256):
        ranks[b"a" + bytes([first])] = 256 + 2 * first
        ranks[b"1" + bytes([first])] = 257 + 2 * first
    plain = tiktoken.Encoding("classes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = byte_bpe._class_table()
    for point in range(0x30000):
        if not 0xD800 <= point < 0xE000:
            joins = [plain.encode_ordinary(before + chr(point))[0] >= 256 for before in "a1"]
            assert joins == [table[point] in (byte_bpe.LETTER, byte_bpe.ENDS), table[point] == byte_bpe.NUMBER], hex(point)


def test_tokens_of_the_table(spark, tokens):
    texts = dict(database(FOLDER).execute("SELECT doc_id, text FROM documents").fetchall())
    found = queries.op12_byte_bpe(spark, FOLDER).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = tokens[1].encode_ordinary(texts[row.doc_id] or "")
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert row.decoded_sha256 == sha(texts[row.doc_id] or "")


def test_tokens_of_odd_rows(spark, rows, tokens):
    docs = documents(spark, [(1, None), (1, None), (2, ""), (None, "it's"), (3, " \n ")], ids=5, offsets="x", decoded=None)
    docs = docs.unionByName(docs.limit(1).select(F.lit(9).cast("bigint").alias("doc_id"), F.expr("cast(X'61FF' as string)").alias("text"), "ids", "offsets", "decoded"))
    found = byte_bpe.decoded(byte_bpe.encoded(docs, tokens[0]), tokens[0])
    got = sorted(((r.doc_id, bytes(r.decoded).decode(), len(r.ids) == len(r.offsets)) for r in found.collect()), key=repr)
    assert got == sorted([(1, "", True), (1, "", True), (2, "", True), (None, "it's", True), (3, " \n ", True), (9, "a�", True)], key=repr)
    assert byte_bpe.encoded(documents(spark, []), tokens[0]).count() == 0


def features_by_hand(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def resampled_by_hand(docs, target, least=20):
    features = [(i, *features_by_hand(text)) for i, text in docs]
    source, aim = Counter(), Counter()
    for _, _, buckets in features:
        source.update(buckets)
    for text in target:
        aim.update(features_by_hand(text)[1])
    n_source, n_aim = sum(source.values()), sum(aim.values())
    gain = [
        math.floor(1000 * math.log((aim[b] + 1) * (n_source + 10_000) / ((source[b] + 1) * (n_aim + 10_000)))) for b in range(10_000)
    ]
    rows = []
    for i, n_words, buckets in features:
        h = int(sha(f"42:{'' if i is None else i}")[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append((n_words, i, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((row for row in rows if row[0] >= least), key=lambda row: (-row[4], row[1] is not None, row[1]))
    drawn = order[: 5 * len(order) // 100]
    ranks = {id(row): nr for nr, row in enumerate(drawn, 1)}
    return [(*row[1:], ranks.get(id(row))) for row in rows]


def test_resampling_of_the_table(spark, rows):
    tables = database("/root/testdata/sf0.01")
    docs = tables.execute("SELECT doc_id, text FROM documents").fetchall()
    target = [text for (text,) in tables.execute("SELECT text FROM benchmark").fetchall()]
    expected = resampled_by_hand(docs, target)
    found = queries.op13_importance(spark, "/root/testdata/sf0.01").select("doc_id", "n_features", "weight", "score", "rank")
    assert rows(found) == sorted(expected, key=repr) and sum(row[-1] is not None for row in expected) > 40


def test_resampling_of_odd_rows(spark, rows):
    texts = ["", None, "a", "x y", "One two THREE " * 10, "é界 " * 25, "z" * 900 + " k" * 30, " - ", "a b c " * 8]
    docs = [(i, texts[i % len(texts)]) for i in range(200)] + [(None, texts[4])] + [(7, texts[8])] * 100
    frame = documents(spark, docs, rank="r", weight=1.5, out=True, row=3, n_words=None, range=0)
    target = spark.createDataFrame([("one two", 1), (None, 2)], "text string, bucket int")
    kept = importance.resampled(frame, target).select("doc_id", "n_features", "weight", "score", "rank")
    expected = resampled_by_hand(docs, ["one two", None])
    assert rows(kept.select("doc_id", "n_features", "weight", "score")) == sorted((row[:-1] for row in expected), key=repr)
    ranks = lambda found: sorted((row[-1], row[0]) for row in found if row[-1] is not None)
    assert ranks(kept.collect()) == ranks(expected) and len(ranks(expected)) > 5
    nothing = importance.resampled(documents(spark, []), target)
    assert nothing.count() == 0
    assert importance.resampled(frame, target.limit(0)).where("rank IS NULL").count() == len(docs) - len(ranks(expected))


def test_features_whatever_the_dictionary_and_segments():
    some = random.Random(2)
    words = importance.Dictionary(most=50, rebuilt_from=3)
    for _ in range(100):
        signs = ["a", "B", " ", "é", "界", "-", "x" * 300, "q9", "\n", "word", "w" + str(some.randrange(99))]
        texts = ["".join(some.choices(signs, k=some.randrange(30))) for _ in range(5)]
        found = [Counter() for _ in texts]
        for segments in importance._segments([text.encode() for text in texts], 3, some.choice([1, 5, 30, 1000])):
            for place, bucket in importance._features(segments, words, 10_000, 3):
                for at, b in zip(place.tolist(), bucket.tolist()):
                    found[segments[at][0]][b] += 1
        assert found == [Counter(features_by_hand(text)[1]) for text in texts]
    assert len(words.known) == 50


def test_shifted_checksums():
    some = random.Random(4)
    for size in (0, 1, 7, 255, 256, 70_000, 1 << 20):
        left, right = some.randbytes(9), some.randbytes(size)
        both = importance.shifted(importance.np.array([zlib.crc32(left)], "uint32"), importance.np.array([size]))
        assert int(both[0]) ^ zlib.crc32(right) == zlib.crc32(left + right)
