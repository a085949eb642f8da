"""The registered queries against SQL, or against brute force where SQL has no form for them."""

import html
import re
import zlib

import corpus_pipeline
import pytest
from compare import database, differences
from pyspark.sql import functions as F
from test_documents import components_by_hand, hits_by_hand, sets_by_hand
from tillstream.llm import queries
from tillstream.llm.queries import registry, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return database(FOLDER)


def rows_of(tables, query):
    return tables.execute(query).fetchall()


@pytest.mark.parametrize("name", sorted(registry.sql))
def test_query_equals_sql(spark, tables, name):
    mine = registry.queries[name](spark, FOLDER).toPandas()
    other = tables.execute(registry.sql[name]).df()
    for column in mine.columns:  # a column of nulls alone has no type of its own
        if mine[column].isna().all() and other[column].isna().all():
            mine[column] = other[column] = None
    for column in mine.columns:
        if other[column].dtype.kind != mine[column].dtype.kind:
            other[column] = other[column].astype(mine[column].dtype)
    assert differences(mine, other) is None and len(mine) > 0


def test_near_duplicates_of_the_table(spark, tables):
    sets = sets_by_hand(rows_of(tables, "SELECT doc_id, text FROM documents"))
    expected = components_by_hand(sets)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op1_near_dedup(spark, FOLDER).collect()}
    assert found == {i: (len(sets[i]), c, c == i) for i, c in expected.items()}


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    known = {r[0]: r[1] for r in rows_of(database(folder), "SELECT doc_id, quality FROM labels")}
    held = [(known[r.doc_id], r.predicted, r.score) for r in queries.op2_quality(spark, folder).collect() if r.held_out and r.doc_id in known]
    assert len(held) > 100 and sum(q == p for q, p, _ in held) / len(held) > 0.9
    good, bad = ([s for q, _, s in held if q == wanted] for wanted in (1, 0))
    assert sum(g > b for g in good for b in bad) / len(good) / len(bad) > 0.95


def test_language_of_held_out_documents(spark, tables):
    known = dict(rows_of(tables, "SELECT doc_id, lang FROM documents"))
    held = [r for r in queries.op4_language(spark, FOLDER).collect() if r.held_out]
    assert len(held) > 50 and sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) > 0.95


def test_main_text_of_the_table(spark, tables):
    """The given pages have one article each; its blocks, read by patterns."""
    found = {r.page_id: r.text for r in queries.op8_html_text(spark, FOLDER).collect()}
    for page_id, page in rows_of(tables, "SELECT page_id, html FROM pages"):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        article = re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1|li|div)[^>]*>", "\0", article))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", part)).split()) for part in article.split("\0")]
        assert found[page_id] == "\n".join(block for block in blocks if block)


def test_packing_of_the_table(spark, tables):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    pieces = {}
    for row in queries.op9_packing(spark, FOLDER).collect():
        pieces.setdefault(row.doc_id, []).append(row)
    for doc_id, text in rows_of(tables, "SELECT doc_id, text FROM documents"):
        data = b"".join(i.to_bytes(4, "little") for i in [*plain.encode(text or "", add_special_tokens=False).ids, 2])
        at = 0
        for piece in sorted(pieces[doc_id], key=lambda p: p.start):
            assert piece.start == at and piece.doc_tokens == len(data) // 4
            assert piece.ids_crc32 == zlib.crc32(data[4 * at : 4 * (at + piece.length)])
            at += piece.length
        assert at == len(data) // 4


def test_pipeline_against_brute_force(spark, tables):
    """Every stage on what the stage before kept, and the documents that are packed in the end."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    some = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 !", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(some).withColumn("keep", F.lit("other"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    left = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    expected = [set(left)]
    largest = {}
    for i, t in sorted(left.items()):
        largest[re.sub("[A-Z]", lambda m: m[0].lower(), t)] = i
    left = {i: left[i] for i in largest.values()}
    expected.append(set(left))
    component = components_by_hand(sets_by_hand(left.items()))
    left = {i: t for i, t in left.items() if component[i] == i}
    expected.append(set(left))
    items = rows_of(tables, "SELECT item_id, text FROM benchmark")
    expected.append({row[0] for row in hits_by_hand(left.items(), items, 10) if not row[-1]})
    expected.append(expected[-1])
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected, strict=True):
        found = stage(spark, docs, FOLDER)
        if name != "packing":
            assert found.columns == docs.columns
            found = found.cache()
        assert {r.doc_id for r in found.select("doc_id").collect()} == ids, name
        docs = found
