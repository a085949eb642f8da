"""Search, JSON rows and text keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions.documents import record_json
from tillstream.functions.keys import joined, prefixed, source_topic
from tillstream.functions.text import has_nested_term, query_tokens
from tillstream.operators.postings import hits, tokens, write_postings
from tillstream.operators.search import by_id, search
from tillstream.plans.inputs import load
from tillstream.plans.registry import Registry
from tillstream.session import workspace
from tillstream.sources.tables import sql_rows

registry = Registry()

QUERY = "Eauouon enpaeux the"
NESTED_TERM = "with"

_TOKENS = "[" + ", ".join(f"'{t}'" for t in query_tokens(QUERY)) + "]"
_WORDS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+')"
_HIT = f"list_has_any({_WORDS.format('lower(text)')}, {_TOKENS})"
_MARKED = (
    rf"array_to_string([CASE WHEN list_contains({_TOKENS}, lower(x)) THEN '<em>' || x || '</em>' ELSE x END "
    rf"FOR x IN regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')], '')"
)


def _nested(documents):
    """Documents with their words as an array of structs (place, name)."""
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return documents.withColumn("items", F.transform(words, lambda word, place: F.struct(place.alias("id"), word.alias("name"))))


@registry.query(f"SELECT doc_id, lang, {_MARKED} AS marked FROM documents WHERE {_HIT}")
def search_match(spark, folder):
    """All documents with a token of the query, tokens marked."""
    return search(load(spark, folder, "documents"), "text", QUERY, mark="marked").select("doc_id", "lang", "marked")


@registry.query(
    rf"""
    WITH asked AS (
        SELECT item_id, unnest(list_distinct(list_filter({_WORDS.format('lower(text)')}, lambda t: length(t) >= 10))) AS token FROM benchmark),
    held AS (SELECT doc_id, unnest(list_distinct({_WORDS.format('lower(text)')})) AS token FROM documents)
    SELECT item_id, doc_id, count(*) AS n_tokens FROM asked JOIN held USING (token) GROUP BY item_id, doc_id
    """
)
def search_many(spark, folder):
    """The long words of every benchmark item as one query each, answered together from a table of postings."""
    place = workspace(spark, "postings")
    postings = write_postings(load(spark, folder, "documents"), "doc_id", "text", place)
    asked = load(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.filter(tokens(F.col("text")), lambda t: F.char_length(t) >= 10).alias("tokens")
    )
    return hits(postings, asked).select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id"), "n_tokens")


def _page(spark, folder, sort, start, size):
    found = search(
        load(spark, folder, "documents"), "text", QUERY, only=F.col("lang") == "en", sort=sort, start=start, size=size,
        mark="marked",
    )
    return found.select("doc_id", "n_chars", "marked")


def _page_sql(order: str, start: int, size: int) -> str:
    return f"""
        SELECT doc_id, n_chars, {_MARKED} AS marked FROM documents WHERE lang = 'en' AND {_HIT}
        ORDER BY n_chars {order}, doc_id LIMIT {size} OFFSET {start}
    """


@registry.query(_page_sql("DESC", 0, 20))
def search_page(spark, folder):
    return _page(spark, folder, [F.col("n_chars").desc(), F.col("doc_id")], 0, 20)


@registry.query(_page_sql("ASC", 10, 10))
def search_next_page_ascending(spark, folder):
    return _page(spark, folder, [F.col("n_chars"), F.col("doc_id")], 10, 10)


@registry.query(
    rf"""
    SELECT doc_id, lang FROM documents WHERE list_contains({_WORDS.format('text')}, '{NESTED_TERM}')
    """
)
def search_nested_term(spark, folder):
    """Documents as an id with an array of structs; those with an element of exactly this name."""
    nested = _nested(load(spark, folder, "documents"))
    return nested.filter(has_nested_term(F.col("items"), "name", NESTED_TERM)).select("doc_id", "lang")


@registry.query(
    rf"""
    SELECT doc_id, n_chars, {_MARKED} AS marked FROM documents
    WHERE {_HIT} AND list_contains({_WORDS.format('text')}, '{NESTED_TERM}')
    ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 5
    """
)
def search_request(spark, folder):
    """A whole request: match, exact term in nested structs, sort, page and highlight."""
    found = search(
        _nested(load(spark, folder, "documents")), "text", QUERY, only=has_nested_term(F.col("items"), "name", NESTED_TERM),
        sort=[F.col("n_chars").desc(), F.col("doc_id")], start=5, size=20, mark="marked",
    )
    return found.select("doc_id", "n_chars", "marked")


@registry.query("SELECT doc_id, lang, source, n_chars, text FROM documents WHERE doc_id = 42")
def document_by_id(spark, folder):
    return by_id(load(spark, folder, "documents"), "doc_id", 42).select("doc_id", "lang", "source", "n_chars", "text")


@registry.query(
    """
    SELECT conv_id, CAST(count(*) AS BIGINT) AS turns, CAST(count(*) FILTER (role = 'system') AS BIGINT) AS hits
    FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'system') > 0
    """
)
def search_nested_rows(spark, folder):
    """Conversations with a system turn: the nested rows are tested before they are put together."""
    turns = load(spark, folder, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.count_if(F.col("role") == "system").alias("hits")
    )
    return turns.filter(F.col("hits") > 0)


@registry.query(
    """
    SELECT CAST(to_json({'id': o_orderkey, 'user_id': o_custkey, 'order_status': o_orderstatus,
                         'final_total_amount': o_totalprice}) AS VARCHAR) AS "row" FROM orders
    """
)
def row_json(spark, folder):
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("final_total_amount"),
    )
    return orders.select(record_json().alias("row"))


@registry.query(
    """
    SELECT CAST(to_json({'USER_ID': o_custkey, 'ORDERS': count(*)}) AS VARCHAR) AS "row" FROM orders GROUP BY o_custkey
    """
)
def sql_rows_json(spark, folder):
    query = "SELECT o_custkey AS user_id, count(*) AS orders FROM {orders} GROUP BY o_custkey"
    return sql_rows(spark, query, upper_labels=True, orders=load(spark, folder, "orders"))


@registry.query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'ods_' || lower(l_returnflag) AS topic,
           'order_join:' || l_orderkey AS state_key, l_returnflag || ',' || l_linestatus AS flags
    FROM lineitem
    """
)
def text_keys(spark, folder):
    lines = load(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        source_topic(F.lower("l_returnflag")).alias("topic"),
        prefixed("order_join", F.col("l_orderkey")).alias("state_key"),
        joined(F.array("l_returnflag", "l_linestatus")).alias("flags"),
    )


@registry.query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def first_rows(spark, folder):
    """The rows a console print of 100 shows."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)
