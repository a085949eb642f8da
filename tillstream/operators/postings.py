"""Search through postings: which documents hold a token, looked up for many queries at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 32
# Tokens as in `functions.text`: runs of letters and digits in lower case, Han characters one by one.
_TOKEN = r"[\p{L}\p{N}&&[^\p{IsHan}]]+|\p{IsHan}"


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0)))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int").alias("bucket")


def write_postings(documents: DataFrame, id_column: str, text: str, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """One row per token and document, in folders by the token's hash; gives the table.

    A token that very many documents hold is as many rows, never one list; its folder is written by several tasks.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.explode(tokens(F.col(text))).alias("token"))
    placed = rows.select("token", "id", _bucket(buckets)).hint("rebalance", "bucket")
    placed.sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(folder)
    return stored_postings(documents.sparkSession, folder, documents.schema[id_column].dataType.simpleString())


def stored_postings(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    return spark.read.schema(f"token string, id {id_type}, bucket int").parquet(folder)


def hits(postings: DataFrame, queries: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Documents with any token of a query: `query_id`, `id`, `n_tokens` (distinct tokens of the query that they hold).

    `queries` has `query_id` and `tokens`. Only postings are read, and of them the folders of the queries' tokens.
    """
    wanted = queries.select("query_id", F.explode(F.array_distinct("tokens")).alias("token")).select("*", _bucket(buckets))
    return postings.join(wanted, ["bucket", "token"]).groupBy("query_id", "id").agg(F.count(F.lit(1)).alias("n_tokens"))
