"""The operators over the given tables, with their SQL form where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.llm import (
    byte_bpe, decontamination, exact_dedup, fill_in_middle, html_text, importance, language, line_dedup, near_dedup, packing,
    quality, sql, url_filter, warc,
)
from tillstream.llm.base import table
from tillstream.plans.registry import Registry
from tillstream.session import tune

registry = Registry()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@registry.query()
def op1_near_dedup(spark, folder):
    """Near-duplicate groups; the document with the smallest id stays."""
    return near_dedup.near_groups(table(tune(spark), folder, "documents")).drop("class_id", "text_key")


@registry.query()
def op2_quality(spark, folder):
    """Quality score of every document."""
    tune(spark)
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@registry.query(sql.URL_FILTER)
def op3_url_filter(spark, folder):
    """Host, path, rule and verdict of every page's URL."""
    return url_filter.judged_pages(table(tune(spark), folder, "pages"))


@registry.query()
def op4_language(spark, folder):
    """Language of every document."""
    return language.identify(table(tune(spark), folder, "documents"))


@registry.query(sql.EXACT_DEDUP)
def op5_exact_dedup(spark, folder):
    """Groups of equal texts and the row that stays."""
    return exact_dedup.exact_groups(table(tune(spark), folder, "documents")).drop("locator")


@registry.query(sql.LINE_DEDUP)
def op6_line_dedup(spark, folder):
    """Texts without the passages that an earlier place has, and where the removed units were."""
    rows = line_dedup.without_repeats(table(tune(spark), folder, "documents"))
    spans = F.transform("removed", lambda span: F.concat(span["start"].cast("string"), F.lit("+"), span["length"].cast("string")))
    return rows.select(
        "doc_id", F.col("n_removed").cast("bigint").alias("n_removed"), F.array_join(spans, ",").alias("removed"), "text"
    )


@registry.query(sql.DECONTAMINATION)
def op7_decontamination(spark, folder):
    """Words of each document that lie in windows of benchmark items."""
    tune(spark)
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("items", "hits")


@registry.query()
def op8_html_text(spark, folder):
    """Main text of every page."""
    return html_text.main_text(table(tune(spark), folder, "pages"))


@registry.query()
def op9_packing(spark, folder):
    """Pieces of the packed token sequences."""
    return packing.packed(table(tune(spark), folder, "documents"), tokenizer_path(), with_ids=False)


@registry.query(sql.ARCHIVES)
def op10_warc(spark, folder):
    """Pages after a way through ARC and WARC files."""
    return warc.archived(table(tune(spark), folder, "pages")).drop("record_id")


@registry.query(sql.FILL_IN_MIDDLE)
def op11_fill_in_middle(spark, folder):
    """Form, cuts and digests of every text after its middle went to the end, and of the text restored from that."""
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(table(tune(spark), folder, "documents")))


@registry.query()
def op12_byte_bpe(spark, folder):
    """Number and digest of every text's tokens, and the digest of what they decode to."""
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(tune(spark), folder, "documents"), path)


@registry.query()
def op13_importance(spark, folder):
    """Weight, score and rank of every document in a sample that follows the benchmark's n-grams."""
    tune(spark)
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("n_words")
