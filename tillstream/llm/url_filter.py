"""URL filter: rules are regular expressions, found through their rarest literal token.

Every rule names the literal words a matching URL must contain. Word counts over all distinct URLs tell
which of a rule's words is rarest, and the rule is indexed under that word alone. A URL's words fetch
candidate rules from the index, and only these run their regular expression.

Defined cases: a null URL, or one without `://`, has an empty host and path and no rule; a repeated URL is
judged once and each of its rows gets the verdict; of rules that fit, the longest wins, then the
alphabetically last; a rule without literal words is a candidate for every URL; an empty table gives an empty result. Other
columns of the input are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillstream.llm.base import LOWER, UPPER, filled

NO_WORD = ""


@dataclass(frozen=True)
class Rule:
    """A pattern over host and path put together, the words it needs, its verdict and its rank among fitting rules."""

    name: str
    pattern: str
    verdict: str
    words: tuple[str, ...]
    rank: int
    named: bool = True


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with its subdomains and the paths that start with `path`."""
    closed = path[: path.rfind("/") + 1]  # a last segment that is still open may go on in a URL
    words = tuple(dict.fromkeys(re.findall(r"[a-z0-9]+", f"{host}/{closed}".lower())))
    pattern = rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, pattern, verdict, words, len(host + path))


def host_word_rule(word: str, verdict: str = "block") -> Rule:
    """A rule for hosts with a word in one of their labels; it yields to every site rule and gives no rule name."""
    return Rule(word, rf"(?s)^(?:[^/]*[^/a-z0-9])?{re.escape(word)}(?![a-z0-9])", verdict, (word,), -1, named=False)


# The given site rules, and words that mark a host as unwanted where no site rule fits.
SITE_RULES = [
    site_rule("net", "/", "block"),
    site_rule("example.net", "/en/", "allow"),
    site_rule("example.com", "/de/", "block"),
    site_rule("org", "/fr/", "allow"),
]
UNWANTED_HOST_WORDS = ["casino", "gambling", "porn", "spam", "viagra"]
DEFAULT_RULES = SITE_RULES + [host_word_rule(word) for word in UNWANTED_HOST_WORDS]


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    return F.regexp_extract(filled(url), r"(?s)^.*?://(.*)$", 1)


def judged_urls(pages: DataFrame, rules: list[Rule] = DEFAULT_RULES, url: str = "url") -> DataFrame:
    """Distinct URLs with host, path, the named rule that decided (or null) and the verdict."""
    spark = pages.sparkSession
    urls = pages.select(F.col(url).alias("url")).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    target = F.concat("host", "path")
    words = F.array_distinct(F.split(F.translate(target, UPPER, LOWER), "[^a-z0-9]+"))
    by_word = urls.select("url", target.alias("target"), F.explode(F.array_union(words, F.array(F.lit(NO_WORD)))).alias("word"))

    def small(rows, *columns):
        fields = [StructField(name, IntegerType() if name == "rank" else StringType()) for name in columns]
        return spark.createDataFrame(rows, StructType(fields))

    # one number for each word of the rules: as many as the rules passed in have
    needed = sorted({word for rule in rules for word in rule.words})
    counted = by_word.join(small([(word,) for word in needed], "word"), "word").groupBy("word").count()
    counts = {row["word"]: row["count"] for row in counted.collect()}
    rarest = [min(rule.words, key=lambda word: (counts.get(word, 0), word), default=NO_WORD) for rule in rules]
    index = small(
        [(word, r.name if r.named else None, r.pattern, r.verdict, r.rank) for word, r in zip(rarest, rules)],
        "word", "rule", "pattern", "verdict", "rank",
    )
    fitting = by_word.join(index, "word").where(F.expr("target RLIKE pattern"))
    best = fitting.groupBy("url").agg(F.max(F.struct("rank", "rule", "verdict")).alias("best"))
    return urls.join(best, "url", "left").select(
        "url", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit("allow")).alias("verdict")
    )


def judged_pages(pages: DataFrame, rules: list[Rule] = DEFAULT_RULES) -> DataFrame:
    """Every page with host, path, rule and verdict of its URL."""
    judged = judged_urls(pages, rules).withColumnRenamed("url", "judged_url")
    rows = pages.select("page_id", "url").join(judged, F.col("url").eqNullSafe(F.col("judged_url")), "left")
    return rows.select("page_id", "host", "path", "rule", "verdict")
