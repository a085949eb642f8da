"""Full-text predicates on whole texts: tokens, match, highlight, nested terms."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

_WORD = re.compile(r"[^\W_]+")
_HAN = re.compile(r"[㐀-䶿一-鿿]")
_NOT_WORD_BEFORE = r"(?<![\p{L}\p{N}&&[^\p{IsHan}]])"
_NOT_WORD_AFTER = r"(?![\p{L}\p{N}&&[^\p{IsHan}]])"


def query_tokens(query: str) -> list[str]:
    """Lower-case tokens of a query string: runs of letters and digits, Han characters one by one."""
    tokens: list[str] = []
    for run in _WORD.findall(query.lower()):
        tokens += _HAN.findall(run) + [part for part in _HAN.split(run) if part]
    return list(dict.fromkeys(tokens))


def _pattern(tokens: list[str]) -> str:
    han = [t for t in tokens if _HAN.fullmatch(t)]
    words = [t for t in tokens if not _HAN.fullmatch(t)]
    parts = list(han)
    if words:
        parts.append(f"{_NOT_WORD_BEFORE}(?:{'|'.join(words)}){_NOT_WORD_AFTER}")
    return "|".join(parts)


def matches(text: Column, query: str) -> Column:
    """True when the text holds any token of the query. A plain search goes first: most texts hold none of the tokens at all."""
    tokens = query_tokens(query)
    if not tokens:
        return F.lit(False)
    lowered = F.lower(text)
    return reduce(or_, [lowered.contains(token) for token in tokens]) & lowered.rlike(_pattern(tokens))


def highlight(text: Column, query: str, before: str = "<em>", after: str = "</em>") -> Column:
    """The text with every matching token marked."""
    tokens = query_tokens(query)
    return F.regexp_replace(text, f"(?iu)({_pattern(tokens)})", f"{before}$1{after}") if tokens else text


def has_nested_term(items: Column, field: str, term: str) -> Column:
    """True when some struct of the array has exactly this field value."""
    return F.coalesce(F.exists(items, lambda item: item[field] == term), F.lit(False))
