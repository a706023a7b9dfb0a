"""Keyword -> genre rules and model-response parsing as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewlens import schemas as S


def literal_lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Exact-match lookup in a small fixed table (NULL when absent)."""
    if not table:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in table.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[key]


def hint_genre(keyword: Column, hints: Sequence[tuple[str, Sequence[str]]] = S.GENRE_HINTS) -> Column:
    """First hint whose word occurs in the lower-cased keyword (NULL if none)."""
    low = F.lower(keyword)
    expr = None
    for genre, words in hints:
        cond = None
        for w in words:
            c = low.contains(w.lower())
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(genre)) if expr is None else expr.when(cond, F.lit(genre))
    return expr


def closed_genre(genre: Column, genres: Sequence[str] = S.GENRES, default: str = S.DEFAULT_GENRE) -> Column:
    """Labels outside the closed set (and NULL) become the default."""
    return F.when(genre.isin(list(genres)), genre).otherwise(F.lit(default))


def rule_genre(keyword: Column, named: Column | None = None, overrides: Mapping[str, str] = S.GENRE_EXAMPLES,
               hints: Sequence[tuple[str, Sequence[str]]] = S.GENRE_HINTS) -> Column:
    """Worked examples first, then hints, then the genre of a known name, then the default label."""
    rules = [literal_lookup(keyword, overrides), hint_genre(keyword, hints)] + ([named] if named is not None else [])
    return closed_genre(F.coalesce(*rules))


def response_json(text: Column) -> Column:
    """The span from the first '{' to the last '}' of a free-text answer."""
    return F.regexp_extract(text, r"(?s)(\{.*\})", 1)


def parse_response_map(text: Column) -> Column:
    """keyword -> label entries of a free-text answer, in their order; NULL when it is not one JSON object.

    The span is parsed as the value of a wrapper object, so anything after
    the answer's object (a second object, text) is malformed as a whole.
    """
    wrapped = F.concat(F.lit('{"answer":'), response_json(text), F.lit("}"))
    parsed = F.from_json(wrapped, "answer map<string,string>, _bad string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"})
    return F.when(parsed["_bad"].isNull(), F.map_entries(parsed["answer"]))


def label_from_response(entries: Column, keyword: Column, default: str = S.DEFAULT_GENRE) -> Column:
    """The answer's last label for ``keyword``; missing key / object -> default."""
    return F.coalesce(F.try_element_at(F.filter(entries, lambda e: e["key"] == keyword), F.lit(-1))["value"], F.lit(default))
