"""Article selection: filters and time ranges compiled to ``Column`` predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgrid.functions.text import (
    blank_to_null,
    compact_key,
    count_words,
    fold,
    fold_words,
    holds,
    strip,
    words_within,
)
from pressgrid.plans.request import MATCH_MODES, Filters, TimeRange

# Columns whose text is searched, in this order; a landed corpus adds its full text as ``text``.
LISTED_TEXT = ("title", "domain", "sourcecountry")
CORPUS_TEXT = (*LISTED_TEXT, "text")

# The prefixes of a scoped keyword.
_PREFIXED = re.compile(r"(theme|domain|domainis|sourcecountry|sourcelang):(.*)", re.S)
_SPAN = re.compile(r"(\d+)\s*([a-z]*)")
# The units of a relative time range, in minutes.
_SPAN_UNITS = {
    "min": 1, "mins": 1, "minute": 1, "minutes": 1,
    "h": 60, "hour": 60, "hours": 60,
    "d": 1440, "day": 1440, "days": 1440,
    "w": 10080, "week": 10080, "weeks": 10080,
    "m": 43200, "month": 43200, "months": 43200,
}


def _any(tests: Iterable[Column]) -> Column:
    return reduce(or_, tests)


def _all(tests: Iterable[Column]) -> Column:
    return reduce(and_, tests)


def in_theme(theme: str) -> Column:
    return F.array_contains("themes", theme.strip())


def in_country(countries: Sequence[str]) -> Column:
    return compact_key(F.col("sourcecountry")).isin([c.strip().lower().replace(" ", "") for c in countries])


def in_language(languages: Sequence[str]) -> Column:
    return compact_key(F.col("language")).isin([c.strip().lower().replace(" ", "") for c in languages])


def in_domain_group(domain: str) -> Column:
    """The domain itself or any of its subdomains."""
    name = domain.strip().lower()
    actual = F.lower(strip(F.col("domain")))
    return (actual == name) | actual.endswith(f".{name}")


def in_exact_domain(domains: Sequence[str]) -> Column:
    return F.lower(strip(F.col("domain"))).isin([d.strip().lower() for d in domains])


def _scoped(kind: str, value: str) -> Column:
    match kind:
        case "theme":
            return in_theme(value)
        case "domain":
            return in_domain_group(value)
        case "domainis":
            return in_exact_domain([value])
        case "sourcecountry":
            return in_country([value])
        case _:
            return in_language([value])


def _phrase(value: str, space: Column) -> Column:
    text = value.replace('"', "").strip()
    if not text:
        raise ValueError("a search term cannot be empty")
    return space.contains(text.casefold())


def _keyword(value: str, space: Column) -> Column:
    """A bare word, a phrase (anything with a space) or a prefixed scope such as ``domain:x``."""
    scope = _PREFIXED.fullmatch(value)
    return _scoped(*scope.groups()) if scope else _phrase(value, space)


def _excluded(value: str, space: Column) -> Column:
    """The negated keyword; a minus sign already in front of a bare word is not doubled."""
    bare = value.removeprefix("-") if " " not in value else value
    return ~F.coalesce(_keyword(bare, space), F.lit(False))


def _included(value: str, space: Column) -> Column:
    if value.startswith("-") and " " not in value:
        return _excluded(value, space)
    return _keyword(value, space)


def _searches_text(value: str) -> bool:
    return not _PREFIXED.fullmatch(value.removeprefix("-") if " " not in value else value)


def scope_tests(spec: Filters) -> list[Column]:
    """Tests on single short columns; listed first so that they cut rows before any text is read."""
    tests = []
    if spec.tone_min is not None:
        tests.append(F.col("tone") > spec.tone_min)
    if spec.tone_max is not None:
        tests.append(F.col("tone") < spec.tone_max)
    if spec.tone_abs_min is not None:
        tests.append(F.abs("tone") > spec.tone_abs_min)
    if spec.tone_abs_max is not None:
        tests.append(F.abs("tone") < spec.tone_abs_max)
    if spec.source_countries:
        tests.append(in_country(spec.source_countries))
    if spec.source_languages:
        tests.append(in_language(spec.source_languages))
    if spec.domains:
        tests.append(_any(map(in_domain_group, spec.domains)))
    if spec.exact_domains:
        tests.append(in_exact_domain(spec.exact_domains))
    return tests


def _repeats(spec: Filters) -> list[tuple[list[str], int]]:
    """Repeated terms as words and counts, leaving out those whose count asks for nothing."""
    return [(_words(term), count) for term, count in spec.repeated_terms.items() if count > 0]


def _words(term: str) -> list[str]:
    """The folded words of a term; one without letters or digits could never be counted and is refused."""
    words = fold_words(term)
    if not words:
        raise ValueError(f"the term {term!r} has no letters or digits")
    return words


def text_test(spec: Filters, space: Column) -> Column | None:
    """Everything that looks at the folded text ``space``, as one test; null when nothing does."""
    content = [
        *(_included(value, space) for value in spec.keywords),
        *(_phrase(value, space) for value in (*spec.exact_phrases, *spec.entities)),
        *map(in_theme, spec.themes),
    ]
    tests = []
    if content:
        if spec.match_mode not in MATCH_MODES:
            raise ValueError(f"match_mode must be one of {', '.join(MATCH_MODES)}")
        # Missing themes or domains make a test null, which must not spoil the other alternatives.
        content = [F.coalesce(test, F.lit(False)) for test in content]
        tests.append((_all if spec.match_mode == "all" else _any)(content))
    tests += [_excluded(value, space) for value in spec.exclude_terms]
    for words, count in _repeats(spec):
        tests.append(space.contains(words[0]) & (count_words(space, words) >= count))
    for near in spec.proximity:
        tests.append(words_within(space, [word for term in near.terms for word in _words(term)], near.distance))
    return _all(tests) if tests else None


def match_space(columns: Sequence[str] | Sequence[Column]) -> Column:
    """The non-empty texts joined by single spaces."""
    parts = (F.col(c) if isinstance(c, str) else c for c in columns)
    return F.concat_ws(" ", *(blank_to_null(part) for part in parts))


def article_predicate(spec: Filters, text_columns: Sequence[str] = LISTED_TEXT) -> Column:
    """All filters of ``spec`` as one predicate for ``df.filter``.

    The searched text is folded once per row, however many terms there are.
    """
    tests = scope_tests(spec)
    needs_text = (
        any(map(_searches_text, (*spec.keywords, *spec.exclude_terms)))
        or spec.exact_phrases or spec.entities or spec.proximity or _repeats(spec)
    )
    if needs_text:
        tests.append(holds(fold(match_space(text_columns)), lambda space: text_test(spec, space)))
    elif (test := text_test(spec, F.lit(""))) is not None:
        tests.append(test)
    if not tests:
        raise ValueError("at least one filter is required")
    return _all(tests)


def span(text: str) -> timedelta:
    """Length of a relative range: a count and a unit, such as ``24h``, ``7days`` or ``15min``."""
    found = _SPAN.fullmatch(text.strip().lower())
    if not found or found[2] not in _SPAN_UNITS:
        raise ValueError(f"cannot read the timespan {text!r}")
    return timedelta(minutes=int(found[1]) * _SPAN_UNITS[found[2]])


def bounds(date_range: TimeRange) -> TimeRange:
    """The range with a timespan turned into explicit bounds."""
    if not date_range.timespan:
        return date_range
    if date_range.as_of is None:
        raise ValueError("a timespan needs the as_of time it is counted back from")
    return TimeRange(date_range.as_of - span(date_range.timespan), date_range.as_of)


def in_range(date_range: TimeRange, column: str = "seen_at") -> Column:
    """Both ends included, either may be open. Literals only, so the test reaches the file scan."""
    limits = bounds(date_range)
    test = F.lit(True)
    if limits.start:
        test = test & (F.col(column) >= F.lit(limits.start))
    if limits.end:
        test = test & (F.col(column) <= F.lit(limits.end))
    return test


def within(articles: DataFrame, date_range: TimeRange, column: str = "seen_at") -> DataFrame:
    """Articles inside the time range.

    A ``seen_date`` column, by which landed tables are partitioned, is tested as well, so that directories outside
    the range are never listed.
    """
    articles = articles.filter(in_range(date_range, column))
    if column != "seen_at" or "seen_date" not in articles.columns:
        return articles
    limits = bounds(date_range)
    if limits.start:
        articles = articles.filter(F.col("seen_date") >= F.lit(limits.start.date()))
    if limits.end:
        articles = articles.filter(F.col("seen_date") <= F.lit(limits.end.date()))
    return articles


def select_articles(
    articles: DataFrame,
    spec: Filters,
    date_range: TimeRange | None = None,
    text_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Articles that pass the filters and the time range."""
    if text_columns is None:
        text_columns = CORPUS_TEXT if "text" in articles.columns else LISTED_TEXT
    if date_range is not None:
        articles = within(articles, date_range)
    return articles.filter(article_predicate(spec, text_columns))
