from __future__ import annotations

import pytest

from pressgrid.operators.predicates import article_predicate, in_range, select_articles, span
from pressgrid.plans.request import Filters, Near, Request, Sort, TimeRange

ROWS = (
    dict(title="Climate policy and emissions rise, emissions fall", domain="bbc.co.uk", language="English",
         sourcecountry="United Kingdom", tone=-3.0, themes=["ENV_CLIMATE"]),
    dict(title="European Union debates sports", domain="news.bbc.co.uk", language="French",
         sourcecountry="France", tone=1.5, themes=["SPORT"]),
    dict(title="PARTY in Straße", domain="example.com", language="German", sourcecountry="Germany", tone=7.0),
    dict(title=None, domain="notbbc.co.uk", language=None, sourcecountry=None, tone=None, themes=None),
)


@pytest.fixture
def picked(raw):
    def run(**filters):
        return sorted(r.position for r in raw(*ROWS).filter(article_predicate(Filters(**filters))).collect())

    return run


@pytest.mark.parametrize("filters,expected", [
    (dict(keywords=["climate"]), [0]),
    (dict(keywords=["art"]), [2]),  # substrings count
    (dict(keywords=["STRASSE"]), [2]),
    (dict(exact_phrases=['"European Union"']), [1]),
    (dict(entities=["european union", "party"]), [1, 2]),
    (dict(keywords=["policy bbc"]), []),
    (dict(keywords=["fall bbc.co.uk"]), [0]),  # a term may span two joined fields
    (dict(themes=["SPORT"]), [1]),
    (dict(themes=["SPORT"], keywords=["policy"]), [0, 1]),
    (dict(themes=["ENV_CLIMATE"], keywords=["policy", "rise"], match_mode="all"), [0]),
    (dict(keywords=["policy", "absent"], match_mode="all"), []),
    (dict(source_countries=["united kingdom", " FRANCE "]), [0, 1]),
    (dict(source_languages=["german", "english"]), [0, 2]),
    (dict(domains=["bbc.co.uk"]), [0, 1]),
    (dict(exact_domains=["BBC.co.uk"]), [0]),
    (dict(tone_max=-2), [0]),
    (dict(tone_min=1.5), [2]),  # strictly above
    (dict(tone_abs_min=2, tone_abs_max=7), [0]),
    (dict(proximity=[Near(2, ("climate", "and"))]), [0]),
    (dict(proximity=[Near(1, ("climate", "and"))]), []),
    (dict(proximity=[Near(5, ("emissions", "emissions"))]), [0]),  # a word asked for twice must occur twice
    (dict(proximity=[Near(1, ("emissions", "emissions"))]), []),
    (dict(proximity=[Near(9, ("policy", "policy"))]), []),
    (dict(repeated_terms={"emissions": 2}), [0]),
    (dict(repeated_terms={"emissions": 3}), []),
    (dict(exclude_terms=["sports"]), [0, 2, 3]),
    (dict(exclude_terms=["-sports", "climate policy"]), [2, 3]),
    (dict(exclude_terms=["theme:SPORT", "domain:example.com"]), [0, 3]),
    (dict(exclude_terms=["-sourcelang:french"]), [0, 2, 3]),
    (dict(keywords=["theme:SPORT", "domainis:example.com"]), [1, 2]),
    (dict(keywords=["sourcecountry:unitedkingdom"]), [0]),
    (dict(keywords=["-sports"]), [0, 2, 3]),
    (dict(keywords=["emissions"], source_countries=["united kingdom"], exact_domains=["bbc.co.uk"], tone_max=-2,
          proximity=[Near(5, ("climate", "emissions"))], repeated_terms={"emissions": 2}, exclude_terms=["sports"]), [0]),
])
def test_filters(picked, filters, expected):
    assert picked(**filters) == expected


def test_errors():
    with pytest.raises(ValueError, match="at least one filter"):
        article_predicate(Filters())
    with pytest.raises(ValueError, match="at least one filter"):
        article_predicate(Filters(keywords=[" "], repeated_terms={"x": 0}))
    with pytest.raises(ValueError, match="cannot be empty"):
        article_predicate(Filters(exact_phrases=['""']))
    for spec in (Filters(keywords=["c"], repeated_terms={"@": 3}), Filters(proximity=[Near(1, ("c", "@"))])):
        with pytest.raises(ValueError, match="no letters or digits"):
            article_predicate(spec)
    with pytest.raises(ValueError, match="match_mode"):
        article_predicate(Filters(keywords=["a"], match_mode="most"))
    # The mode matters only where there is content to combine.
    article_predicate(Filters(tone_min=1, match_mode="most"))
    with pytest.raises(ValueError, match="distance"):
        Near(0, ("a", "b"))
    with pytest.raises(ValueError, match="two or more"):
        Near(3, ("a", " "))
    with pytest.raises(ValueError, match="raw_fragments"):
        Filters.from_dict({"raw_fragments": ["near20:x"]})
    with pytest.raises(ValueError, match="starts after"):
        TimeRange("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError, match="not both"):
        TimeRange("2024-01-02", timespan="24h")
    for bad in (dict(max_records=0), dict(bucket_size="week"), dict(batch_window_hours=0), dict(scrape_limit=0)):
        with pytest.raises(ValueError):
            Request(filters=Filters(keywords=["x"]), **bad)


def test_time_range(spark, raw):
    from pressgrid.sources import with_seen_at

    rows = with_seen_at(raw(*(dict(seendate=f"2024010{d}T000000Z", title=str(d)) for d in range(1, 6)), dict(title="x")))

    def days(**kw):
        return sorted(r.title for r in rows.filter(in_range(TimeRange(**kw))).collect())

    assert days(start="2024-01-02", end="2024-01-04") == ["2", "3", "4"]
    assert days(start="2024-01-04") == ["4", "5"]
    assert days(end="2024-01-01") == ["1"]
    assert days(timespan="2days", as_of="2024-01-04T12:00:00Z") == ["3", "4"]
    assert len(days()) == 6
    with pytest.raises(ValueError, match="as_of"):
        in_range(TimeRange(timespan="24h"))
    with pytest.raises(ValueError, match="timespan"):
        span("soon")
    assert [span(t).total_seconds() for t in ("24h", "15min", "7days", "1w")] == [86400, 900, 604800, 604800]
    chosen = select_articles(rows, Filters(keywords=["2", "9"]), TimeRange("2024-01-01", "2024-01-03"))
    assert [r.title for r in chosen.collect()] == ["2"]


def test_request_from_dict():
    request = Request.from_dict({
        "filters": {"keywords": ["climate change", " "], "proximity": [{"distance": 5, "terms": ["a", "b"]}],
                    "repeated_terms": {" emissions ": 2}, "match_mode": " ANY "},
        "date_range": {"start": "2026-04-15T00:00:00Z", "end": "2026-04-16T23:59:59Z"},
        "sort": "DateDesc", "bucket_size": " Hour ", "batch_window_hours": None, "scrape_timeout": 15,
    })
    assert request.filters.keywords == ("climate change",)
    assert request.filters.proximity[0].distance == 5 and request.filters.repeated_terms == {"emissions": 2}
    assert request.sort is Sort.NEWEST and request.bucket_size == "hour"
    assert request.batch_window_hours == 24 and request.max_records is None and request.deduplicate
    assert not Request.from_dict({"deduplicate": None}).deduplicate and Request.from_dict({}).sort is Sort.RELEVANCE
