from __future__ import annotations

import pytest

from pressgrid import normalize_articles, quality_summary, violations
from pressgrid.plans.contracts import ARTICLE, CONTRACTS, TREND, record_contract
from pressgrid.schemas import SERIES, SOURCED_SERIES

RECORD = {
    "type": "object", "additionalProperties": False, "required": ["id", "name", "kind"],
    "properties": {
        "id": {"type": "integer"}, "name": {"type": ["string", "null"]}, "kind": {"type": "string", "enum": ["a", "b"]},
        "score": {"type": ["number", "null"]}, "ok": {"type": "boolean"}, "open": {"type": "object"},
        "tags": {"type": "array", "items": {"type": "string"}},
        "parts": {"type": "array", "items": {
            "type": "object", "required": ["n"], "additionalProperties": False, "properties": {"n": {"type": "integer"}}}},
    },
}


@pytest.fixture
def broken(spark):
    def run(*lines):
        rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
        found = violations(rows, RECORD, "i", json="line").collect()
        return sorted((r.record_id, r.path, r.rule) for r in found)

    return run


GOOD = '{"id": 1, "name": null, "kind": "a"'


@pytest.mark.parametrize("line,expected", [
    (GOOD + "}", []),
    (GOOD + ', "score": 1, "ok": true, "open": {"x": [1]}, "tags": ["t"], "parts": [{"n": 1}]}', []),
    (GOOD + ', "score": 1.5}', []),
    (GOOD + ', "score": 1e3}', []),
    ('{"id": true, "name": "n", "kind": "a"}', [("$.id", "type")]),
    ('{"id": 1.0, "name": "n", "kind": "a"}', [("$.id", "type")]),
    ('{"id": 123456789012345678901, "name": "n", "kind": "a"}', []),
    ('{"id": "1", "name": 5, "kind": "c"}', [("$.id", "type"), ("$.kind", "enum"), ("$.name", "type")]),
    ('{"id": null, "kind": "a"}', [("$", "required"), ("$.id", "type")]),
    (GOOD + ', "score": true}', [("$.score", "type")]),
    (GOOD + ', "ok": 1}', [("$.ok", "type")]),
    (GOOD + ', "open": []}', [("$.open", "type")]),
    (GOOD + ', "tags": ["t", 1, null]}', [("$.tags[1]", "type"), ("$.tags[2]", "type")]),
    (GOOD + ', "tags": "t"}', [("$.tags", "type")]),
    (GOOD + ', "parts": [{"n": 1}, {}, {"n": "x", "m": 1}, 4]}',
     [("$.parts[1]", "required"), ("$.parts[2]", "extra"), ("$.parts[2].n", "type"), ("$.parts[3]", "type")]),
    (GOOD + ', "zz": 1, "aa": 2}', [("$", "extra")]),
    ("[1]", [("$", "type")]),
    ("null", [("$", "type")]),
    ("{broken", [("$", "json")]),
])
def test_json_records(broken, line, expected):
    assert broken(line) == [(0, *e) for e in expected]


def test_all_violations_of_all_records(spark, broken):
    assert len(broken(GOOD + "}", '{"id": "x"}', "[]")) == 4
    rows = spark.createDataFrame([(GOOD + "}",), ('{"id": "x"}',)], "line string")
    assert tuple(quality_summary(rows, RECORD, "record", json="line").first()) == ("record", 2, 1, False)


def test_typed_tables(spark, raw):
    good = normalize_articles(raw(dict(title="x", seendate="20260101T000000Z"))).drop("window_index", "position")
    assert violations(good, ARTICLE, "article_id").count() == 0
    assert quality_summary(good, ARTICLE, "articles").first().validated
    (missing,) = violations(good.drop("domain"), ARTICLE, "article_id").collect()
    assert (missing.path, missing.rule, missing.detail) == ("$", "required", "missing domain")
    (extra,) = violations(good.selectExpr("*", "1 AS more"), ARTICLE, "article_id").collect()
    assert (extra.rule, extra.detail) == ("extra", "unexpected more")
    series = spark.createDataFrame(
        [(None, 1.0, "article_count", None, None, "corpus-timeline"), (None, None, "clicks", 2.0, "l", "corpus-timeline")],
        SOURCED_SERIES,
    )
    found = sorted((r.path, r.rule) for r in violations(series, TREND, "metric").collect())
    assert found == [("$.bucket_start", "type"), ("$.bucket_start", "type"), ("$.metric", "enum"), ("$.value", "type")]
    wrong = spark.createDataFrame([("1", ["a", None])], "value string, tags array<string>")
    contract = {"type": "object", "properties": {
        "value": {"type": "number"}, "tags": {"type": "array", "items": {"type": "string"}}}}
    assert sorted(r.path for r in violations(wrong, contract, "value").collect()) == ["$.tags[1]", "$.value"]


def test_contracts_cover_the_declared_columns():
    assert len(ARTICLE["required"]) == 24 and ARTICLE["properties"]["article_id"]["type"] == ["string", "null"]
    assert ARTICLE["properties"]["matched_keywords"] == {"type": "array", "items": {"type": "string"}}
    assert TREND["properties"]["metric"]["enum"] == ["article_count"]
    assert len(CONTRACTS["windows"]["required"]) == 8
    assert record_contract(SERIES, ())["properties"]["value"]["type"] == ["number", "null"]
