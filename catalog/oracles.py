"""DuckDB SQL for the registered queries, written from the meaning of each operator."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%SZ'"

FEED = f"""
feed AS (
  SELECT event_id,
    CASE WHEN event_id % 7 = 0 THEN NULL
         WHEN event_id % 10 = 3
           THEN upper('https://' || event_type || '.example.com/' || user_id || '/' || floor(value)::BIGINT)
         ELSE 'https://' || event_type || '.example.com/' || user_id || '/' || floor(value)::BIGINT END AS url,
    event_type || ' reported by user ' || user_id AS title,
    strftime(ts, '%Y%m%dT%H%M%SZ') AS seendate,
    date_trunc('second', ts) AS seen_at,
    event_type || '.example.com' AS domain,
    CASE user_id % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'French' WHEN 2 THEN 'German' ELSE 'Spanish' END
      AS language,
    replace(n_name, '_', ' ') AS sourcecountry, 5 - value / 10 AS tone,
    (event_id // 100)::INTEGER AS window_index, (event_id % 100)::INTEGER AS position,
    (event_id // 100) * 4294967296 + event_id % 100 AS fetch_key
  FROM events JOIN nation ON n_nationkey = user_id % 25)
"""

CORPUS = """
corpus AS (
  SELECT doc_id,
    CASE WHEN doc_id % 7 = 0 THEN NULL
         ELSE 'https://' || source || '.example.com/a/' || doc_id END AS url,
    'Report from ' || replace(n_name, '_', ' ') || ' by ' || source AS title,
    TIMESTAMP '2024-01-01' + to_seconds(doc_id * 7919 % 2592000) AS seen_at,
    source || '.example.com' AS domain, lang AS language, replace(n_name, '_', ' ') AS sourcecountry,
    (n_chars % 2001 - 1000)::DOUBLE / 100 AS tone, source, text,
    replace(lower(concat_ws(' ', 'Report from ' || replace(n_name, '_', ' ') || ' by ' || source, source || '.example.com',
                            replace(n_name, '_', ' '), nullif(text, ''))), 'ß', 'ss') AS space,
    (doc_id // 100)::INTEGER AS window_index, (doc_id % 100)::INTEGER AS position
  FROM documents JOIN nation ON n_nationkey = doc_id % 25)
"""

# Python-style white space, for trimming.
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"

LINKED = """
linked AS (
  SELECT c.* EXCLUDE (url), coalesce(p.url, c.url) AS url, p.url AS page_url, p.page_id, p.html
  FROM corpus c LEFT JOIN pages p ON p.page_id = c.doc_id)
"""

TIMELINE = """
points AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 4 = 1 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS moment,
    CASE WHEN event_id % 11 = 0 THEN 7.0 WHEN event_id % 13 = 0 THEN NULL ELSE value END AS v,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 0.0 ELSE user_id::DOUBLE END AS norm
  FROM events)
"""

DEDUP = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY CASE WHEN coalesce(url, '') <> '' THEN 'url:' || lower(url)
                      ELSE 'fallback:' || lower(title) || '|' || seendate || '|' || lower(domain) END
    ORDER BY window_index, position) AS rn
  FROM feed)
"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


def _volume(size: str) -> str:
    return _with(FEED) + f"""
    SELECT strftime(date_trunc('{size}', seen_at), {ISO}) AS bucket_start, count(*)::DOUBLE AS value,
           'article_count' AS metric, NULL::DOUBLE AS norm, NULL::VARCHAR AS label
    FROM feed GROUP BY date_trunc('{size}', seen_at)"""


KEYWORDS = "['And The', 'eaux', 'LICENSE', 'absentterm', 'tion and']"
ENTITIES = "['Nation 7', 'für', 'the the', 'nation 1']"


def _hits(terms: str) -> str:
    return f"list_filter({terms}, lambda t: contains(space, replace(lower(t), 'ß', 'ss')))"


def _entities(size: str) -> str:
    return _with(CORPUS) + f"""
    SELECT strftime(bucket, {ISO}) AS bucket_start, entity, count(*) AS article_count
    FROM (SELECT date_trunc('{size}', seen_at) AS bucket, unnest({_hits(ENTITIES)}) AS entity FROM corpus)
    GROUP BY bucket, entity"""


def _rank(column: str) -> str:
    return _with(FEED) + f"""
    SELECT {column} AS value, count(*) AS count, min(fetch_key)::VARCHAR AS first_at
    FROM feed GROUP BY {column}"""


def _filter(where: str) -> str:
    return _with(CORPUS) + f" SELECT doc_id, domain, language FROM corpus WHERE {where}"


WORDS = r"""
words AS (
  SELECT doc_id, w.word, w.at FROM (
    SELECT doc_id, unnest(list_transform(regexp_split_to_array(space, '[^\p{L}\p{N}]+'),
                                         lambda x, i: {'word': x, 'at': i})) AS w
    FROM corpus))
"""

FILTERS = {
    "filter_any": "contains(space, 'eaux') OR contains(space, 'license') OR contains(space, 'and the')"
                  " OR contains(space, 'nation 7')",
    "filter_all": "contains(space, 'the') AND contains(space, 'tion') AND contains(space, 'of the')",
    "filter_keyword": "contains(space, 'eaux')",
    "filter_phrase": "contains(space, 'tion and')",
    "filter_entity": "contains(space, 'nation 3') OR contains(space, 'nation 21')",
    "filter_theme": "language = 'de' OR source = 'src3'",
    "filter_prefix": "language = 'fr' OR sourcecountry = 'NATION 9' OR source = 'src5'",
    "filter_country_lang": "sourcecountry IN ('NATION 3', 'NATION 12') AND language IN ('en', 'de')",
    "filter_domain": "domain LIKE '%.example.com' AND language <> 'fr'",
    "filter_exact_domain": "domain IN ('src1.example.com', 'src2.example.com')",
    "filter_tone": "tone > -2.5 AND tone < 4.0",
    "filter_tone_abs": "abs(tone) > 3.0 AND abs(tone) < 8.0",
    "filter_repeat": r"len(list_filter(regexp_split_to_array(space, '[^\p{L}\p{N}]+'), lambda w: w = 'the')) >= 5",
    "filter_exclude": "language = 'en' AND NOT contains(space, 'the') AND NOT contains(space, 'license')"
                      " AND NOT contains(space, 'of the')",
}


def _sort(order: str) -> str:
    return _with(FEED) + f"""
    SELECT event_id, seendate, round(tone, 6) AS tone, window_index, position,
           row_number() OVER (ORDER BY {order}) AS rank FROM feed"""


def _rebucket(size: str, value: str) -> str:
    return _with(TIMELINE) + f"""
    SELECT strftime(date_trunc('{size}', moment), {ISO}) AS bucket_start, round({value}, 6) AS value,
           'article_count' AS metric, nullif(round(sum(norm), 6), 0) AS norm, NULL::VARCHAR AS label
    FROM points WHERE v IS NOT NULL GROUP BY date_trunc('{size}', moment)"""


def tree(source: str, max_rows: int) -> str:
    """Recursive halving of the 30 days of January from the 1st, half-open windows, the last one closed."""
    return f"""
ev AS (SELECT epoch_us(seen_at) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM {source}),
base AS (SELECT i AS base, i * 86400000000 AS lo, (i + 1) * 86400000000 AS hi FROM range(30) r(i)),
nodes AS (
  SELECT b.base, b.lo, b.hi, 0 AS depth, count(e.us) AS n
  FROM base b LEFT JOIN ev e ON e.us >= b.lo AND (e.us < b.hi OR (b.base = 29 AND e.us = b.hi))
  GROUP BY b.base, b.lo, b.hi
  UNION ALL
  SELECT c.base, c.lo, c.hi, c.depth, count(e.us) AS n
  FROM (
    SELECT base, depth + 1 AS depth,
      CASE WHEN s.side = 0 THEN lo ELSE lo + greatest(1, (hi - lo) // 2000000) * 1000000 END AS lo,
      CASE WHEN s.side = 1 THEN hi ELSE lo + greatest(1, (hi - lo) // 2000000) * 1000000 END AS hi
    FROM nodes, (VALUES (0), (1)) s(side)
    WHERE n >= {max_rows} AND hi - lo >= 2000000) c
  LEFT JOIN ev e ON e.us >= c.lo AND (e.us < c.hi OR (c.hi = 2592000000000 AND e.us = c.hi))
  GROUP BY c.base, c.lo, c.hi, c.depth),
leaves AS (
  SELECT *, (row_number() OVER (ORDER BY lo))::INTEGER AS idx FROM nodes
  WHERE NOT (n >= {max_rows} AND hi - lo >= 2000000))
"""


def _at(us: str) -> str:
    return f"strftime(TIMESTAMP '2024-01-01' + to_microseconds({us}), {ISO})"


def _placed(source: str, order: str, max_rows: int) -> str:
    return f"""
placed AS (
  SELECT * FROM (
    SELECT f.*, (l.lo // 1000000)::INTEGER AS leaf, row_number() OVER (PARTITION BY l.idx ORDER BY {order}) - 1 AS place
    FROM {source} f JOIN leaves l
      ON epoch_us(f.seen_at) - epoch_us(TIMESTAMP '2024-01-01') >= l.lo
     AND epoch_us(f.seen_at) - epoch_us(TIMESTAMP '2024-01-01') < l.hi)
  WHERE place < {max_rows})
"""


def _collect(max_rows: int) -> str:
    return _with(FEED, tree("feed", max_rows), _placed("feed", "seen_at DESC, event_id", max_rows)) + """
    SELECT event_id, leaf AS window_index, place::INTEGER AS position FROM placed"""


def _warnings(max_rows: int) -> str:
    return f"""
    SELECT depth AS split_depth, '{max_rows} articles or more in the window ' || {_at('lo')} || ' to ' || {_at('hi')} || ': '
      || CASE WHEN hi - lo >= 2000000 THEN 'it is read in halves' ELSE 'any further ones are left out' END AS message
    FROM nodes WHERE n >= {max_rows}"""


STATUS = """
status AS (
  SELECT *, CASE WHEN coalesce(url, '') = '' THEN 'skipped' WHEN page_url IS NOT NULL THEN 'ok' ELSE 'error' END
    AS state FROM linked)
"""
FIRST = """
first AS (SELECT doc_id FROM linked ORDER BY seen_at DESC, window_index, position LIMIT 150)
"""
PAGE_LANGUAGE = "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)"


def _unescaped(text: str) -> str:
    """The character references that occur in the given pages."""
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{sign}', 'g')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


# What follows an opening <p> is a paragraph if it is closed before the next one opens. A page without any shows
# its body text, in which every tag separates words.
PAGE_TEXT = f"""
visible AS (
  SELECT *, regexp_replace(html, '<script>.*?</script>|<style>.*?</style>|<!--.*?-->', '', 'gs') AS shown
  FROM pages),
parts AS (
  SELECT page_id, url, html,
    nullif({_unescaped("regexp_extract(shown, '<title>(.*?)</title>', 1, 's')")}, '') AS title,
    array_to_string(list_filter(list_transform(
      list_filter(string_split(shown, '<p>')[2:], lambda s: contains(s, '</p>')),
      lambda s: {_unescaped("regexp_replace(replace(split_part(s, '</p>', 1), '<br>', ' '), '<[^>]*>', '', 'g')")}),
      lambda s: s <> ''), chr(10) || chr(10)) AS paragraphs,
    {_unescaped("regexp_replace(split_part(split_part(shown, '<body>', 2), '</body>', 1), '<[^>]*>', ' ', 'g')")}
      AS body
  FROM visible),
page_text AS (SELECT *, CASE WHEN paragraphs <> '' THEN paragraphs ELSE body END AS text FROM parts)
"""
ENRICHED = f"""
  doc_id, url,
  CASE state WHEN 'skipped' THEN 'missing url' WHEN 'error' THEN 'page not found' END AS scrape_error,
  state AS scrape_status, state = 'ok' AS scrape_success,
  CASE WHEN state = 'ok' THEN page_url END AS scraped_final_url,
  CASE WHEN state = 'ok' THEN nullif({PAGE_LANGUAGE}, '') END AS scraped_language
"""

DATASET_WHERE = """
  (contains(space, 'eaux') OR contains(space, 'and the') OR contains(space, 'nation 7') OR contains(space, 'nation 1'))
  AND NOT contains(space, 'license')
"""
SELECTED = f"""
selected AS (SELECT * FROM linked WHERE {DATASET_WHERE})
"""
TWICE = "twice AS (SELECT *, 0 AS copy FROM selected UNION ALL SELECT *, 1 AS copy FROM selected)"
UNIQUE = """
uniq AS (
  SELECT * FROM twice QUALIFY row_number() OVER (
    PARTITION BY CASE WHEN coalesce(url, '') <> '' THEN 'url:' || lower(url)
                      ELSE 'fallback:' || lower(title) || '|' || epoch(seen_at) || '|' || lower(domain) END
    ORDER BY seen_at, doc_id, copy) = 1)
"""
DATASET_TREE = tree("selected", 20)
DATASET_PLACED = _placed("selected", "seen_at DESC, doc_id", 20)

JSON_FAULTS = """
faults AS (
  SELECT event_id AS record_id, '$' AS path, 'required' AS rule, 'missing id' AS detail
    FROM events WHERE event_id % 9 = 0
  UNION ALL SELECT event_id, '$.id', 'type', 'expected integer, got boolean' FROM events WHERE event_id % 9 = 1
  UNION ALL SELECT event_id, '$.id', 'type', 'expected integer, got number' FROM events WHERE event_id % 9 IN (2, 3, 4)
  UNION ALL SELECT event_id, '$.kind', 'enum',
      'expected one of [''click'', ''view'', ''signup'', ''purchase''], got error'
    FROM events WHERE event_type = 'error'
  UNION ALL SELECT event_id, '$', 'extra', 'unexpected more' FROM events WHERE event_id % 6 = 0
  UNION ALL SELECT event_id, '$.value', 'type', 'expected number or null, got string'
    FROM events WHERE event_id % 5 = 1
  UNION ALL SELECT event_id, '$.tags[1]', 'type', 'expected string, got integer' FROM events WHERE event_id % 4 = 0
  UNION ALL SELECT event_id, '$.tags', 'type', 'expected array, got object' FROM events WHERE event_id % 4 = 1)
"""

ORACLES: dict[str, str] = {
    "volume_minute": _volume("minute"),
    "volume_hour": _volume("hour"),
    "volume_day": _volume("day"),
    "normalize_articles": _with(CORPUS) + f"""
    SELECT sha256(url) AS article_id, title, url, NULL::VARCHAR AS mobile_url,
      strftime(seen_at, {ISO}) AS seen_at, domain, language, sourcecountry AS source_country,
      NULL::VARCHAR AS social_image_url,
      array_to_string({_hits(KEYWORDS)}, ' | ') AS matched_keywords,
      array_to_string({_hits(ENTITIES)}, ' | ') AS matched_entities,
      'ENV | ECON' AS requested_themes, 'ok' AS scrape_status, true AS scrape_success,
      NULL::VARCHAR AS scrape_error, NULL::VARCHAR AS scraped_title,
      nullif(trim(text, {SPACES}), '') AS scraped_text, length(text) AS scraped_text_length, url AS raw_url,
      window_index, position
    FROM corpus""",
    "match_terms": _with(CORPUS) + f"""
    SELECT doc_id, array_to_string({_hits(KEYWORDS)}, ' | ') AS matched_keywords,
           array_to_string({_hits(ENTITIES)}, ' | ') AS matched_entities FROM corpus""",
    "entity_tracking_day": _entities("day"),
    "entity_tracking_hour": _entities("hour"),
    "rank_language": _rank("language"),
    "rank_country": _rank("sourcecountry"),
    "rank_domain": _rank("domain"),
    "rank_entity": _with(FEED) + """
    SELECT entity AS value, count(*) AS count,
           min({'a': fetch_key, 'b': place - 1}).a || '/' || min({'a': fetch_key, 'b': place - 1}).b AS first_at
    FROM (SELECT fetch_key, unnest(['Nation 7', 'click', 'nation 1', 'click']) AS entity,
                 unnest([1, 2, 3, 4]) AS slot, lower(concat_ws(' ', title, domain, sourcecountry)) AS space
          FROM feed) e
    JOIN LATERAL (
      SELECT 1 + (CASE WHEN slot > 1 AND contains(space, 'nation 7') THEN 1 ELSE 0 END)
               + (CASE WHEN slot > 2 AND contains(space, 'click') THEN 1 ELSE 0 END)
               + (CASE WHEN slot > 3 AND contains(space, 'nation 1') THEN 1 ELSE 0 END) AS place) y ON true
    WHERE contains(space, lower(entity)) GROUP BY entity""",
    "rank_country_newest": _with(FEED) + """
    SELECT sourcecountry AS value, count(*) AS count,
           min({'a': -epoch(seen_at)::BIGINT, 'b': fetch_key}).a || '/' || min({'a': -epoch(seen_at)::BIGINT, 'b': fetch_key}).b
             AS first_at
    FROM feed GROUP BY sourcecountry""",
    "summary": _with(CORPUS, LINKED, STATUS) + """
    SELECT count(*) AS article_count, 2 * count(*) AS raw_article_count, count(*) AS duplicates_removed,
           count(*) FILTER (state = 'ok') AS scraped_article_count,
           count(*) FILTER (state <> 'ok') AS scrape_failed_count FROM status""",
    **{name: _filter(where) for name, where in FILTERS.items()},
    "filter_proximity": _with(CORPUS, WORDS) + """
    SELECT doc_id, domain, language FROM corpus WHERE doc_id IN (
      SELECT a.doc_id FROM words a JOIN words b ON a.doc_id = b.doc_id AND abs(a.at - b.at) <= 3
      WHERE a.word = 'and' AND b.word = 'the')""",
    "filter_proximity_three": _with(CORPUS, WORDS) + """
    SELECT doc_id, domain, language FROM corpus WHERE doc_id IN (
      SELECT a.doc_id FROM words a
      JOIN words b ON a.doc_id = b.doc_id AND b.word = 'the' AND abs(a.at - b.at) <= 6
      JOIN words c ON a.doc_id = c.doc_id AND c.word = 'of' AND abs(a.at - c.at) <= 6
                  AND abs(b.at - c.at) <= 6
      WHERE a.word = 'and')""",
    "filter_repeat_phrase": _with(CORPUS, WORDS) + """
    SELECT doc_id, domain, language FROM corpus WHERE doc_id IN (
      SELECT a.doc_id FROM words a JOIN words b ON a.doc_id = b.doc_id AND b.at = a.at + 1
      WHERE a.word = 'of' AND b.word = 'the' GROUP BY a.doc_id HAVING count(*) >= 2)""",
    "filter_range": _with(CORPUS) + f"""
    SELECT doc_id, strftime(seen_at, {ISO}) AS seen_at FROM corpus
    WHERE seen_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 06:30:00'""",
    "filter_timespan": _with(FEED) + f"""
    SELECT event_id, strftime(seen_at, {ISO}) AS seen_at FROM feed
    WHERE seen_at BETWEEN TIMESTAMP '2024-01-13 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "compact_times": _with(FEED) + " SELECT event_id, strftime(seen_at, '%Y%m%d%H%M%S') AS second FROM feed",
    "union_fetches": _with(FEED) + """
    SELECT event_id, url, window_index, position FROM feed
    UNION ALL SELECT event_id, url, window_index + 1000000, position FROM feed""",
    "dedup": _with(FEED, DEDUP) + """
    SELECT event_id, url, title, seendate, domain, window_index, position FROM ranked WHERE rn = 1""",
    "dedup_count": _with(FEED, DEDUP) + """
    SELECT count(*) AS raw_article_count, count(*) FILTER (rn = 1) AS deduplicated_article_count,
           count(*) FILTER (rn > 1) AS duplicates_removed FROM ranked""",
    "sort_date_desc": _sort("seendate DESC, window_index, position"),
    "sort_date_asc": _sort("seendate, window_index, position"),
    "sort_tone_desc": _sort("window_index, tone DESC NULLS LAST, position"),
    "sort_tone_asc": _sort("window_index, tone ASC NULLS LAST, position"),
    "sort_relevance": _sort("window_index, position"),
    "timeline_normalize": _with(TIMELINE) + f"""
    SELECT strftime(moment, {ISO}) AS bucket_start, round(v, 6) AS value, 'article_count' AS metric,
           round(norm, 6) AS norm, NULL::VARCHAR AS label FROM points WHERE v IS NOT NULL""",
    "rebucket_sum": _rebucket("day", "sum(v)"),
    "rebucket_sum_hour": _rebucket("hour", "sum(v)"),
    "rebucket_weighted": _rebucket(
        "day", "sum(v * CASE WHEN norm > 0 THEN norm ELSE 1 END) / sum(CASE WHEN norm > 0 THEN norm ELSE 1 END)"
    ),
    "volume_timeline": _with(CORPUS) + f"""
    SELECT strftime(date_trunc('day', seen_at), {ISO}) AS bucket_start,
           (count(*) FILTER ({FILTERS['filter_any']}))::DOUBLE AS value, 'article_count' AS metric,
           count(*)::DOUBLE AS norm, NULL::VARCHAR AS label
    FROM corpus GROUP BY date_trunc('day', seen_at)""",
    "tone_timeline": _with(FEED) + f"""
    SELECT strftime(date_trunc('hour', seen_at), {ISO}) AS bucket_start, round(avg(tone), 6) AS value,
           'average_tone' AS metric, count(tone)::DOUBLE AS norm, NULL::VARCHAR AS label
    FROM feed GROUP BY date_trunc('hour', seen_at)""",
    "trend_supplied": f"SELECT *, 'supplied-timeline' AS source FROM ({_rebucket('day', 'sum(v)')})",
    "trend_fallback": f"SELECT *, 'article-bucket-fallback' AS source FROM ({_volume('hour')})",
    "sentiment_series": _with(FEED) + f"""
    SELECT strftime(date_trunc('day', seen_at), {ISO}) AS bucket_start, round(avg(tone), 6) AS value,
           'average_tone' AS metric, count(tone)::DOUBLE AS norm, NULL::VARCHAR AS label,
           'supplied-timeline' AS source
    FROM feed GROUP BY date_trunc('day', seen_at)""",
    "trend_source": _with(TIMELINE) + """
    SELECT CASE WHEN count(v) > 0 THEN 'supplied-timeline' ELSE 'article-bucket-fallback' END AS trend_source
    FROM points""",
    "analysis_targets": """
    SELECT 'article_count' AS trend_metric, 'average_tone' AS sentiment_metric,
           'Nation 7 | für | the the | nation 1' AS tracked_entities, 'day' AS bucket_size,
           count(DISTINCT date_trunc('day', ts)) AS trend_rows FROM events""",
    "fixed_windows": _with(FEED) + f""",
    grid AS (SELECT i, TIMESTAMP '2024-01-02 05:00:00' + to_hours(36 * i) AS s,
               least(TIMESTAMP '2024-01-02 05:00:00' + to_hours(36 * i + 36), TIMESTAMP '2024-01-30 17:00:00') AS e
             FROM range(19) r(i))
    SELECT (i + 1)::INTEGER AS index, strftime(s, {ISO}) AS start, strftime(e, {ISO}) AS "end",
           NULL::VARCHAR AS timespan, count(f.event_id) AS articles
    FROM grid LEFT JOIN feed f ON f.seen_at >= s AND (f.seen_at < e OR (i = 18 AND f.seen_at = e))
    GROUP BY i, s, e""",
    "adaptive_windows": _with(FEED, tree("feed", 100)) + f"""
    SELECT idx AS index, {_at('lo')} AS start, {_at('hi')} AS "end", NULL::VARCHAR AS timespan,
           least(n, 100) AS returned_articles, n >= 100 AS truncated, depth AS split_depth,
           depth > 0 AS adaptive_split FROM leaves""",
    "collect_articles": _collect(100),
    "collect_articles_tight": _collect(1),
    "capped_articles": _with(FEED) + """
    SELECT event_id, index, (place - 1)::INTEGER AS position FROM (
      SELECT event_id, (date_diff('day', TIMESTAMP '2024-01-01', seen_at) + 1)::INTEGER AS index,
             row_number() OVER (PARTITION BY date_trunc('day', seen_at) ORDER BY tone DESC, event_id) AS place
      FROM feed) WHERE place <= 75""",
    "capped_articles_large": _with(FEED) + """
    SELECT event_id, 1 AS index, (place - 1)::INTEGER AS position FROM (
      SELECT event_id, row_number() OVER (ORDER BY tone DESC, event_id) AS place FROM feed
      WHERE seen_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31') WHERE place <= 5000""",
    "collect_articles_uncapped": _with(FEED) + """
    SELECT event_id, 0 AS window_index, (row_number() OVER (ORDER BY seen_at DESC, event_id) - 1)::INTEGER AS position
    FROM feed WHERE seen_at BETWEEN TIMESTAMP '2024-01-13 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "coverage_summary": _with(
        FEED, tree("feed", 100), _placed("feed", "seen_at DESC, event_id", 100)
    ) + """,
    kept AS (
      SELECT count(*) AS raw, count(DISTINCT CASE WHEN coalesce(url, '') <> '' THEN 'url:' || lower(url)
        ELSE 'fallback:' || lower(title) || '|' || seendate || '|' || lower(domain) END) AS distinct_rows
      FROM placed)
    SELECT true AS batching_enabled, 24 AS batch_window_hours, count(*) FILTER (idx IS NOT NULL) AS batch_count,
           count(*) AS fetch_attempt_count, count(*) FILTER (idx IS NULL) AS split_window_count,
           any_value(raw) AS raw_article_count, any_value(distinct_rows) AS deduplicated_article_count,
           any_value(raw) - any_value(distinct_rows) AS duplicates_removed,
           count(*) FILTER (idx IS NOT NULL AND n >= 100) AS truncated_window_count
    FROM (SELECT nodes.n, leaves.idx FROM nodes LEFT JOIN leaves USING (lo, hi, depth)), kept""",
    "coverage_warnings": _with(FEED, tree("feed", 100)) + f"""
    {_warnings(100)}""",
    "extract_pages": _with(PAGE_TEXT) + f"""
    SELECT page_id, url, 'ok' AS status, title, NULL::VARCHAR AS description, NULL::VARCHAR AS published_at,
      nullif({PAGE_LANGUAGE}, '') AS language, NULL::VARCHAR AS canonical_url, nullif(text, '') AS text,
      CASE WHEN text <> '' THEN trim(left(text, 280), ' ' || chr(10)) || CASE WHEN length(text) > 280 THEN '...' ELSE '' END END
        AS excerpt,
      length(text) AS text_length
    FROM page_text""",
    "enrich_articles": _with(CORPUS, LINKED, STATUS) + f" SELECT {ENRICHED} FROM status",
    "enrich_limit": _with(CORPUS, LINKED, STATUS, FIRST) + f"""
    SELECT {ENRICHED} FROM status WHERE doc_id IN (SELECT doc_id FROM first)
    UNION ALL
    SELECT doc_id, url, NULL, 'not_requested', false, NULL, NULL FROM status
    WHERE doc_id NOT IN (SELECT doc_id FROM first)""",
    "enrich_half": _with(CORPUS, LINKED, STATUS) + """,
    half AS (
      SELECT doc_id FROM linked ORDER BY seen_at DESC, window_index, position LIMIT (SELECT count(*) // 2 FROM linked))
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM half) THEN state ELSE 'not_requested' END AS scrape_status
    FROM status""",
    "enrich_crowded": _with(CORPUS, LINKED) + f""",
    shared AS (
      SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN (SELECT min(url) FROM pages) ELSE url END AS url FROM linked),
    landed AS (SELECT url, arg_min(html, page_id) AS html, min(page_id) AS page_id FROM pages GROUP BY url)
    SELECT doc_id, s.url,
           CASE WHEN coalesce(s.url, '') = '' THEN 'skipped' WHEN p.url IS NULL THEN 'error' ELSE 'ok' END AS scrape_status,
           p.url AS scraped_final_url, nullif({PAGE_LANGUAGE}, '') AS scraped_language,
           strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), {ISO}) AS fetched_at
    FROM shared s LEFT JOIN landed p ON p.url = s.url""",
    "enrich_summary": _with(CORPUS, LINKED, STATUS, FIRST) + """
    SELECT true AS requested, count(*) FILTER (chosen AND state <> 'skipped') AS attempted,
           count(*) FILTER (chosen AND state = 'ok') AS succeeded,
           count(*) FILTER (chosen AND state = 'error') AS failed,
           count(*) FILTER (NOT chosen OR state = 'skipped') AS skipped, 150 AS "limit"
    FROM (SELECT state, doc_id IN (SELECT doc_id FROM first) AS chosen FROM status)""",
    "extract_pages_empty": f"""
    SELECT page_id, url, CASE WHEN page_id % 20 = 0 THEN 'error' ELSE 'ok' END AS status, page_id % 20 <> 0 AS success,
           CASE WHEN page_id % 20 = 0 THEN 'page has no content' END AS error,
           CASE WHEN page_id % 20 <> 0 THEN nullif({PAGE_LANGUAGE}, '') END AS language FROM pages""",
    "enrich_copies": _with(CORPUS, LINKED, STATUS) + """
    SELECT doc_id, url, CASE WHEN state = 'ok' AND page_id % 20 = 0 THEN 'error' ELSE state END AS scrape_status,
           CASE WHEN state = 'skipped' THEN 'missing url' WHEN state = 'error' THEN 'page not found'
                WHEN page_id % 20 = 0 THEN 'page has no content' END AS scrape_error FROM status""",
    "landed_windows": _with(FEED) + """
    SELECT (date_diff('day', TIMESTAMP '2024-01-05', seen_at) + 1)::INTEGER AS index, count(*) AS articles FROM feed
    WHERE seen_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-09 12:00:00' GROUP BY ALL""",
    "read_articles": _with(FEED) + """
    SELECT url, title, seendate, domain, language, sourcecountry, round(tone, 6) AS tone,
           (dense_rank() OVER (ORDER BY window_index) - 1)::INTEGER AS window_index,
           (row_number() OVER (PARTITION BY window_index ORDER BY position) - 1)::INTEGER AS position FROM feed""",
    "read_timeline": """
    SELECT CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y%m%dT%H%M%SZ') WHEN 1 THEN strftime(ts, '%Y%m%d')
                             WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(ts, '%Y%m%d%H%M%S') END AS date,
           CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN round(value, 6) END AS value,
           CASE WHEN event_id % 11 = 0 THEN 7.0::DOUBLE END AS count,
           CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 0.0 ELSE user_id::DOUBLE END AS norm
    FROM events""",
    "match_term_table": f"""
    WITH items AS (SELECT regexp_split_to_array(text, '\\s+') AS w FROM benchmark),
    terms AS (
      SELECT DISTINCT trim(unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)])), {SPACES}) AS term
      FROM items),
    turns AS (SELECT conv_id, turn, replace(lower(text), 'ß', 'ss') AS space FROM conversations)
    SELECT term, count(DISTINCT (conv_id, turn)) AS turns, min(conv_id) AS first_conv
    FROM turns JOIN terms ON contains(space, replace(lower(term), 'ß', 'ss')) WHERE term <> '' GROUP BY term""",
    "dataset_quality": """
    SELECT unnest(['articles', 'trend_series', 'entity_tracking', 'languages', 'source_countries', 'domains',
                   'matched_entities', 'summary', 'windows', 'coverage', 'sentiment_series', 'enrichment']) AS contract,
           0::BIGINT AS records_bad, true AS validated""",
    "enrich_errors": _with(CORPUS, LINKED, STATUS) + """
    SELECT window_index, position, url || ': page not found' AS error FROM status WHERE state = 'error'""",
    "flat_articles": _with(CORPUS) + f"""
    SELECT coalesce(sha256(url), '') AS article_id, title, coalesce(url, '') AS url, '' AS mobile_url,
      strftime(seen_at, {ISO}) AS seen_at, domain, language, sourcecountry AS source_country,
      '' AS social_image_url, array_to_string({_hits(KEYWORDS)}, ' | ') AS matched_keywords,
      array_to_string({_hits(ENTITIES)}, ' | ') AS matched_entities, 'ENV' AS requested_themes,
      'ok' AS scrape_status, '' AS scraped_title, '' AS scraped_description, '' AS scraped_published_at,
      '' AS scraped_language, length(text)::VARCHAR AS scraped_text_length, '' AS scraped_excerpt
    FROM corpus""",
    "write_articles_csv": _with(FEED) + """
    SELECT coalesce(sha256(url), '') AS article_id, title, coalesce(url, '') AS url, '' AS mobile_url,
      strftime(seen_at, '%Y-%m-%dT%H:%M:%SZ') AS seen_at, domain, language, sourcecountry AS source_country,
      '' AS social_image_url, '' AS matched_keywords,
      array_to_string(list_filter(['Nation 7', 'click', 'nation 1', 'click'], lambda t: contains(
        lower(concat_ws(' ', title, domain, sourcecountry)), lower(t))), ' | ') AS matched_entities,
      '' AS requested_themes, 'not_requested' AS scrape_status, '' AS scraped_title, '' AS scraped_description,
      '' AS scraped_published_at, '' AS scraped_language, '0' AS scraped_text_length, '' AS scraped_excerpt
    FROM feed""",
    "write_sections_json": _volume("day"),
    "write_sections_parquet": _volume("day"),
    "landed_corpus": _with(FEED) + """
    SELECT event_id, url, strftime(seen_at, '%Y-%m-%d') AS seen_date FROM feed
    WHERE language = 'German' AND seen_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-09 12:00:00'""",
    "quality_violations": """
    SELECT conv_id AS record_id, '$.role' AS path, 'enum' AS rule,
           'expected one of [''user'', ''assistant''], got ' || role AS detail, count(*) AS n
    FROM conversations WHERE role NOT IN ('user', 'assistant') GROUP BY conv_id, role""",
    "quality_json_violations": "WITH " + JSON_FAULTS + "SELECT record_id, path, rule, detail FROM faults",
    "quality_summary": """
    SELECT 'turn' AS contract, count(*) AS records_checked,
           count(*) FILTER (role NOT IN ('user', 'assistant')) AS records_bad,
           count(*) FILTER (role NOT IN ('user', 'assistant')) = 0 AS validated FROM conversations""",
    "quality_articles": """
    SELECT 'articles' AS contract, count(*) AS records_checked, 0::BIGINT AS records_bad, true AS validated
    FROM documents""",
    "dataset_articles": _with(CORPUS, LINKED, SELECTED, DATASET_TREE, DATASET_PLACED) + f"""
    SELECT sha256(url) AS article_id, url,
      CASE WHEN url IS NULL THEN 'skipped' WHEN page_url IS NOT NULL THEN 'ok' ELSE 'error' END AS scrape_status,
      nullif({PAGE_LANGUAGE}, '') AS scraped_language, leaf AS window_index, place::INTEGER AS position
    FROM placed""",
    "dataset_trend": _with(CORPUS) + f"""
    SELECT strftime(date_trunc('day', seen_at), {ISO}) AS bucket_start,
           (count(*) FILTER ({DATASET_WHERE}))::DOUBLE AS value, 'article_count' AS metric,
           count(*)::DOUBLE AS norm, NULL::VARCHAR AS label, 'corpus-timeline' AS source
    FROM corpus GROUP BY date_trunc('day', seen_at)""",
    "dataset_entities": _with(CORPUS, LINKED, SELECTED) + f"""
    SELECT strftime(bucket, {ISO}) AS bucket_start, entity, count(*) AS article_count FROM (
      SELECT date_trunc('day', seen_at) AS bucket, unnest(list_filter(['Nation 7', 'nation 1'], lambda t: contains(
        lower(concat_ws(' ', title, domain, sourcecountry)), lower(t)))) AS entity FROM selected)
    GROUP BY bucket, entity""",
    "dataset_summary": _with(CORPUS, LINKED, SELECTED) + """
    SELECT count(*) AS article_count, count(*) AS raw_article_count, 0::BIGINT AS duplicates_removed,
           count(page_url) AS scraped_article_count, count(*) - count(page_url) AS scrape_failed_count
    FROM selected""",
    "dataset_coverage": _with(CORPUS, LINKED, SELECTED, DATASET_TREE) + """
    SELECT true AS batching_enabled, 24 AS batch_window_hours, count(*) FILTER (idx IS NOT NULL) AS batch_count,
           count(*) AS fetch_attempt_count, count(*) FILTER (idx IS NULL) AS split_window_count,
           (SELECT count(*) FROM selected) AS raw_article_count,
           (SELECT count(*) FROM selected) AS deduplicated_article_count, 0::BIGINT AS duplicates_removed,
           0::BIGINT AS truncated_window_count
    FROM (SELECT leaves.idx FROM nodes LEFT JOIN leaves USING (lo, hi, depth))""",
    "dataset_domains": _with(CORPUS, LINKED, SELECTED) + """
    SELECT domain AS value, count(*) AS count FROM selected GROUP BY domain""",
    "dataset_sentiment": _with(CORPUS, LINKED, SELECTED) + f"""
    SELECT strftime(date_trunc('day', seen_at), {ISO}) AS bucket_start, round(avg(tone), 6) AS value,
           'average_tone' AS metric, count(tone)::DOUBLE AS norm, NULL::VARCHAR AS label, 'corpus-timeline' AS source
    FROM selected GROUP BY date_trunc('day', seen_at)""",
    "dataset_enrichment": _with(CORPUS, LINKED, SELECTED) + """
    SELECT true AS requested, count(url) AS attempted, count(page_url) AS succeeded, count(url) - count(page_url) AS failed,
           count(*) - count(url) AS skipped, NULL::INTEGER AS "limit" FROM selected""",
    "dataset_matched_entities": _with(CORPUS, LINKED, SELECTED) + """
    SELECT entity AS value, count(*) AS count FROM (
      SELECT unnest(list_filter(['Nation 7', 'nation 1'], lambda t: contains(
        lower(concat_ws(' ', title, domain, sourcecountry)), lower(t)))) AS entity FROM selected)
    GROUP BY entity""",
    "dataset_windows": _with(CORPUS, LINKED, SELECTED, TWICE, tree("twice", 2)) + f"""
    SELECT idx AS index, {_at('lo')} AS start, {_at('hi')} AS "end", NULL::VARCHAR AS timespan,
           least(n, 2) AS returned_articles, n >= 2 AS truncated, depth AS split_depth, depth > 0 AS adaptive_split
    FROM leaves""",
    "dataset_warnings": _with(CORPUS, LINKED, SELECTED, TWICE, tree("twice", 2)) + _warnings(2),
    "dataset_summary_repeated": _with(CORPUS, LINKED, SELECTED, TWICE, UNIQUE) + """
    SELECT count(*) AS article_count, (SELECT count(*) FROM twice) AS raw_article_count,
           (SELECT count(*) FROM twice) - count(*) AS duplicates_removed, count(page_url) AS scraped_article_count,
           count(*) - count(page_url) AS scrape_failed_count FROM uniq""",
    "dataset_coverage_repeated": _with(CORPUS, LINKED, SELECTED, TWICE, UNIQUE, tree("twice", 2)) + """
    SELECT true AS batching_enabled, 24 AS batch_window_hours, count(*) FILTER (idx IS NOT NULL) AS batch_count,
           count(*) AS fetch_attempt_count, count(*) FILTER (idx IS NULL) AS split_window_count,
           (SELECT count(*) FROM twice) AS raw_article_count, (SELECT count(*) FROM uniq) AS deduplicated_article_count,
           (SELECT count(*) FROM twice) - (SELECT count(*) FROM uniq) AS duplicates_removed,
           count(*) FILTER (idx IS NOT NULL AND n >= 2) AS truncated_window_count
    FROM (SELECT nodes.n, leaves.idx FROM nodes LEFT JOIN leaves USING (lo, hi, depth))""",
    "dataset_quality_repeated": _with(CORPUS, LINKED, SELECTED, TWICE, UNIQUE) + """
    SELECT contract, CASE WHEN contract = 'articles' THEN bad ELSE 0 END AS records_bad,
           contract <> 'articles' OR bad = 0 AS validated
    FROM (SELECT unnest(['articles', 'trend_series', 'entity_tracking', 'languages', 'source_countries', 'domains',
                         'matched_entities', 'summary', 'windows', 'coverage', 'sentiment_series', 'enrichment']) AS contract),
         (SELECT count(*) FILTER (url IS NULL) AS bad FROM uniq)""",
}
