"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from pressgrid.llm.mixing import BUDGET

MARGINS = ("source", "lang", "topic")

SUBSTRING = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS pos FROM words WHERE len(w) >= 20
), windows AS (
    SELECT doc_id, pos, array_to_string(w[pos:pos + 19], ' ') AS v FROM starts
), ranked AS (
    SELECT doc_id, pos, rank() OVER (PARTITION BY v ORDER BY doc_id, pos) AS r FROM windows
), gone AS (
    SELECT doc_id, list_distinct(flatten(list(generate_series(pos, pos + 19)))) AS places FROM ranked WHERE r > 1
    GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string([w[i] FOR i IN generate_series(1, len(w)) IF NOT coalesce(list_contains(places, i), false)], ' '))
           AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), lead_ids AS (
    SELECT body, max(page_id) AS lead_id FROM p GROUP BY body
), digits AS (
    SELECT page_id, body, lead_id,
           [CAST('0x' || substr(hex, 5 * g + 1, 5) AS BIGINT) FOR g IN generate_series(0, 7)] AS parts
    FROM p JOIN lead_ids USING (body)
)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)
                        FOR i IN generate_series(0, 31)], '') AS payload_digest,
       CASE WHEN page_id = lead_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = lead_id THEN NULL ELSE lead_id END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM digits
"""


def _mixing() -> str:
    """Raking unrolled: one table for each margin and round, more rounds than the given tables need."""
    parts = [r"""
docs AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
           greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) AS tokens FROM documents
)""", """
base AS MATERIALIZED (
    SELECT doc_id, source, lang, tokens, CASE WHEN contains(text, ' | ') THEN 'table'
        WHEN contains(lower(text), 'license') THEN 'legal' WHEN contains(text, '@') THEN 'contact'
        WHEN tokens < 100 THEN 'note' WHEN tokens < 400 THEN 'article' ELSE 'long' END AS topic FROM docs
)""", """
c0 AS MATERIALIZED (
    SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS weight FROM base
    GROUP BY source, lang, topic
)""", "mass AS MATERIALIZED (SELECT sum(tokens) AS mass FROM c0)"]
    for m in MARGINS:
        parts.append(f"""
share_{m} AS MATERIALIZED (
    SELECT {m}, sqrt(sum(tokens)) / sum(sqrt(sum(tokens))) OVER () AS share FROM c0 GROUP BY {m}
)""")
    step = 0
    for _ in range(100):
        for m in MARGINS:
            parts.append(f"""
c{step + 1} AS MATERIALIZED (
    SELECT c.source, c.lang, c.topic, c.tokens, c.weight * s.share * mass / sum(c.weight) OVER (PARTITION BY c.{m}) AS weight
    FROM c{step} c JOIN share_{m} s USING ({m}) CROSS JOIN mass
)""")
            step += 1
    return "WITH " + ",".join(parts) + f""",
ordered AS (
    SELECT *, coalesce(sum(tokens) OVER w, 0) AS sure, mass - coalesce(sum(weight) OVER w, 0) AS rest
    FROM c{step} CROSS JOIN mass
    WINDOW w AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), scales AS (
    SELECT ({BUDGET} * mass - sure) / rest AS scale, sure FROM ordered
    WHERE ({BUDGET} * mass - sure) / rest * weight / tokens < 1
), scale AS (SELECT arg_min(scale, sure) AS scale FROM scales),
chances AS (
    SELECT source, lang, topic, weight / tokens AS weight, least(1.0, scale * weight / tokens) AS probability
    FROM c{step} CROSS JOIN scale
)
SELECT doc_id, source, lang, topic, tokens, round(weight, 6) AS weight, round(probability, 6) AS probability,
       CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':17'), 1, 13) AS BIGINT) / 4503599627370496.0 < probability
           OR probability >= 1 AS sampled
FROM base JOIN chances USING (source, lang, topic)
"""



UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _level(name: str, below: str) -> str:
    """One level of all trees: runs of 16 become a node, except where a tree has come down to one."""
    return f"""
{name} AS MATERIALIZED (
    SELECT tree, pos // 16 AS pos,
           CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {below}) GROUP BY tree, pos // 16
)"""


def _siblings(name: str, level: str) -> str:
    return f"""
{name} AS MATERIALIZED (
    SELECT a.tree, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r, any_value(a.n) > 1 AS deep
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {level}) a
    JOIN {level} b ON a.tree = b.tree AND a.pos // 16 = b.pos // 16 GROUP BY a.tree, a.pos
)"""


def _folded(name: str, below: str, siblings: str) -> str:
    return f"""
{name} AS MATERIALIZED (
    SELECT f.doc_id, f.source_tree, f.leaf, f.tree, f.pos // 16 AS pos, f.proof || s.l || s.r AS proof,
           CASE WHEN s.deep THEN sha256(s.l || f.now || s.r) ELSE f.now END AS now
    FROM {below} f JOIN {siblings} s ON f.tree = s.tree AND f.pos = s.pos
)"""


def _manifest(levels: int = 4, top: int = 3) -> str:
    """Trees of up to 16 ** levels documents a source, and up to 16 ** top sources."""

    def part(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    steps = "flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])"
    crc = (
        f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, x: "
        "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"
    )
    parts = [f"""
leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('s' || source, '') AS tree, {leaf("text")} AS digest,
           CASE WHEN {crc} % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf("text")} END AS other
    FROM documents
)""", """
l0 AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaves
)""", "f0 AS (SELECT doc_id, tree AS source_tree, digest AS leaf, tree, pos, '' AS proof, other AS now FROM l0)"]
    for at in range(levels):
        parts += [_siblings(f"s{at}", f"l{at}"), _folded(f"f{at + 1}", f"f{at}", f"s{at}"), _level(f"l{at + 1}", f"l{at}")]
    parts += [f"""
t0 AS MATERIALIZED (
    SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, tree AS source_tree FROM l{levels}
)""", f"""
g0 AS (
    SELECT f.doc_id, f.source_tree, f.leaf, t.tree, t.pos, f.proof, f.now FROM f{levels} f JOIN t0 t USING (source_tree)
)"""]
    for at in range(top):
        parts += [_siblings(f"u{at}", f"t{at}"), _folded(f"g{at + 1}", f"g{at}", f"u{at}"), _level(f"t{at + 1}", f"t{at}")]
    return "WITH " + ",".join(parts) + f"""
SELECT g.doc_id, g.leaf, t0.digest AS subroot, r.digest AS root, sha256(g.proof) AS proof_sha256, g.now AS folded_root,
       g.now = r.digest AS verified
FROM g{top} g JOIN t0 USING (source_tree) CROSS JOIN t{top} r
"""


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEARCH = rf"""
WITH asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_TERMS}')) AS term FROM benchmark
), docs AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERMS}') AS w FROM documents
), sizes AS MATERIALIZED (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
tf AS MATERIALIZED (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf CROSS JOIN sizes GROUP BY term
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) CROSS JOIN sizes GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

ORACLES = {
    "op7_substring_dedup": SUBSTRING, "op8_warc": WARC, "op10_mixing": _mixing(), "op12_manifest": _manifest(),
    "op13_search": SEARCH,
}
