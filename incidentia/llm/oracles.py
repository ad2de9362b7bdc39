"""DuckDB SQL for the queries of the corpus operators that SQL can express."""

from __future__ import annotations

from incidentia.llm.licenses import BETWEEN, COMMENT_LINE, STOP_WORDS, TEMPLATES

ORACLES: dict[str, str] = {}

ORACLES["op2_neighbours"] = """
WITH vectors AS (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           max(list_cosine_similarity(q.e, c.e)) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0
    GROUP BY 1, 2
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
    FROM pairs
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

# Five hex digits of the digest are four letters; what follows the contract's
# columns is the URL key of the merged index.
ORACLES["op5_warc"] = """
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex
    FROM pages
), digests AS (
    SELECT *, octet_length(encode(payload)) AS payload_bytes,
        max(page_id) OVER (PARTITION BY payload) AS winner,
        list_aggregate(list_transform(range(32), lambda i: substr(
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            CAST((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT)
                  >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), 'string_agg', '')
            AS payload_digest,
        lower(url) AS address
    FROM payloads
), hosts AS (
    SELECT *, regexp_extract(address, '^[a-z]+://([^/?#:]*)', 1) AS host,
        regexp_extract(address, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(address, '^[^?#]*[?]([^#]*)', 1) AS query
    FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN winner > page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN winner > page_id THEN winner END AS refers_to,
    list_aggregate(list_reverse(string_split(regexp_replace(host, '^www[.]', ''), '.')),
        'string_agg', ',') || ')' || CASE WHEN path = '' THEN '/' ELSE path END
        || CASE WHEN query = '' THEN '' ELSE '?' || query END AS url_key
FROM hosts
"""


ORACLES["op11_hard_negatives"] = """
WITH vectors AS (
    SELECT DISTINCT vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
        CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
    FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
         AS INTEGER) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLES["op12_lexical_search"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), items AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), totals AS (
    SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(len(terms)) AS BIGINT) AS tokens
    FROM docs WHERE len(terms) > 0
), asked AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL
), postings AS (
    SELECT place, doc_id, n, term, count(*) AS tf
    FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term
), scored AS (
    SELECT item, item_id, place, doc_id, CAST(sum(times * w * ((1000000000 * tf)
        // (1000 * tf + 8 * (25 + (75 * n * documents) // tokens)))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), totals
    GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

# The tables hold one shape of page: headings, paragraphs and bold text in one
# article, and two kinds of character references.
ORACLES["op13_main_text"] = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS part
    FROM pages
), texts AS (
    SELECT page_id, url, trim(regexp_replace(replace(replace(replace(
        regexp_replace(regexp_replace(part, '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g'),
        '&quot;', '"'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g')) AS text
    FROM articles
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""


def _license_sql() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate(TEMPLATES))
    stop = ", ".join(map(quoted, sorted(STOP_WORDS)))
    return f"""
WITH templates(template, license, body) AS (VALUES {rows}),
template_terms AS (
    SELECT template, license, term, count(*) AS times
    FROM (SELECT template, license, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term
          FROM templates)
    WHERE term NOT IN ({stop}) GROUP BY ALL
), rarity AS (
    SELECT term, ln(1 + (SELECT count(*) FROM templates) / count(*)) AS rare
    FROM template_terms GROUP BY term
), template_weights AS (
    SELECT t.*, times * rare / sqrt(sum(times * rare * times * rare) OVER (PARTITION BY template))
           AS weight
    FROM template_terms t JOIN rarity USING (term)
), files AS (
    SELECT doc_id, text, coalesce(source, 'none') || '/' || (doc_id // 1000)
           || CASE WHEN doc_id % 1000 = 0 THEN '/LICENSE'
                   WHEN doc_id % 100 = 0 THEN '/' || (doc_id // 100) || '/LICENSE'
                   ELSE '/' || (doc_id // 100) || '/' || doc_id || '.txt' END AS path
    FROM documents
), units AS (
    SELECT DISTINCT path, unit
    FROM (SELECT path, unnest([text] || string_split(text, chr(10))
              || string_split_regex(text, '{BETWEEN}')
              || string_split_regex(array_to_string(list_transform(string_split(text, chr(10)),
                  lambda line: CASE WHEN regexp_matches(line, '{COMMENT_LINE}') THEN line ELSE '' END),
                  chr(10)), '\n\n+')) AS unit
          FROM files)
), counted AS (
    SELECT path, unit, term, count(*) AS times
    FROM (SELECT path, unit, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS term FROM units)
    WHERE term NOT IN ({stop}) GROUP BY ALL
), weighted AS (
    SELECT c.*, times * coalesce(rare, ln(1 + (SELECT count(*) FROM templates))) AS own
    FROM counted c LEFT JOIN rarity USING (term)
), lengths AS (
    SELECT path, unit, sqrt(sum(own * own)) AS length FROM weighted GROUP BY ALL
), close AS (
    SELECT path, license, round(sum(own * weight) / any_value(length), 9) AS similarity
    FROM weighted JOIN template_weights USING (term) JOIN lengths USING (path, unit)
    GROUP BY path, unit, template, license
), own AS (
    SELECT path, license, similarity
    FROM close WHERE similarity >= 0.6
    QUALIFY row_number() OVER (PARTITION BY path ORDER BY similarity DESC, license) = 1
), stated AS (
    SELECT regexp_replace(path, '/[^/]*$', '') AS above, path, license, similarity
    FROM own WHERE path LIKE '%/LICENSE'
), inherited AS (
    SELECT f.path, s.path AS stated_by, s.license, s.similarity
    FROM files f JOIN stated s ON starts_with(f.path, s.above || '/')
    QUALIFY row_number() OVER (PARTITION BY f.path ORDER BY length(s.above) DESC) = 1
)
SELECT f.doc_id, f.path, coalesce(o.license, i.license) AS license,
    coalesce(o.similarity, i.similarity) AS similarity,
    CASE WHEN o.path IS NOT NULL THEN 'own' WHEN i.path IS NOT NULL THEN 'inherited' END AS origin,
    CASE WHEN o.path IS NOT NULL THEN f.path ELSE i.stated_by END AS license_path
FROM files f LEFT JOIN own o ON o.path = f.path LEFT JOIN inherited i ON i.path = f.path
"""


ORACLES["op10_licenses"] = _license_sql()
