"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

CONTENT = """
SELECT doc_id, lower_text, sha256(lower_text) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents)
"""



def _warc(html: str) -> str:
    http = f"'HTTP/1.1 200 OK' || crlf || 'Content-Type: text/html; charset=utf-8' || crlf || crlf || {html}"
    return f"""
    'WARC/1.0' || crlf || 'WARC-Type: response' || crlf || 'WARC-Date: 1970-01-01T00:00:00Z' || crlf
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || crlf || 'WARC-Target-URI: '
    || coalesce(url, '') || crlf || 'Content-Type: application/http;msgtype=response' || crlf
    || 'Content-Length: ' || strlen({http}) || crlf || crlf || {http} || crlf || crlf"""


_ORACLES = {
    "op2_warc_fixity": f"""
WITH source AS (
    SELECT page_id, url, coalesce(html, '') AS html, chr(13) || chr(10) AS crlf,
           left(md5(CAST(page_id AS VARCHAR)), 2) AS mark
    FROM pages
),
records AS (
    SELECT page_id, mark, {_warc("html")} AS content,
           {_warc("'#' || substring(html, 2)")} AS spoilt
    FROM source
),
placed AS (
    SELECT *, CAST(CAST(floor(page_id / 1000) AS BIGINT) AS VARCHAR) AS file,
           CAST(coalesce(sum(strlen(content)) OVER (
               PARTITION BY floor(page_id / 1000) ORDER BY page_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
    FROM records
)
SELECT page_id, file, "offset", CASE mark WHEN '00' THEN 'altered' ELSE 'missing' END AS status,
       sha256('0' || content) AS primary_sha256,
       CASE mark WHEN '00' THEN sha256('0' || spoilt) END AS replica_sha256
FROM placed
WHERE mark = '01' OR mark = '00' AND spoilt <> content
""",
    "op5_kd_search": """
WITH whole AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored)
WHERE rank <= 20
""",
    "op6_content_sort": f"""
WITH content AS ({CONTENT}),
sizes AS (SELECT lower_text, max(doc_id) AS keep_id, count(*) AS group_size FROM content GROUP BY 1)
SELECT c.doc_id, s.keep_id, s.group_size,
       row_number() OVER (PARTITION BY c.lower_text ORDER BY c.doc_id DESC NULLS LAST) = 1 AS kept,
       c.text_sha256
FROM content c JOIN sizes s USING (lower_text)
""",
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
