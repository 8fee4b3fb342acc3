"""SQL for DuckDB that states what the queries return, where SQL can."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(x: str) -> str:
    return f"translate(coalesce({x}, ''), '{_UPPER}', '{_LOWER}')"


_WORD4 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '{_WORD4}') AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS size FROM (SELECT item_id, regexp_extract_all({_lower("text")}, '{_WORD4}') AS w FROM benchmark) WHERE len(w) > 0),
test AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
place AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM test))),
found AS (SELECT doc_id, item_id, i, size FROM place JOIN test USING (size, s)),
hit AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT met.a, met.b FROM met JOIN n p ON p.doc_id = met.a JOIN n q ON q.doc_id = met.b WHERE 100 * met.n >= 80 * (p.n + q.n - met.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""

_WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to FROM m
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _found(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    size = lambda x: f"list_sum(list_transform({x}, lambda v: length(v)))"
    return (
        f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, coalesce({size('gap[1:i]')}, 0) + coalesce({size('hit[1:i - 1]')}, 0) AS start, length(hit[i]) AS n FROM "
        f"(SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM (SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gap, regexp_extract_all(t, '{pattern}') AS hit, regexp_extract_all(t, '{pattern}', {group}) AS part FROM d)) WHERE length(part[i]) >= {least}"
    )


_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_found(0, "assign", _ASSIGN, 1, 6)} UNION ALL {_found(1, "access", "AKIA[A-Z0-9]+", 0, 20)} UNION ALL {_found(2, "hex", "[0-9a-f]{24,}", 0, 24)}),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k, count(*) FILTER (rank = 2) AS h, string_agg(kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, rank) AS s FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_wu_manber_decontamination": _DECONTAMINATION, "op5_token_group_join": _JACCARD, "op6_warc_transactions": _WARC, "op9_blob_ledger_secrets": _SECRETS}
