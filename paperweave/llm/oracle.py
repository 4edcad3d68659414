"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"

OP7 = rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""

_RULES = (
    ("example.org/en/1", "block"), ("example.org/es/", "block"), ("com/de/", "block"), ("com/fr/", "allow"), ("org/", "allow"),
)


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


def _shrunk(source: str, out: str, keep: str) -> str:
    """Beta-binomial shrinkage of ``source`` (n, k, prior) by its own over-dispersion."""
    return f"""
{out}_m AS (
  SELECT 1 / least(greatest(coalesce(
           (sum(n * pow(k / n - prior, 2) / (prior * (1 - prior))) - count(*)) / nullif(sum(n) - count(*), 0), 0.5), 0.001), 0.5) - 1 AS m
  FROM {source} WHERE n > 0 AND prior > 0 AND prior < 1
),
{out} AS (
  SELECT {keep}, n, k, k + m * prior AS a, n - k + m * (1 - prior) AS b,
         (k + m * prior) / (k + m * prior + n - k + m * (1 - prior)) AS mean
  FROM {source}, {out}_m
)"""


OP10 = rf"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
outcome AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
host_counts AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
  FROM p LEFT JOIN outcome ON page_id = doc_id GROUP BY host
),
bare AS (
  SELECT *, regexp_extract(host, '([^@:]*)(:[0-9]*)?$', 1) AS bare FROM host_counts
),
suffixed AS (
  SELECT *, CASE
      WHEN bare = 'org.uk' OR ends_with(bare, '.org.uk') THEN 'org.uk'
      WHEN bare = 'com.au' OR ends_with(bare, '.com.au') THEN 'com.au'
      WHEN bare = 'co.uk' OR ends_with(bare, '.co.uk') THEN 'co.uk'
      WHEN bare = 'co.jp' OR ends_with(bare, '.co.jp') THEN 'co.jp'
      ELSE split_part(bare, '.', -1) END AS suffix
  FROM bare
),
hosts AS (
  SELECT *, CASE WHEN len(string_split(bare, '.')) <= len(string_split(suffix, '.')) THEN bare
      ELSE array_to_string(string_split(bare, '.')[-(len(string_split(suffix, '.')) + 1):], '.') END AS domain
  FROM suffixed
),
domain_counts AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffix_counts AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domain_counts GROUP BY ALL),
s0 AS (SELECT s.*, (r.k + 0.5) / (r.n + 1.0) AS prior FROM suffix_counts s, (SELECT sum(n) AS n, sum(k) AS k FROM suffix_counts) r),
{_shrunk("s0", "s1", "suffix")},
d0 AS (SELECT d.*, s1.mean AS prior FROM domain_counts d JOIN s1 USING (suffix)),
{_shrunk("d0", "d1", "domain, suffix")},
h0 AS (SELECT h.host, h.n, h.k, d1.mean AS prior FROM hosts h JOIN d1 USING (domain, suffix)),
{_shrunk("h0", "h1", "host")},
rules AS (
  SELECT p.*, CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for r, _ in _RULES)} END AS rule,
         CASE {" ".join(f"WHEN {_fits(r)} THEN '{a}'" for r, a in _RULES)} END AS action
  FROM p
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN mean - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.3 THEN 'block' ELSE 'allow' END) AS verdict
FROM rules JOIN h1 USING (host)
"""


OP6 = r"""
WITH r AS (
  SELECT 'pages-' || coalesce(CAST(CAST(floor(page_id / 256) AS BIGINT) AS VARCHAR), 'none') || '.warc' AS file, page_id AS record_id,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM pages
),
p AS (
  SELECT file, record_id, payload, sha256(payload) AS expected,
         row_number() OVER w - 1 AS ordinal, row_number() OVER (PARTITION BY file ORDER BY record_id DESC, sha256(payload) DESC) = 1 AS last,
         CAST(sum(strlen(payload)) OVER w AS BIGINT) AS finish, CAST(strlen(payload) AS BIGINT) AS size
  FROM r WINDOW w AS (PARTITION BY file ORDER BY record_id, sha256(payload) ROWS UNBOUNDED PRECEDING)
),
d AS (
  SELECT *, last AND starts_with(sha256(file), '0') AS lost, starts_with(expected, '00') AS hit,
         sha256(left(payload, length(payload) - 1) || '#') AS spoiled
  FROM p
)
SELECT file, ordinal, finish - size AS "begin", finish, record_id, expected,
       CASE WHEN lost THEN NULL ELSE spoiled END AS found, CASE WHEN lost THEN 'missing' ELSE 'corrupt' END AS status
FROM d WHERE lost OR hit
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_merkle_audit": OP6, "op7_stream_dedup": OP7, "op10_host_reputation": OP10}
