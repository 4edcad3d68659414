"""Independent DuckDB SQL for every registered query (the correctness oracle).

The works fixture is derived in SQL from the same TPC-H-style tables
(``orders``, ``lineitem``, ``customer``, ``nation``, ``part``,
``documents``) as ``paperweave.sources.fixture`` derives it in Spark; each
query is the fixture prefix below plus a final SELECT. Nothing here shares
code with the Spark operators: ids are numbered with window functions,
components by a recursive label-propagation CTE, abstracts straight from
the document tokens.
"""

from __future__ import annotations

from . import schemas
from .sources.fixture import DOI_PREFIX, ORCID_PREFIX, URL_PREFIX

_KEEP = ", ".join(f"'{t}'" for t in schemas.KEEP_TYPES)
_VENUES = ", ".join(f"'{v}'" for v in schemas.VALIDATION_VENUES)

PREFIX = f"""
WITH RECURSIVE
fx_work_all AS (
  SELECT o_orderkey AS k, CAST(1000 + 3*o_orderkey AS BIGINT) AS oa_id,
    CONCAT('{URL_PREFIX}W', CAST(1000 + 3*o_orderkey AS VARCHAR)) AS id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'article' WHEN '2-HIGH' THEN 'review'
      WHEN '3-MEDIUM' THEN 'preprint' WHEN '5-LOW' THEN 'letter' ELSE 'dataset' END AS type,
    CONCAT(CASE WHEN o_orderkey % 23 = 0 THEN chr(9) || ' ' ELSE '' END, 'Work, "', CAST(o_orderkey AS VARCHAR), '"',
      CASE WHEN o_orderkey % 23 < 2 THEN ' ' ELSE '' END) AS title,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(YEAR(o_orderdate) AS INT) END AS publication_year,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL
      WHEN o_orderkey % 17 = 1 THEN SUBSTRING(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 4)
      ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS publication_date,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CONCAT('{DOI_PREFIX}', CAST(o_orderkey AS VARCHAR)) END AS doi,
    CAST(FLOOR(o_totalprice/1000) AS BIGINT) AS cited_by_count,
    NULLIF(d.lang, '') AS language,
    d.text AS text,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN o_orderkey % 10 = 9 THEN CAST(9000 + o_orderkey % 7 AS BIGINT)
      ELSE CAST(100 + 10*c_nationkey AS BIGINT) END AS oa_source_id,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN o_orderkey % 10 = 9 THEN CONCAT(' Rare venue ', CAST(o_orderkey % 7 AS VARCHAR))
      WHEN c_nationkey = 0 THEN 'Nature' WHEN c_nationkey = 1 THEN 'SCIENCE'
      ELSE n_name END AS source_name,
    CAST(CASE o_orderkey % 3 WHEN 0 THEN '2024-01-01' WHEN 1 THEN '2024-02-01' ELSE '2024-03-01' END AS DATE)
      AS updated_date
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN documents d ON d.doc_id = o_orderkey
),
fx_line AS (
  SELECT lineitem.*, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_shipdate) - 1 AS pos FROM lineitem
),
fx_ref AS (
  SELECT l_orderkey AS k, CAST(1000 + 3*(CASE WHEN l_linenumber = 7 THEN NULL
     WHEN l_orderkey % 10 < 6 THEN l_partkey*10 + l_suppkey % 6
     WHEN l_linenumber = 1 THEN l_orderkey - l_orderkey % 1000 + 6
     ELSE l_orderkey - l_orderkey % 1000 + 6 + 10*(l_partkey % 100) + l_suppkey % 4 END) AS BIGINT) AS ref_oa_id
  FROM lineitem
),
fx_authorship AS (
  SELECT l_orderkey AS k, pos, CASE WHEN l_partkey % 37 <> 0 THEN CAST(500 + l_partkey AS BIGINT) END AS oa_author_id, p_name AS name,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CONCAT('{ORCID_PREFIX}', CAST(l_partkey AS VARCHAR)) END AS orcid
  FROM (SELECT l_orderkey, pos, l_partkey, l_quantity FROM fx_line
        UNION ALL SELECT l_orderkey, pos + 100, l_partkey, l_quantity FROM fx_line WHERE l_orderkey % 7 = 0) x
  JOIN part ON p_partkey = l_partkey
),
fx_topic AS (
  SELECT l_orderkey AS k, CAST(pos AS BIGINT) AS sequence,
    CASE WHEN p_size % 11 = 0 THEN NULL WHEN l_orderkey % 10 = 9 THEN CAST(60 + p_size % 3 AS BIGINT)
      ELSE CAST(10 + p_size % 10 AS BIGINT) END AS field_id,
    CASE WHEN p_size % 13 = 0 THEN NULL WHEN l_orderkey % 10 = 9 THEN CAST(9000 + p_size % 5 AS BIGINT)
      ELSE CAST(1000 + p_size AS BIGINT) END AS subfield_id,
    p_size % 13 = 1 AS subfield_bad
  FROM fx_line JOIN part ON p_partkey = l_partkey
),
kept AS (SELECT * FROM fx_work_all WHERE type IN ({_KEEP})),
papers AS (
  SELECT k, oa_id, updated_date, CAST(ROW_NUMBER() OVER (ORDER BY oa_id) - 1 AS BIGINT) AS paper_id FROM kept
),
toks AS (
  SELECT p.paper_id, list_filter(regexp_split_to_array(w.text, '[ \\t\\r\\n]+'), lambda x: x <> '') AS t
  FROM kept w JOIN papers p ON p.k = w.k WHERE w.text IS NOT NULL
),
src_first AS (
  SELECT * FROM (SELECT oa_source_id, source_name, updated_date, k,
      ROW_NUMBER() OVER (PARTITION BY oa_source_id ORDER BY updated_date, k) AS rn
    FROM kept WHERE oa_source_id IS NOT NULL) s WHERE rn = 1
),
sources AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY updated_date, k) - 1 AS BIGINT) AS source_id,
    oa_source_id AS openalex_source_id, source_name AS display_name, CAST(NULL AS VARCHAR) AS issn_l,
    'journal' AS type
  FROM src_first
),
meta AS (
  SELECT p.paper_id, w.oa_id AS openalex_id, w.title, w.publication_year AS year, w.doi, w.type,
    w.publication_date,
    CASE WHEN length(w.publication_date) >= 7 AND TRY_CAST(substring(w.publication_date, 6, 2) AS INT) IS NOT NULL
      THEN COALESCE(w.publication_year, 0)
           + CAST(TRY_CAST(substring(w.publication_date, 6, 2) AS INT) - 1 AS DOUBLE) / CAST(12 AS DOUBLE)
      ELSE CAST(COALESCE(w.publication_year, 0) AS DOUBLE) END AS frac_year,
    w.cited_by_count, w.language, COALESCE(s.source_id, -1) AS source_id
  FROM kept w JOIN papers p ON p.k = w.k LEFT JOIN sources s ON s.openalex_source_id = w.oa_source_id
),
au AS (
  SELECT p.paper_id, p.updated_date, a.k, a.oa_author_id, a.name, a.orcid,
    a.position
  FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY k ORDER BY pos) - 1 AS BIGINT) AS position FROM fx_authorship) a
  JOIN papers p ON p.k = a.k WHERE a.oa_author_id IS NOT NULL
),
au_first AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY oa_author_id ORDER BY updated_date, k, position) AS rn
    FROM au) a WHERE rn = 1
),
authors AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY updated_date, k, position) - 1 AS BIGINT) AS author_id,
    oa_author_id AS openalex_author_id, name, orcid
  FROM au_first
),
pa AS (
  SELECT DISTINCT au.paper_id, a.author_id FROM au JOIN authors a ON a.openalex_author_id = au.oa_author_id
),
tp AS (
  SELECT p.paper_id, t.k, t.sequence, t.field_id, CONCAT('Field ', CAST(t.field_id AS VARCHAR)) AS field_name,
    CASE WHEN t.subfield_bad THEN -1 ELSE COALESCE(t.subfield_id, -1) END AS subfield_id,
    CASE WHEN t.subfield_id IS NULL THEN '' ELSE CONCAT('Subfield ', CAST(t.subfield_id AS VARCHAR)) END
      AS subfield_name
  FROM fx_topic t JOIN papers p ON p.k = t.k WHERE t.field_id IS NOT NULL
),
cats AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY kind, oid) - 1 AS BIGINT) AS class_id,
    CASE kind WHEN 0 THEN 'main' ELSE 'sub' END AS type, title, oid AS openalex_id
  FROM (SELECT DISTINCT 0 AS kind, field_id AS oid, field_name AS title FROM tp WHERE field_id >= 0
        UNION ALL
        SELECT DISTINCT 1 AS kind, subfield_id AS oid, subfield_name AS title FROM tp WHERE subfield_id >= 0) x
),
pcat AS (
  SELECT tp.paper_id, m.class_id AS main_class_id, COALESCE(s.class_id, -1) AS sub_class_id, tp.sequence
  FROM tp JOIN cats m ON m.type = 'main' AND m.openalex_id = tp.field_id
  LEFT JOIN cats s ON s.type = 'sub' AND s.openalex_id = tp.subfield_id
),
refs AS (SELECT p.paper_id, r.ref_oa_id FROM fx_ref r JOIN papers p ON p.k = r.k WHERE r.ref_oa_id IS NOT NULL),
resolved AS (SELECT r.paper_id AS src, q.paper_id AS dst FROM refs r JOIN papers q ON q.oa_id = r.ref_oa_id),
cit AS (SELECT DISTINCT src, dst FROM resolved WHERE src <> dst),
und AS (SELECT src AS a, dst AS b FROM cit UNION SELECT dst AS a, src AS b FROM cit),
deg AS (
  SELECT p.paper_id, CAST(COUNT(u.b) AS BIGINT) AS degree FROM papers p LEFT JOIN und u ON u.a = p.paper_id
  GROUP BY p.paper_id
),
lab(v, comp) USING KEY (v) AS (
  SELECT paper_id, paper_id FROM papers
  UNION
  SELECT u.b, MIN(l.comp) FROM lab l JOIN und u ON u.a = l.v JOIN recurring.lab r ON r.v = u.b
  GROUP BY u.b HAVING MIN(l.comp) < MIN(r.comp)
),
comp AS (SELECT v AS paper_id, comp AS component FROM lab),
csize AS (SELECT component, CAST(COUNT(*) AS BIGINT) AS size FROM comp GROUP BY component),
cmax AS (
  SELECT c.component, MAX(d.degree) AS max_degree FROM comp c JOIN deg d ON d.paper_id = c.paper_id
  GROUP BY c.component
),
cseed AS (
  SELECT m.component, s.size, m.max_degree, MIN(c.paper_id) AS seed
  FROM cmax m JOIN csize s ON s.component = m.component
  JOIN comp c ON c.component = m.component JOIN deg d ON d.paper_id = c.paper_id AND d.degree = m.max_degree
  GROUP BY m.component, s.size, m.max_degree
),
lcc_x AS (SELECT component FROM csize ORDER BY size DESC, component LIMIT 1),
top_seeds AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY max_degree DESC, seed) AS seed_rank FROM cseed
  ORDER BY max_degree DESC, seed LIMIT {schemas.SEEDED_REPEATS}
),
lcc_s AS (SELECT component FROM top_seeds ORDER BY size DESC, seed_rank LIMIT 1),
flags AS (
  SELECT c.paper_id, CAST(CASE WHEN c.component = (SELECT component FROM lcc_x) THEN 1 ELSE 0 END AS INT)
    AS is_connected FROM comp c
),
ptab AS (SELECT m.*, f.is_connected FROM meta m JOIN flags f ON f.paper_id = m.paper_id),
abst AS (SELECT paper_id, array_to_string(t, ' ') AS abstract FROM toks WHERE len(t) > 0),
pmap AS (
  SELECT paper_id AS old_id, CAST(ROW_NUMBER() OVER (ORDER BY paper_id) - 1 AS BIGINT) AS new_id
  FROM flags WHERE is_connected = 1
),
lcc_pa_old AS (SELECT m.new_id AS paper_id, pa.author_id FROM pa JOIN pmap m ON m.old_id = pa.paper_id),
amap AS (
  SELECT author_id AS old_id, CAST(ROW_NUMBER() OVER (ORDER BY author_id) - 1 AS BIGINT) AS new_id
  FROM (SELECT DISTINCT author_id FROM lcc_pa_old) x
),
lcc_pcat AS (
  SELECT m.new_id AS paper_id, c.main_class_id, c.sub_class_id, c.sequence FROM pcat c
  JOIN pmap m ON m.old_id = c.paper_id
),
lcc_ptab AS (
  SELECT m.new_id AS paper_id, t.openalex_id, t.title, t.year, t.doi, t.type, t.publication_date, t.frac_year,
    t.cited_by_count, t.language, t.source_id
  FROM ptab t JOIN pmap m ON m.old_id = t.paper_id
),
venue_top AS (
  SELECT t.paper_id, t.cited_by_count, t.is_connected FROM ptab t
  WHERE t.source_id IN (SELECT source_id FROM sources WHERE lower(display_name) IN ({_VENUES}))
  ORDER BY t.cited_by_count DESC NULLS FIRST, t.paper_id LIMIT {schemas.VALIDATION_TOP_N}
),
adj_rows AS (
  SELECT p.paper_id AS row, CAST(COUNT(c.dst) AS BIGINT) AS degree FROM papers p
  LEFT JOIN cit c ON c.src = p.paper_id GROUP BY p.paper_id
),
scan_files AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY updated_date ORDER BY k) AS rn_in_partition FROM fx_work_all
)
"""

# Rows per file when the fixture is written as a snapshot (scan_file_cap).
SCAN_ROWS_PER_FILE = 1000
# Partition date of the repeated records of ``dedupe_works``.
DEDUPE_DATE = "2024-04-01"

_TAILS = {
    "scan_works": "SELECT id, type, title, CAST(updated_date AS VARCHAR) AS updated_date FROM fx_work_all",
    "scan_partitions": "SELECT id, type, CAST(updated_date AS VARCHAR) AS updated_date FROM fx_work_all "
    "WHERE updated_date IN (DATE '2024-01-01', DATE '2024-03-01')",
    "scan_file_cap": "SELECT id, CAST(updated_date AS VARCHAR) AS updated_date FROM scan_files "
    f"WHERE rn_in_partition <= {SCAN_ROWS_PER_FILE}",
    "empty_guard": f"SELECT CAST(updated_date AS VARCHAR) AS updated_date, SUM(CASE WHEN type IN ({_KEEP}) THEN 1 ELSE 0 END)::BIGINT AS n_works, "
    f"SUM(CASE WHEN type IN ({_KEEP}) THEN 1 ELSE 0 END) = 0 AS stopped FROM fx_work_all GROUP BY updated_date "
    "UNION ALL VALUES ('1999-01-01', 0::BIGINT, true), ('2999-12-31', 0::BIGINT, true)",
    "standalone_lcc_papers": "SELECT * FROM lcc_ptab",
    "standalone_lcc_author_table": "SELECT m.new_id AS author_id, a.openalex_author_id, a.name, a.orcid FROM authors a "
    "JOIN amap m ON m.old_id = a.author_id",
    "snapshot_author_table": "SELECT * FROM authors",
    "snapshot_source_table": "SELECT * FROM sources",
    "snapshot_paper_table": "SELECT * FROM ptab",
    "dedupe_works": f"""
        SELECT oa_id, title, CAST(updated_date AS VARCHAR) AS updated_date FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY oa_id ORDER BY updated_date DESC) AS rn FROM (
            SELECT oa_id, type, title, updated_date FROM fx_work_all
            UNION ALL
            SELECT oa_id, CASE WHEN k % 22 = 0 THEN 'dataset' ELSE type END, CONCAT('Revised ', title),
              DATE '{DEDUPE_DATE}' FROM fx_work_all WHERE k % 11 = 0) d
          WHERE type IN ({_KEEP})) r
        WHERE rn = 1""",
    "type_filter": "SELECT oa_id, type FROM kept",
    "parse_oa_id": f"""
        SELECT DISTINCT url, oa_id FROM (
          SELECT id AS url, oa_id FROM fx_work_all
          UNION ALL SELECT CONCAT('{URL_PREFIX}W', CAST(ref_oa_id AS VARCHAR)), ref_oa_id FROM fx_ref
          UNION ALL SELECT CONCAT('{URL_PREFIX}A', CAST(oa_author_id AS VARCHAR)), oa_author_id FROM fx_authorship
          UNION ALL SELECT CONCAT('{URL_PREFIX}S', CAST(oa_source_id AS VARCHAR)), oa_source_id FROM fx_work_all
            WHERE oa_source_id IS NOT NULL
          UNION ALL SELECT CONCAT('{URL_PREFIX}fields/', CAST(field_id AS VARCHAR)), field_id FROM fx_topic
            WHERE field_id IS NOT NULL
          UNION ALL SELECT CONCAT('{URL_PREFIX}subfields/', CASE WHEN subfield_bad THEN NULL ELSE CAST(subfield_id AS VARCHAR) END),
            CASE WHEN subfield_bad THEN NULL ELSE subfield_id END FROM fx_topic WHERE subfield_id IS NOT NULL) u""",
    "frac_year": "SELECT openalex_id AS oa_id, publication_date, year, frac_year FROM meta",
    "paper_index": "SELECT oa_id, paper_id FROM papers",
    "paper_metadata": "SELECT * FROM meta",
    "explode_references": "SELECT paper_id, ref_oa_id FROM refs",
    "explode_authorships": "SELECT paper_id, position, oa_author_id, name, orcid FROM au",
    "explode_topics": "SELECT paper_id, field_id, field_name, subfield_id, subfield_name, sequence FROM tp",
    "inverted_index_postings": "SELECT paper_id, unnest(t) AS word, CAST(generate_subscripts(t, 1) - 1 AS BIGINT) "
    "AS position FROM toks",
    "reconstruct_abstract": "SELECT doc_id, COALESCE(array_to_string(list_filter(regexp_split_to_array(text, "
    "'[ \\t\\r\\n]+'), lambda x: x <> ''), ' '), '') AS abstract FROM documents",
    "abstracts": "SELECT paper_id, abstract FROM abst",
    "abstract_lookup": "SELECT paper_id, abstract FROM abst WHERE paper_id IN "
    "(SELECT paper_id FROM ptab ORDER BY cited_by_count DESC NULLS LAST, paper_id LIMIT 1000)",
    "abstract_length": "SELECT paper_id, CAST(len(t) - 1 AS BIGINT) AS max_position, "
    "CAST(len(t) AS BIGINT) AS n_positions FROM toks WHERE len(t) > 0",
    "resolve_citations": "SELECT src, dst FROM resolved",
    "lookup_ids": "SELECT r.paper_id, r.ref_oa_id, COALESCE(q.paper_id, -1) AS dst FROM refs r "
    "LEFT JOIN papers q ON q.oa_id = r.ref_oa_id",
    "citation_net": "SELECT src, dst FROM cit",
    "graph_shape": "SELECT (SELECT COUNT(*) FROM papers) AS n_rows, (SELECT COUNT(*) FROM papers) AS n_cols, "
    "(SELECT COUNT(*) FROM cit) AS nnz",
    "symmetrize": "SELECT a AS src, b AS dst FROM und",
    "undirected_degree": "SELECT paper_id, degree FROM deg",
    "adjacency": "SELECT row, CAST(COALESCE(SUM(degree) OVER (ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS BIGINT) AS start, degree FROM adj_rows",
    "connected_components": "SELECT paper_id, component FROM comp",
    "component_sizes": "SELECT component, size FROM csize",
    "component_seeds": "SELECT component, size, max_degree, seed FROM cseed",
    "lcc_exact": "SELECT paper_id FROM comp WHERE component = (SELECT component FROM lcc_x)",
    "lcc_seeded": "SELECT paper_id FROM comp WHERE component = (SELECT component FROM lcc_s)",
    "expand_from_seed": "SELECT paper_id FROM comp WHERE component = (SELECT component FROM cseed "
    "ORDER BY max_degree DESC, seed LIMIT 1)",
    "expand_bfs": "SELECT paper_id FROM comp WHERE component = (SELECT component FROM cseed "
    "ORDER BY max_degree DESC, seed LIMIT 1)",
    "source_table": "SELECT * FROM sources",
    "source_first_seen": "SELECT source_id, openalex_source_id FROM sources",
    "author_table": "SELECT * FROM authors",
    "author_first_seen": "SELECT author_id, openalex_author_id FROM authors",
    "paper_author_net": "SELECT paper_id, author_id FROM pa",
    "category_table": "SELECT * FROM cats",
    "paper_category_table": "SELECT * FROM pcat",
    "paper_table": "SELECT * FROM ptab",
    "paper_table_seeded": "SELECT m.*, CAST(CASE WHEN c.component = (SELECT component FROM lcc_s) THEN 1 ELSE 0 END "
    "AS INT) AS is_connected FROM meta m JOIN comp c ON c.paper_id = m.paper_id",
    "venue_top_cited": "SELECT paper_id, cited_by_count FROM venue_top",
    "venue_validation": f"SELECT CAST(COUNT(*) AS BIGINT) AS n_top, CAST(COALESCE(SUM(is_connected), 0) AS BIGINT) "
    f"AS n_in_lcc, COALESCE(SUM(is_connected), 0) < {schemas.VALIDATION_WARN_BELOW} AS warn FROM venue_top",
    "completeness": "SELECT (SELECT COUNT(*) FROM meta) AS n_metadata, (SELECT COUNT(*) FROM papers) AS n_index",
    "registry_papers": "SELECT paper_id, oa_id AS openalex_id FROM papers",
    "registry_authors": "SELECT author_id, openalex_author_id FROM authors",
    "registry_meta": "SELECT (SELECT COUNT(*) FROM papers) AS n_papers, (SELECT COUNT(*) FROM authors) AS n_authors, "
    "strftime(current_date, '%Y-%m-%d') AS sync_date",
    "dataset_counts": """SELECT
        (SELECT COUNT(*) FROM papers) AS n_papers,
        (SELECT COUNT(*) FROM resolved) AS n_citation_links,
        (SELECT COUNT(*) FROM au) AS n_authorship_links,
        (SELECT COUNT(*) FROM authors) AS n_authors,
        (SELECT COUNT(*) FROM sources) AS n_sources,
        (SELECT COUNT(*) FROM tp) AS n_topics,
        (SELECT COUNT(*) FROM abst) AS n_abstracts,
        (SELECT COUNT(*) FROM cit) AS n_citation_edges,
        (SELECT COUNT(*) FROM pa) AS n_paper_author_edges,
        (SELECT COUNT(*) FROM fx_ref r JOIN papers p ON p.k = r.k WHERE r.ref_oa_id IS NULL) AS n_bad_references,
        (SELECT COUNT(*) FROM fx_authorship a JOIN papers p ON p.k = a.k WHERE a.oa_author_id IS NULL) AS n_bad_authors,
        CAST(0 AS BIGINT) AS n_bad_fields,
        (SELECT COUNT(*) FROM fx_topic t JOIN papers p ON p.k = t.k WHERE t.subfield_bad) AS n_bad_subfields,
        CAST(0 AS BIGINT) AS n_bad_sources, CAST(0 AS BIGINT) AS n_bad_works""",
    "csv_roundtrip": "SELECT * FROM ptab",
    "csv_gz_roundtrip": "SELECT * FROM authors",
    "parquet_roundtrip": "SELECT * FROM pcat",
    "abstracts_sink": "SELECT paper_id, abstract FROM abst",
    "lcc_papers": "SELECT * FROM lcc_ptab",
    "lcc_citation_net": "SELECT a.new_id AS src, b.new_id AS dst FROM cit c JOIN pmap a ON a.old_id = c.src "
    "JOIN pmap b ON b.old_id = c.dst",
    "lcc_paper_author_net": "SELECT l.paper_id, m.new_id AS author_id FROM lcc_pa_old l "
    "JOIN amap m ON m.old_id = l.author_id",
    "lcc_author_table": "SELECT m.new_id AS author_id, a.openalex_author_id, a.name, a.orcid FROM authors a "
    "JOIN amap m ON m.old_id = a.author_id",
    "lcc_paper_category": "SELECT * FROM lcc_pcat",
    "lcc_category_table": "SELECT * FROM cats WHERE class_id IN (SELECT main_class_id FROM lcc_pcat UNION "
    "SELECT sub_class_id FROM lcc_pcat WHERE sub_class_id <> -1)",
    "lcc_abstracts": "SELECT m.new_id AS paper_id, a.abstract FROM abst a JOIN pmap m ON m.old_id = a.paper_id",
    "lcc_source_table": "SELECT * FROM sources WHERE source_id IN (SELECT source_id FROM lcc_ptab "
    "WHERE source_id <> -1)",
    "lcc_registry_papers": "SELECT paper_id, openalex_id FROM lcc_ptab",
    "lcc_registry_authors": "SELECT m.new_id AS author_id, a.openalex_author_id FROM authors a "
    "JOIN amap m ON m.old_id = a.author_id",
    "written_paper_table": "SELECT *, paper_id AS place FROM ptab",
    "written_author_table": "SELECT *, author_id AS place FROM authors",
    "written_paper_category": "SELECT *, ROW_NUMBER() OVER (ORDER BY paper_id, sequence) - 1 AS place FROM pcat",
    "written_registry_papers": "SELECT paper_id, oa_id AS openalex_id, ROW_NUMBER() OVER (ORDER BY oa_id) - 1 AS place FROM papers",
    "written_lcc_papers": "SELECT *, paper_id AS place FROM lcc_ptab",
    "written_lcc_category_table": "SELECT *, ROW_NUMBER() OVER (ORDER BY class_id) - 1 AS place FROM cats WHERE class_id IN "
    "(SELECT main_class_id FROM lcc_pcat UNION SELECT sub_class_id FROM lcc_pcat WHERE sub_class_id <> -1)",
    "written_lcc_source_table": "SELECT *, ROW_NUMBER() OVER (ORDER BY source_id) - 1 AS place FROM sources WHERE source_id IN "
    "(SELECT source_id FROM lcc_ptab WHERE source_id <> -1)",
    "written_lcc_citation_net": "SELECT a.new_id AS src, b.new_id AS dst FROM cit c JOIN pmap a ON a.old_id = c.src "
    "JOIN pmap b ON b.old_id = c.dst",
    "written_lcc_shapes": "SELECT 'citation_net' AS graph, (SELECT COUNT(*) FROM pmap) AS n_rows, (SELECT COUNT(*) FROM pmap) AS n_cols, "
    "(SELECT COUNT(*) FROM cit c JOIN pmap a ON a.old_id = c.src JOIN pmap b ON b.old_id = c.dst) AS nnz UNION ALL "
    "SELECT 'paper_author_net', (SELECT COUNT(*) FROM pmap), (SELECT COUNT(*) FROM amap), (SELECT COUNT(*) FROM lcc_pa_old)",
    "written_lcc_registry_meta": "SELECT (SELECT COUNT(*) FROM pmap) AS n_papers, (SELECT COUNT(*) FROM amap) AS n_authors, "
    "'2024-05-01' AS sync_date",
    "adjacency_entries": "SELECT ROW_NUMBER() OVER (ORDER BY src, dst) - 1 AS pos, src, dst FROM cit",
    "lcc_registry_meta": "SELECT (SELECT COUNT(*) FROM pmap) AS n_papers, (SELECT COUNT(*) FROM amap) AS n_authors, "
    "strftime(current_date, '%Y-%m-%d') AS sync_date",
}


def oracle_sql() -> dict[str, str]:
    return {name: PREFIX + tail for name, tail in _TAILS.items()}
