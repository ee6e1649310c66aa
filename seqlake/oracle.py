"""DuckDB SQL equal to each registered query (the correctness oracle).

DuckDB sees only the driver tables, so each statement repeats the
recipes of :mod:`seqlake.sources.derived` as CTEs.  Dialect notes:
``regexp_full_match`` is a whole-value match, ``instr`` avoids LIKE's
``_`` wildcard, ``replace`` changes every occurrence, ``//`` is integer
division.
"""

from __future__ import annotations

# ------------------------------------------------------------ recipes
META = """
meta_b AS (
  SELECT l_linenumber, l_partkey, l_suppkey,
         concat('WA', lpad(CAST(l_orderkey % 3000 AS VARCHAR), 7, '0'),
                CASE WHEN l_suppkey % 2 = 0 THEN '-WA9' ELSE '' END) AS sid,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem),
meta_c AS (
  SELECT CASE WHEN l_linenumber IN (6, 7) THEN 'null' ELSE sid END AS id,
         CASE l_partkey % 5 WHEN 0 THEN 'PHoeNIx_v2' WHEN 1 THEN 'TheiaProk_Illumina_PE' WHEN 2 THEN 'recapp'
                            WHEN 3 THEN 'BaseSpace_Fetch_PHB' ELSE 'mycosnp' END AS workflow,
         concat('run_', CAST(l_suppkey % 20 AS VARCHAR)) AS run,
         CASE l_linenumber WHEN 1 THEN concat(sid, '_R1_001.fastq.gz') WHEN 2 THEN concat(sid, '_R2_001.fastq.gz')
                           WHEN 3 THEN concat(sid, '.scaffolds.fa.gz') WHEN 4 THEN concat(sid, '_contigs.fasta')
                           WHEN 5 THEN concat(sid, '.synopsis') WHEN 6 THEN 'Phoenix_Summary.tsv'
                           ELSE 'terra_table.tsv' END AS file,
         CAST(ts AS VARCHAR) AS timestamp
  FROM meta_b),
meta AS (
  SELECT id, workflow, run, file, timestamp,
         concat('s3://prod/', run, '/', file) AS origin,
         concat('s3://results/data/id=', id, '/workflow=', workflow, '/run=', run, '/file=', file,
                '/timestamp=', timestamp, '/', file) AS current
  FROM meta_c)"""

META_ALT = META + """,
meta_alt AS (
  SELECT DISTINCT id,
         CASE WHEN lower(workflow) LIKE '%phoenix%' THEN 'phoenix'
              WHEN lower(workflow) LIKE '%theiaprok%' THEN 'theiaprok'
              WHEN upper(workflow) LIKE '%RECAPP%' THEN 'recapp'
              WHEN upper(workflow) LIKE '%BASESPACE%' THEN 'basespace_fetch'
              ELSE workflow END AS workflow,
         run, file, timestamp, origin, current,
         regexp_replace(id, '-WA.*', '') AS id_alt
  FROM meta),
meta_fastq AS (
  SELECT * FROM meta_alt
  WHERE file LIKE '%.fastq.gz%' AND (file LIKE '%R1%' OR file LIKE '%R2%')),
meta_fasta AS (
  SELECT * FROM meta_alt
  WHERE file LIKE '%.fasta%' OR file LIKE '%.fa' OR file LIKE '%.fa.gz' OR file LIKE '%.fna%')"""

RESULTS = """
results AS (
  SELECT o_orderkey AS row_id,
         concat('WA', lpad(CAST(o_orderkey % 3000 AS VARCHAR), 7, '0')) AS id,
         CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
         CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'O' THEN 'PASS' END AS qc,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE replace(replace(o_orderpriority, ',', ';'), ' ', '_') END AS species
  FROM orders),
latest AS (
  SELECT row_id, id, timestamp, qc, species FROM (
    SELECT *, row_number() OVER (PARTITION BY id
                                 ORDER BY TRY_CAST(timestamp AS DECIMAL(18,3)) DESC NULLS LAST, row_id) AS rn
    FROM results) WHERE rn = 1),
passing AS (
  SELECT * FROM latest
  WHERE qc IS DISTINCT FROM 'FAIL' AND species IS NOT NULL AND species <> '')"""

PAIRS = """
reads AS (
  SELECT id_alt, file, current FROM meta_fastq
  WHERE regexp_full_match(file, '.*_R[12].*.fastq.gz') AND id_alt <> 'null'),
first_mate AS (
  SELECT id_alt, current AS fastq_1, replace(file, 'R1', 'R2') AS mate FROM (
    SELECT *, row_number() OVER (PARTITION BY id_alt ORDER BY file, current) AS rn
    FROM reads WHERE regexp_full_match(file, '.*_R1.*.fastq.gz')) WHERE rn = 1),
pairs AS (
  SELECT f.id_alt, f.fastq_1, min(r.current) AS fastq_2
  FROM first_mate f JOIN reads r ON r.id_alt = f.id_alt AND r.file = f.mate
  GROUP BY f.id_alt, f.fastq_1)"""

ASSEMBLY = """
asm_files AS (
  SELECT id_alt, current AS assembly, TRY_CAST(timestamp AS DECIMAL(18,3)) AS t FROM meta_fasta
  WHERE (file = id || '.scaffolds.fa.gz' OR file = id || '_contigs.fasta') AND id_alt <> 'null'),
asm AS (
  SELECT id_alt, assembly FROM (
    SELECT *, row_number() OVER (PARTITION BY id_alt ORDER BY t DESC NULLS LAST, assembly) AS rn
    FROM asm_files) WHERE rn = 1)"""

ANALYSIS = META_ALT + "," + RESULTS + "," + PAIRS + "," + ASSEMBLY + """,
analysis AS (
  SELECT p.id, p.row_id, p.timestamp, p.qc, p.species, r.fastq_1, r.fastq_2, a.assembly
  FROM passing p LEFT JOIN pairs r ON r.id_alt = p.id LEFT JOIN asm a ON a.id_alt = p.id),
flagged AS (
  SELECT *, (assembly IS NOT NULL AND assembly <> '' AND fastq_1 IS NOT NULL AND fastq_1 <> ''
             AND fastq_2 IS NOT NULL AND fastq_2 <> '') AS ok
  FROM analysis)"""


def _w(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


ORACLE: dict[str, str] = {
    "catalog_clean": _w(META_ALT, "SELECT * FROM meta_alt"),
    "catalog_results": _w(META_ALT, """
        SELECT * FROM meta_alt WHERE
          (id = 'null' AND workflow = 'phoenix' AND file = 'Phoenix_Summary.tsv') OR
          (id = 'null' AND workflow = 'phoenix' AND file = 'terra_table.tsv') OR
          (id = 'null' AND workflow = 'theiaprok' AND file = 'terra_table.tsv') OR
          (id = 'null' AND workflow = 'recapp' AND file = 'terra_table.tsv')"""),
    "catalog_reads": _w(META_ALT, "SELECT * FROM meta_fastq"),
    "catalog_assemblies": _w(META_ALT, "SELECT * FROM meta_fasta"),
    "latest_result": _w(RESULTS, "SELECT * FROM latest"),
    "latest_passing": _w(RESULTS, "SELECT * FROM passing"),
    "read_pairs": _w(META_ALT + "," + PAIRS, "SELECT * FROM pairs"),
    "latest_assembly": _w(META_ALT + "," + ASSEMBLY, "SELECT * FROM asm"),
    "analysis_table": _w(ANALYSIS, "SELECT * EXCLUDE (ok) FROM flagged"),
    "analysis_ok": _w(ANALYSIS, "SELECT * EXCLUDE (ok) FROM flagged WHERE ok"),
    "analysis_missing": _w(ANALYSIS, "SELECT * EXCLUDE (ok) FROM flagged WHERE NOT ok"),
}

# ------------------------------------------------------- read export
NEW_READS = META_ALT + """,
nr AS (
  SELECT concat(id, '_', CASE WHEN contains(file, 'R1') THEN 'R1' ELSE 'R2' END, '.fastq.gz') AS dest_name,
         current AS source, TRY_CAST(trim(timestamp) AS BIGINT) AS ts, timestamp AS ts_text
  FROM meta_fastq
  WHERE contains(file, '_R1') OR contains(file, 'R2')),
nr_now AS (
  SELECT dest_name, source, ts FROM nr
  WHERE regexp_full_match(ts_text, '\\s*[+-]?\\d+\\s*') AND ts > 999993600 - 30 * 86400),
nr_prev AS (
  SELECT dest_name, source, ts FROM nr
  WHERE regexp_full_match(ts_text, '\\s*[+-]?\\d+\\s*') AND ts > 999993600 - 15 * 86400 - 30 * 86400
    AND ts <= 999993600 - 15 * 86400),
nr_latest AS (
  SELECT dest_name, source, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY dest_name ORDER BY ts DESC NULLS LAST, source) AS rn
    FROM nr_now) WHERE rn = 1)"""

ORACLE["new_reads"] = _w(NEW_READS, "SELECT * FROM nr_now")
ORACLE["new_reads_latest"] = _w(NEW_READS, "SELECT * FROM nr_latest")
ORACLE["new_reads_pending"] = _w(NEW_READS, """
    SELECT * FROM nr_latest WHERE dest_name NOT IN (SELECT dest_name FROM nr_prev)""")

# ------------------------------------------------------- submissions
SUBS = """
subs AS (
  SELECT CAST(event_id AS VARCHAR) AS submission_id, event_type AS method,
         concat('entity_', CAST(user_id % 50 AS VARCHAR), CASE WHEN event_id % 3 = 0 THEN '_set' ELSE '' END) AS entity_raw,
         ts AS submission_date,
         CASE WHEN event_id % 4 = 0 THEN 'Aborted' ELSE 'Done' END AS status,
         CASE WHEN event_id % 5 = 0 THEN '{"Failed":1}' ELSE '{"Succeeded":1}' END AS workflow_statuses,
         user_id
  FROM events),
etypes AS (
  SELECT DISTINCT concat('entity_', CAST(user_id % 50 AS VARCHAR)) AS entity_type FROM events WHERE user_id % 50 < 45),
cands AS (
  SELECT submission_id, method, regexp_replace(entity_raw, '_set$', '') AS entity_type, submission_date
  FROM subs
  WHERE status = 'Done' AND json_exists(workflow_statuses, '$.Succeeded')
    AND regexp_replace(entity_raw, '_set$', '') IN (SELECT entity_type FROM etypes)),
best AS (
  SELECT entity_type, method, submission_date FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY submission_date DESC, submission_id) AS rn
    FROM cands) WHERE rn = 1),
newest AS (
  SELECT c.* FROM cands c
  WHERE EXISTS (SELECT 1 FROM best b WHERE b.entity_type = c.entity_type AND b.method = c.method
                AND b.submission_date = c.submission_date)),
ledger AS (SELECT CAST(event_id AS VARCHAR) AS submission_id FROM events WHERE event_id % 7 = 0),
fresh AS (SELECT * FROM newest WHERE submission_id NOT IN (SELECT submission_id FROM ledger)),
capped AS (
  SELECT *, (SELECT count(*) FROM fresh) <= 10 OR row_number() OVER (ORDER BY submission_date, submission_id) <= 19 AS start
  FROM fresh),
summary AS (
  SELECT 'proj' AS project, CASE WHEN user_id % 2 = 0 THEN 'ws_a' ELSE 'ws_b' END AS workspace,
         submission_id AS submissionId, method AS methodConfigurationName,
         concat(entity_raw, ':', 'name_', CAST(user_id AS VARCHAR)) AS submissionEntity,
         submission_date AS submissionDate, status, workflow_statuses AS workflowStatuses
  FROM subs),
wsheet AS (
  SELECT 'proj' AS project, CASE WHEN n_nationkey % 2 = 0 THEN 'ws_a' ELSE 'ws_b' END AS workspace,
         concat('wf_', lower(n_name)) AS workflow, CAST(NULL AS VARCHAR) AS run
  FROM nation WHERE n_nationkey % 5 < 4
  UNION ALL
  SELECT 'proj', CASE WHEN n_nationkey % 2 = 0 THEN 'ws_a' ELSE 'ws_b' END,
         concat('wf_', lower(n_name)), concat('entity_', CAST(n_nationkey AS VARCHAR))
  FROM nation WHERE n_nationkey % 5 = 4),
wcache AS (
  SELECT project, workspace, submissionId FROM summary WHERE CAST(submissionId AS BIGINT) % 7 = 0),
asked AS (
  SELECT * FROM summary s
  WHERE EXISTS (SELECT 1 FROM wsheet w WHERE (w.run IS NULL OR w.run = '')
                AND w.project = s.project AND w.workspace = s.workspace)),
retained AS (
  SELECT project, workspace, split_part(submissionEntity, ':', 1) AS entity, submissionId FROM asked
  WHERE status = 'Done' AND contains(workflowStatuses, 'Succeeded')
    AND NOT contains(split_part(submissionEntity, ':', 1), '_set')),
sdiff AS (
  SELECT DISTINCT project, workspace, entity FROM retained r
  WHERE NOT EXISTS (SELECT 1 FROM wcache c WHERE c.project = r.project AND c.workspace = r.workspace
                    AND c.submissionId = r.submissionId))"""

ORACLE["submission_candidates"] = _w(SUBS, "SELECT * FROM cands")
ORACLE["latest_submission"] = _w(SUBS, "SELECT * FROM newest")
ORACLE["new_submissions"] = _w(SUBS, "SELECT * FROM fresh")
ORACLE["capped_submissions"] = _w(SUBS, "SELECT * FROM capped")
ORACLE["job_rows"] = _w(SUBS, """
    SELECT 'proj' AS project, 'ws' AS workspace, submission_id, method AS workflow, entity_type AS entity,
           's3://results' AS outdir, concat_ws('_', 'proj', 'ws', submission_id) AS job_name, start
    FROM capped""")
ORACLE["submission_diff"] = _w(SUBS, "SELECT * FROM sdiff")
ORACLE["submission_tables"] = _w(SUBS, """
    SELECT d.project, d.workspace, d.entity AS entity_table, w.workflow
    FROM sdiff d JOIN wsheet w ON w.project = d.project AND w.workspace = d.workspace
    UNION ALL
    SELECT project, workspace, run, workflow FROM wsheet WHERE run IS NOT NULL AND run <> ''""")

# --------------------------------------------------------- retention
RETENTION = """
manifest AS (
  SELECT concat('run_', CAST(c_nationkey AS VARCHAR)) AS run, c_name AS sample, c_custkey,
         concat('/reads/', c_name, '_R1.fastq.gz') AS fastq_1,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('/reads/', c_name, '_R2.fastq.gz') END AS fastq_2
  FROM customer),
rules(workflow, kind, pattern) AS (VALUES
  ('phoenix', 'run_files', '/Phoenix_Summary.tsv'),
  ('phoenix', 'run_files', '/versions.yml'),
  ('phoenix', 'sample_files', '/<sample>/<sample>.synopsis'),
  ('phoenix', 'sample_files', '/<sample>/<sample>.tax'),
  ('phoenix', 'sample_files', '/<sample>/assembly/<sample>.scaffolds.fa.gz')),
mruns AS (SELECT DISTINCT run, 'phoenix' AS workflow, 's3://prod/runs/' || run AS run_path FROM manifest),
expanded AS (
  SELECT m.run, r.workflow, m.sample, r.run_path || replace(p.pattern, '<sample>', m.sample) AS file
  FROM manifest m JOIN mruns r ON r.run = m.run JOIN rules p ON p.workflow = r.workflow AND p.kind = 'sample_files'
  UNION ALL
  SELECT r.run, r.workflow, CAST(NULL AS VARCHAR), r.run_path || p.pattern
  FROM mruns r JOIN rules p ON p.workflow = r.workflow AND p.kind = 'run_files'
  UNION ALL
  SELECT m.run, r.workflow, m.sample, m.fastq_1 FROM manifest m JOIN mruns r ON r.run = m.run
  UNION ALL
  SELECT m.run, r.workflow, m.sample, m.fastq_2 FROM manifest m JOIN mruns r ON r.run = m.run
  WHERE m.fastq_2 IS NOT NULL),
listing AS (
  SELECT 's3://prod/runs/' || r.run || p.pattern AS path
  FROM mruns r JOIN rules p ON p.kind = 'run_files'
  UNION ALL
  SELECT 's3://prod/runs/' || m.run || replace(p.pattern, '<sample>', m.sample)
  FROM manifest m JOIN rules p ON p.kind = 'sample_files' WHERE m.c_custkey % 3 <> 0
  UNION ALL
  SELECT fastq_1 FROM manifest WHERE c_custkey % 3 <> 0
  UNION ALL
  SELECT fastq_2 FROM manifest WHERE c_custkey % 3 <> 0 AND fastq_2 IS NOT NULL),
kept AS (SELECT * FROM expanded WHERE file IN (SELECT path FROM listing))"""

ORACLE["retention_candidates"] = _w(RETENTION, "SELECT * FROM expanded")
ORACLE["retention_expand"] = _w(RETENTION, "SELECT * FROM kept")
ORACLE["retention_infer"] = _w(RETENTION + """,
files AS (
  SELECT DISTINCT regexp_extract(path, '^s3://prod/runs/([^/]+)', 1) AS run,
         substr(path, length('s3://prod/runs/' || regexp_extract(path, '^s3://prod/runs/([^/]+)', 1)) + 1) AS rel
  FROM listing WHERE starts_with(path, 's3://prod/runs/')),
hits AS (
  SELECT f.run, f.rel, m.sample, m.c_custkey FROM files f JOIN manifest m ON m.run = f.run AND contains(f.rel, m.sample)),
nfound AS (
  SELECT f.run, f.rel, count(DISTINCT h.sample) AS n_found
  FROM files f LEFT JOIN hits h ON h.run = f.run AND h.rel = f.rel GROUP BY f.run, f.rel),
nsamp AS (SELECT run, count(DISTINCT sample) AS n FROM manifest GROUP BY run)""", """
    SELECT DISTINCT * FROM (
      SELECT 'run_files' AS kind, n.rel AS pattern FROM nfound n LEFT JOIN nsamp s ON s.run = n.run
      WHERE n.n_found < coalesce(s.n, 0)
      UNION ALL
      SELECT 'sample_files', list_reduce(list(sample ORDER BY c_custkey), lambda acc, x: replace(acc, x, '<sample>'), rel)
      FROM hits GROUP BY run, rel)""")

# ------------------------------------------------------ run transfers
TRANSFER = RETENTION + """,
rfold AS (
  SELECT 's3://prod/runs/run_' || CAST(n_nationkey AS VARCHAR) AS path,
         (978307200 + CAST(n_nationkey AS BIGINT) * 2592000) * 1000 + CAST(n_nationkey AS BIGINT) * 250 AS modified_ms,
         n_regionkey <> 4 AS is_dir,
         CASE WHEN n_regionkey = 2 THEN 'mycosnp' ELSE 'phoenix' END AS workflow
  FROM nation),
rman AS (SELECT 's3://prod/runs/run_' || CAST(n_nationkey AS VARCHAR) || '/manifest.csv' AS path FROM nation
         WHERE n_regionkey <> 3),
win AS (
  SELECT path AS run_path, CAST(CAST(modified_ms AS DECIMAL(20,0)) / 1000 AS DECIMAL(18,3)) AS seconds,
         regexp_extract(path, '([^/]+)/*$', 1) AS run, workflow
  FROM rfold
  WHERE is_dir AND CAST(CAST(modified_ms AS DECIMAL(20,0)) / 1000 AS DECIMAL(18,3)) BETWEEN 983404800 AND 1022889600
    AND path IN (SELECT regexp_replace(path, '/manifest\\.csv$', '') FROM rman)),
wexp AS (
  SELECT m.run, w.workflow, m.sample, w.run_path || replace(p.pattern, '<sample>', m.sample) AS file, w.seconds
  FROM manifest m JOIN win w ON w.run = m.run JOIN rules p ON p.kind = 'sample_files' AND p.workflow = w.workflow
  UNION ALL
  SELECT w.run, w.workflow, CAST(NULL AS VARCHAR), w.run_path || p.pattern, w.seconds
  FROM win w JOIN rules p ON p.kind = 'run_files' AND p.workflow = w.workflow
  UNION ALL
  SELECT m.run, w.workflow, m.sample, m.fastq_1, w.seconds FROM manifest m JOIN win w ON w.run = m.run
  UNION ALL
  SELECT m.run, w.workflow, m.sample, m.fastq_2, w.seconds FROM manifest m JOIN win w ON w.run = m.run
  WHERE m.fastq_2 IS NOT NULL),
wkept AS (SELECT * FROM wexp WHERE file IN (SELECT path FROM listing)),
plan0 AS (
  SELECT run, workflow, sample, file AS origin, regexp_extract(file, '([^/]+)/*$', 1) AS file,
         regexp_replace(regexp_replace(CAST(seconds AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '') AS timestamp
  FROM wkept),
plan AS (
  SELECT DISTINCT *, concat_ws('/', 's3://results', 'data', 'id=' || coalesce(sample, 'null'), 'workflow=' || workflow,
                               'run=' || run, 'file=' || file, 'timestamp=' || timestamp, file) AS dest
  FROM plan0),
lake AS (
  SELECT c_name AS id, unnest([c_name || '.tax', c_name || '.scaffolds.fa.gz', c_name || '_R1.fastq.gz', c_name || '_R2.fastq.gz']) AS file, n.*
  FROM customer JOIN nation n ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'null', unnest(['Phoenix_Summary.tsv', 'versions.yml']), n.* FROM nation n),
lake_t AS (
  SELECT *, CAST(CAST((978307200 + CAST(n_nationkey AS BIGINT) * 2592000) * 1000 + CAST(n_nationkey AS BIGINT) * 250
                      - CASE WHEN n_nationkey % 3 = 1 THEN 86400000 ELSE 0 END AS DECIMAL(20,0)) / 1000 AS DECIMAL(18,3)) AS seconds
  FROM lake WHERE n_nationkey % 3 <> 2),
done AS (
  SELECT concat_ws('/', 's3://results', 'data', 'id=' || id, 'workflow=' || CASE WHEN n_regionkey = 2 THEN 'mycosnp' ELSE 'phoenix' END,
                   'run=run_' || CAST(n_nationkey AS VARCHAR), 'file=' || file,
                   'timestamp=' || regexp_replace(regexp_replace(CAST(seconds AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', ''), file) AS dest
  FROM lake_t),
pending AS (SELECT * FROM plan WHERE dest NOT IN (SELECT dest FROM done))"""

ORACLE["run_window"] = _w(TRANSFER, """
    SELECT run_path, run,
           regexp_replace(regexp_replace(CAST(seconds AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '') AS timestamp
    FROM win""")
ORACLE["transfer_plan"] = _w(TRANSFER, "SELECT * FROM plan")
ORACLE["transfer_pending"] = _w(TRANSFER, "SELECT * FROM pending")
ORACLE["transfer_batches"] = _w(TRANSFER, """
    SELECT dest, CAST((row_number() OVER (ORDER BY dest) - 1) // 20 AS BIGINT) AS batch FROM pending""")
ORACLE["run_summary"] = _w(TRANSFER, """
    SELECT run, timestamp, count(*) AS files FROM pending GROUP BY run, timestamp""")
ORACLE["transfer_catalog"] = _w(TRANSFER, """
    SELECT coalesce(sample, 'null') AS id, workflow, run, file,
           CAST(CAST(round(CAST(timestamp AS DECIMAL(18,3)), 0) AS BIGINT) AS VARCHAR) AS timestamp, origin, dest AS current FROM pending""")

# -------------------------------------------------- workspace tables
WIDE = """
wide AS (
  SELECT concat('S', CAST(p_partkey AS VARCHAR)) AS id,
         CASE WHEN p_size % 2 = 0 THEN concat('gs://bkt/', CAST(p_partkey AS VARCHAR), '.fa.gz') ELSE p_brand END AS c1,
         CASE WHEN p_size % 3 = 0 THEN concat('gs://bkt/', CAST(p_partkey AS VARCHAR), '_R1.fastq.gz') ELSE NULL END AS c2,
         p_type AS c3
  FROM part)"""

ORACLE["wide_uris"] = _w(WIDE, """
    SELECT * FROM (
      SELECT id AS sample, 'id' AS attribute, id AS uri FROM wide
      UNION ALL SELECT id, 'c1', c1 FROM wide
      UNION ALL SELECT id, 'c2', c2 FROM wide
      UNION ALL SELECT id, 'c3', c3 FROM wide) WHERE contains(uri, 'gs://')""")
ORACLE["wide_uris_text"] = _w(WIDE + """,
lines AS (SELECT concat_ws(chr(9), id, coalesce(c1, ''), coalesce(c2, ''), coalesce(c3, '')) AS value FROM wide),
cells AS (SELECT string_split(translate(value, chr(9) || ' ', ',_'), ',') AS c FROM lines)""", """
    SELECT id, uri FROM (SELECT c[1] AS id, unnest(c) AS uri FROM cells) WHERE contains(uri, 'gs://')""")
ORACLE["entity_pages"] = """
    SELECT s_name AS supplier_id, CAST(s_nationkey AS VARCHAR) AS nation, CAST(s_suppkey AS VARCHAR) AS suppkey,
           CASE WHEN s_suppkey % 7 = 0 THEN ''
                ELSE concat('gs://bkt/suppliers/', CAST(s_suppkey AS VARCHAR), '.tsv') END AS report
    FROM supplier"""

ORACLE["entity_file"] = f"""
    WITH entities AS ({ORACLE["entity_pages"]})
    SELECT 1 AS line, concat_ws(chr(9), 'supplier_id', 'nation', 'suppkey', 'report') AS text
    UNION ALL
    SELECT 1 + row_number() OVER (ORDER BY supplier_id), concat_ws(chr(9), supplier_id, nation, suppkey, report)
    FROM entities"""

# ----------------------------------------------------------- id text
ORACLE["normalize_ids"] = _w(META + """,
ids AS (
  SELECT DISTINCT id, workflow, run FROM meta
  UNION
  SELECT concat('X', CAST(year(l_shipdate) AS VARCHAR), 'JQ-', lpad(CAST(l_orderkey % 100000 AS VARCHAR), 5, '0'),
                '-WA', CAST(l_linenumber AS VARCHAR)), 'legacy', concat('run_', CAST(l_suppkey % 20 AS VARCHAR))
  FROM lineitem),
s1 AS (SELECT *, regexp_replace(id, '-WA.*', '') AS a FROM ids),
s2 AS (SELECT *, coalesce(nullif(regexp_extract(a, 'WA\\d{7}'), ''), a) AS b FROM s1)""", """
    SELECT id, coalesce(nullif(regexp_extract(b, '\\d{4}JQ-\\d{5}'), ''), b) AS id_norm,
           translate(concat(workflow, ', ', run), ', ', ';_') AS label
    FROM s2""")
ORACLE["extract_last_pattern"] = _w(META, """
    SELECT file, coalesce(nullif(regexp_extract(file, 'WA\\d{7}'), ''),
                          nullif(regexp_extract(file, '_R[12]_\\d{3}'), ''), 'None') AS match
    FROM (SELECT DISTINCT file FROM meta)""")
ORACLE["resolve_headers"] = """
    WITH e AS (
      SELECT event_id, event_type AS et, json_extract_string(props, '$.k') AS k,
             concat('WA', lpad(CAST(user_id AS VARCHAR), 7, '0'), CASE WHEN event_id % 2 = 0 THEN '-WA2' ELSE '' END) AS sid,
             CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 = 0 THEN 'FAIL'
                  WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 = 1 THEN 'PASS' ELSE '' END AS qc,
             CASE event_id % 4 WHEN 0 THEN 'Escherichia coli' WHEN 1 THEN 'Klebsiella pneumoniae' WHEN 2 THEN ''
                  ELSE 'Candida auris, clade I' END AS sp
      FROM events),
    n AS (SELECT *, regexp_replace(sid, '-WA.*', '') AS a FROM e),
    n2 AS (SELECT *, coalesce(nullif(regexp_extract(a, 'WA\\d{7}'), ''), a) AS b FROM n)
    SELECT event_id, coalesce(nullif(regexp_extract(b, '\\d{4}JQ-\\d{5}'), ''), b) AS id,
           translate(CASE WHEN et IN ('click', 'view', 'purchase') THEN nullif(qc, '') END, ', ', ';_') AS qc,
           translate(nullif(sp, ''), ', ', ';_') AS species,
           translate(CASE WHEN et IN ('click', 'view', 'purchase') THEN nullif(k, '') END, ', ', ';_') AS read_depth,
           """ + ",\n           ".join(f"CASE WHEN et IN ('click', 'view') THEN concat('{f};_', k) END AS {f}" for f in ("mlst_1", "mlst_2", "mlst_1_scheme", "mlst_2_scheme", "beta_amr", "other_amr", "plasmids", "vir_genes")) + """,
           """ + ",\n           ".join(f"CASE WHEN et IN ('click', 'view', 'purchase') THEN concat('{f};_', k) END AS {f}" for f in ("qc_reason", "assembly_len", "n_contigs", "per_gc", "species_conf")) + """
    FROM n2"""

# ------------------------------------------------------- samplesheet
SHEET = """
sheet AS (
  SELECT o_orderkey AS line, concat('cust ', CAST(o_custkey AS VARCHAR)) AS sample,
         concat('r', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 50 = 0 THEN '.bam' ELSE '_1.fastq.gz' END) AS fastq_1,
         CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 33 = 0 THEN concat('r', CAST(o_orderkey AS VARCHAR), '_2.fq.gz')
              ELSE concat('r', CAST(o_orderkey AS VARCHAR), '_2.fastq.gz') END AS fastq_2
  FROM orders),
chk AS (
  SELECT *, coalesce(fastq_1, '') AS f1, coalesce(fastq_2, '') AS f2 FROM sheet)"""


def _sfx(c: str) -> str:
    return f"regexp_extract(regexp_extract({c}, '([^/]*)$', 1), '(\\.[^.]*){{1,2}}$', 0)"


ORACLE["sheet_errors"] = _w(SHEET, f"""
    SELECT line, error FROM (
      SELECT line,
             CASE WHEN length(coalesce(sample, '')) <= 0 THEN 'Sample input is required.'
                  WHEN length(f1) <= 0 THEN 'At least the first FASTQ file is required.'
                  WHEN NOT (ends_with(f1, '.fq.gz') OR ends_with(f1, '.fastq.gz'))
                       THEN 'The FASTQ file has an unrecognized extension: ' || f1 || chr(10) || 'It should be one of: .fq.gz, .fastq.gz'
                  WHEN length(f2) > 0 AND NOT (ends_with(f2, '.fq.gz') OR ends_with(f2, '.fastq.gz'))
                       THEN 'The FASTQ file has an unrecognized extension: ' || f2 || chr(10) || 'It should be one of: .fq.gz, .fastq.gz'
                  WHEN length(f2) > 0 AND {_sfx('f1')} <> {_sfx('f2')}
                       THEN 'FASTQ pairs must have the same file extensions.'
             END AS error
      FROM chk) WHERE error IS NOT NULL""")
ORACLE["sheet_valid"] = _w(SHEET, """
    SELECT concat(replace(sample, ' ', '_'), '_T',
                  CAST(row_number() OVER (PARTITION BY replace(sample, ' ', '_') ORDER BY line) AS VARCHAR)) AS sample,
           NOT (length(f1) > 0 AND length(f2) > 0) AS single_end, line, fastq_1, fastq_2
    FROM chk
    WHERE length(coalesce(sample, '')) > 0 AND (f1 LIKE '%.fq.gz' OR f1 LIKE '%.fastq.gz')
      AND (length(f2) = 0 OR f2 LIKE '%.fq.gz' AND f1 LIKE '%.fq.gz' OR f2 LIKE '%.fastq.gz' AND f1 LIKE '%.fastq.gz')""")
ORACLE["sheet_file"] = f"""
    WITH valid AS ({ORACLE["sheet_valid"]})
    SELECT 1 AS line, 'sample,single_end,fastq_1,fastq_2' AS text
    UNION ALL
    SELECT 1 + row_number() OVER (ORDER BY line),
           concat_ws(',', sample, CASE WHEN single_end THEN 'true' ELSE 'false' END, fastq_1, fastq_2)
    FROM valid"""
ORACLE["sheet_duplicates"] = _w(SHEET, """
    SELECT replace(sample, ' ', '_') AS sample, fastq_1, count(*) AS n FROM sheet
    GROUP BY 1, 2 HAVING count(*) > 1""")

# ---------------------------------------------------------- streaming
ORACLE["stream_new_ids"] = _w(SUBS, """
    SELECT * FROM cands WHERE submission_id NOT IN (SELECT submission_id FROM ledger)""")
ORACLE["stream_windowed_dedupe"] = _w(SUBS, """
    SELECT DISTINCT submission_id, method, entity_raw, submission_date, status, workflow_statuses FROM subs""")

# ---------------------------------------------------- events and URIs
ORACLE["upload_trigger_runs"] = _w(META, """
    SELECT DISTINCT concat('s3://', regexp_extract(origin, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$', 2), '/',
                           regexp_replace(regexp_extract(origin, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$', 3),
                                          '/*[^/]+/*$', ''), '/') AS run,
           'phoenix' AS workflow
    FROM meta
    WHERE regexp_extract(origin, '([^/]*)$', 1) = 'Phoenix_Summary.tsv'""")
ORACLE["uri_parts"] = _w(META, """
    SELECT current,
           regexp_extract(current, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$', 1) AS scheme,
           regexp_extract(current, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$', 2) AS bucket,
           regexp_extract(current, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/?(.*)$', 3) AS key,
           regexp_extract(current, '([^/]+)/*$', 1) AS name,
           regexp_replace(current, '/*[^/]+/*$', '') AS parent
    FROM (SELECT DISTINCT current FROM meta)""")
ORACLE["run_job_names"] = _w(META, """
    SELECT workflow, run, concat_ws('_', workflow, replace(string_split(run, '/')[-2], '.', '-')) AS job_name
    FROM (SELECT DISTINCT workflow, concat('s3://prod/', run, '/') AS run FROM meta)""")

SKEWED_SHEET = """
ssheet AS (
  SELECT l_orderkey * 8 + l_linenumber AS line,
         CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE concat('S ', CAST(l_orderkey % 1000 AS VARCHAR)) END AS sample,
         concat('r', CAST(l_partkey % 500 AS VARCHAR), '_1.fastq.gz') AS fastq_1,
         CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE concat('r', CAST(l_partkey % 500 AS VARCHAR), '_2.fastq.gz') END AS fastq_2
  FROM lineitem)"""
ORACLE["sheet_valid_skewed"] = _w(SKEWED_SHEET, """
    SELECT concat(replace(sample, ' ', '_'), '_T',
                  CAST(row_number() OVER (PARTITION BY replace(sample, ' ', '_')
                                          ORDER BY line, fastq_1, fastq_2) AS VARCHAR)) AS sample,
           NOT (length(coalesce(fastq_1, '')) > 0 AND length(coalesce(fastq_2, '')) > 0) AS single_end,
           line, fastq_1, fastq_2
    FROM ssheet""")
ORACLE["sheet_duplicates_skewed"] = _w(SKEWED_SHEET, """
    SELECT replace(sample, ' ', '_') AS sample, fastq_1, count(*) AS n FROM ssheet
    GROUP BY 1, 2 HAVING count(*) > 1""")


# -------------------------------------------------- further operators
ORACLE["manifest_headers"] = _w(RETENTION, "SELECT run, sample, fastq_1, fastq_2 FROM manifest")
ORACLE["newest_cache"] = """
    SELECT workspace, path, modified_ms FROM (
      SELECT *, row_number() OVER (PARTITION BY workspace ORDER BY modified_ms DESC, path) AS rn FROM (
        SELECT concat('ws_', CAST(user_id % 20 AS VARCHAR)) AS workspace,
               concat('cache/ws_', CAST(user_id % 20 AS VARCHAR), '/', CAST(event_id AS VARCHAR), '.tsv') AS path,
               (event_id // 2) * 1000 AS modified_ms FROM events)) WHERE rn = 1"""
EXPORTED = """
exported AS (
  SELECT 'wf' AS workflow, concat('plate_', CAST(p_size % 4 AS VARCHAR)) AS run, concat('S', CAST(p_partkey AS VARCHAR)) AS sample,
         concat('gs://bkt/', CAST(p_partkey AS VARCHAR), '.fa.gz') AS file, p_partkey FROM part)"""
ORACLE["table_uris"] = _w(EXPORTED, "SELECT workflow, run, sample, file FROM exported")
ORACLE["workspace_plan"] = _w(EXPORTED + """,
kept AS (
  SELECT DISTINCT workflow, run, sample, file AS origin, CAST(p_partkey + 1700000001 AS VARCHAR) AS timestamp
  FROM exported WHERE p_partkey % 3 <> 0
  UNION ALL
  SELECT DISTINCT workflow, run, CAST(NULL AS VARCHAR), concat('/tables/', run, '.tsv'), '1700000000' FROM exported),
named AS (SELECT *, regexp_extract(origin, '([^/]+)$', 1) AS file FROM kept)""", """
    SELECT run, workflow, sample, origin, file, timestamp,
           concat('s3://results/data/id=', coalesce(sample, 'null'), '/workflow=', workflow, '/run=', run, '/file=', file,
                  '/timestamp=', timestamp, '/', file) AS dest
    FROM named""")
ORACLE["run_level_present"] = _w(META, """
    SELECT DISTINCT * FROM meta WHERE id = 'null' AND CAST(regexp_extract(run, '([0-9]+)$', 1) AS INTEGER) % 3 <> 0""")
ORACLE["tables_without_sets"] = _w(SUBS, "SELECT DISTINCT entity_raw FROM subs WHERE NOT contains(entity_raw, '_set')")
ORACLE["entity_subset"] = """
    SELECT s_name AS supplier_id, CAST(s_nationkey AS VARCHAR) AS nation,
           CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat('gs://bkt/suppliers/', CAST(s_suppkey AS VARCHAR), '.tsv') END AS report,
           CAST(ceil((SELECT count(*) FROM supplier) / 1000.0) AS BIGINT) AS pages
    FROM supplier"""
ORACLE["workspaces_checked"] = _w(SUBS + """,
wasked AS (
  SELECT DISTINCT trim(unnest(string_split(concat('ws_', CAST(n_nationkey AS VARCHAR), ', ws_', CAST(n_nationkey * 7 % 20 AS VARCHAR),
                                                  ',ws_', CAST(n_nationkey AS VARCHAR)), ','))) AS workspace
  FROM nation WHERE n_nationkey % 3 = 0),
wtypes AS (
  SELECT DISTINCT concat('ws_', CAST(user_id % 20 AS VARCHAR)) AS workspace, concat('entity_', CAST(user_id % 50 AS VARCHAR)) AS entity_type
  FROM events WHERE user_id % 50 < 45),
wcands AS (
  SELECT concat('ws_', CAST(user_id % 20 AS VARCHAR)) AS workspace, submission_id, method, regexp_replace(entity_raw, '_set$', '') AS entity_type, submission_date
  FROM subs WHERE status = 'Done' AND json_exists(workflow_statuses, '$.Succeeded')),
wknown AS (SELECT c.* FROM wcands c JOIN wasked USING (workspace) JOIN wtypes USING (workspace, entity_type)),
wbest AS (
  SELECT workspace, entity_type, method, submission_date FROM (
    SELECT *, row_number() OVER (PARTITION BY workspace, entity_type ORDER BY submission_date DESC, submission_id) AS rn FROM wknown) WHERE rn = 1),
wnew AS (
  SELECT c.* FROM wknown c
  WHERE EXISTS (SELECT 1 FROM wbest b WHERE b.workspace = c.workspace AND b.entity_type = c.entity_type AND b.method = c.method AND b.submission_date = c.submission_date)
    AND CAST(submission_id AS BIGINT) % 7 <> 0)""", """
    SELECT *, row_number() OVER (PARTITION BY workspace ORDER BY submission_date, submission_id) <= 19 AS start FROM wnew""")
ORACLE["capped_repeated"] = _w(SUBS + """,
repeated AS (
  SELECT * FROM cands
  UNION ALL SELECT * FROM cands WHERE CAST(submission_id AS BIGINT) % 3 = 0
  UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS submission_id) FROM cands WHERE CAST(submission_id AS BIGINT) % 11 = 0)""", """
    SELECT *, rank() OVER (ORDER BY submission_date, submission_id NULLS FIRST) <= 19 AS start FROM repeated""")
ORACLE["workspace_ledger"] = _w(SUBS + """,
landed AS (
  SELECT 'proj' AS project, CASE WHEN user_id % 2 = 0 THEN 'ws_a' ELSE 'ws_b' END AS workspace,
         concat('entity_', CAST(user_id % 50 AS VARCHAR)) AS entity, event_id
  FROM events WHERE user_id % 50 % 4 <> 3),
whole AS (SELECT project, workspace, entity FROM landed GROUP BY project, workspace, entity HAVING NOT bool_or(event_id % 401 = 0))""", """
    SELECT DISTINCT r.project, r.workspace, r.submissionId FROM retained r JOIN whole USING (project, workspace, entity)
    WHERE NOT EXISTS (SELECT 1 FROM wcache c WHERE c.project = r.project AND c.workspace = r.workspace AND c.submissionId = r.submissionId)""")
ORACLE["text_forms"] = """
    SELECT event_id, concat(event_type, ' ', CAST(event_id AS VARCHAR)) AS collapsed,
           concat(CASE WHEN event_id % 3 = 2 THEN 's3://b/' ELSE '/a/' END, CAST(event_id AS VARCHAR)) AS path_text,
           epoch_us(ts) AS micros, CAST(user_id AS VARCHAR) AS value_text
    FROM events"""
ORACLE["transfer_plan_shared_names"] = _w(RETENTION, """
    SELECT concat('s3://prod/runs/', m.run) AS run_path, m.run, 'phoenix' AS workflow, m.sample,
           regexp_extract(replace(r.pattern, '<sample>', m.sample), '([^/]+)$', 1) AS file
    FROM manifest m JOIN rules r ON r.kind = 'sample_files' AND r.workflow = 'phoenix'
    WHERE m.c_custkey % 3 <> 0
    UNION ALL
    SELECT DISTINCT concat('s3://prod/runs/', m.run), m.run, 'phoenix', CAST(NULL AS VARCHAR), regexp_extract(r.pattern, '([^/]+)$', 1)
    FROM manifest m JOIN rules r ON r.kind = 'run_files' AND r.workflow = 'phoenix'
    UNION ALL
    SELECT concat('s3://prod/runs/', run), run, 'phoenix', sample, regexp_extract(fastq_1, '([^/]+)$', 1) FROM manifest WHERE c_custkey % 3 <> 0
    UNION ALL
    SELECT concat('s3://prod/runs/', run), run, 'phoenix', sample, regexp_extract(fastq_2, '([^/]+)$', 1) FROM manifest
    WHERE c_custkey % 3 <> 0 AND fastq_2 IS NOT NULL
    UNION ALL
    SELECT concat('s3://prod/alt/run_', CAST(s_nationkey AS VARCHAR)), concat('run_', CAST(s_nationkey AS VARCHAR)), 'mycosnp', s_name,
           concat(s_name, '_R1.fastq.gz') FROM supplier WHERE s_suppkey % 2 = 0""")
ORACLE["results_to_analysis"] = f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id DESC) AS rn FROM ({ORACLE["resolve_headers"]})) WHERE rn = 1"""

ORACLE["attribute_texts"] = """
    SELECT 'P' || k AS part_id, k AS number, CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END AS flag,
           CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS brand,
           CASE WHEN p_partkey % 4 = 0 THEN '[''gs://bkt/' || k || '_R1.fq'', None]'
                ELSE '[''gs://bkt/' || k || '_R1.fq'', ''gs://bkt/' || k || '_R2.fq'']' END AS reads,
           '{''entityName'': "it''s ' || k || '", ''entityType'': ''sample'', ''known'': ' || CASE WHEN p_partkey % 5 = 0 THEN 'True' ELSE 'False' END || '}' AS ref,
           '[{''n'': ' || k || ', ''t'': ''say "a"''}]' AS list, '' AS absent
    FROM (SELECT *, CAST(p_partkey AS VARCHAR) AS k FROM part)"""
ORACLE["stream_versions"] = """
    SELECT DISTINCT concat('run_', CAST(user_id % 20 AS VARCHAR)) AS run, concat('S', CAST(user_id AS VARCHAR)) AS sample,
           concat(event_type, '.tsv') AS file, epoch_ms(date_trunc('day', ts)) AS modified_ms
    FROM events"""
