"""SQL counterparts of the registered queries, over the same tables.

Written from what the results must be, not from how the jobs compute them: expected values,
verdicts and keys are stated per shape of row.
"""

from __future__ import annotations

from feedmark import model as m


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


# --- indicator feed ------------------------------------------------------------------------

# ``shape`` is the kind of record; ``value`` is what normalisation must arrive at.
IOC = """
line AS (
  SELECT l_orderkey AS o, l_partkey AS k, l_suppkey AS s, l_linenumber AS ln,
         CAST(l_quantity AS INTEGER) % 10 AS shape,
         CAST(round(l_tax * 100) AS INTEGER) AS tax,
         CAST(round(l_discount * 100) AS INTEGER) AS disc,
         l_returnflag AS rf, l_linestatus AS ls, l_shipdate AS ship,
         CAST(year(l_shipdate) AS VARCHAR) AS run_id
  FROM lineitem
),
ioc AS (
  SELECT *,
    'threatfox' AS source,
    CASE WHEN shape IN (0, 9) THEN 'domain-name' WHEN shape = 1 THEN 'url'
         WHEN shape = 2 THEN 'file-md5' WHEN shape = 3 THEN 'file-sha1'
         WHEN shape = 4 THEN 'file-sha256' WHEN shape = 5 THEN 'ipv4-addr'
         WHEN shape IN (6, 7) THEN 'ipv6-addr' END AS type,
    CASE shape
      WHEN 0 THEN 'host' || o || '.example.com'
      WHEN 1 THEN 'https://cdn' || (o % 1000) || '.example.org/p/' || k
      WHEN 2 THEN CASE WHEN o % 97 = 0 THEN 'd41d8cd98f00b204e9800998ecf8427e' ELSE md5(o || '-' || ln) END
      WHEN 3 THEN sha1(o || '-' || ln)
      WHEN 4 THEN sha256(o || '-' || ln)
      WHEN 5 THEN '10.' || (o % 256) || '.' || (k % 256) || '.' || ln
      WHEN 6 THEN '2001:db8::' || lower(to_hex(k % 65535 + 1)) || ':' || ln
      WHEN 7 THEN '2001:db8::' || lower(to_hex(o % 65535 + 1))
      WHEN 9 THEN 'bot' || s || '.net' END AS value,
    CASE WHEN shape = 9 THEN CASE ln % 3 WHEN 0 THEN '[.]' WHEN 1 THEN '(.)' ELSE '.' END ELSE value END AS spelling,
    CASE WHEN disc = 10 THEN 40 ELSE disc * 11 END AS confidence,
    CASE WHEN tax IN (7, 8) THEN NULL
         WHEN k % 97 = 0 THEN 'win.漢字'
         WHEN k % 17 = 0 THEN 'win.zz' || k
         WHEN k % 10 = 0 AND ls = 'F' THEN 'elf.part_kit_' || k
         ELSE 'win.part_kit_' || k END AS family_id,
    CASE WHEN k % 97 = 0 THEN '漢字' WHEN ln = 1 THEN 'PART-KIT ' || k WHEN ln = 2 AND k % 19 = 0 THEN 'Pärt Kit ' || k
         ELSE 'Part Kit ' || k END AS family_label,
    CASE WHEN k % 97 = 0 THEN [] WHEN k % 11 = 0 THEN ['Alt ' || (k + 1), 'kit ' || k]
         WHEN k % 13 = 0 THEN ['Kit-Group ' || (k % 100)]
         WHEN ln = 3 THEN ['A' || k, 'B ' || k] ELSE [] END AS aliases,
    CASE WHEN rf = 'A' THEN 'botnet_cc' ELSE 'payload' END AS threat_type,
    CASE WHEN o % 25 = 0 THEN 'https://ref.example/' || o ELSE 'https://threatfox.abuse.ch/' END AS source_reference,
    CASE WHEN rf <> 'N' THEN 't' || s ELSE '' END AS tags,
    strftime(ship, '%Y-%m-%d') || ' 0' || ln || ':00:00' AS first_seen,
    CASE WHEN rf = 'R' THEN strftime(ship + INTERVAL 1 DAY, '%Y-%m-%d') || ' 12:00:00' END AS last_seen,
    (run_id = '2001' AND ln <= 5) OR o % 211 = 0 AS loose,
    CASE WHEN shape = 8 THEN 'unsupported_type'
         WHEN shape = 7 AND o % 5 = 0 THEN 'ipv6_malformed'
         WHEN ln = 7 AND tax = 0 AND disc <> 10 THEN 'confidence_out_of_range'
         WHEN o % 101 = 0 THEN 'first_seen_illegible'
         WHEN rf = 'R' AND run_id = '1997' THEN 'last_seen_illegible' END AS fault
  FROM line
),
ioc_raw AS (
  SELECT *, NOT loose AND o % 223 = 0 AS no_ioc, NOT loose AND o % 223 <> 0 AND o % 227 = 0 AS loose_tags,
    o % 229 = 0 OR o % 233 = 0 OR o % 239 = 0 AS odd_level,
    CASE WHEN loose THEN 'not_an_object'
         WHEN o % 223 = 0 THEN 'ioc_missing'
         WHEN fault IN ('unsupported_type', 'ipv6_malformed') THEN fault
         WHEN o % 229 = 0 OR o % 233 = 0 OR o % 239 = 0 THEN 'confidence_out_of_range'
         WHEN fault IS NOT NULL THEN fault
         WHEN o % 227 = 0 THEN 'tags_not_a_list' END AS raw_fault
  FROM ioc
),
ioc_ok AS (
  SELECT * REPLACE (CASE WHEN run_id = '1999' THEN [] ELSE aliases END AS aliases) FROM ioc_raw WHERE raw_fault IS NULL
)
"""

VULN = """
entry AS (
  SELECT o_orderkey AS o, 'cisa-kev' AS source, CAST(year(o_orderdate) AS VARCHAR) AS run_id,
    CAST(o_orderdate AS DATE) AS added,
    'CVE-' || year(o_orderdate) || '-' || o_orderkey AS value,
    CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS cust, o_custkey % 40 AS vendor_no, o_orderkey % 12 AS product_no,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'VENDOR-' ELSE 'Vendor ' END || (o_custkey % 40) AS vendor,
    'Suite ' || (o_orderkey % 12) AS product,
    CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' WHEN o_orderkey % 83 = 0 THEN NULL
         ELSE strftime(o_orderdate + INTERVAL 21 DAY, '%Y-%m-%d') END AS due_date,
    CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0
         THEN CAST(o_orderdate AS DATE) + 21 END AS due,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Known' ELSE 'Unknown' END AS ransomware,
    o_orderstatus AS status_code,
    CASE WHEN o_orderkey % 71 = 0 THEN 'cveID_missing'
         WHEN o_orderkey % 103 = 0 THEN 'dateAdded_illegible' END AS fault
  FROM orders
),
vuln AS (
  SELECT *, 'vulnerability' AS type, 90 AS confidence, sha256('vulnerability' || value) AS canonical_key
  FROM entry WHERE fault IS NULL
)
"""

# --- catalogue, families, rules ------------------------------------------------------------


def _software(version: int = 2, name: str = "software") -> str:
    deprecated = {2: 49, 1: 48}[version]
    return f"""
{name}_all AS (
  SELECT p_partkey AS p, 'malware--' || p_partkey AS id, p_size % 7 <> 0 AS aliased,
    CASE WHEN p_size = 50 THEN 'revoked' WHEN p_size = {deprecated} THEN 'x_mitre_deprecated' END AS marker
  FROM part
),
{name} AS (SELECT * FROM {name}_all WHERE marker IS NULL),
{name}_names AS (
  SELECT 'partkit' || p AS canon, id AS software_id, 'Part Kit ' || p AS name FROM {name}
  UNION ALL SELECT 'alt' || p, id, 'alt-' || p FROM {name} WHERE aliased
  UNION ALL SELECT 'kitgroup' || (p % 100), id, 'kit group ' || (p % 100) FROM {name} WHERE aliased
),
{name}_index AS (
  SELECT canon, count(DISTINCT software_id) AS n_software, min(software_id) AS software_id
  FROM {name}_names GROUP BY canon
)
"""


PATTERN = """
pattern AS (
  SELECT s_suppkey AS s, 'attack-pattern--' || s_suppkey AS id,
    CASE WHEN s_suppkey % 35 = 0 THEN '' ELSE s_name END AS technique_name,
    CASE WHEN s_suppkey % 15 = 5 THEN ''
         WHEN s_suppkey % 5 = 0 THEN 'T' || (s_suppkey % 9000 + 1000)
         ELSE 'T' || (s_suppkey % 9000 + 1000) || '.001' END AS technique_id
  FROM supplier
),
edge AS (
  SELECT 'malware--' || l_partkey AS software_id, 'attack-pattern--' || l_suppkey AS pattern_id,
    count(*) AS n_edges
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2
),
live_edge AS (
  SELECT e.software_id, e.pattern_id, t.technique_id, t.technique_name, e.n_edges
  FROM edge e JOIN software w ON w.id = e.software_id JOIN pattern t ON t.id = e.pattern_id
)
"""

FAMILY = r"""
name_list AS (
  SELECT DISTINCT family_id, unnest(list_concat([family_label], aliases)) AS name
  FROM ioc_ok WHERE family_id IS NOT NULL
),
candidate_all AS (
  SELECT DISTINCT family_id, 0 AS rank, substr(family_id, 5) AS name FROM name_list
  UNION ALL SELECT family_id, 1, name FROM name_list
),
candidate_canon AS (
  SELECT *, regexp_replace(lower(strip_accents(name)), '[^a-z0-9]', '', 'g') AS canon FROM candidate_all
),
candidate AS (
  SELECT family_id, canon, rank, name,
    CASE rank WHEN 0 THEN 'malpedia' ELSE 'threatfox' END AS authority
  FROM (SELECT *, row_number() OVER (PARTITION BY family_id, canon ORDER BY rank, name) AS pos
        FROM candidate_canon WHERE canon <> '')
  WHERE pos = 1
),
hit AS (
  SELECT c.*, i.n_software, i.software_id, f.n_families,
    row_number() OVER (PARTITION BY c.family_id ORDER BY c.rank, c.name) AS place
  FROM candidate c JOIN software_index i USING (canon)
  JOIN (SELECT canon, count(*) AS n_families FROM candidate GROUP BY canon) f USING (canon)
),
verdict AS (
  SELECT family_id,
    min(CASE WHEN n_software > 1 OR n_families > 1 THEN place END) AS stop_at,
    count(DISTINCT software_id) AS n_targets, min(software_id) AS target
  FROM hit GROUP BY family_id
),
resolved AS (
  SELECT f.family_id,
    CASE WHEN v.family_id IS NULL THEN 'familia_sin_entrada'
         WHEN v.stop_at IS NOT NULL THEN
           CASE WHEN h.n_software > 1 THEN 'ambiguedad_catalogo' ELSE 'ambiguedad_origen' END
         WHEN v.n_targets > 1 THEN 'ambiguedad_candidatos' END AS reason,
    v.target, a.name AS first_name, a.authority AS first_authority
  FROM (SELECT DISTINCT family_id FROM name_list) f
  LEFT JOIN verdict v USING (family_id)
  LEFT JOIN hit h ON h.family_id = v.family_id AND h.place = v.stop_at
  LEFT JOIN hit a ON a.family_id = v.family_id AND a.place = 1
),
resolution AS (
  SELECT family_id, reason,
    CASE WHEN reason IS NULL THEN target END AS software_id,
    CASE WHEN reason IS NULL THEN first_name END AS matched_name,
    CASE WHEN reason IS NULL THEN first_authority END AS authority
  FROM resolved
),
technique AS (
  SELECT r.family_id, e.technique_id, e.technique_name, 'derived' AS mapping_method,
    CASE r.authority WHEN 'malpedia' THEN 'high' ELSE 'medium' END AS mapping_confidence,
    r.matched_name, r.authority, CAST(sum(e.n_edges) AS BIGINT) AS n_edges
  FROM resolution r JOIN live_edge e USING (software_id)
  WHERE regexp_matches(e.technique_id, '^T[0-9]{4}$') AND e.technique_name <> ''
  GROUP BY ALL
),
mapping AS (
  SELECT r.family_id,
    CASE WHEN r.reason IS NULL AND t.family_id IS NULL THEN 'familia_sin_tecnicas' ELSE r.reason END AS reason,
    r.software_id, CAST(coalesce(t.n, 0) AS BIGINT) AS n_techniques, coalesce(t.ids, '') AS technique_ids,
    t.conf AS mapping_confidence, coalesce(t.techniques, '') AS techniques, t.rationale
  FROM resolution r LEFT JOIN (
    SELECT family_id, sum(n_edges) AS n, string_agg(DISTINCT technique_id, ',' ORDER BY technique_id) AS ids,
      min(mapping_confidence) AS conf,
      string_agg(DISTINCT technique_id || '=' || technique_name, ',' ORDER BY technique_id || '=' || technique_name) AS techniques,
      min(authority || ': ' || matched_name) AS rationale
    FROM technique GROUP BY family_id) t USING (family_id)
)
"""

RULES = """
rule_all AS (
  SELECT p_partkey AS position, p_partkey % 25 AS vendor_no, p_size % 8 AS product_no,
    'curated from ' || p_type AS rationale, coalesce(p_type = 'PROMO', false) AND p_brand <> 'Brand#24' AS unspecific,
    CASE WHEN p_brand = 'Brand#25' THEN 'T1059' WHEN p_brand = 'Brand#24' THEN NULL
         WHEN p_type = 'ECONOMY' THEN 'T1190' WHEN p_type = 'LARGE' THEN 'T1203'
         WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN 'T1210' ELSE 'T1068' END AS technique
  FROM part
),
rule_checked AS (
  SELECT *, CASE WHEN technique = 'T1059' THEN 'technique_not_allowed'
                 WHEN technique IS NULL AND NOT unspecific THEN 'no_vector' END AS fault
  FROM rule_all
),
rule AS (
  SELECT vendor_no, product_no, technique, unspecific, rationale
  FROM (SELECT *, row_number() OVER (PARTITION BY vendor_no, product_no ORDER BY position DESC) AS pos
        FROM rule_checked WHERE fault IS NULL)
  WHERE pos = 1
),
technique_names(technique, technique_name) AS (
  VALUES ('T1190', 'Exploit Public-Facing Application'), ('T1203', 'Exploitation for Client Execution'),
         ('T1068', 'Exploitation for Privilege Escalation'), ('T1210', 'Exploitation of Remote Services')
)
"""

# Needs VULN and RULES.
VULN_ENRICHED = """
vuln_enriched AS (
  SELECT v.*,
    CASE WHEN r.vendor_no IS NULL THEN 'producto_sin_clasificar'
         WHEN r.unspecific THEN 'producto_inespecifico' END AS reason,
    CASE WHEN NOT r.unspecific THEN r.technique END AS technique_id, r.rationale
  FROM vuln v LEFT JOIN rule r ON r.vendor_no = v.vendor_no AND r.product_no = v.product_no
)
"""

ENRICHED = """
enriched AS (
  SELECT sha256(i.type || i.value || 'threatfox') AS id, i.source, i.type, i.value, i.confidence, i.family_label,
    CASE WHEN i.family_id IS NULL THEN 'sin_atribucion' ELSE f.reason END AS reason,
    coalesce(f.technique_ids, '') AS technique_ids, coalesce(f.n_techniques, 0) AS n_techniques,
    CASE WHEN f.n_techniques > 0 THEN 'derived' END AS mapping_method, f.mapping_confidence,
    md5(i.family_label || i.threat_type) AS raw, coalesce(f.techniques, '') AS techniques, f.rationale
  FROM ioc_ok i LEFT JOIN mapping f USING (family_id)
  UNION ALL
  SELECT sha256('vulnerability' || value || 'cisa-kev'), source, type, value, confidence, NULL, reason,
    coalesce(technique_id, ''), CASE WHEN technique_id IS NULL THEN 0 ELSE 1 END,
    CASE WHEN technique_id IS NOT NULL THEN 'inferred' END, CASE WHEN technique_id IS NOT NULL THEN 'low' END,
    md5(value || vendor || 'Flaw ' || cust), coalesce(technique_id || '=' || n.technique_name, ''),
    CASE WHEN technique_id IS NOT NULL THEN rationale END
  FROM vuln_enriched LEFT JOIN technique_names n ON n.technique = technique_id
)
"""

ALL_FAMILY = (IOC, _software(), PATTERN, FAMILY)
ALL_ENRICHED = (*ALL_FAMILY, VULN, RULES, VULN_ENRICHED, ENRICHED)

# --- snapshots and state -------------------------------------------------------------------

EVENTS = """
ev_base AS (
  SELECT event_type || '-' || (user_id % 3) AS source,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id, ts
  FROM events
),
ev AS (
  SELECT source, 'u' || user_id || '-k' || (k % 10) || '.example.com' AS value,
    sha256('domain-name' || value) AS canonical_key,
    CASE WHEN k >= 10 THEN 'fam' || (k // 10) END AS family, k AS confidence, ts AS last_seen,
    date_trunc('day', ts) AS ingested_at,
    CASE WHEN ts >= TIMESTAMP '2024-01-21' AND source NOT LIKE 'view-%' AND source <> 'click-1' THEN 2 WHEN ts >= TIMESTAMP '2024-01-11' THEN 1 ELSE 0 END AS snapshot
  FROM ev_base
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY source, canonical_key, snapshot
    ORDER BY last_seen DESC, confidence DESC, family NULLS LAST) AS pos
  FROM ev
),
snap AS (SELECT * FROM best WHERE pos = 1),
obs AS (
  SELECT * FROM snap WHERE snapshot = 2
),
obs_rows AS (
  SELECT source, count(*) AS n FROM ev
  WHERE snapshot = 2 GROUP BY source
),
prior AS (
  SELECT source, canonical_key, value, family, last_seen, ingested_at, 'presente' AS status,
    CAST(NULL AS TIMESTAMP) AS fallen_since
  FROM snap WHERE snapshot = 1
  UNION ALL
  SELECT source, canonical_key, value, family, last_seen, ingested_at, 'caido', last_seen - INTERVAL 5 DAY
  FROM snap s WHERE snapshot = 0
    AND NOT EXISTS (SELECT 1 FROM snap p WHERE p.snapshot = 1 AND p.source = s.source AND p.canonical_key = s.canonical_key)
),
run AS (
  SELECT DISTINCT source,
    CASE WHEN source = 'error-2' THEN 'fallida' WHEN source LIKE 'error-%' THEN 'parcial' ELSE 'correcta' END AS status,
    source LIKE 'view-%' AS unchanged,
    CASE WHEN source = 'purchase-1' THEN 0 WHEN source <> 'purchase-2' THEN 864000 END AS window_seconds,
    CASE WHEN source LIKE 'signup-%' THEN NULL
         WHEN source IN ('purchase-0', 'purchase-2', 'error-0') THEN TIMESTAMP '2024-01-20'
         WHEN source = 'click-2' THEN TIMESTAMP '2024-01-30'
         ELSE TIMESTAMP '2024-01-21' END AS watermark
  FROM ev
),
timed AS (
  SELECT r.*, coalesce(o.n, 0) AS n_observed,
    CAST(epoch(TIMESTAMP '2024-01-31') - epoch(watermark) AS BIGINT) AS interval_seconds
  FROM run r LEFT JOIN obs_rows o USING (source)
),
gate AS (
  SELECT *, CASE
      WHEN status <> 'correcta' THEN 'source_not_correct'
      WHEN watermark IS NULL THEN 'first_observation'
      WHEN unchanged THEN 'unchanged'
      WHEN n_observed = 0 THEN 'correct_but_empty'
      WHEN interval_seconds > window_seconds THEN 'interval_beyond_window'
      ELSE 'compared' END AS rule
  FROM timed
),
pub AS (
  SELECT *, rule IN ('interval_beyond_window', 'compared') AS sets_computed,
    rule IN ('unchanged', 'compared') AS fallen_published,
    rule = 'first_observation' AS in_baseline,
    rule = 'interval_beyond_window' AS new_reading_degraded,
    rule = 'source_not_correct' AND window_seconds > 0 AND coalesce(interval_seconds > window_seconds, false) AS additions_lost_risk
  FROM gate
),
member AS (
  SELECT o.source, o.canonical_key, o.value, o.family, o.last_seen,
    CASE WHEN p.source IS NULL THEN 'new' WHEN p.status = 'caido' THEN 'reappeared' ELSE 'kept' END AS member
  FROM obs o JOIN pub g ON g.source = o.source AND g.sets_computed
  LEFT JOIN prior p ON p.source = o.source AND p.canonical_key = o.canonical_key
  UNION ALL
  SELECT p.source, p.canonical_key, p.value, p.family, p.last_seen, 'fallen'
  FROM prior p JOIN pub g ON g.source = p.source AND g.rule = 'compared'
  WHERE p.status = 'presente'
    AND NOT EXISTS (SELECT 1 FROM obs o WHERE o.source = p.source AND o.canonical_key = p.canonical_key)
),
diff_source AS (
  SELECT g.*,
    coalesce(m.n_new, 0) AS n_new, coalesce(m.n_reappeared, 0) AS n_reappeared,
    CASE WHEN g.fallen_published THEN coalesce(m.n_fallen, 0) END AS n_fallen
  FROM pub g LEFT JOIN (
    SELECT source, count(*) FILTER (member = 'new') AS n_new, count(*) FILTER (member = 'reappeared') AS n_reappeared,
      count(*) FILTER (member = 'fallen') AS n_fallen
    FROM member GROUP BY source) m USING (source)
)
"""


def _state(mode: str) -> str:
    """Next state; also what became of prior rows that were not observed."""
    marks = "g.fallen_published" if mode == m.MODE_DIFFERENTIAL else "false"
    return f"""
unseen AS (
  SELECT p.*, g.status = 'correcta' AND g.n_observed > 0 AS writes, {marks} AS marks
  FROM prior p JOIN pub g USING (source)
  WHERE NOT (g.status = 'correcta' AND EXISTS (
    SELECT 1 FROM obs o WHERE o.source = p.source AND o.canonical_key = p.canonical_key))
),
kept AS (
  SELECT source, canonical_key, value, family, last_seen, ingested_at,
    CASE WHEN writes AND marks AND status = 'presente' THEN 'caido' ELSE status END AS status,
    CASE WHEN writes AND marks AND status = 'presente' THEN TIMESTAMP '2024-01-31' ELSE fallen_since END AS fallen_since
  FROM unseen
  WHERE NOT (writes AND status = 'caido' AND TIMESTAMP '2024-01-31' - fallen_since > INTERVAL 30 DAY)
),
state AS (
  SELECT * FROM kept
  UNION ALL
  SELECT o.source, o.canonical_key, o.value, o.family, o.last_seen, o.ingested_at, 'presente', NULL
  FROM obs o JOIN pub g ON g.source = o.source AND g.status = 'correcta'
)
"""


VARIATION = """
open_source AS (SELECT source, rule FROM pub WHERE NOT in_baseline AND fallen_published),
today_rows AS (
  SELECT o.canonical_key, o.source, o.family FROM obs o JOIN open_source USING (source)
  UNION ALL
  SELECT p.canonical_key, p.source, p.family FROM prior p JOIN open_source s ON s.source = p.source AND s.rule = 'unchanged'
  WHERE p.status = 'presente'
),
today_family AS (
  SELECT canonical_key, family FROM (
    SELECT *, row_number() OVER (PARTITION BY canonical_key ORDER BY source DESC) AS pos FROM today_rows)
  WHERE pos = 1
),
before_family AS (
  SELECT canonical_key, arg_max(family, source) FILTER (family IS NOT NULL) AS family
  FROM prior GROUP BY canonical_key
  HAVING bool_or(status = 'presente' AND source IN (SELECT source FROM open_source))
),
variation AS (
  SELECT family, CAST(sum(step) AS BIGINT) AS delta FROM (
    SELECT family, 1 AS step FROM today_family UNION ALL SELECT family, -1 FROM before_family)
  WHERE family IS NOT NULL GROUP BY family HAVING sum(step) <> 0
)
"""

# --- quality -------------------------------------------------------------------------------

_VERDICTS = """
verdicts AS (
  SELECT source, run_id, raw_fault AS reason,
    CASE WHEN raw_fault IS NULL THEN 'valid' WHEN raw_fault = 'unsupported_type' THEN 'unsupported' ELSE 'invalid' END AS verdict
  FROM ioc_raw
  UNION ALL
  SELECT source, run_id, fault, CASE WHEN fault IS NULL THEN 'valid' ELSE 'invalid' END FROM entry
)
"""

# Share of objects that give each field; the thresholds are the feeds' own.
_IOC_FIELDS = {
    "ioc": "NOT no_ioc",
    "ioc_type": "true",
    "confidence_level": "disc <> 10 OR odd_level",
    "first_seen": "true",
    "malware": "tax <> 7",
    "threat_type": "true",
    "last_seen": "rf = 'R'",
    "reference": "o % 25 = 0",
    "tags": "rf <> 'N' OR loose_tags",
    "malware_alias": "len(aliases) > 0 AND (run_id <> '1999' OR no_ioc OR loose_tags)",
}
_VULN_FIELDS = {
    "cveID": "o % 71 <> 0",
    "vendorProject": "true",
    "product": "true",
    "vulnerabilityName": "status_code <> 'P'",
    "dateAdded": "true",
    "dueDate": "due_date IS NOT NULL",
    "knownRansomwareCampaignUse": "true",
}


def _coverage_part(table: str, fields: dict[str, str], low: tuple[str, ...], is_object: str) -> list[str]:
    return [
        f"""SELECT source, run_id, '{name}' AS field, count(*) AS n_records,
          count(*) FILTER ({is_object}) AS n_objects,
          count(*) FILTER ({is_object} AND ({given})) AS n_present,
          {0.1 if name in low else 0.8}::DOUBLE AS threshold
        FROM {table} GROUP BY source, run_id"""
        for name, given in fields.items()
    ]


_COVERAGE = (
    "coverage_counts AS (\n"
    + "\nUNION ALL\n".join(
        _coverage_part(
            "ioc_raw", _IOC_FIELDS, ("last_seen", "reference", "tags", "malware_alias"), "NOT loose"
        )
        + _coverage_part("entry", _VULN_FIELDS, (), "true")
    )
    + """
),
coverage AS (
  SELECT source, run_id, field, n_objects, n_present,
    n_objects > 0 AND n_objects >= 0.5 * n_records AS evaluated,
    CASE WHEN n_objects > 0 AND n_objects >= 0.5 * n_records THEN round(n_present / n_objects, 4) END AS coverage,
    threshold,
    coalesce(CASE WHEN n_objects > 0 AND n_objects >= 0.5 * n_records THEN n_present / n_objects END < threshold, false) AS short
  FROM coverage_counts
)
"""
)

_STATUS = """
counts AS (
  SELECT source, run_id, count(*) AS total, count(*) FILTER (verdict = 'valid') AS records,
    count(*) FILTER (verdict = 'invalid') AS invalid, count(*) FILTER (verdict = 'unsupported') AS unsupported
  FROM verdicts GROUP BY source, run_id
),
shorts AS (
  SELECT source, run_id, count(*) FILTER (short) AS n_short, bool_or(evaluated) AS evaluated,
    string_agg(field, ',' ORDER BY field) FILTER (short) AS names,
    string_agg(printf('%s=%.4f', field, coverage), ',' ORDER BY field || '=') FILTER (short) AS details
  FROM coverage GROUP BY source, run_id
),
statuses AS (
  SELECT c.*, s.n_short, s.evaluated, s.names, s.details,
    CASE WHEN records > 0 AND invalid > 0 THEN 'parcial' WHEN records = 0 AND invalid > 0 THEN 'fallida'
         WHEN s.n_short > 0 THEN 'parcial' ELSE 'correcta' END AS status
  FROM counts c JOIN shorts s USING (source, run_id)
)
"""

QUALITY = (IOC, VULN, _VERDICTS, _COVERAGE, _STATUS)

_DOCUMENT = """
doc AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_id, o_orderkey AS o,
    CASE WHEN o_orderkey % 41 = 0 THEN 'not_json' WHEN o_orderkey % 31 = 0 THEN 'list_missing'
         WHEN o_orderkey % 37 = 0 THEN 'list_not_a_list' ELSE 'sound' END AS what,
    CASE WHEN o_orderkey % 41 = 0 OR o_orderkey % 31 = 0 OR o_orderkey % 37 = 0 OR o_orderkey % 43 = 0 THEN 0 ELSE 2 END AS n
  FROM orders
),
answer AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, user_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE k WHEN 1 THEN 'rate_limited' WHEN 2 THEN 'not_ok' WHEN 3 THEN 'list_missing'
           WHEN 4 THEN 'list_not_a_list' WHEN 5 THEN 'not_json' ELSE 'sound' END AS what,
    CASE WHEN k <= 6 THEN 0 ELSE 2 END AS n
  FROM events
)
"""

# --- due dates -----------------------------------------------------------------------------

_DUE = """
due AS (
  SELECT *, DATE '1998-06-15' AS today,
    CASE WHEN due IS NULL THEN 2 WHEN due >= DATE '1998-06-15' THEN 0 ELSE 1 END AS decision_band,
    CASE WHEN due IS NULL THEN 0 ELSE abs(due - DATE '1998-06-15') END AS decision_days,
    ransomware <> 'Known' AS no_ransomware,
    coalesce(due BETWEEN DATE '1998-06-15' AND DATE '1998-06-22', false) AS soon,
    added BETWEEN DATE '1998-06-02' AND DATE '1998-06-15' AS is_new
  FROM vuln
)
"""
_DECISION = "decision_band, decision_days, no_ransomware, value"

PROFILE = """
profile_{v} AS (
  SELECT 'objects' AS magnitude, (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM lineitem) AS observed
  UNION ALL SELECT 'software', (SELECT count(*) FROM part)
  UNION ALL SELECT 'software_live', (SELECT count(*) FROM {s})
  UNION ALL SELECT 'live_with_aliases', (SELECT count(*) FROM {s} WHERE aliased)
  UNION ALL SELECT 'software_retired', (SELECT count(*) FROM {s}_all WHERE marker IS NOT NULL)
  UNION ALL SELECT 'canons', (SELECT count(*) FROM {s}_index)
  UNION ALL SELECT 'canons_ambiguous', (SELECT count(*) FROM {s}_index WHERE n_software > 1)
  UNION ALL SELECT 'uses_live', (SELECT count(*) FROM lineitem l JOIN {s} w ON w.p = l.l_partkey
    JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'A')
)
"""


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


def sql() -> dict[str, str]:
    out: dict[str, str] = {}

    # scans, sources, sinks
    out["scan_snapshot_feed"] = _with(_DOCUMENT) + """
SELECT run_id, what, count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_records FROM doc GROUP BY 1, 2
UNION ALL
SELECT run_id, 'records', CAST(sum(n) AS BIGINT), CAST(sum(CASE WHEN o % 71 = 0 THEN 0 ELSE n END) AS BIGINT)
FROM doc GROUP BY 1 HAVING sum(n) > 0"""
    out["scan_large_documents"] = """
WITH doc AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_id,
    CASE year(o_orderdate) WHEN 1992 THEN 'not_json' WHEN 1993 THEN 'list_missing' ELSE 'sound' END AS what,
    CASE WHEN o_orderkey % 71 <> 0 THEN 'CVE-' || year(o_orderdate) || '-' || o_orderkey END AS id,
    o_orderkey % 83 <> 0 OR o_orderkey % 89 = 0 AS due
  FROM orders
)
SELECT run_id, what, what = 'sound' AS run_ok, CASE what WHEN 'sound' THEN count(*) ELSE 0 END AS n_records,
  CASE what WHEN 'sound' THEN count(*) ELSE 0 END AS read, CASE what WHEN 'sound' THEN count(DISTINCT id) ELSE 0 END AS n_ids,
  CASE what WHEN 'sound' THEN min(id) END AS first_id, CASE what WHEN 'sound' THEN max(id) END AS last_id,
  CASE what WHEN 'sound' THEN count(*) FILTER (due) ELSE 0 END AS n_due
FROM doc GROUP BY run_id, what"""
    out["scan_window_feed"] = _with(_DOCUMENT) + """
SELECT run_id, what, count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_records FROM answer GROUP BY 1, 2
UNION ALL
SELECT run_id, 'records', CAST(sum(n) AS BIGINT), count(DISTINCT user_id) FROM answer WHERE n > 0 GROUP BY 1"""
    out["scan_stix_catalog"] = _with(_software(), PATTERN) + """
SELECT 'objects' AS part, (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM lineitem) AS n
UNION ALL SELECT 'software', count(*) FROM software
UNION ALL SELECT 'retired', count(*) FROM software_all WHERE marker IS NOT NULL
UNION ALL SELECT 'patterns', count(*) FROM pattern
UNION ALL SELECT 'patterns_with_id', count(*) FROM pattern WHERE technique_id <> ''
UNION ALL SELECT 'uses', count(*) FROM lineitem WHERE l_returnflag = 'A'"""
    out["validate_rule_dimension"] = _with(RULES) + """
SELECT 'vendor' || vendor_no AS vendor_canon, 'suite' || product_no AS product_canon, technique, unspecific, rationale
FROM rule"""
    out["rule_faults"] = _with(RULES) + """
SELECT fault, count(*) AS n_rules FROM rule_checked WHERE fault IS NOT NULL GROUP BY fault"""
    watermark = """CASE WHEN status = 'correcta' AND (n_observed > 0 OR unchanged) THEN TIMESTAMP '2024-01-31' ELSE watermark END"""
    out["state_read_write"] = _with(EVENTS, _state(m.MODE_DIFFERENTIAL)) + f"""
SELECT s.source, s.status, s.n, strftime({watermark.replace('status', 'g.status')}, '%Y-%m-%d %H:%M:%S') AS watermark
FROM (SELECT source, status, count(*) AS n FROM state GROUP BY 1, 2) s JOIN pub g USING (source)"""
    told = "source, status, count(*) AS n, count(fallen_since) AS n_since, strftime(max(last_seen), '%Y-%m-%d %H:%M:%S') AS last_seen"
    out["state_change_log"] = _with(EVENTS, _state(m.MODE_DIFFERENTIAL), f"""
pruned AS (
  SELECT p.* FROM prior p WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.source = p.source AND s.canonical_key = p.canonical_key)
),
changed AS (
  SELECT s.* FROM state s LEFT JOIN prior p ON p.source = s.source AND p.canonical_key = s.canonical_key
  WHERE p.source IS NULL OR (p.value, p.family, p.last_seen, p.ingested_at, p.status, p.fallen_since)
    IS DISTINCT FROM (s.value, s.family, s.last_seen, s.ingested_at, s.status, s.fallen_since)
  UNION ALL SELECT * FROM pruned
)
""") + f"""
SELECT 'before' AS version, {told} FROM prior GROUP BY source, status
UNION ALL SELECT 'merged', {told} FROM state GROUP BY source, status
UNION ALL SELECT 'compacted', {told} FROM state GROUP BY source, status
UNION ALL SELECT 'written', {told} FROM changed GROUP BY source, status"""
    out["write_full_dump"] = _with(*ALL_ENRICHED) + """
SELECT source, type, count(*) AS n, count(DISTINCT id) AS n_ids, CAST(sum(n_techniques) AS BIGINT) AS n_techniques,
  count(DISTINCT raw) AS n_raw, min(raw) AS first_raw, max(raw) AS last_raw
FROM enriched GROUP BY 1, 2"""
    out["append_source_runs"] = _with(*QUALITY) + """
SELECT source, run_id, status, records, invalid, unsupported,
  unsupported / total > 0.05 AS unsupported_excess,
  CASE source WHEN 'threatfox' THEN 'P5D/now' END AS declared_window,
  run_id || '-12-31 06:00:00' AS attempt_time, CAST(NULL AS VARCHAR) AS failure_reason,
  CAST(200 AS BIGINT) AS http_code, CAST(0 AS BIGINT) AS retries,
  coalesce(names, '') AS short_fields, NOT evaluated AS coverage_not_evaluated
FROM statuses"""
    out["publish_report_marts"] = _with(IOC, VULN) + """
SELECT '2024-01-31' AS report_date, type, count(*) AS n_observations
FROM (SELECT type FROM ioc_ok UNION ALL SELECT type FROM vuln) GROUP BY type"""

    # bulk normalisation
    valid_only = ", ".join(
        f"CASE WHEN fault IS NULL THEN {expr} END AS {name}"
        for name, expr in {
            "type": "'vulnerability'",
            "value": "value",
            "id": "sha256('vulnerability' || value || 'cisa-kev')",
            "canonical_key": "sha256('vulnerability' || value)",
            "source_reference": f"'{m.VULN_REFERENCE}'",
            "first_seen": "strftime(added, '%Y-%m-%d') || ' 00:00:00'",
            "confidence": "CAST(90 AS BIGINT)",
            "tags": "CASE ransomware WHEN 'Known' THEN 'ransomware' ELSE '' END",
            "vendor": "vendor",
            "product": "product",
            "due_date": "due_date",
            "ransomware": "ransomware",
        }.items()
    )
    out["normalize_vuln_feed"] = _with(VULN) + f"""
SELECT run_id, CASE WHEN fault IS NULL THEN 'valid' ELSE 'invalid' END AS verdict, fault AS reason,
  CAST(NULL AS VARCHAR) AS last_seen, {valid_only} FROM entry"""
    valid_ioc = ", ".join(
        f"CASE WHEN raw_fault IS NULL THEN {expr} END AS {name}"
        for name, expr in {
            "type": "type",
            "value": "value",
            "id": "sha256(type || value || 'threatfox')",
            "canonical_key": "sha256(type || value)",
            "source_reference": "source_reference",
            "first_seen": "first_seen",
            "last_seen": "last_seen",
            "confidence": "CAST(confidence AS BIGINT)",
            "tags": "tags",
            "family_label": "family_label",
            "family_id": "family_id",
            "threat_type": "threat_type",
        }.items()
    )
    out["normalize_ioc_feed"] = _with(IOC) + f"""
SELECT run_id, CASE WHEN raw_fault IS NULL THEN 'valid' WHEN raw_fault = 'unsupported_type' THEN 'unsupported' ELSE 'invalid' END AS verdict,
  raw_fault AS reason, {valid_ioc} FROM ioc_raw"""
    out["key_observations"] = _with(IOC) + """
SELECT sha256(type || value) AS canonical_key, type, value, count(*) AS n_rows, count(DISTINCT spelling) AS n_spellings
FROM ioc_ok GROUP BY type, value"""
    band = "CASE WHEN confidence >= 85 THEN 'alta' WHEN confidence >= 60 THEN 'media' WHEN confidence >= 30 THEN 'baja' ELSE 'no_valorada' END"
    out["reportable_filter"] = _with(IOC) + f"""
SELECT sha256(type || value || 'threatfox') AS id, type, CAST(confidence AS BIGINT) AS confidence, {band} AS band
FROM ioc_ok WHERE confidence >= 30"""
    out["trivial_value_filter"] = _with(IOC) + f"""
SELECT source, type, count(*) FILTER (value <> '{m.TRIVIAL_DIGESTS[0]}') AS n_kept,
  count(*) FILTER (value = '{m.TRIVIAL_DIGESTS[0]}') AS n_removed
FROM ioc_ok WHERE confidence >= 30 GROUP BY source, type"""

    # feed quality
    out["split_records"] = _with(*QUALITY) + """
SELECT source, run_id, verdict, reason, count(*) AS n_records FROM verdicts GROUP BY ALL"""
    out["batch_status"] = _with(*QUALITY) + """
SELECT source, run_id, total, records, invalid, unsupported, n_short, status FROM statuses"""
    out["field_coverage"] = _with(*QUALITY) + "SELECT * FROM coverage"
    out["unsupported_ratio"] = _with(*QUALITY) + """
SELECT source, run_id, total, unsupported, unsupported > 0 AND unsupported / total > 0.05 AS excess FROM counts"""
    out["missing_fields"] = _with(IOC, VULN) + """
SELECT DISTINCT source, run_id, unnest(['id']) AS field FROM ioc_raw
UNION ALL
SELECT source, run_id, 'malware_alias' FROM ioc_raw WHERE run_id = '1999' GROUP BY 1, 2
  HAVING NOT bool_or(no_ioc OR loose_tags)
UNION ALL
SELECT DISTINCT source, run_id, 'cwes' FROM entry"""
    out["broken_time_formats"] = _with(IOC, VULN) + """
SELECT source, run_id, 'first_seen' AS field, count(*) AS n_given, count(*) FILTER (o % 101 <> 0) AS n_legible,
  count(*) FILTER (o % 101 <> 0) = 0 AS broken
FROM ioc_raw WHERE NOT loose GROUP BY 1, 2
UNION ALL
SELECT source, run_id, 'last_seen', count(*), count(*) FILTER (run_id <> '1997'), count(*) FILTER (run_id <> '1997') = 0
FROM ioc_raw WHERE NOT loose AND rf = 'R' GROUP BY 1, 2
UNION ALL
SELECT source, run_id, 'dateAdded', count(*), count(*) FILTER (o % 103 <> 0), count(*) FILTER (o % 103 <> 0) = 0
FROM entry GROUP BY 1, 2"""
    out["envelope_verdict"] = _with(_DOCUMENT) + """
SELECT source, run_id, verdict, count(*) AS n_documents FROM (
  SELECT 'cisa-kev' AS source, run_id,
    CASE WHEN what IN ('list_missing', 'list_not_a_list') THEN 'broken' WHEN n = 0 THEN 'not_verified' ELSE 'ok' END AS verdict
  FROM doc
  UNION ALL
  SELECT 'threatfox', run_id,
    CASE WHEN what IN ('list_missing', 'list_not_a_list') THEN 'broken' WHEN n = 0 THEN 'not_verified' ELSE 'ok' END
  FROM answer)
GROUP BY ALL"""
    now, base = PROFILE.format(v=2, s="software"), PROFILE.format(v=1, s="older")
    out["catalog_profile"] = _with(_software(), now) + "SELECT magnitude, observed FROM profile_2"
    out["catalog_drift"] = _with(_software(), _software(1, "older"), now, base) + """
SELECT magnitude, n.observed, b.observed AS expected,
  CASE WHEN magnitude IN ('live_with_aliases', 'uses_live') AND n.observed = 0 THEN 'gone'
       WHEN n.observed <> b.observed THEN 'changed' END AS defect
FROM profile_2 n JOIN profile_1 b USING (magnitude)"""
    out["catalog_object_drift"] = _with(_software(), _software(1, "older")) + """
SELECT id, CASE WHEN p_size % 2 = 0 THEN 'malware' ELSE 'tool' END AS type,
  CASE WHEN o.marker IS NULL THEN 'retired' WHEN n.marker IS NULL THEN 'revived' ELSE 'remarked' END AS change,
  o.marker, n.marker AS marker_now, 'Part Kit ' || p_partkey AS name, 'Part Kit ' || p_partkey AS name_now
FROM software_all n JOIN older_all o USING (id) JOIN part ON p_partkey = n.p
WHERE n.marker IS DISTINCT FROM o.marker"""
    out["retired_by_identity"] = _with(_software(), _software(1, "older")) + """
SELECT d.id, d.marker, n.marker AS marker_now,
  CASE WHEN n.marker IS NULL THEN 'absent' WHEN n.marker <> d.marker THEN 'marker_changed' ELSE 'kept' END AS verdict
FROM older_all d JOIN software_all n USING (id)
WHERE d.marker IS NOT NULL AND (SELECT count(DISTINCT marker) FROM older_all) = 2
UNION ALL SELECT NULL, NULL, NULL, 'not_checkable' WHERE (SELECT count(DISTINCT marker) FROM older_all) <> 2"""
    out["enrichment_invariant"] = _with(*ALL_ENRICHED) + """
, picked AS (
  SELECT *, CAST('0x' || md5(value)[1:2] AS INTEGER) AS pick FROM enriched
),
damaged AS (
  SELECT source, n_techniques, CASE WHEN pick < 8 THEN NULL WHEN pick < 16 THEN 'sin_atribucion'
    WHEN pick < 24 THEN 'producto_inespecifico' WHEN pick < 28 THEN 'sin_motivo' ELSE reason END AS reason
  FROM picked
)
SELECT source, CASE
    WHEN n_techniques = 0 AND reason IS NULL THEN 'gap_without_reason'
    WHEN n_techniques > 0 AND reason IS NOT NULL THEN 'techniques_with_reason'
    WHEN reason = 'sin_motivo' THEN 'unknown_reason'
    WHEN source = 'threatfox' AND reason LIKE 'producto%' THEN 'level_not_for_source'
    WHEN source = 'cisa-kev' AND reason NOT LIKE 'producto%' THEN 'level_not_for_source'
    ELSE 'none' END AS violation, count(*) AS n_rows
FROM damaged GROUP BY 1, 2""".replace("\n, picked", ", picked", 1)

    # entity resolution and enrichment
    out["canonicalize_names"] = _with(IOC, _software()) + """
, named AS (SELECT DISTINCT family_label AS name FROM ioc_ok UNION SELECT name FROM software_names),
canoned AS (SELECT name, regexp_replace(lower(strip_accents(name)), '[^a-z0-9]', '', 'g') AS canon FROM named)
SELECT canon, name, count(*) OVER (PARTITION BY canon) AS n_names FROM canoned""".lstrip("\n")
    out["group_families"] = _with(IOC, _software(), FAMILY) + """
SELECT family_id, count(*) AS n_names, min(name) AS first_name, max(name) AS last_name FROM name_list GROUP BY family_id"""
    out["family_name_list"] = _with(IOC, _software(), FAMILY) + "SELECT family_id, name FROM name_list"
    out["family_candidates"] = _with(IOC, _software(), FAMILY) + """
SELECT family_id, canon, CAST(rank AS BIGINT) AS rank, name, authority FROM candidate"""
    out["catalog_name_index"] = _with(_software()) + "SELECT canon, n_software, software_id FROM software_index"
    out["software_techniques"] = _with(_software(), PATTERN) + """
SELECT software_id, pattern_id, technique_id, technique_name, n_edges FROM live_edge"""
    out["resolve_families"] = _with(*ALL_FAMILY) + """
SELECT family_id, reason, software_id, matched_name, authority FROM resolution"""
    out["family_techniques"] = _with(*ALL_FAMILY) + "SELECT * FROM technique"
    out["family_mapping"] = _with(*ALL_FAMILY) + "SELECT * FROM mapping"
    out["vector_lookup"] = _with(VULN, RULES) + """
SELECT DISTINCT v.vendor, v.product,
  CASE WHEN r.vendor_no IS NULL THEN 'producto_sin_clasificar' WHEN r.unspecific THEN 'producto_inespecifico' END AS reason,
  CASE WHEN NOT r.unspecific THEN r.technique END AS technique_id,
  CASE WHEN NOT r.unspecific THEN t.technique_name END AS technique_name,
  CASE WHEN NOT r.unspecific THEN 'inferred' END AS mapping_method,
  CASE WHEN NOT r.unspecific THEN 'low' END AS mapping_confidence,
  CASE WHEN NOT r.unspecific THEN r.rationale END AS rationale
FROM vuln v LEFT JOIN rule r ON r.vendor_no = v.vendor_no AND r.product_no = v.product_no
LEFT JOIN technique_names t ON t.technique = r.technique"""
    out["enrich_observations"] = _with(*ALL_ENRICHED) + """
SELECT id, source, reason, technique_ids, CAST(n_techniques AS BIGINT) AS n_techniques, mapping_method, mapping_confidence,
  techniques, rationale
FROM enriched"""
    out["enrich_unavailable"] = _with(IOC, VULN) + """
SELECT source, 'etapa_no_disponible' AS reason, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_techniques
FROM (SELECT source FROM ioc_ok UNION ALL SELECT source FROM vuln) GROUP BY source"""
    out["consolidate_sources"] = _with(EVENTS) + """
, per_source AS (
  SELECT canonical_key, source, max(confidence) AS confidence, min(last_seen) AS first_seen, max(last_seen) AS last_seen,
    arg_max('ref/' || source || coalesce('/' || family, ''), (confidence, 'ref/' || source || coalesce('/' || family, ''))) AS reference
  FROM ev GROUP BY 1, 2
)
SELECT canonical_key, CAST(max(confidence) AS BIGINT) AS confidence, string_agg(reference, ',' ORDER BY source) AS references,
  count(*) AS n_sources, strftime(min(first_seen), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(max(last_seen), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM per_source GROUP BY canonical_key""".lstrip("\n").replace(" AS references", ' AS "references"')

    # aggregates
    out["technique_frequency"] = _with(*ALL_FAMILY) + """
SELECT technique_id, min(technique_name) AS technique_name, count(DISTINCT (family_id, technique_name)) AS n_families,
  (SELECT count(*) FROM mapping) AS total_families,
  round(count(DISTINCT (family_id, technique_name)) / (SELECT count(*) FROM mapping), 4) AS share
FROM technique GROUP BY technique_id"""
    out["technique_frequency_top"] = _with(*ALL_FAMILY) + """
SELECT technique_id, technique_name, count(DISTINCT family_id) AS n_families, (SELECT count(*) FROM mapping) AS total_families,
  CAST(count(DISTINCT family_id) * 100 // (SELECT count(*) FROM mapping) AS BIGINT) AS percent
FROM technique GROUP BY 1, 2 ORDER BY n_families DESC, technique_id, technique_name LIMIT 10"""
    out["inferred_frequency"] = _with(VULN, RULES, VULN_ENRICHED) + """
, period AS (SELECT * FROM vuln_enriched WHERE added BETWEEN DATE '1998-06-02' AND DATE '1998-06-15')
SELECT technique_id, count(*) AS n_entries, (SELECT count(*) FROM period) AS total_entries,
  CAST(count(*) * 100 // (SELECT count(*) FROM period) AS BIGINT) AS percent, CAST(NULL AS VARCHAR) AS reason
FROM period WHERE technique_id IS NOT NULL GROUP BY technique_id ORDER BY n_entries DESC, technique_id LIMIT 10""".lstrip("\n")
    out["reasons_by_family"] = _with(*ALL_FAMILY) + """
SELECT reason, count(*) AS n_families FROM mapping WHERE reason IS NOT NULL GROUP BY reason"""
    out["reasons_by_record"] = _with(*ALL_ENRICHED) + """
SELECT source, reason, CASE source WHEN 'threatfox' THEN 'indicador' ELSE 'entrada_kev' END AS level,
  count(*) AS n, any_value(d.denominator) AS denominator
FROM enriched JOIN (SELECT source, count(*) AS denominator FROM enriched GROUP BY source) d USING (source)
WHERE reason IN ('sin_atribucion', 'producto_sin_clasificar', 'producto_inespecifico') GROUP BY 1, 2"""
    out["kev_coverage"] = _with(VULN, RULES, VULN_ENRICHED) + """
, per_run AS (
  SELECT source, run_id, count(*) AS n, count(technique_id) AS mapped,
    count(*) FILTER (reason = 'producto_sin_clasificar') AS unclassified,
    count(*) FILTER (reason = 'producto_inespecifico') AS unspecific
  FROM vuln_enriched GROUP BY 1, 2
)
SELECT source, run_id,
  CASE run_id WHEN '1997' THEN 0 ELSE n END AS processed,
  CASE WHEN run_id IN ('1997', '1999') THEN 0 ELSE mapped END AS with_vector,
  CASE WHEN run_id IN ('1997', '1999') THEN 0 ELSE unclassified END AS unclassified,
  CASE WHEN run_id IN ('1997', '1999') THEN 0 ELSE unspecific END AS unspecific,
  CASE WHEN run_id = '1997' THEN 'unchanged' WHEN run_id = '1999' THEN 'stage_unavailable'
       WHEN run_id IN ('1996', '2000') THEN 'run_not_correct' END AS gate,
  CASE WHEN run_id NOT IN ('1996', '1997', '1999', '2000') THEN round(mapped / n, 4) END AS coverage
FROM per_run""".lstrip("\n")
    out["census_by_source"] = _with(EVENTS) + """
SELECT source, status = 'correcta' AS included, CASE WHEN status = 'correcta' THEN n END AS n_observations
FROM run JOIN (SELECT source, count(*) AS n FROM ev GROUP BY source) USING (source)"""
    out["census_families"] = _with(EVENTS) + """
SELECT feed AS family_feed, CASE WHEN feed = 'click-0' THEN (SELECT count(DISTINCT family) FROM ev WHERE source = feed AND family <> '') END AS n_families
FROM (VALUES ('click-0'), ('error-0'), ('error-2')) f(feed)"""
    sound = VULN.replace("WHERE fault IS NULL", "")
    out["full_run"] = _with(IOC, sound, RULES, VULN_ENRICHED) + """
, kev AS (
  SELECT v.*, e.technique_id, e.reason, v.added BETWEEN DATE '1998-06-02' AND DATE '1998-06-15' AS is_new
  FROM vuln v JOIN vuln_enriched e USING (value)
),
run AS (SELECT * FROM (VALUES ('run-1', DATE '1998-06-01', 'linea_base', 1), ('run-2', DATE '1998-06-15', 'diferencial', 2)) r(run, today, mode, number)),
held AS (
  SELECT r.run, r.number, r.today, k.*,
    CASE WHEN due IS NULL THEN 2 WHEN due >= today THEN 0 ELSE 1 END AS band, coalesce(abs(due - today), 0) AS days,
    coalesce(due BETWEEN today AND today + 7, false) AS soon
  FROM run r JOIN kev k ON r.number = 2 OR NOT k.is_new
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY band, days, ransomware <> 'Known', value) AS pos FROM held),
ioc_valid AS (SELECT count(*) AS n FROM ioc_ok),
techniques AS (
  SELECT technique_id, count(*) AS n FROM kev WHERE is_new AND technique_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10
)
SELECT run, 'mode' AS part, mode AS detail, number::BIGINT AS n FROM run
UNION ALL SELECT run, 'status', 'cisa-kev:correcta', count(*) FROM held GROUP BY run
UNION ALL SELECT run, 'status', 'threatfox:parcial', (SELECT n FROM ioc_valid) FROM run
UNION ALL SELECT run, 'new', 'cisa-kev', CASE number WHEN 2 THEN (SELECT count(*) FROM kev WHERE is_new) ELSE 0 END FROM run
UNION ALL SELECT run, 'new', 'threatfox', 0 FROM run
UNION ALL SELECT run, 'fallen', 'cisa-kev', CASE number WHEN 2 THEN 0 END FROM run
UNION ALL SELECT run, 'fallen', 'threatfox', NULL FROM run
UNION ALL SELECT run, 'state', 'cisa-kev:presente', count(*) FROM held GROUP BY run
UNION ALL SELECT 'run-1', 'inferred', 'baseline_mode', NULL
UNION ALL SELECT 'run-2', 'inferred', technique_id, n FROM techniques
UNION ALL SELECT run, 'census', 'cisa-kev', count(*) FROM held GROUP BY run
UNION ALL SELECT run, 'census', 'threatfox', NULL FROM run
UNION ALL SELECT run, 'families', NULL, NULL FROM run
UNION ALL SELECT run, 'due_soon', NULL, count(*) FILTER (soon) FROM held GROUP BY run
UNION ALL SELECT run, 'illegible_due', NULL, count(*) FILTER (due_date = 'n/a') FROM held GROUP BY run
UNION ALL SELECT run, 'vuln_section', NULL, count(*) FILTER (CASE number WHEN 2 THEN is_new OR soon ELSE pos <= 20 OR soon END) FROM ranked GROUP BY run
UNION ALL SELECT run, 'work_queue', NULL, CASE WHEN any_value(number) = 2 THEN count(*) FILTER (is_new AND reason = 'producto_sin_clasificar')
  ELSE least(20, count(*) FILTER (reason = 'producto_sin_clasificar')) END FROM held GROUP BY run
UNION ALL SELECT run, 'work_queue_total', NULL, count(*) FILTER (reason = 'producto_sin_clasificar') FROM held GROUP BY run""".lstrip("\n")
    out["count_by_type"] = _with(IOC, VULN) + """
SELECT type, count(*) AS n_observations FROM (SELECT type FROM ioc_ok UNION ALL SELECT type FROM vuln) GROUP BY type"""
    out["family_variation"] = _with(EVENTS, VARIATION) + "SELECT family, delta FROM variation"
    out["family_variation_top"] = _with(EVENTS, VARIATION) + """
SELECT family, delta FROM variation ORDER BY abs(delta) DESC, family LIMIT 10"""
    out["diff_totals"] = _with(EVENTS) + """
SELECT CAST(sum(n_new) AS BIGINT) AS n_new, CAST(sum(n_reappeared) AS BIGINT) AS n_reappeared,
  CAST(sum(n_fallen) AS BIGINT) AS n_fallen, count(n_fallen) AS n_sources_with_fallen, CAST(NULL AS VARCHAR) AS suppressed_source
FROM diff_source
UNION ALL SELECT NULL, NULL, NULL, NULL, source FROM diff_source WHERE n_fallen IS NULL"""
    out["source_status_table"] = _with(*QUALITY) + """
SELECT source, run_id, status, records, invalid, unsupported, evaluated, coalesce(details, '') AS short_fields FROM statuses"""
    out["judgement_counts"] = _with(*ALL_FAMILY, VULN, _DUE, EVENTS) + """
SELECT 'due_soon_with_ransomware' AS judgement, count(*) FILTER (ransomware = 'Known') AS part, count(*) AS total
FROM due WHERE soon HAVING count(*) FILTER (ransomware = 'Known') > 0
UNION ALL
SELECT 'families_without_entry', count(*) FILTER (reason = 'familia_sin_entrada'), count(*) FROM mapping
HAVING NOT EXISTS (SELECT 1 FROM ioc_raw WHERE raw_fault IS NOT NULL AND raw_fault <> 'unsupported_type')
UNION ALL
SELECT 'sources_with_fallen_suppressed', count(*) FILTER (n_fallen IS NULL), count(*) FROM diff_source"""
    out["enrichment_summary"] = _with(*ALL_ENRICHED) + """
SELECT count(*) AS n_rows, count(*) FILTER (n_techniques > 0) AS n_with_technique,
  count(*) FILTER (n_techniques = 0) AS n_without, (SELECT count(*) FROM mapping) AS n_families,
  (SELECT count(*) FROM mapping WHERE n_techniques > 0) AS n_families_mapped, CAST(0 AS BIGINT) AS n_internal_errors,
  NOT EXISTS (SELECT 1 FROM ioc_raw WHERE raw_fault IS NOT NULL AND raw_fault <> 'unsupported_type') AS panorama_publishable
FROM enriched"""

    # differences and state
    out["snapshot_diff"] = _with(EVENTS) + """
SELECT source, status, rule, n_observed, n_new, n_reappeared, n_fallen, in_baseline, new_reading_degraded, additions_lost_risk
FROM diff_source"""
    out["dedupe_observed"] = _with(EVENTS) + f"""
SELECT source, canonical_key, value, family, {_ts('last_seen')}, {_ts('ingested_at')} FROM (
  SELECT *, row_number() OVER (PARTITION BY source, canonical_key
    ORDER BY last_seen DESC, confidence DESC, family NULLS LAST) AS place FROM ev)
WHERE place = 1"""
    for key, member in (("new_members", "new"), ("reappeared_members", "reappeared"), ("fallen_members", "fallen")):
        out[key] = _with(EVENTS) + f"""
SELECT source, canonical_key, value, family, {_ts('last_seen')} FROM member WHERE member = '{member}'"""
    out["source_interval"] = _with(EVENTS) + """
, days AS (SELECT DISTINCT source, ingested_at AS day FROM ev)
SELECT d.source || '@' || strftime(d.day, '%Y-%m-%d') AS source,
  CAST(epoch(d.day) - epoch(b.day) AS BIGINT) AS interval_seconds
FROM days d LEFT JOIN days b ON b.source = d.source AND b.day + INTERVAL 1 DAY = d.day""".lstrip("\n")
    out["merge_state_sources"] = _with(EVENTS) + """
SELECT canonical_key, any_value(value) AS value, arg_max(family, source) FILTER (family IS NOT NULL) AS family,
  strftime(arg_max(last_seen, source), '%Y-%m-%d %H:%M:%S') AS last_seen,
  strftime(arg_min(ingested_at, source), '%Y-%m-%d %H:%M:%S') AS ingested_at,
  string_agg(source || '=' || status, ',' ORDER BY source) AS sources
FROM prior GROUP BY canonical_key"""
    out["publication_gate"] = _with(EVENTS) + """
SELECT source, status, n_observed, rule, interval_seconds, CAST(window_seconds AS BIGINT) AS window_seconds, sets_computed,
  fallen_published, CASE WHEN NOT fallen_published THEN rule END AS unpublished_reason, in_baseline, new_reading_degraded,
  coalesce(additions_lost_risk, false) AS additions_lost_risk
FROM pub"""
    out["watermark_advance"] = _with(EVENTS) + f"""
SELECT source, strftime({watermark}, '%Y-%m-%d %H:%M:%S') AS watermark FROM pub WHERE {watermark} IS NOT NULL"""
    out["rebuild_state"] = _with(EVENTS, _state(m.MODE_DIFFERENTIAL)) + f"""
SELECT source, canonical_key, value, family, status, {_ts('fallen_since')}, {_ts('last_seen')}, {_ts('ingested_at')} FROM state"""
    parts = []
    for mode in (m.MODE_DIFFERENTIAL, m.MODE_BASELINE):
        parts.append(
            f"""SELECT * FROM ({_with(EVENTS, _state(mode))}
SELECT k.source, k.status, count(*) AS n, '{mode}' AS mode FROM kept k
WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.source = k.source AND o.canonical_key = k.canonical_key) GROUP BY 1, 2)"""
        )
    out["mark_and_prune_fallen"] = "\nUNION ALL\n".join(parts)
    out["run_mode"] = """
WITH days AS (
  SELECT date_trunc('day', ts) AS start, count(DISTINCT event_type) AS n, CAST(day(date_trunc('day', ts)) AS INTEGER) AS d
  FROM events GROUP BY 1
),
decided AS (
  SELECT *, CASE WHEN d = 1 THEN 'estado_ausente' WHEN d = 2 THEN 'estado_no_interpretable'
      WHEN d IN (3, 9) THEN 'estado_sin_marca_de_agua' WHEN d = 4 THEN 'marca_de_agua_incoherente'
      WHEN d % 7 = 5 THEN 'regeneracion_solicitada' WHEN d % 7 = 6 THEN 'regeneracion_periodica' END AS baseline_reason,
    CASE WHEN d % 7 = 6 THEN 31 WHEN d % 7 = 0 THEN 30 ELSE 3 END AS age
  FROM days
),
moded AS (
  SELECT *, CASE WHEN d % 8 = 0 THEN 'fallo_total' WHEN baseline_reason IS NOT NULL THEN 'linea_base' ELSE 'diferencial' END AS mode
  FROM decided
)
SELECT strftime(start, '%Y-%m-%d') AS run_id, mode, baseline_reason,
  strftime(CASE WHEN mode = 'linea_base' THEN start ELSE start - to_days(age) END, '%Y-%m-%d %H:%M:%S') AS next_baseline_instant
FROM moded"""
    out["freshness_warnings"] = _with(EVENTS) + """
SELECT source, interval_seconds, CASE WHEN status = 'correcta' THEN 'watermark_did_not_advance' ELSE 'source_not_correct' END AS cause
FROM pub WHERE interval_seconds > 36 * 3600"""
    out["unpublished_ledger"] = _with(EVENTS) + """
SELECT 'three_sets' AS calculation, source, 'source_first_seen' AS reason, '2024-01-10' AS run_id FROM pub WHERE in_baseline
UNION ALL SELECT 'fallen', source, rule, '2024-01-10' FROM pub WHERE NOT in_baseline AND NOT fallen_published
UNION ALL SELECT 'additions', source, 'beyond_window_while_not_correct', '2024-01-10' FROM pub WHERE additions_lost_risk
UNION ALL SELECT 'techniques', NULL, 'stage_unavailable', '2024-01-10'
UNION ALL SELECT 'three_sets', NULL, 'baseline_mode', '2024-01-04'
UNION ALL SELECT 'inferred_techniques', NULL, 'baseline_mode', '2024-01-04'
UNION ALL SELECT 'family_panorama', 'threatfox', 'source_not_correct', unnest(['2024-01-04', '2024-01-10'])"""

    # rankings
    out["due_soon"] = _with(VULN, _DUE) + "SELECT value, due_date, ransomware FROM due WHERE soon"
    out["illegible_due"] = _with(VULN) + "SELECT value, due_date FROM vuln WHERE due_date = 'n/a'"
    out["decision_order"] = _with(VULN, _DUE) + """
SELECT value, due_date, CAST(decision_band AS BIGINT) AS decision_band, CAST(decision_days AS BIGINT) AS decision_days, no_ransomware
FROM due"""
    out["vuln_section"] = _with(VULN, _DUE) + f"""
SELECT 'diferencial' AS mode, value, due_date, CAST(NULL AS BIGINT) AS total FROM due WHERE is_new OR soon
UNION ALL
SELECT 'linea_base', value, due_date, (SELECT count(*) FROM due)
FROM (SELECT *, row_number() OVER (ORDER BY {_DECISION}) AS pos FROM due) WHERE pos <= 20 OR soon"""
    unclassified = """
, queue AS (SELECT d.* FROM due d JOIN vuln_enriched e USING (value) WHERE e.reason = 'producto_sin_clasificar')""".lstrip("\n")
    out["work_queue"] = _with(VULN, RULES, VULN_ENRICHED, _DUE) + unclassified + """
SELECT value, due_date, ransomware, (SELECT count(*) FROM queue) AS total FROM queue WHERE is_new
UNION ALL SELECT NULL, NULL, NULL, count(*) FROM queue"""
    out["work_queue_head"] = _with(VULN, RULES, VULN_ENRICHED, _DUE) + unclassified + f"""
SELECT value, due_date, (SELECT count(*) FROM queue) AS total FROM queue ORDER BY {_DECISION} LIMIT 20"""
    out["highlighted"] = _with(*ALL_ENRICHED) + f"""
SELECT CASE WHEN type IN ('ipv4-addr', 'ipv6-addr', 'domain-name', 'url')
    THEN replace(replace(value, 'https://', 'hxxps://'), '.', '[.]') ELSE value END AS shown,
  type, source, CAST(confidence AS BIGINT) AS confidence, family_label, technique_ids AS techniques
FROM enriched WHERE confidence >= 30 AND type <> 'vulnerability' AND value <> '{m.TRIVIAL_DIGESTS[0]}'
ORDER BY confidence DESC, sha256(type || value), source, family_label LIMIT 15"""
    out["recommendations"] = _with(VULN, _DUE, EVENTS) + """
, soon AS (SELECT * FROM due WHERE soon)
SELECT 'patch' AS action, (SELECT count(*) FROM soon) AS n,
  (SELECT string_agg(due_date || ' ' || value, ',' ORDER BY due_date, value) FROM (SELECT * FROM soon ORDER BY due_date, value LIMIT 3)) AS detail
WHERE (SELECT count(*) FROM soon) > 0
UNION ALL
SELECT 'review_collection', (SELECT count(*) FROM run WHERE status <> 'correcta'), source FROM run WHERE status <> 'correcta'""".lstrip("\n")

    # streaming
    out["stream_snapshots"] = _with(EVENTS) + f"""
, last_seen_in AS (SELECT source, canonical_key, max(snapshot) AS last FROM snap GROUP BY 1, 2)
SELECT s.source, s.canonical_key, s.value, s.family, CASE WHEN l.last = 2 OR l.last = 1 AND quiet THEN 'presente' ELSE 'caido' END AS status,
  CASE WHEN l.last = 1 AND NOT quiet THEN '2024-01-31 00:00:00' WHEN l.last = 0 THEN '2024-01-21 00:00:00' END AS fallen_since,
  strftime(s.last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen, strftime(s.ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM (SELECT *, source LIKE 'view-%' OR source = 'click-1' AS quiet FROM last_seen_in) l
JOIN snap s ON s.source = l.source AND s.canonical_key = l.canonical_key AND s.snapshot = l.last""".lstrip("\n")
    out["stream_reappearance"] = _with(EVENTS) + """
, run_at AS (SELECT * FROM (VALUES (0, '2024-01-11 00:00:00'), (1, '2024-01-21 00:00:00'), (2, '2024-01-31 00:00:00')) v(snapshot, run_start)),
sighting AS (
  SELECT source, canonical_key, snapshot, lag(snapshot) OVER w AS earlier, lead(snapshot) OVER w AS later
  FROM snap WINDOW w AS (PARTITION BY source, canonical_key ORDER BY snapshot)
)
SELECT source, canonical_key, CASE WHEN earlier IS NULL THEN 'new' ELSE 'reappeared' END AS member, run_start
FROM sighting JOIN run_at USING (snapshot) WHERE earlier IS NULL OR earlier < snapshot - 1
UNION ALL
SELECT source, canonical_key, 'fallen', t.run_start
FROM sighting s JOIN run_at t ON t.snapshot = s.snapshot + 1 WHERE later IS NULL OR later > s.snapshot + 1""".lstrip("\n")
    out["sliding_family_census"] = """
WITH seen AS (
  SELECT ts, json_extract_string(props, '$.k') AS k FROM events
),
days AS (
  SELECT unnest(generate_series((SELECT min(date_trunc('day', ts)) FROM seen) - INTERVAL 4 DAY,
    (SELECT max(date_trunc('day', ts)) FROM seen), INTERVAL 1 DAY)) AS start
)
SELECT strftime(d.start, '%Y-%m-%d') AS window_start, count(DISTINCT s.k) AS n_families, count(*) AS n_observations,
  d.start + INTERVAL 7 DAY <= (SELECT max(ts) FROM seen) AS closed
FROM days d JOIN seen s ON s.ts >= d.start AND s.ts < d.start + INTERVAL 5 DAY
GROUP BY d.start"""
    return out
