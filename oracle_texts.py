"""DuckDB texts of the registered queries, for the side-by-side check."""

from __future__ import annotations

# Fixed value: accepted postal codes of the United States.
POSTAL = "^[0-9]{5}(-[0-9]{4})?$|^[0-9]{5}-?$"
FIELDS = "id, name, category, street, city, state, postal_code, country"
REST = "longitude, latitude, phone, website_url"
SILVER_COLUMNS = f"{FIELDS}, {REST}"
DIMS = "name, category, state, country, city"

FEED = f"""
WITH raw AS (
 SELECT o.o_orderkey AS seq, CAST(o.o_orderkey // 50 AS BIGINT) + 1 AS page, o.o_orderdate AS seen_at,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS id,
  'Chain_' || CAST(o.o_custkey % 3 AS VARCHAR) AS name, c.c_mktsegment AS category,
  CAST(c.c_nationkey AS VARCHAR) || ' Main St' AS street,
  'City_' || CAST(o.o_custkey % 5 AS VARCHAR) AS city, n.n_name AS state,
  CASE o.o_orderkey % 5 WHEN 0 THEN lpad(CAST(o.o_custkey AS VARCHAR), 5, '0')
   WHEN 1 THEN lpad(CAST(o.o_custkey AS VARCHAR), 5, '0') || '-0001'
   WHEN 2 THEN lpad(CAST(o.o_custkey AS VARCHAR), 5, '0') || '-'
   WHEN 3 THEN 'X' || CAST(o.o_custkey AS VARCHAR) ELSE NULL END AS postal_code,
  CASE WHEN r.r_name = 'AMERICA' THEN 'United States' ELSE r.r_name END AS country,
  CASE WHEN o.o_orderkey % 11 = 0 THEN '' WHEN o.o_orderkey % 13 = 0 THEN 'n/a'
   ELSE '-' || CAST(o.o_orderkey % 180 AS VARCHAR) || '.25' END AS longitude,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_orderkey % 90 AS VARCHAR) || '.5' END AS latitude,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE '555' || lpad(CAST(o.o_custkey AS VARCHAR), 7, '0') END AS phone,
  CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE 'http://e' || CAST(o.o_custkey AS VARCHAR) || '.example' END
   AS website_url
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
typed AS (SELECT seq, page, seen_at, {FIELDS}, try_cast(nullif(longitude, '') AS DOUBLE) AS longitude,
  try_cast(nullif(latitude, '') AS DOUBLE) AS latitude, phone, website_url FROM raw),
bronze AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen_at DESC, seq DESC)
  AS rn FROM typed) t WHERE rn = 1),
clean AS (SELECT seq, id, lower(name) AS name, lower(category) AS category, street, lower(city) AS city,
  lower(state) AS state, postal_code, lower(country) AS country, longitude, latitude,
  sha256(phone) AS phone, website_url FROM bronze WHERE id IS NOT NULL),
flagged AS (SELECT *, coalesce(country = 'united states' AND NOT regexp_matches(postal_code, '{POSTAL}'), FALSE)
  AS bad_postal, phone IS NULL AND website_url IS NULL AS no_contact FROM clean),
silver AS (SELECT * FROM flagged WHERE NOT no_contact),
gold AS (SELECT {DIMS}, CAST(count(id) AS BIGINT) AS entity_count FROM silver GROUP BY {DIMS}),
by_category AS (SELECT state, category, CAST(sum(entity_count) AS BIGINT) AS entity_count
  FROM gold GROUP BY state, category),
accepted AS (SELECT * FROM flagged WHERE NOT no_contact AND NOT bad_postal),
accepted_gold AS (SELECT {DIMS}, CAST(count(id) AS BIGINT) AS entity_count FROM accepted GROUP BY {DIMS}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY state
  ORDER BY entity_count DESC, category, name, country, city) AS rank FROM gold),
totals AS (SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT id) + max(CASE WHEN id IS NULL
  THEN 1 ELSE 0 END) AS BIGINT) AS kept FROM raw),
doubles AS (SELECT id, CAST(count(*) AS BIGINT) AS copies FROM raw GROUP BY id HAVING count(*) > 1),
metrics AS (SELECT (SELECT CAST(count(*) AS BIGINT) FROM doubles) AS duplicate_keys,
  CAST(count(*) FILTER (WHERE bad_postal) AS BIGINT) AS bad_postal,
  CAST(count(*) FILTER (WHERE no_contact) AS BIGINT) AS no_contact,
  CAST(count(*) FILTER (WHERE postal_code IS NULL) AS BIGINT) AS postal_missing FROM flagged)
"""


def _share(source: str, columns: str) -> str:
    # Integer arithmetic rounds half up exactly, like decimals do.
    return f"""SELECT {columns}, CAST((entity_count * 20000 + total) // (2 * total) AS DOUBLE) / 100 AS percentage
      FROM (SELECT *, CAST(sum(entity_count) OVER (PARTITION BY state) AS BIGINT) AS total FROM {source}) t"""


def _total(dim: str, source: str = "gold", where: str = "") -> str:
    return f"""SELECT {dim}, CAST(sum(entity_count) AS BIGINT) AS total_entities
      FROM {source} {where} GROUP BY {dim}"""


def _winners(source: str, ties: str, states: str) -> str:
    return f"""SELECT category AS most_popular_category, CAST(sum(entity_count) AS BIGINT) AS total{states}
      FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY entity_count DESC, {ties}) AS rn
        FROM {source}) t WHERE rn = 1 GROUP BY category"""


def _after_run(number: int) -> str:
    """What silver holds after the first `number` of three batches of pages."""
    pages = f"page <= (SELECT max(page) FROM raw) * {number} // 3"
    return f"""accepted_{number} AS (SELECT id, lower(name) AS name, lower(category) AS category, street, lower(city) AS city,
      lower(state) AS state, postal_code, lower(country) AS country, longitude, latitude, sha256(phone) AS phone, website_url
      FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen_at DESC, seq DESC) AS rn FROM typed WHERE {pages}) t
      WHERE rn = 1 AND id IS NOT NULL AND (phone IS NOT NULL OR website_url IS NOT NULL)
      AND NOT coalesce(lower(country) = 'united states' AND NOT regexp_matches(postal_code, '{POSTAL}'), FALSE))"""


_OTHER = [c.strip() for c in SILVER_COLUMNS.split(",") if c.strip() != "id"]
_CHANGED = ", ".join(f"CASE WHEN b.{c} IS DISTINCT FROM a.{c} THEN '{c}' END" for c in _OTHER)

_RAW = f"SELECT seq, page, {FIELDS}, {REST} FROM raw"
_TYPED = f"SELECT seq, {FIELDS}, {REST} FROM typed"
_GOLD = f"SELECT {DIMS}, entity_count FROM gold"
_SILVER = f"SELECT {SILVER_COLUMNS} FROM silver"
_BRONZE = f"SELECT {FIELDS}, {REST} FROM bronze"
_COPY = """SELECT id, name, category, street AS address_1, CAST(NULL AS VARCHAR) AS address_2,
  CAST(NULL AS VARCHAR) AS address_3, city, state AS state_province, postal_code, country, longitude, latitude,
  phone, website_url, state, street FROM raw"""
_LOST_PAGE = "(SELECT CAST(max(page) * 9 // 10 AS BIGINT) FROM raw)"

_FEED_QUERIES = {
    "src_page_prefix": f"SELECT seq, page, {FIELDS}, {REST} FROM raw WHERE page < {_LOST_PAGE}",
    "src_page_report": f"""SELECT {_LOST_PAGE} AS boundary, {_LOST_PAGE} - 1 AS pages_read,
      {_LOST_PAGE} <= (SELECT max(page) FROM raw) AS broken,
      {_LOST_PAGE} <= (SELECT max(page) FROM raw) AS truncated, CAST(0 AS BIGINT) AS unnumbered,
      CAST(0 AS BIGINT) AS skipped""",
    "src_page_files": f"SELECT page, {FIELDS}, {REST} FROM raw",
    "src_typed_schema": _TYPED,
    "src_layer_scan": _BRONZE,
    "stream_landing": f"SELECT {FIELDS}, {REST} FROM raw",
    "snk_partitioned_roundtrip": _SILVER,
    "snk_gold_roundtrip": _GOLD,
    "snk_landing_roundtrip": _COPY,
    "snk_namespaces": """SELECT 'silver' AS namespace, CAST(count(*) AS BIGINT) AS entities FROM silver
      UNION ALL SELECT 'gold' AS namespace, CAST(sum(entity_count) AS BIGINT) AS entities FROM gold""",
    "snk_compact": _SILVER,
    "snk_compact_hot": _SILVER,
    "snk_zorder": _SILVER,
    "prj_fixed_fields": f"SELECT {FIELDS}, {REST}, CAST(NULL AS VARCHAR) AS updated_at FROM raw",
    "prj_parse_coords": """SELECT seq, longitude, latitude, longitude_malformed FROM (SELECT t.seq, t.longitude,
      t.latitude, r.longitude = 'n/a' AS longitude_malformed FROM typed t JOIN raw r ON t.seq = r.seq) x""",
    "prj_cast_double": "SELECT seq, longitude, latitude FROM typed",
    "prj_lower": """SELECT seq, lower(name) AS name, lower(category) AS category, lower(city) AS city,
      lower(state) AS state, lower(country) AS country FROM raw""",
    "prj_sha256_mask": "SELECT seq, sha256(phone) AS phone, sha256('pepper' || phone) AS salted FROM raw",
    "prj_load_stamp": "SELECT CAST(count(*) AS BIGINT) AS stamped, CAST(1 AS BIGINT) AS stamps FROM raw",
    "flt_drop_null_key": f"SELECT seq, {FIELDS}, {REST} FROM raw WHERE id IS NOT NULL",
    "flt_equality": "SELECT seq, id, state, country FROM raw WHERE country = 'United States'",
    "flt_invalid_postal": "SELECT id, postal_code, country FROM flagged WHERE bad_postal",
    "flt_require_any": _SILVER,
    "flt_missing_all": f"SELECT {SILVER_COLUMNS} FROM flagged WHERE no_contact",
    "agg_duplicate_keys": "SELECT id, copies FROM doubles",
    "agg_dedupe_latest": f"SELECT seq, {FIELDS}, {REST} FROM bronze",
    "agg_gold_rollup": _GOLD,
    "agg_reconcile": """SELECT total, kept, total - kept AS dropped,
      (SELECT CAST(count(*) AS BIGINT) FROM doubles) AS duplicate_keys FROM totals""",
    "agg_reconcile_frames": """SELECT *, total - kept AS dropped FROM (SELECT
      (SELECT CAST(count(*) AS BIGINT) FROM clean) AS total,
      (SELECT CAST(count(*) AS BIGINT) FROM silver) AS kept) t""",
    "agg_reconcile_rule": """SELECT *, total - kept AS dropped FROM (SELECT
      (SELECT CAST(count(*) AS BIGINT) FROM clean) AS total,
      (SELECT CAST(count(*) AS BIGINT) FROM silver) AS kept) t""",
    "dq_metrics": "SELECT duplicate_keys, bad_postal, no_contact, postal_missing FROM metrics",
    "dq_gate": """SELECT *, bad_postal AS issues, bad_postal = 0 AS passed,
      CAST(CASE WHEN bad_postal = 0 THEN 1 ELSE 0 END AS INT) AS fl_quality FROM metrics""",
    "dq_gate_strict": """SELECT duplicate_keys, bad_postal, no_contact, postal_missing,
      duplicate_keys + bad_postal + no_contact AS issues, passed,
      CAST(CASE WHEN passed THEN 1 ELSE 0 END AS INT) AS fl_quality FROM (SELECT *, duplicate_keys <= 0
        AND bad_postal <= 100 AND no_contact <= 10000000 AS passed FROM metrics) t""",
    "dq_quarantine": f"""SELECT CASE WHEN bad_postal THEN 'bad_postal' ELSE 'no_contact' END AS verdict,
      {SILVER_COLUMNS} FROM flagged WHERE bad_postal OR no_contact""",
    "dq_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS least,
        CAST(max({c}) AS VARCHAR) AS greatest, TRUE AS close FROM typed"""
        for c in ("seq", "id", "postal_code", "longitude")
    ),
    "dq_gate_history": f""", rules AS (SELECT strftime(seen_at, '%Y-%m') AS run,
        coalesce(lower(country) = 'united states' AND NOT regexp_matches(postal_code, '{POSTAL}'), FALSE) AS bad_postal,
        phone IS NULL AND website_url IS NULL AS no_contact, postal_code IS NULL AS postal_missing FROM raw),
      months AS (SELECT run, count(*) FILTER (bad_postal) AS bad_postal, count(*) FILTER (no_contact) AS no_contact,
        count(*) FILTER (postal_missing) AS postal_missing, count(*) AS total FROM rules GROUP BY run),
      per_month AS (SELECT run, metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT months
        ON bad_postal, no_contact, postal_missing, total INTO NAME metric VALUE value) t),
      held AS (SELECT *, coalesce(list(CAST(value AS DOUBLE)) OVER (PARTITION BY metric ORDER BY run
        ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), []) AS held FROM per_month),
      middle AS (SELECT *, list_median(held) AS median FROM held),
      spread AS (SELECT *, 1.4826 * list_median([abs(x - median) for x in held]) AS spread FROM middle),
      room AS (SELECT *, greatest(CAST(3 * spread AS DOUBLE), CAST(0.05 * abs(median) AS DOUBLE), CAST(5 AS DOUBLE)) AS room FROM spread)
      SELECT run, metric, value, CAST(len(held) AS INTEGER) AS earlier, median,
        len(held) >= 5 AND (value > median + room OR value < median - room) AS drifted FROM room""",
    "win_percent_of_partition": _share("gold", f"{DIMS}, entity_count"),
    "win_row_number": f"SELECT {DIMS}, entity_count, CAST(rank AS BIGINT) AS rank FROM ranked",
    "win_top1": f"SELECT {DIMS}, entity_count FROM ranked WHERE rank = 1",
    "kpi_1_total_by_state": _total("state"),
    "kpi_2_total_by_category": _total("category"),
    "kpi_3_states_for_category": _total("state", where="WHERE category = 'building'"),
    "kpi_4_share": _share("gold", "state, category, name, country, city, entity_count"),
    "kpi_4_share_by_category": _share("by_category", "state, category, entity_count"),
    "kpi_5_popular": _winners("gold", "category, name, country, city", ""),
    "kpi_5_popular_by_category": _winners(
        "by_category", "category", ", CAST(count(*) AS BIGINT) AS states"
    ),
    "flow_bronze": _BRONZE,
    "flow_silver": f"SELECT {SILVER_COLUMNS} FROM accepted",
    "flow_gold": f"SELECT {DIMS}, entity_count FROM accepted_gold",
    "flow_all": _total("state", source="accepted_gold"),
    "flow_incremental": f"SELECT {SILVER_COLUMNS} FROM accepted",
    "flow_second_entity": """SELECT lower(p_type) AS type, lower(p_name) AS name, CAST(count(*) AS BIGINT) AS entity_count
      FROM part WHERE NOT (lower(p_type) = 'economy' AND NOT regexp_matches(CAST(p_size AS VARCHAR), '^[1-3]?[0-9]$'))
      GROUP BY ALL""",
    "flow_gold_delta": f"SELECT {DIMS}, entity_count FROM accepted_gold",
    "flow_replay": f"SELECT {SILVER_COLUMNS} FROM accepted",
    "flow_rerun": f"SELECT {SILVER_COLUMNS} FROM accepted",
    "stream_upsert": f"SELECT seq, {FIELDS}, {REST} FROM (SELECT *, row_number() OVER (PARTITION BY id"
    " ORDER BY seen_at DESC, seq DESC) AS rn FROM raw WHERE id IS NOT NULL) t WHERE rn = 1",
    "doc_schema_widened": """SELECT CAST(seq AS BIGINT) AS seq, state, CASE WHEN seq % 3 = 1 THEN latitude ELSE
        CAST(trunc(latitude) AS DOUBLE) END AS latitude, CASE WHEN seq % 3 < 2 THEN CAST(page AS VARCHAR) END AS page,
      CASE WHEN seq % 3 = 2 THEN city END AS city, 'r' || CAST(seq % 3 + 1 AS VARCHAR) AS run_id FROM typed""",
    "doc_schema_drift": """SELECT * FROM (VALUES ('r2', 'seq', 'widened', 'int', 'bigint'),
        ('r2', 'latitude', 'widened', 'int', 'double'), ('r2', 'page', 'widened', 'bigint', 'string'),
        ('r3', 'seq', 'narrowed', 'bigint', 'int'), ('r3', 'latitude', 'narrowed', 'double', 'int'),
        ('r3', 'page', 'missing', 'string', NULL), ('r3', 'city', 'added', NULL, 'string'))
      t("run", "column", change, "before", "after") WHERE (SELECT count(*) FROM raw) > 0""",
    "doc_postal_table": """SELECT id, country, postal_code FROM clean JOIN region ON country =
      CASE r_name WHEN 'AMERICA' THEN 'united states' ELSE lower(r_name) END
      WHERE r_regionkey < 4 AND NOT regexp_matches(postal_code, '^[0-9]{5}$')
      AND NOT (r_regionkey % 2 = 1 AND regexp_matches(postal_code, '^[0-9]{5}-[0-9]{4}$'))""",
    "doc_changes": f""", {_after_run(2)}, {_after_run(3)}
      SELECT * FROM (SELECT coalesce(b.id, a.id) AS id,
        CASE WHEN b.id IS NULL THEN 'inserted' WHEN a.id IS NULL THEN 'deleted' ELSE 'updated' END AS change,
        array_to_string([x for x in [{_CHANGED}] if x IS NOT NULL], ',') AS changed,
        b.postal_code AS postal_code_before, a.postal_code AS postal_code_after,
        b.longitude AS longitude_before, a.longitude AS longitude_after
        FROM accepted_2 b FULL JOIN accepted_3 a ON b.id = a.id) t WHERE change <> 'updated' OR changed <> ''""",
    "doc_history": f""", {_after_run(1)}, {_after_run(2)}, {_after_run(3)},
      states AS (SELECT 1 AS run, * FROM accepted_1 UNION ALL SELECT 2, * FROM accepted_2 UNION ALL SELECT 3, * FROM accepted_3),
      islands AS (SELECT id, postal_code, longitude, phone, run,
        run - row_number() OVER (PARTITION BY id, postal_code, longitude, phone ORDER BY run) AS island FROM states)
      SELECT id, postal_code, longitude, phone, CAST(min(run) AS INTEGER) AS valid_from,
        CAST(CASE WHEN max(run) < 3 THEN max(run) + 1 END AS INTEGER) AS valid_to
      FROM islands GROUP BY id, postal_code, longitude, phone, island""",
    "sql_kpi_1": _total("state", source="accepted_gold"),
    "sql_kpi_2": _total("category", source="accepted_gold"),
    "sql_kpi_3": _total("state", source="accepted_gold", where="WHERE category = 'building'"),
    "sql_kpi_4": _share("accepted_gold", "state, category, name, country, city, entity_count"),
    "sql_kpi_5": _winners("accepted_gold", "category, name, country, city", ""),
    "doc_upsert": """SELECT seq, id, lower(name) AS name, lower(category) AS category, street,
      lower(city) AS city, lower(state) AS state, postal_code, lower(country) AS country, longitude, latitude,
      sha256(phone) AS phone, website_url FROM bronze WHERE id IS NOT NULL""",
    "doc_enforce_schema": f"""SELECT {FIELDS}, CAST(longitude AS VARCHAR) AS longitude,
      CAST(latitude AS VARCHAR) AS latitude, phone, website_url, CAST(NULL AS VARCHAR) AS updated_at,
      CAST(NULL AS VARCHAR) AS created_at FROM raw""",
    "doc_incremental": """SELECT seq, id, state FROM raw WHERE (seen_at, seq) NOT IN (SELECT (seen_at, seq) FROM raw
      WHERE seen_at < (SELECT max(seen_at) FROM raw WHERE seen_at < TIMESTAMP '1997-01-01 00:00:00')
      OR seen_at < TIMESTAMP '1997-01-01 00:00:00' AND seq % 2 = 0)""",
    "doc_postal_by_country": f"""SELECT id, country, postal_code FROM clean
      WHERE (country = 'united states' AND NOT regexp_matches(postal_code, '{POSTAL}'))
      OR (country = 'europe' AND NOT regexp_matches(postal_code, '^[0-9]{{5}}$'))
      OR (country = 'asia' AND NOT regexp_matches(postal_code, '^[0-9]{{5}}-[0-9]{{4}}$'))""",
}

TEXTS = {name: f"{FEED}\n{text}" for name, text in _FEED_QUERIES.items()}
TEXTS["src_json_map"] = """SELECT event_id, event_type, json_extract_string(props, '$.k') AS k,
  CAST(NULL AS VARCHAR) AS absent FROM events"""
TEXTS["src_json_rows"] = """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS order_key,
    o_orderstatus AS status, CAST(l_linenumber AS VARCHAR) AS line, CAST(l_quantity AS DOUBLE) AS qty,
    CASE WHEN l_orderkey IS NOT NULL THEN '{"flag":"' || l_returnflag || '"}' END AS rest
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber > 1) l ON l_orderkey = o_orderkey"""
