"""The stand-in queries as SQL for DuckDB."""

from __future__ import annotations

SITES = """
sites AS (
    SELECT 'b-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS id,
           c_name AS name,
           nullif(c_mktsegment, 'FURNITURE') AS brewery_type,
           r_name AS country,
           n_name AS state,
           n_name || '-' || CAST(c_custkey % 7 AS VARCHAR) AS city,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '0' || CAST(c_custkey AS VARCHAR)
                WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_custkey AS VARCHAR) || '.5'
                WHEN c_mktsegment = 'HOUSEHOLD' THEN 'true'
                WHEN c_mktsegment <> 'FURNITURE' THEN 'PC ' || CAST(c_custkey AS VARCHAR)
           END AS postal_code,
           c_acctbal AS longitude
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)
"""

KEYED_EVENTS = """
keyed AS (
    SELECT *, 'e-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS key FROM events
),
mark AS (
    SELECT max(key) AS mark FROM keyed
    WHERE ts < (SELECT date_trunc('day', max(ts)) FROM events)
)
"""

ACCOUNTS = """
accounts AS (
    SELECT 'c-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS id,
           c_mktsegment AS kind, c_acctbal AS amount
    FROM customer
    UNION ALL
    SELECT CASE WHEN s_nationkey <> 0
                THEN 's-' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') END,
           'SUPPLIER', s_acctbal
    FROM supplier
),
newest AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events
),
changes AS (
    SELECT 'c-' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS id,
           event_type AS kind, value AS amount
    FROM newest WHERE rn = 1
    UNION ALL
    SELECT CASE WHEN p_size <> 1
                THEN 'p-' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') END,
           p_type, p_retailprice
    FROM part
)
"""

UPSERTED = f"""
WITH {ACCOUNTS}
SELECT id, kind, amount FROM accounts t
WHERE NOT EXISTS (SELECT 1 FROM changes s WHERE s.id = t.id)
UNION ALL
SELECT id, kind, amount FROM changes
"""

RUN_EVENTS = """
runs AS (
    SELECT *,
           CASE WHEN event_type = 'error' THEN 'data/backfill/'
                ELSE 'data/' || strftime(date_trunc('day', ts), '%Y_%m_%d_%H_%M_%S_%f') || '/'
           END AS folder,
           try_strptime(split_part(folder, '/', 2), '%Y_%m_%d_%H_%M_%S_%f') AS run_at
    FROM events
)
"""

CLASS = r"""
CASE WHEN {value} IS NULL THEN 'Unknown'
     WHEN regexp_matches({value}, '^(-|\+)? ?\d*\.\d*\z') THEN 'Fractional'
     WHEN regexp_matches({value}, '^(-|\+)? ?\d*\z') THEN 'Integral'
     WHEN regexp_matches({value}, '^(true|false)\z') THEN 'Boolean'
     ELSE 'String' END
"""

MART = """
SELECT country, state, city, brewery_type, count(*) AS brewery_count
FROM sites GROUP BY country, state, city, brewery_type
"""


def _complete(column: str, relation: str = "sites") -> str:
    return f"(SELECT count({column}) / count(*)::DOUBLE FROM {relation})"


def _unique(column: str, relation: str = "sites") -> str:
    return f"""(
        SELECT count(*) FILTER (n = 1) / sum(n)::DOUBLE
        FROM (SELECT count(*) AS n FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column})
    )"""


def _class_share(column: str, wanted: str) -> str:
    return f"""(
        SELECT count(*) FILTER ({CLASS.format(value=column)} = '{wanted}')
               / nullif(count({column}), 0)::DOUBLE
        FROM sites
    )"""


def _report(rows: list[tuple[str, str, str, str, str]]) -> str:
    measured = " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{level}' AS level, '{column}' AS "column",
                   '{label}' AS "constraint", CAST({metric} AS DOUBLE) AS metric"""
        for check, level, column, label, metric in rows
    )
    return f"""
        SELECT *,
               CASE WHEN metric = 1.0 THEN 'success' ELSE 'failure' END AS status,
               CASE WHEN metric = 1.0 THEN ''
                    WHEN "column" = 'latitude' THEN 'no such column'
                    WHEN metric IS NULL THEN 'nothing to measure'
                    ELSE 'metric is not 1.0' END AS message
        FROM ({measured})
    """


REPORT_ROWS = [
    ("identity", "error", "id", "unique", _unique("id")),
    ("identity", "error", "id", "complete", _complete("id")),
    ("identity", "error", "name", "complete", _complete("name")),
    *[("places", "error", c, "complete", _complete(c)) for c in ("country", "state", "city")],
    *[
        ("places", "error", c, "data_type[String]", _class_share(c, "String"))
        for c in ("id", "country", "state", "city")
    ],
    ("places", "error", "longitude", "data_type[Fractional]", _complete("longitude")),
    ("optional", "warning", "country", "unique", _unique("country")),
    ("optional", "warning", "brewery_type", "complete", _complete("brewery_type")),
    ("optional", "warning", "postal_code", "complete", _complete("postal_code")),
    ("optional", "warning", "latitude", "complete", "NULL"),
    *[
        ("optional", "warning", "postal_code", f"data_type[{c}]", _class_share("postal_code", c))
        for c in ("String", "Integral")
    ],
]
STRICT_ROWS = [
    ("strict", "error", "id", "unique", _unique("id")),
    ("strict", "error", "brewery_type", "complete", _complete("brewery_type")),
]


def _gated(rows) -> str:
    return f"""
        WITH {SITES}, report AS ({_report(rows)}), mart AS ({MART})
        SELECT * FROM mart
        WHERE NOT EXISTS (SELECT 1 FROM report WHERE level = 'error' AND status = 'failure')
    """


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


SITE_COLUMNS = [
    "id", "name", "brewery_type", "country", "state", "city", "postal_code", "longitude",
]
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
MOVED = "CASE WHEN country = 'ASIA' THEN 'MOVED' ELSE brewery_type END"

ORACLE: dict[str, str] = {
    "count_by_type_location": f"WITH {SITES} {MART}",
    "stamped_mart": f"""
        WITH {SITES}
        SELECT country, brewery_type, count(*) AS brewery_count,
               '2024-05-06 07:08:09' AS update_at
        FROM sites GROUP BY country, brewery_type
    """,
    "rollup_region": f"""
        WITH {SITES}
        SELECT country, state, city, brewery_type,
               grouping(country, state, city, brewery_type) AS level,
               count(*) AS brewery_count
        FROM sites GROUP BY ROLLUP (country, state, city, brewery_type)
    """,
    "upsert_by_key": UPSERTED,
    "cast_projection": """
        SELECT 'o-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id,
               TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a'
                             ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS amount,
               CAST(o_custkey AS VARCHAR) AS customer,
               CAST(NULL AS VARCHAR) AS remark
        FROM orders
    """,
    "dedupe_latest": """
        SELECT event_id, ts, user_id, event_type, value, props
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                           ORDER BY ts DESC, event_id DESC) AS rn
              FROM events)
        WHERE rn = 1
    """,
    "incremental_filter": f"""
        WITH {KEYED_EVENTS}
        SELECT * FROM keyed WHERE key > (SELECT mark FROM mark)
    """,
    "incremental_pages": f"""
        WITH {KEYED_EVENTS},
        paged AS (
            SELECT key, event_type,
                   (row_number() OVER (ORDER BY key DESC) - 1) // 50 + 1 AS page
            FROM keyed
        ),
        known AS (
            SELECT page FROM paged GROUP BY page
            HAVING count(*) FILTER (key > (SELECT mark FROM mark)) = 0
        )
        SELECT key, event_type, page FROM paged
        WHERE key > (SELECT mark FROM mark)
          AND page < (SELECT coalesce(min(page), 9223372036854775807) FROM known)
    """,
    "full_load_pages": f"""
        WITH {SITES},
        paged AS (
            SELECT id, (row_number() OVER (ORDER BY id) - 1) // 200 + 1 AS page FROM sites
        )
        SELECT page, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id
        FROM paged GROUP BY page
    """,
    "pages_with_ties": """
        SELECT page, l_returnflag, count(*) AS n_rows
        FROM (SELECT l_returnflag,
                     (row_number() OVER (ORDER BY l_returnflag) - 1) // 5000 + 1 AS page
              FROM lineitem)
        GROUP BY page, l_returnflag
    """,
    "new_watermark": f"""
        WITH {KEYED_EVENTS}
        SELECT 'moved' AS load,
               coalesce((SELECT max(key) FROM keyed WHERE key > mark), mark) AS max_id
        FROM mark
        UNION ALL
        SELECT 'kept' AS load, max(key) AS max_id FROM keyed
    """,
    "latest_run": f"""
        WITH {RUN_EVENTS}
        SELECT event_id, folder, value FROM runs
        WHERE run_at = (SELECT max(run_at) FROM runs)
    """,
    "point_in_time_run": f"""
        WITH {RUN_EVENTS}
        SELECT event_id, folder, value FROM runs
        WHERE run_at = (SELECT max(run_at) FROM runs
                        WHERE run_at <= TIMESTAMP '2024-01-15 12:00:00')
    """,
    "completeness": f"WITH {SITES} "
    + _union(f"SELECT '{c}' AS \"column\", {_complete(c)} AS metric" for c in SITE_COLUMNS),
    "uniqueness": f"WITH {SITES} "
    + _union(
        f"SELECT '{c}' AS \"column\", {_unique(c, r)} AS metric"
        for c, r in [
            ("id", "sites"),
            ("country", "sites"),
            ("postal_code", "sites"),
            ("text", "documents"),
        ]
    ),
    "data_type_profile": f"""
        WITH {SITES}, classified AS (
    """
    + _union(
        f"SELECT '{c}' AS \"column\", {CLASS.format(value=c)} AS value_class FROM sites"
        for c in ("id", "country", "brewery_type", "postal_code")
    )
    + """
            UNION ALL
            SELECT 'longitude', CASE WHEN longitude IS NULL THEN 'Unknown' ELSE 'Fractional' END
            FROM sites
        )
        SELECT "column", value_class, count(*) AS n_values
        FROM classified GROUP BY "column", value_class
    """,
    "verification_report": f"WITH {SITES} {_report(REPORT_ROWS)}",
    "gated_mart": _gated([row for row in REPORT_ROWS if row[1] == "error"]),
    "gated_mart_refused": _gated(STRICT_ROWS),
    "schema_report": """
        SELECT field, problem, (SELECT count(*) FROM customer) AS n_rows
        FROM (VALUES ('longitude', 'type'), ('latitude', 'missing'), ('postal_code', 'extra'))
             AS problems(field, problem)
    """,
    "row_count": _union(
        f"SELECT '{name}' AS \"table\", count(*) AS n_rows FROM {name}" for name in TABLES
    ),
    "raw_json_scan": """
        SELECT 'd-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS id, lang,
               CAST(NULL AS VARCHAR) AS origin,
               CASE WHEN lang = 'de' THEN NULL ELSE CAST(n_chars AS DOUBLE) END AS n_chars,
               text
        FROM documents
    """,
    "quarantined_records": """
        SELECT CASE WHEN lang = 'es' THEN 'damaged' ELSE lang END AS lang, count(*) AS n_records
        FROM documents GROUP BY ALL
    """,
    "snapshot_rewrite": UPSERTED,
    "snapshot_append": UPSERTED,
    "evolved_overwrite": f"""
        WITH {SITES}
        SELECT country, CAST(NULL AS VARCHAR) AS state, brewery_type, count(*) AS brewery_count
        FROM sites GROUP BY country, brewery_type
    """,
    "partitioned_overwrite": f"""
        WITH {SITES}
        SELECT lpad(CAST(length(state) % 3 AS VARCHAR), 2, '0') AS zone, country,
               count(*) AS brewery_count
        FROM sites GROUP BY ALL
    """,
    "schema_refused": """
        SELECT field, problem, (SELECT count(*) FROM customer) AS n_rows
        FROM (VALUES ('name', 'missing'), ('longitude', 'type'), ('more', 'extra'))
             AS report(field, problem)
    """,
    "stamped_now": f"""
        WITH {SITES}
        SELECT country, count(*) AS brewery_count, true AS stamped FROM sites GROUP BY country
    """,
    "raw_json_pages": f"""
        WITH {SITES} SELECT id, name, longitude FROM sites
    """,
    "salvaged_pages": f"""
        WITH {SITES},
        placed AS (
            SELECT id, name, city, row_number() OVER (ORDER BY id) - 1 AS spot FROM sites
        ),
        paged AS (
            SELECT *, spot // 200 + 1 AS page, spot % 200 + 1 AS place,
                   count(*) OVER (PARTITION BY spot // 200) AS n
            FROM placed
        )
        SELECT id, name, city FROM paged WHERE NOT (page % 2 = 1 AND n >= 150 AND place >= 150)
    """,
    "raw_drift": f"""
        WITH {SITES},
        runs AS (
            SELECT '2024_01_02_00_00_00_000000' AS second,
                   '2024_01_03_00_00_00_000000' AS third, count(*) AS n,
                   count(*) FILTER (country = 'ASIA') AS n_asia
            FROM sites
        )
        SELECT second AS run, 'longitude' AS field, 'changed' AS problem, 'string' AS kinds,
               'number' AS before, n AS n_records
        FROM runs WHERE n > 0
        UNION ALL
        SELECT second, 'rating', 'undeclared', 'number', NULL, n_asia FROM runs WHERE n_asia > 0
        UNION ALL
        SELECT third, 'longitude', 'changed', 'number', 'string', n FROM runs WHERE n > 0
        UNION ALL
        SELECT third, 'name', 'absent', NULL, 'string', 0 FROM runs WHERE n > 0
    """,
    "saved_watermark": f"""
        WITH {KEYED_EVENTS}
        SELECT 'incremental' AS mode, mark, (SELECT max(key) FROM keyed) AS max_id FROM mark
    """,
    "paged_full_load": f"""
        WITH {SITES}
        SELECT id, name, longitude, (SELECT max(id) FROM sites) AS next_mark FROM sites
    """,
    "paged_incremental_load": f"""
        WITH {KEYED_EVENTS}
        SELECT key, event_type, value, (SELECT max(key) FROM keyed) AS next_mark
        FROM keyed WHERE key > (SELECT mark FROM mark)
    """,
    "layered_flow": f"""
        WITH {SITES},
        moved AS (SELECT * REPLACE ({MOVED} AS brewery_type) FROM sites)
        SELECT country, state, city, brewery_type, count(*) AS brewery_count
        FROM moved GROUP BY country, state, city, brewery_type
    """,
    "delta_mart": f"""
        WITH {SITES},
        moved AS (SELECT * REPLACE ({MOVED} AS brewery_type) FROM sites)
        SELECT country, state, city, brewery_type, count(*) AS brewery_count
        FROM moved GROUP BY country, state, city, brewery_type
    """,
    "merged_verification": f"WITH {SITES} {_report(REPORT_ROWS)}",
    "region_distribution": f"""
        WITH {SITES},
        counted AS (
            SELECT country, state, city, brewery_type,
                   grouping(country, state, city, brewery_type) AS level,
                   count(*) AS brewery_count
            FROM sites GROUP BY ROLLUP (country, state, city, brewery_type)
        )
        SELECT own.*, own.brewery_count / coalesce(above.brewery_count, own.brewery_count) AS share
        FROM counted own LEFT JOIN counted above
        ON above.level = 2 * own.level + 1
        AND (above.level >= 8 OR above.country IS NOT DISTINCT FROM own.country)
        AND (above.level >= 4 OR above.state IS NOT DISTINCT FROM own.state)
        AND (above.level >= 2 OR above.city IS NOT DISTINCT FROM own.city)
    """,
    "stream_upsert": f"""
        WITH {SITES}
        SELECT id, name, {MOVED} AS brewery_type, city, postal_code, country, longitude, state
        FROM sites
    """,
}
