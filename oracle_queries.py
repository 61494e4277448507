"""DuckDB statements that recompute each registered query from the same tables.

They follow FIXTURES.md and share nothing with the Spark code.
"""

from __future__ import annotations

AS_OF = "DATE '2004-01-01'"

MESSAGES = """
hearings AS (
  SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS f1, CAST(max(l_shipdate) AS DATE) AS f2
  FROM lineitem GROUP BY l_orderkey),
messages AS (
  SELECT 'C' || o_orderkey AS ddl_case_id,
    CAST(n_regionkey + 1 AS VARCHAR) AS state_code,
    CAST(n_nationkey + 1 AS VARCHAR) AS dist_code,
    CAST(o_custkey % 7 AS VARCHAR) AS court_no,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS judge_position,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
      WHEN 'HOUSEHOLD' THEN '4' WHEN 'MACHINERY' THEN '5' END AS type_name,
    substr(o_orderpriority, 1, 1) AS purpose_name,
    CASE WHEN o_orderkey % 97 = 0 THEN 'x' WHEN o_orderstatus = 'F' THEN '1'
      WHEN o_orderstatus = 'O' THEN '2' WHEN o_orderstatus = 'P' THEN '3' END AS disp_name,
    CASE WHEN o_orderkey % 101 = 0 THEN '2010-02-30' WHEN o_orderkey % 103 = 0 THEN '01/02/1999'
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_of_filing,
    CASE WHEN o_orderstatus = 'F' THEN strftime(f2, '%Y-%m-%d') ELSE '' END AS date_of_decision,
    strftime(f1, '%Y-%m-%d') AS date_first_list,
    strftime(f2, '%Y-%m-%d') AS date_last_list,
    CASE WHEN o_orderstatus = 'O' THEN strftime(f2 + INTERVAL 30 DAY, '%Y-%m-%d') END AS date_next_list,
    CASE o_orderkey % 5 WHEN 0 THEN '1 female' WHEN 1 THEN '0 male' WHEN 2 THEN '0 male'
      WHEN 3 THEN '-9998 unclear' END AS female_petitioner,
    CASE o_orderkey % 4 WHEN 0 THEN '1 female' WHEN 1 THEN '0 male'
      WHEN 2 THEN '-9999 missing name' END AS female_defendant
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN hearings ON o_orderkey = l_orderkey)
"""

KEYS = """
type_key(type_name, type_name_s) AS (
  VALUES (1, 'AUTOMOBILE'), (2, 'BUILDING'), (3, 'FURNITURE'), (4, 'HOUSEHOLD')),
disp_key(disp_name, disp_name_s) AS (VALUES (1, 'disposed'), (2, 'dismissed')),
purpose_key AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS purpose_name, min(o_orderpriority) AS purpose_name_s
  FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1),
state_key AS (
  SELECT CAST(r_regionkey + 1 AS INT) AS state_code, min(r_name) AS state_name
  FROM region WHERE r_regionkey <> 4 GROUP BY 1),
district_key AS (
  SELECT CAST(n_regionkey + 1 AS INT) AS state_code, CAST(n_nationkey + 1 AS INT) AS dist_code,
    min(n_name) AS district_name FROM nation GROUP BY 1, 2),
court_raw AS (
  SELECT CAST(n_regionkey + 1 AS INT) AS state_code, CAST(n_nationkey + 1 AS INT) AS dist_code,
    CAST(c.k AS INT) AS court_no, y.y AS year,
    'Court ' || c.k || ' of ' || n_name || ' (' || y.y || ')' AS court_name
  FROM nation, range(0, 6) AS c(k), range(2016, 2019) AS y(y)),
court_key AS (
  SELECT state_code, dist_code, court_no, court_name FROM (
    SELECT *, row_number() OVER (PARTITION BY state_code, dist_code, court_no
      ORDER BY year DESC, court_name) AS rn FROM court_raw) WHERE rn = 1)
"""


def _date(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN try_cast({c} AS DATE) END AS {c}"
    )


def _gender(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '1%' THEN 'female' WHEN {c} LIKE '0%' THEN 'male' ELSE 'unknown' END AS {c}"
    )


_CODES = ["state_code", "dist_code", "court_no", "type_name", "purpose_name", "disp_name"]
_DATES = ["date_of_filing", "date_of_decision", "date_first_list", "date_last_list", "date_next_list"]

TYPED = f"""
typed AS (
  SELECT ddl_case_id, {", ".join(f"try_cast({c} AS INT) AS {c}" for c in _CODES)}, judge_position,
    {", ".join(_date(c) for c in _DATES)},
    {_gender("female_petitioner")}, {_gender("female_defendant")}
  FROM messages)
"""

ENRICHED = """
enriched AS (
  SELECT t.*, coalesce(type_name_s, 'Unknown') AS type_name_s, coalesce(disp_name_s, 'Pending') AS disp_name_s,
    coalesce(purpose_name_s, 'Not Listed') AS purpose_name_s, coalesce(state_name, 'Unknown') AS state_name,
    coalesce(district_name, 'Unknown') AS district_name, coalesce(court_name, 'Unknown') AS court_name
  FROM typed t
  LEFT JOIN type_key USING (type_name) LEFT JOIN disp_key USING (disp_name)
  LEFT JOIN purpose_key USING (purpose_name) LEFT JOIN state_key USING (state_code)
  LEFT JOIN district_key d ON t.state_code = d.state_code AND t.dist_code = d.dist_code
  LEFT JOIN court_key c ON t.state_code = c.state_code AND t.dist_code = c.dist_code
    AND t.court_no = c.court_no)
"""

CLEANED = f"""
valid AS (
  SELECT * FROM enriched WHERE date_of_filing IS NOT NULL
    AND (date_of_decision IS NULL OR date_of_decision >= date_of_filing)),
aged AS (
  SELECT *, CAST(date_diff('day', date_of_filing, coalesce(date_of_decision, {AS_OF})) AS INT) AS age FROM valid),
cleaned AS (
  SELECT ddl_case_id, state_name, district_name, court_name, court_no, judge_position,
    type_name_s AS case_type, purpose_name_s AS purpose, disp_name_s AS disposal_type,
    {", ".join(_DATES)},
    CASE WHEN date_of_decision IS NULL THEN 0 ELSE 1 END AS is_resolved, age AS case_age_days,
    CASE WHEN age < 365 THEN 'Fast' WHEN age < 1095 THEN 'Medium' WHEN age < 2555 THEN 'Slow'
      ELSE 'Stuck' END AS delay_category,
    CAST(year(date_of_filing) AS INT) AS filing_year,
    CAST(date_diff('day', date_first_list, date_last_list) AS INT) AS hearing_span_days,
    female_petitioner AS petitioner_gender, female_defendant AS defendant_gender
  FROM aged)
"""

_FROM_CLEANED = "WITH " + ",".join([MESSAGES, KEYS, TYPED, ENRICHED, CLEANED])


def from_messages(sql: str) -> str:
    return f"WITH {MESSAGES} {sql}"


def from_typed(sql: str) -> str:
    return f"WITH {MESSAGES}, {TYPED} {sql}"


def from_cleaned(sql: str, *more: str) -> str:
    return ",".join([_FROM_CLEANED, *more]) + " " + sql


_TOTAL = "count(*) AS total_cases"
_RESOLVED = "CAST(sum(is_resolved) AS BIGINT) AS resolved_cases"
_PENDING = "CAST(count(*) - sum(is_resolved) AS BIGINT) AS pending_cases"
_RATE = "round(avg(is_resolved) * 100, 2) AS resolution_rate"
_AGE = "round(avg(case_age_days), 0) AS avg_case_age"
_DAYS = "round(avg(CASE WHEN is_resolved = 1 THEN case_age_days END), 0) AS avg_resolution_days"
_WORKLOAD = [_TOTAL, _RESOLVED, _PENDING, _RATE]
_CLEARANCE = [_TOTAL, _RESOLVED, _RATE, _DAYS]


def _summary(by: str, measures: list[str], order: str = "") -> str:
    return from_cleaned(f"SELECT {by}, {', '.join(measures)} FROM cleaned GROUP BY {by} {order}")


_LARGEST = "ORDER BY total_cases DESC"

SUMMARIES = {
    "yearly_summary": _summary("filing_year", _WORKLOAD + [_AGE], "ORDER BY filing_year"),
    "state_summary": _summary("state_name", _WORKLOAD + [_AGE], _LARGEST),
    "district_summary": _summary("state_name, district_name", _WORKLOAD + [_AGE], _LARGEST),
    "casetype_summary": _summary("case_type", _WORKLOAD + [_DAYS], _LARGEST),
    "delay_summary": from_cleaned(
        "SELECT delay_category, count(*) AS total_cases, "
        "round(count(*) / (SELECT count(*) FROM cleaned) * 100, 2) AS percentage "
        "FROM cleaned GROUP BY delay_category"
    ),
    "judge_summary": _summary("judge_position", _CLEARANCE, _LARGEST),
    "gender_summary": _summary("petitioner_gender", _CLEARANCE),
    "time_trends": from_cleaned(
        f"SELECT 'yearly' AS period_type, CAST(filing_year AS VARCHAR) AS period_value, {', '.join(_WORKLOAD)} "
        "FROM cleaned GROUP BY filing_year UNION ALL "
        f"SELECT 'monthly', strftime(date_of_filing, '%Y-%m'), {', '.join(_WORKLOAD)} "
        "FROM cleaned GROUP BY strftime(date_of_filing, '%Y-%m')"
    ),
    "disposal_summary": _summary("disposal_type", [_TOTAL, _AGE, _DAYS], _LARGEST),
    "hearing_span_summary": from_cleaned(
        "SELECT case_type, delay_category, count(*) AS total_cases, "
        "round(avg(hearing_span_days), 0) AS avg_hearing_span_days, "
        "max(hearing_span_days) AS max_hearing_span_days "
        "FROM cleaned WHERE hearing_span_days IS NOT NULL GROUP BY ALL ORDER BY total_cases DESC"
    ),
    "defendant_gender_summary": _summary("defendant_gender", _CLEARANCE),
    "oldest_pending_cases": from_cleaned(
        "SELECT ddl_case_id, state_name, district_name, court_name, case_type, date_of_filing, case_age_days, "
        "delay_category FROM cleaned WHERE is_resolved = 0 ORDER BY case_age_days DESC, ddl_case_id LIMIT 50"
    ),
    "casetype_delay_crosstab": from_cleaned(
        "SELECT case_type, "
        + ", ".join(f"count(*) FILTER (delay_category = '{c}') AS {c}" for c in ["Fast", "Medium", "Slow", "Stuck"])
        + ", count(*) AS total_cases FROM cleaned GROUP BY case_type ORDER BY total_cases DESC"
    ),
}

_QUALITY = (
    "SELECT count(*) AS total_received, count(*) FILTER (ok) AS valid_records, "
    "CAST(0 AS BIGINT) AS null_records, CAST(0 AS BIGINT) AS duplicate_records, "
    "count(*) FILTER (NOT ok) AS impossible_dates FROM (SELECT date_of_filing IS NOT NULL AND "
    "(date_of_decision IS NULL OR date_of_decision >= date_of_filing) AS ok FROM typed)"
)

_MESSAGE_ROWS = from_messages("SELECT * FROM messages")
_CLEANED_ROWS = from_cleaned("SELECT * FROM cleaned")

# The columns of the given tables, for the profile.
TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
_MESSAGE_COLUMNS = (
    "ddl_case_id state_code dist_code court_no judge_position type_name purpose_name disp_name "
    "date_of_filing date_of_decision date_first_list date_last_list date_next_list "
    "female_petitioner female_defendant"
)


def _profile() -> str:
    parts = []
    for table, columns in {**TABLE_COLUMNS, "messages": _MESSAGE_COLUMNS}.items():
        names = columns.split()
        parts += [
            f"SELECT '{table}' AS table_name, count(*) AS row_count, {len(names)} AS column_count, "
            f"{i} AS position, '{c}' AS column_name, count(*) - count({c}) AS nulls FROM {table}"
            for i, c in enumerate(names)
        ]
    return from_messages(" UNION ALL ".join(parts))


def _profile_files() -> str:
    """Counts of each table, and of its first row by all columns the texts and whole numbers; then the two sources that cannot be read."""
    parts = []
    for table, columns in TABLE_COLUMNS.items():
        names = columns.split()
        order = ", ".join(f"{c} ASC NULLS FIRST" for c in names)
        parts += [
            f"SELECT '{table}' AS table_name, 'ok' AS status, (SELECT count(*) FROM {table}) AS row_count, {len(names)} AS column_count, "
            f"{i} AS position, '{c}' AS column_name, (SELECT count(*) - count({c}) FROM {table}) AS nulls, "
            f"(SELECT CASE WHEN typeof({c}) IN ('VARCHAR', 'INTEGER', 'BIGINT') THEN CAST({c} AS VARCHAR) END FROM {table} "
            f"ORDER BY {order} LIMIT 1) AS first_value"
            for i, c in enumerate(names)
        ]
    parts += [f"SELECT '{name}', '{status}', NULL, NULL, NULL, NULL, NULL, NULL" for name, status in
              [("nothing", "missing"), ("case_files", "unreadable")]]
    return " UNION ALL ".join(parts)


_FILE_YEAR = (
    "CAST(CASE WHEN date_of_filing LIKE '__/%' THEN substr(date_of_filing, 7, 4) "
    "ELSE substr(date_of_filing, 1, 4) END AS INT)"
)
_WORKLOAD = ["total_cases", "resolved_cases", "pending_cases", "resolution_rate"]
_CLEARANCE = ["total_cases", "resolved_cases", "resolution_rate", "avg_resolution_days"]
_FILES = from_messages(
    "SELECT "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in _MESSAGE_COLUMNS.split())
    + f", {_FILE_YEAR} AS file_year FROM messages"
)
_RAW = """
raw AS (
  SELECT * REPLACE (nullif(date_of_decision, '') AS date_of_decision),
    try_cast(date_of_filing AS DATE) AS filing_date_parsed,
    try_cast(date_of_decision AS DATE) AS decision_date_parsed FROM messages)
"""
_IS_RESOLVED = (
    "(decision_date_parsed >= filing_date_parsed AND try_cast(state_code AS INT) > 0 "
    "AND try_cast(disp_name AS INT) > 0)"
)
_IS_PENDING = (
    "(date_of_decision IS NULL AND filing_date_parsed IS NOT NULL AND try_cast(state_code AS INT) > 0)"
)


def from_raw(sql: str) -> str:
    return f"WITH {MESSAGES}, {_RAW} {sql}"


# The columns that name a row of a summary table, and its measures.
_SHAPES = {
    "yearly_summary": (["filing_year"], _WORKLOAD + ["avg_case_age"]),
    "state_summary": (["state_name"], _WORKLOAD + ["avg_case_age"]),
    "district_summary": (["state_name", "district_name"], _WORKLOAD + ["avg_case_age"]),
    "casetype_summary": (["case_type"], _WORKLOAD + ["avg_resolution_days"]),
    "delay_summary": (["delay_category"], ["total_cases", "percentage"]),
    "judge_summary": (["judge_position"], _CLEARANCE),
    "gender_summary": (["petitioner_gender"], _CLEARANCE),
    "time_trends": (["period_type", "period_value"], _WORKLOAD),
    "disposal_summary": (["disposal_type"], ["total_cases", "avg_case_age", "avg_resolution_days"]),
    "hearing_span_summary": (
        ["case_type", "delay_category"], ["total_cases", "avg_hearing_span_days", "max_hearing_span_days"]
    ),
    "defendant_gender_summary": (["defendant_gender"], _CLEARANCE),
    "oldest_pending_cases": (
        ["ddl_case_id", "state_name", "district_name", "court_name", "case_type", "date_of_filing", "delay_category"],
        ["case_age_days"],
    ),
    "casetype_delay_crosstab": (["case_type"], ["Fast", "Medium", "Slow", "Stuck", "total_cases"]),
}


def _text(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


def _cells() -> str:
    """Every cell of all summary tables."""
    parts = []
    for name, sql in SUMMARIES.items():
        keys, measures = _SHAPES[name]
        names = ", ".join(f"'{m}'" for m in measures)
        values = ", ".join(f"CAST({m} AS DOUBLE)" for m in measures)
        parts.append(
            f"SELECT '{name}' AS table_name, {_text(keys)} AS row_key, unnest([{names}]) AS measure, "
            f"unnest([{values}]) AS value FROM ({sql})"
        )
    return " UNION ALL ".join(parts)


CLEANING = {
    "read_yearly_csv": _FILES,
    "published_per_year": f"SELECT file_year, count(*) AS published FROM ({_FILES}) GROUP BY file_year",
    "all_summaries": _cells(),
    "export_summaries": _cells(),
    "resolved_pool": from_raw(
        "SELECT *, CAST(date_diff('day', filing_date_parsed, decision_date_parsed) AS INT) AS duration_days "
        f"FROM raw WHERE {_IS_RESOLVED}"
    ),
    "resolved_sample": from_raw(
        "SELECT ddl_case_id, filing_date_parsed, decision_date_parsed, "
        "CAST(date_diff('day', filing_date_parsed, decision_date_parsed) AS INT) AS duration_days "
        f"FROM raw WHERE {_IS_RESOLVED} ORDER BY ddl_case_id LIMIT 3"
    ),
    "pending_pool": from_raw(f"SELECT * FROM raw WHERE {_IS_PENDING}"),
    "cleaning_profile": from_raw(
        f"SELECT count(*) AS raw_rows, count(*) FILTER ({_IS_RESOLVED}) AS resolved_rows, "
        f"count(*) FILTER ({_IS_PENDING}) AS pending_rows FROM raw"
    ),
    "profile_tables": _profile(),
    "profile_files": _profile_files(),
    "profile_first_row": from_messages("SELECT * FROM messages ORDER BY ddl_case_id LIMIT 1"),
    "json_roundtrip": _MESSAGE_ROWS,
    "publish_cases": _MESSAGE_ROWS,
    "dedupe_keys": (
        f"WITH {KEYS} SELECT 'type' AS key_table, CAST(NULL AS INT) AS state_code, type_name AS code, "
        "type_name_s AS name FROM type_key "
        "UNION ALL SELECT 'disposition', NULL, * FROM disp_key UNION ALL SELECT 'purpose', NULL, * FROM purpose_key "
        "UNION ALL SELECT 'state', NULL, * FROM state_key UNION ALL SELECT 'district', * FROM district_key"
    ),
    "court_key_latest": f"WITH {KEYS} SELECT * FROM court_key",
    "typed_cases": from_typed("SELECT * FROM typed"),
    "gender_clean": from_typed("SELECT ddl_case_id, female_petitioner, female_defendant FROM typed"),
    "enriched_cases": from_cleaned("SELECT * FROM enriched"),
    "valid_cases": from_cleaned("SELECT * FROM valid"),
    "derived_features": from_cleaned(
        "SELECT ddl_case_id, is_resolved, case_age_days, delay_category, filing_year, hearing_span_days FROM cleaned"
    ),
    "cases_cleaned": _CLEANED_ROWS,
    "stream_cases_cleaned": _CLEANED_ROWS,
    "data_quality": from_typed(_QUALITY),
    "stream_quality_log": from_typed(_QUALITY),
    "run_counters": from_cleaned(
        "SELECT count(*) AS total_cases, count(*) FILTER (is_resolved = 1) AS resolved_cases, "
        "count(*) FILTER (is_resolved = 0) AS pending_cases FROM cleaned"
    ),
}


# Messages that come twice, or are cut off.
_SENT = """
judged AS (
  SELECT t.ddl_case_id, CASE WHEN CAST(substr(m.ddl_case_id, 2) AS BIGINT) % 89 = 0 THEN 'malformed'
      WHEN t.date_of_filing IS NULL AND m.date_of_filing <> '' THEN 'unreadable filing date'
      WHEN t.date_of_filing IS NULL THEN 'no filing date'
      WHEN t.date_of_decision < t.date_of_filing THEN 'decided before filing' END AS problem,
    unnest(CASE WHEN CAST(substr(m.ddl_case_id, 2) AS BIGINT) % 7 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM messages m JOIN typed t USING (ddl_case_id))
"""
CLEANING["stream_problems"] = from_typed(
    f", {_SENT} SELECT " + ", ".join(
        f"count(*) FILTER (problem = '{name}') AS {name.replace(' ', '_')}"
        for name in ["malformed", "unreadable filing date", "no filing date", "decided before filing"]
    ) + ", CAST(count(*) FILTER (copy = 1 AND problem IS DISTINCT FROM 'malformed') AS BIGINT) AS repeated_ids FROM judged"
)
CLEANING["stream_quarantine"] = from_typed(
    f", {_SENT} SELECT CASE WHEN problem <> 'malformed' THEN ddl_case_id END AS ddl_case_id, problem, "
    "CASE WHEN problem = 'malformed' THEN 40 END AS size FROM judged WHERE problem IS NOT NULL"
)


_SPLIT = """
parts AS (
  SELECT *, CASE WHEN filing_year <= 1998 THEN 'train' WHEN filing_year <= 2000 THEN 'validation'
    ELSE 'test' END AS split FROM cleaned WHERE filing_year IS NOT NULL)
"""
_LABELS = """
found AS (
  SELECT DISTINCT 'judge_position' AS label_column, coalesce(judge_position, 'unknown') AS label
    FROM parts WHERE split = 'train'
  UNION ALL
  SELECT DISTINCT 'case_type', coalesce(case_type, 'unknown') FROM parts WHERE split = 'train'),
labels_fitted AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY label_column ORDER BY label) - 1 AS INT) AS code FROM found)
"""
_FEATURED = """
calendar AS (
  SELECT *, CAST(month(date_of_filing) AS INT) AS filing_month,
    CAST(isodow(date_of_filing) - 1 AS INT) AS filing_day_of_week,
    CASE delay_category WHEN 'Fast' THEN 0 WHEN 'Medium' THEN 1 WHEN 'Slow' THEN 2 WHEN 'Stuck' THEN 3 END
      AS delay_cat_encoded,
    CASE petitioner_gender WHEN 'female' THEN 1 WHEN 'male' THEN 0 WHEN 'unknown' THEN -1 END AS gender_encoded
  FROM parts),
featured AS (
  SELECT ddl_case_id, split, is_resolved, filing_year, filing_month, filing_day_of_week,
    coalesce(hearing_span_days, 0) AS hearing_span_days, delay_cat_encoded, gender_encoded,
    coalesce(j.code, -1) AS judge_encoded, coalesce(t.code, -1) AS case_type_encoded
  FROM calendar c
  LEFT JOIN labels_fitted j ON j.label_column = 'judge_position'
    AND j.label = coalesce(c.judge_position, 'unknown')
  LEFT JOIN labels_fitted t ON t.label_column = 'case_type' AND t.label = coalesce(c.case_type, 'unknown'))
"""
_FEATURES = (
    "filing_year filing_month filing_day_of_week hearing_span_days delay_cat_encoded gender_encoded "
    "judge_encoded case_type_encoded"
).split()
_SEARCH = (
    "hearing_span_days, case_type_encoded, judge_encoded, filing_month, filing_day_of_week, filing_year, "
    "delay_cat_encoded, gender_encoded"
)
_DISTANCE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _FEATURES)


def _hash(*parts: str) -> str:
    text = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return (
        f"(CAST(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT) AS DOUBLE) "
        "/ CAST(4294967296 AS DOUBLE))"
    )


def _between(c: str) -> str:
    value = (
        f"(CAST(a.{c} AS DOUBLE) + way * (CAST(coalesce(b.{c}, a.{c}) AS DOUBLE) - CAST(a.{c} AS DOUBLE)))"
    )
    if c == "hearing_span_days":
        return f"{value} AS {c}"
    return f"CAST(CAST(trunc({value}) AS BIGINT) AS DOUBLE) AS {c}"


# The smaller class of the training rows is the resolved one on the given tables.
_SMOTE = f"""
train AS (SELECT * FROM featured WHERE split = 'train'),
points AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY {_SEARCH}) - 1 AS point,
    coalesce(sum(copies) OVER (ORDER BY {_SEARCH} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_row
  FROM (SELECT {_SEARCH}, count(*) AS copies FROM train WHERE is_resolved = 1 GROUP BY ALL)),
near AS (
  SELECT point, place, near, copies FROM (
    SELECT a.point, b.point AS near, b.copies,
      row_number() OVER (PARTITION BY a.point ORDER BY {_DISTANCE}, b.point) AS place
    FROM points a JOIN points b ON a.point <> b.point) WHERE place <= 5),
choices AS (
  SELECT point, near, row_number() OVER (PARTITION BY point ORDER BY place, i) - 1 AS slot FROM (
    SELECT point, near, place, unnest(range(0, least(copies, 5))) AS i FROM near
    UNION ALL SELECT point, point, 0, unnest(range(0, least(copies - 1, 5))) FROM points)
  QUALIFY slot < 5),
sizes AS (SELECT point, count(*) AS n FROM choices GROUP BY point),
need AS (
  SELECT count(*) FILTER (is_resolved = 1) AS have,
    count(*) FILTER (is_resolved = 0) - count(*) FILTER (is_resolved = 1) AS want FROM train),
made AS (
  SELECT p.point, unnest(range(0, CAST(p.copies * (want // have)
    + greatest(0, least(p.copies, want % have - first_row)) AS BIGINT))) AS copy FROM points p, need),
drawn AS (
  SELECT m.point, CAST(floor({_hash("42", "'slot'", "m.point", "copy")} * n) AS BIGINT) AS slot,
    {_hash("42", "'way'", "m.point", "copy")} AS way
  FROM made m LEFT JOIN sizes s ON s.point = m.point)
SELECT {", ".join(_between(c) for c in _FEATURES)}, 1 AS is_resolved, 1 AS synthetic
FROM drawn d JOIN points a ON a.point = d.point
LEFT JOIN choices c ON c.point = d.point AND c.slot = d.slot
LEFT JOIN points b ON b.point = c.near
UNION ALL SELECT {", ".join(f"CAST({c} AS DOUBLE)" for c in _FEATURES)}, is_resolved, 0 FROM train
"""
_SCORED = """
scored AS (
  SELECT is_resolved, case_age_days, ((coalesce(hearing_span_days, 0) * 7 + filing_month * 13) % 101) / 100 AS score,
    CAST(filing_month * 30 + 900 AS DOUBLE) AS days
  FROM calendar WHERE split = 'test'),
called AS (SELECT *, score >= 0.5 AS called FROM scored)
"""
_TRAINING = (
    "ddl_case_id case_age_days filing_year hearing_span_days delay_category judge_position case_type "
    "petitioner_gender date_of_filing is_resolved"
).split()
_DIGEST = "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _TRAINING) + "))"
_CANDIDATES = (
    "ddl_case_id, state_name, district_name, case_type, date_of_filing, date_next_list, case_age_days, "
    "delay_category, petitioner_gender, disposal_type, judge_position, hearing_span_days, filing_year"
)
_PENDING_ROWS = "FROM cleaned WHERE is_resolved = 0 AND date_next_list IS NOT NULL"

LEARNING = {
    "temporal_split": from_cleaned("SELECT ddl_case_id, filing_year, split FROM parts", _SPLIT),
    "fallback_split": from_cleaned(
        "SELECT ddl_case_id, CASE WHEN draw < 0.70 THEN 'train' WHEN draw < 0.85 THEN 'validation' "
        f"ELSE 'test' END AS split FROM (SELECT ddl_case_id, {_hash('42', 'ddl_case_id')} AS draw FROM cleaned)"
    ),
    "distinct_years": from_cleaned(
        "SELECT DISTINCT filing_year FROM cleaned WHERE filing_year IS NOT NULL ORDER BY filing_year"
    ),
    "yearly_cap": from_cleaned(
        f"SELECT {', '.join(_TRAINING)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY filing_year ORDER BY {_DIGEST}) AS rn FROM cleaned) WHERE rn <= 1000"
    ),
    "class_distribution": from_cleaned(
        "SELECT is_resolved, count(*) AS cases FROM parts WHERE split = 'train' "
        "GROUP BY is_resolved ORDER BY cases DESC",
        _SPLIT,
    ),
    "label_encode": from_cleaned("SELECT * FROM labels_fitted", _SPLIT, _LABELS),
    "ml_features": from_cleaned(
        f"SELECT ddl_case_id, split, {', '.join(_FEATURES)} FROM featured", _SPLIT, _LABELS, _FEATURED
    ),
    "smote_balance": ",".join([_FROM_CLEANED, _SPLIT, _LABELS, _FEATURED, _SMOTE]),
    "classification_metrics": from_cleaned(
        "SELECT round(count(*) FILTER ((is_resolved = 1) = called) / count(*), 4) AS accuracy, "
        "round(coalesce(count(*) FILTER (is_resolved = 1 AND called) / nullif(count(*) FILTER (called), 0), 0), 4) "
        "AS precision, "
        "round(coalesce(count(*) FILTER (is_resolved = 1 AND called) / "
        "nullif(count(*) FILTER (is_resolved = 1), 0), 0), 4) AS recall, "
        "round(coalesce(2 * count(*) FILTER (is_resolved = 1 AND called) / "
        "nullif(count(*) FILTER (is_resolved = 1) + count(*) FILTER (called), 0), 0), 4) AS f1_score, "
        "(SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)"
        " / count(*), 4) FROM called p, called n WHERE p.is_resolved = 1 AND n.is_resolved = 0) AS roc_auc "
        "FROM called",
        _SPLIT, _LABELS, _FEATURED, _SCORED,
    ),
    "regression_metrics": from_cleaned(
        "SELECT round(avg(abs(days - case_age_days)), 2) AS mae, "
        "round(sqrt(avg((days - case_age_days) ** 2)), 2) AS rmse, "
        "round(1 - avg((days - case_age_days) ** 2) / var_pop(case_age_days), 4) AS r2_score "
        "FROM scored WHERE is_resolved = 1",
        _SPLIT, _LABELS, _FEATURED, _SCORED,
    ),
    "pending_candidates": from_cleaned(f"SELECT {_CANDIDATES} {_PENDING_ROWS}"),
    "lineup_outcome": from_cleaned(
        "SELECT ddl_case_id, (case_age_days % 101) / 100 AS score, CASE WHEN (case_age_days % 101) / 100 >= 0.5 "
        f"THEN 'DISPOSE' ELSE 'ADJOURN' END AS predicted_outcome {_PENDING_ROWS}"
    ),
}


def _run_cells() -> str:
    """Every cell of the tables of a whole run; of the tables of the models, the number of rows."""
    columns = (
        "ddl_case_id, state_name, district_name, court_name, court_no, judge_position, case_type, purpose, disposal_type, "
        "date_of_filing, date_of_decision, date_first_list, date_last_list, date_next_list, is_resolved, case_age_days, "
        "delay_category, filing_year, hearing_span_days, petitioner_gender, defendant_gender"
    ).split(", ")
    rows = f"SELECT 'cases_cleaned', {_text(columns)}, 'row', CAST(1 AS DOUBLE) FROM ({_CLEANED_ROWS})"
    counts = {
        "daily_lineup": f"SELECT count(*) FROM ({LEARNING['pending_candidates']})",
        "shap_values": f"SELECT count(*) FROM ({LEARNING['temporal_split']}) WHERE split = 'test'",
    }
    fixed = {"model_comparison": 6, "feature_importance": 8, "shap_summary": 8, "model_registry": 1}
    counts.update({name: f"SELECT {n}" for name, n in fixed.items()})
    sizes = [f"SELECT '{name}', '', 'rows', CAST(({sql}) AS DOUBLE)" for name, sql in counts.items()]
    return " UNION ALL ".join([_cells(), rows, *sizes])


# The bins of a fit with 16 of them, and the gradients of its first round: classes weigh the same, so each row has half its weight.
_BINS = f"""
train AS (SELECT * FROM featured WHERE split = 'train'),
valued AS (
  UNPIVOT (SELECT is_resolved, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FEATURES)} FROM train)
  ON {", ".join(_FEATURES)} INTO NAME feature VALUE x),
counted AS (SELECT feature, x, count(*) AS n FROM valued GROUP BY ALL),
placed AS (
  SELECT feature, x, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS place, sum(n) OVER (PARTITION BY feature) AS whole,
    count(*) OVER (PARTITION BY feature) AS different
  FROM counted),
cuts AS (
  SELECT feature, max(x) AS cut FROM placed
  GROUP BY feature, CASE WHEN different <= 16 THEN place ELSE floor(before * 16 / whole) END)
"""
_PLACES = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_FEATURES)) + " END"
_GAINS = f"""
classes AS (
  SELECT greatest(1, sum(is_resolved) / sum(1 - is_resolved)) AS weight_0,
    greatest(1, sum(1 - is_resolved) / sum(is_resolved)) AS weight_1 FROM train),
sloped AS (
  SELECT feature, x, CASE WHEN is_resolved = 1 THEN weight_1 * (0.5 - 1) ELSE weight_0 * 0.5 END AS g,
    CASE WHEN is_resolved = 1 THEN weight_1 ELSE weight_0 END * 0.25 AS h
  FROM valued, classes),
histogram AS (
  SELECT feature, (SELECT min(cut) FROM cuts c WHERE c.feature = s.feature AND c.cut >= s.x) AS cut, count(*) AS n, sum(g) AS g, sum(h) AS h
  FROM sloped s GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER upto AS left_n, sum(g) OVER upto AS left_g, sum(h) OVER upto AS left_h, sum(n) OVER whole AS all_n,
    sum(g) OVER whole AS all_g, sum(h) OVER whole AS all_h
  FROM histogram WINDOW upto AS (PARTITION BY feature ORDER BY cut), whole AS (PARTITION BY feature)),
gains AS (
  SELECT *, CASE WHEN least(left_n, all_n - left_n) >= 20 THEN left_g ** 2 / (left_h + 1)
    + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g ** 2 / (all_h + 1) END AS gain FROM running),
best AS (SELECT * FROM gains WHERE gain > 1e-9 ORDER BY round(gain, 9) DESC, {_PLACES}, cut LIMIT 1)
"""
_FIT = [_SPLIT, _LABELS, _FEATURED, _BINS]

# The leaves of the fixed ensembles: value, and for each of the two features the interval and the share of rows that goes there.
_FIXED_LEAVES = """
leaves AS (
  SELECT * FROM (VALUES
    ('Fixed', 'hearing_span_days', -1e9, 60, 0.4, 'delay_cat_encoded', -1e9, 1, 0.625, -0.5),
    ('Fixed', 'hearing_span_days', -1e9, 60, 0.4, 'delay_cat_encoded', 1, 1e9, 0.375, 0.3),
    ('Fixed', 'hearing_span_days', 60, 1e9, 0.6, 'filing_month', -1e9, 6, 0.6, 0.1),
    ('Fixed', 'hearing_span_days', 60, 1e9, 0.6, 'filing_month', 6, 1e9, 0.4, 0.7),
    ('Fixed', 'judge_encoded', -1e9, 2, 0.6, 'gender_encoded', -1e9, -1, 0.25, 0.2),
    ('Fixed', 'judge_encoded', -1e9, 2, 0.6, 'gender_encoded', -1, 1e9, 0.75, -0.4),
    ('Fixed', 'judge_encoded', 2, 1e9, 0.4, 'case_type_encoded', -1e9, 1, 0.625, 0.6),
    ('Fixed', 'judge_encoded', 2, 1e9, 0.4, 'case_type_encoded', 1, 1e9, 0.375, -0.1),
    ('Days', 'delay_cat_encoded', -1e9, 1, 0.5, 'filing_month', -1e9, 4, 0.4, -400),
    ('Days', 'delay_cat_encoded', -1e9, 1, 0.5, 'filing_month', 4, 1e9, 0.6, -150),
    ('Days', 'delay_cat_encoded', 1, 1e9, 0.5, 'filing_day_of_week', -1e9, 2, 0.2, 300),
    ('Days', 'delay_cat_encoded', 1, 1e9, 0.5, 'filing_day_of_week', 2, 1e9, 0.8, 700))
  AS t(model, f1, low1, high1, s1, f2, low2, high2, s2, value)),
tested AS (
  UNPIVOT (SELECT ddl_case_id, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FEATURES) + """
    FROM featured WHERE split = 'test') ON """ + ", ".join(_FEATURES) + """ INTO NAME feature VALUE x),
met AS (
  SELECT ddl_case_id, model, f1, f2, CAST(value AS DOUBLE) AS value, CAST(s1 AS DOUBLE) AS s1, CAST(s2 AS DOUBLE) AS s2,
    CASE WHEN a.x > low1 AND a.x <= high1 THEN 1 ELSE 0 END AS in1, CASE WHEN b.x > low2 AND b.x <= high2 THEN 1 ELSE 0 END AS in2
  FROM leaves JOIN tested a ON a.feature = f1 JOIN tested b USING (ddl_case_id) WHERE b.feature = f2),
margins AS (SELECT ddl_case_id, model, sum(value * in1 * in2) AS margin FROM met GROUP BY ALL),
called AS (
  SELECT m.ddl_case_id, 0.25 + margin AS margin, 1 / (1 + exp(-0.25 - margin)) AS score, 0.25 + margin > 0 AS called, p.is_resolved
  FROM margins m JOIN parts p USING (ddl_case_id) WHERE model = 'Fixed'),
days AS (
  SELECT 900 + margin AS days, CAST(p.case_age_days AS DOUBLE) AS age
  FROM margins m JOIN parts p USING (ddl_case_id) WHERE model = 'Days' AND p.is_resolved = 1)
"""
_COMPARED = """
  SELECT 'Fixed' AS model_name,
    round(count(*) FILTER ((is_resolved = 1) = called) / count(*), 4) AS accuracy,
    round(coalesce(count(*) FILTER (is_resolved = 1 AND called) / nullif(count(*) FILTER (called), 0), 0), 4) AS precision,
    round(coalesce(count(*) FILTER (is_resolved = 1 AND called) / nullif(count(*) FILTER (is_resolved = 1), 0), 0), 4) AS recall,
    round(coalesce(2 * count(*) FILTER (is_resolved = 1 AND called)
      / nullif(count(*) FILTER (is_resolved = 1) + count(*) FILTER (called), 0), 0), 4) AS f1_score,
    (SELECT round(sum(CASE WHEN round(p.score, 12) > round(n.score, 12) THEN 1.0 WHEN round(p.score, 12) = round(n.score, 12) THEN 0.5 ELSE 0 END)
      / count(*), 4) FROM called p, called n WHERE p.is_resolved = 1 AND n.is_resolved = 0) AS roc_auc,
    NULL AS mae, NULL AS rmse, NULL AS r2_score
  FROM called
  UNION ALL SELECT 'Fixed (Regression)', NULL, NULL, NULL, NULL, NULL, round(avg(abs(days - age)), 2),
    round(sqrt(avg((days - age) ** 2)), 2), round(1 - avg((days - age) ** 2) / var_pop(age), 4) FROM days
"""
_ATTRIBUTED = f"""
attributed AS (
  SELECT ddl_case_id, f1 AS feature, value * (in1 - s1) * (in2 + s2) / 2 AS phi FROM met WHERE model = 'Fixed'
  UNION ALL SELECT ddl_case_id, f2, value * (in2 - s2) * (in1 + s1) / 2 FROM met WHERE model = 'Fixed'
  UNION ALL SELECT ddl_case_id, feature, 0 FROM tested),
each_row AS (SELECT ddl_case_id, feature, sum(phi) AS phi FROM attributed GROUP BY ALL)
"""


# The features of the pending cases, under the name that the leaves of the fixed ensembles look for.
_PENDING_FEATURES = _FEATURED.replace("FROM parts)", "FROM cleaned WHERE is_resolved = 0 AND date_next_list IS NOT NULL)").replace(
    "ddl_case_id, split,", "ddl_case_id, 'test' AS split,"
) + f", pending AS (SELECT * {_PENDING_ROWS})"
_LINEUP_MARGINS = """
lineup_margins AS (
  SELECT ddl_case_id, 0.25 + sum(CASE WHEN model = 'Fixed' THEN value * in1 * in2 ELSE 0 END) AS margin,
    900 + sum(CASE WHEN model = 'Days' THEN value * in1 * in2 ELSE 0 END) AS days
  FROM met GROUP BY ddl_case_id)
"""
_FIXED_LINEUP = (
    "ddl_case_id, state_name, district_name, case_type, date_of_filing, date_next_list, case_age_days, delay_category, petitioner_gender, "
    "disposal_type, round(1 / (1 + exp(-margin)), 9) AS resolution_probability, "
    "CASE WHEN 1 / (1 + exp(-margin)) >= 0.5 THEN 'DISPOSE' ELSE 'ADJOURN' END AS predicted_outcome, "
    f"round(days, 9) AS predicted_days_remaining, {AS_OF} AS prediction_date"
)
_PLAIN_LINEUP = [
    "ddl_case_id", "state_name", "district_name", "case_type", "date_of_filing", "date_next_list", "case_age_days",
    "delay_category", "petitioner_gender", "disposal_type",
]
_LINEUP = from_cleaned(
    "SELECT " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in _PLAIN_LINEUP)
    + f", CAST({AS_OF} AS VARCHAR) AS prediction_date, true AS outcome_agrees {_PENDING_ROWS}"
)
MODELS = {
    "boosting_cuts": from_cleaned("SELECT feature, cut FROM cuts", *_FIT),
    "boosting_first_gains": from_cleaned(
        "SELECT feature, cut, n, round(g, 6) AS gradient, round(h, 6) AS curvature, round(gain, 6) AS gain FROM gains", *_FIT, _GAINS
    ),
    "boosting_first_tree": from_cleaned(
        "SELECT -1 AS tree, 0 AS node, NULL AS feature, NULL AS threshold, NULL AS \"left\", NULL AS \"right\", CAST(0 AS DOUBLE) AS value, "
        "NULL AS n_rows "
        "UNION ALL SELECT 0, 0, feature, cut, 1, 2, NULL, CAST(all_n AS BIGINT) FROM best "
        "UNION ALL SELECT 0, 1, NULL, NULL, NULL, NULL, round(-0.05 * left_g / (left_h + 1), 9), CAST(left_n AS BIGINT) FROM best "
        "UNION ALL SELECT 0, 2, NULL, NULL, NULL, NULL, round(-0.05 * (all_g - left_g) / (all_h - left_h + 1), 9), "
        "CAST(all_n - left_n AS BIGINT) FROM best",
        *_FIT, _GAINS,
    ),
    "feature_importance": from_cleaned(
        "SELECT DISTINCT c.feature, CAST(CASE WHEN b.feature IS NULL THEN 0 ELSE 1 END AS BIGINT) AS importance "
        "FROM cuts c LEFT JOIN best b ON b.feature = c.feature",
        *_FIT, _GAINS,
    ),
    "ensemble_scores": from_cleaned(
        "SELECT ddl_case_id, round(margin, 9) AS margin, round(score, 9) AS score, CAST(called AS INT) AS prediction, "
        "round(margin, 9) AS by_intervals FROM called",
        _SPLIT, _LABELS, _FEATURED, _FIXED_LEAVES,
    ),
    "model_comparison": from_cleaned(_COMPARED, _SPLIT, _LABELS, _FEATURED, _FIXED_LEAVES),
    "shapley_summary": from_cleaned(
        "SELECT feature, round(avg(abs(phi)), 9) AS mean_abs_shap FROM each_row GROUP BY feature",
        _SPLIT, _LABELS, _FEATURED, _FIXED_LEAVES, _ATTRIBUTED,
    ),
    "shapley_values": from_cleaned(
        "SELECT ddl_case_id, CAST(0 AS DOUBLE) AS missed FROM parts WHERE split = 'test'", _SPLIT
    ),
    "latest_model": (
        "SELECT r_name AS model_name, 'v' || r_regionkey AS model_version, make_date(2020, 1, 4) AS trained_on "
        "FROM region ORDER BY least(r_regionkey + 1, 4) DESC, 'v' || r_regionkey DESC LIMIT 1"
    ),
    "daily_lineup": _LINEUP,
    "export_lineup": _LINEUP,
    "fixed_lineup": from_cleaned(
        "SELECT " + _FIXED_LINEUP + " FROM pending JOIN lineup_margins USING (ddl_case_id)", _SPLIT, _LABELS, _PENDING_FEATURES, _FIXED_LEAVES, _LINEUP_MARGINS
    ),
    "lineup_counters": from_cleaned(
        "SELECT count(*) AS total_predictions, count(*) FILTER (1 / (1 + exp(-margin)) >= 0.5) AS dispose_count, "
        "count(*) FILTER (1 / (1 + exp(-margin)) < 0.5) AS adjourn_count FROM pending JOIN lineup_margins USING (ddl_case_id)",
        _SPLIT, _LABELS, _PENDING_FEATURES, _FIXED_LEAVES, _LINEUP_MARGINS,
    ),
}


def statements() -> dict[str, str]:
    return {**CLEANING, **SUMMARIES, **LEARNING, **MODELS, "end_to_end_run": _run_cells()}
