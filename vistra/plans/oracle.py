"""DuckDB SQL equal in meaning to each registered query.

The driver registers its tables as views; each statement re-derives the
fixtures (FIXTURES.md) as common table expressions and then states the
query in plain SQL.
"""

from __future__ import annotations

from vistra.schema import VISIT_COLUMNS

AVG_DIGITS = 6


def _timed(date: str, key: str) -> str:
    """A date with the time of day that the fixture derives from a key."""
    return f"({date} + to_seconds(({key} * 7919) % 86400) + to_microseconds(({key} * 104729) % 1000000))"


def _written(ts: str, key: str) -> str:
    forms = [
        "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f", "  %Y-%m-%d %H:%M:%S ", "%Y-%m-%d %H:%M", "%Y-%-m-%-d %-H:%M:%S",
        "%Y%m%d %H:%M:%S", "%-m/%-d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f789Z", "%Y-%m-%d %H:%M:%S+02:00",
    ]
    cases = " ".join(f"WHEN {i} THEN strftime({ts}, '{f}')" for i, f in enumerate(forms))
    return f"CASE {key} % 9 {cases} END"


def _visits_raw(missing_end: bool = False) -> str:
    end = _written(_timed("l_shipdate", "l_partkey"), "l_partkey")
    if missing_end:
        end = f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {end} END"
    return f"""visits_raw AS (
  SELECT o_orderkey AS visit_occurrence_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS person_id,
         l_partkey AS visit_concept_id,
         CASE WHEN o_orderkey % 89 = 0 THEN 'not-a-date'
              ELSE {_written(_timed("o_orderdate", "o_orderkey"), "o_orderkey")} END AS visit_start_datetime,
         {end} AS visit_end_datetime,
         l_linenumber AS visit_type_concept_id,
         CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS provider_id,
         CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_suppkey END AS care_site_id,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
              ELSE l_returnflag END AS visit_source_value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _parse_ts(col: str) -> str:
    """The accepted forms taken apart by their own patterns and put together from numbers."""
    t = f"trim({col}, ' ' || chr(9) || chr(10) || chr(13))"
    time = r"(?:[ T](\d{1,2}):(\d\d)(?::(\d\d)(?:\.(\d{1,6})\d{0,3})?)?(?:Z|([+-])(\d\d):?(\d\d))?)?"
    names = "'h', 'mi', 's', 'f', 'sign', 'zh', 'zm'"
    iso = f"regexp_extract({t}, '^(\\d{{4}})-(\\d{{1,2}})-(\\d{{1,2}}){time}$', ['y', 'm', 'd', {names}])"
    compact = f"regexp_extract({t}, '^(\\d{{4}})(\\d\\d)(\\d\\d){time}$', ['y', 'm', 'd', {names}])"
    slashed = f"regexp_extract({t}, '^(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}}){time}$', ['m', 'd', 'y', {names}])"

    def made(parts: str) -> str:
        n = lambda f: f"coalesce(try_cast(({parts}).{f} AS BIGINT), 0)"
        micros = f"try_cast(rpad(({parts}).f, 6, '0') AS BIGINT)"
        wall = f"make_timestamp({n('y')}, {n('m')}, {n('d')}, {n('h')}, {n('mi')}, {n('s')}::DOUBLE)"
        shift = f"CASE ({parts}).sign WHEN '-' THEN 1 WHEN '+' THEN -1 ELSE 0 END * ({n('zh')} * 60 + {n('zm')})"
        return f"CASE WHEN ({parts}).y <> '' THEN TRY({wall} + to_microseconds(coalesce({micros}, 0)) + to_minutes({shift})) END"

    return f"coalesce({made(iso)}, {made(compact)}, {made(slashed)})"


_DAYS = "(epoch_us(e) - epoch_us(s)) / 1e6 / 86400.0"

CLEAN = f"""parsed AS (
  SELECT visit_occurrence_id, person_id, visit_concept_id, visit_type_concept_id,
         provider_id, care_site_id, visit_source_value,
         {_parse_ts('visit_start_datetime')} AS s,
         {_parse_ts('visit_end_datetime')} AS e
  FROM visits_raw),
clean AS (
  SELECT visit_occurrence_id::BIGINT AS visit_occurrence_id,
         person_id::BIGINT AS person_id,
         visit_concept_id::BIGINT AS visit_concept_id,
         date_trunc('millisecond', s) AS visit_start_datetime,
         date_trunc('millisecond', e) AS visit_end_datetime,
         visit_type_concept_id::BIGINT AS visit_type_concept_id,
         coalesce(provider_id, -1)::BIGINT AS provider_id,
         coalesce(care_site_id, -1)::BIGINT AS care_site_id,
         coalesce(visit_source_value, 'UNKNOWN') AS visit_source_value,
         year(s)::INTEGER AS visit_year,
         month(s)::INTEGER AS visit_month,
         CASE WHEN {_DAYS} < 0 THEN 0.0 ELSE {_DAYS} END::DOUBLE AS visit_duration_days
  FROM parsed
  WHERE visit_occurrence_id IS NOT NULL AND person_id IS NOT NULL AND s IS NOT NULL),
valid AS (
  SELECT * FROM clean WHERE visit_duration_days >= 0 AND visit_year IS NOT NULL)"""

PERSON = """person_raw AS (
  SELECT CASE WHEN c_custkey % 17 = 0 THEN 'id-' || c_custkey::VARCHAR
              WHEN c_custkey % 5 = 0 THEN '  ' || c_custkey::VARCHAR || ' '
              ELSE c_custkey::VARCHAR END AS person_id,
         c_mktsegment AS gender_source_value,
         n_name AS race_source_value
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
person AS (
  SELECT TRY_CAST(trim(person_id) AS BIGINT) AS person_id, gender_source_value, race_source_value
  FROM person_raw WHERE TRY_CAST(trim(person_id) AS BIGINT) IS NOT NULL)"""

MONTHLY = f"""monthly AS (
  SELECT visit_year, visit_month, count(visit_occurrence_id) AS visit_count,
         avg(visit_duration_days) AS avg_duration_days
  FROM valid GROUP BY visit_year, visit_month)"""


def with_visits(body: str, missing_end: bool = False, person: bool = False, monthly: bool = False) -> str:
    ctes = [_visits_raw(missing_end), CLEAN]
    if person:
        ctes.append(PERSON)
    if monthly:
        ctes.append(MONTHLY)
    return "WITH " + ",\n".join(ctes) + "\n" + body


R = AVG_DIGITS

_RAW_TEXT_COLUMNS = {
    "visit_occurrence_id", "person_id", "visit_concept_id", "visit_start_datetime",
    "visit_end_datetime", "visit_type_concept_id", "provider_id", "care_site_id",
    "visit_source_value",
}


def _profile_sql() -> str:
    visit_rows = []
    for i, c in enumerate(VISIT_COLUMNS, start=1):
        nn = f"count({c})" if c in _RAW_TEXT_COLUMNS else "0"
        visit_rows.append(
            f"SELECT 'visit_occurrence' AS table_name, {i} AS ordinal, '{c}' AS column_name, "
            f"'string' AS data_type, count(*) AS row_count, {nn}::BIGINT AS non_nulls FROM visits_raw"
        )
    person_rows = [
        f"SELECT 'person' AS table_name, {i} AS ordinal, '{c}' AS column_name, "
        f"'string' AS data_type, count(*) AS row_count, count({c})::BIGINT AS non_nulls FROM person_raw"
        for i, c in enumerate(["person_id", "gender_source_value", "race_source_value"], start=1)
    ]
    return with_visits("\nUNION ALL\n".join(visit_rows + person_rows), person=True)


_FILL = """SELECT 'provider_id' AS column_name, count(*) FILTER (WHERE provider_id = -1) AS filled_rows FROM clean
UNION ALL SELECT 'care_site_id', count(*) FILTER (WHERE care_site_id = -1) FROM clean
UNION ALL SELECT 'visit_source_value', count(*) FILTER (WHERE visit_source_value = 'UNKNOWN') FROM clean"""

# Source values as the quoting query writes them; a missing one is UNKNOWN.
_QUOTED = """SELECT * REPLACE (CASE WHEN visit_source_value = 'UNKNOWN' THEN visit_source_value
  WHEN visit_type_concept_id % 4 = 0 THEN 'say "' || visit_source_value || '", ok'
  WHEN visit_type_concept_id % 4 = 1 THEN 'C:\\' || visit_source_value || '\\'
  WHEN visit_type_concept_id % 4 = 2 THEN '"' || visit_source_value || '"'
  ELSE visit_source_value END AS visit_source_value) FROM clean"""

_BROKEN = _QUOTED.replace("SELECT * REPLACE (CASE WHEN", "SELECT * REPLACE (CASE WHEN visit_type_concept_id % 7 = 3 THEN 'two' || chr(10) || 'lines' WHEN", 1)

_DROPPED = f"""SELECT unnest(['rows_read', 'no_visit_id', 'no_person_id', 'no_start', 'unreadable_start', 'dropped', 'kept_unreadable_end']) AS reason,
  unnest([count(*), count(*) FILTER (WHERE visit_occurrence_id IS NULL), count(*) FILTER (WHERE person_id IS NULL),
    count(*) FILTER (WHERE visit_start_datetime IS NULL), count(*) FILTER (WHERE visit_start_datetime IS NOT NULL AND s IS NULL),
    count(*) FILTER (WHERE visit_occurrence_id IS NULL OR person_id IS NULL OR s IS NULL),
    count(*) FILTER (WHERE visit_occurrence_id IS NOT NULL AND person_id IS NOT NULL AND s IS NOT NULL AND visit_end_datetime IS NOT NULL AND e IS NULL)
  ]) AS rows
FROM (SELECT *, {_parse_ts('visit_start_datetime')} AS s, {_parse_ts('visit_end_datetime')} AS e FROM visits_raw)"""

_MONTH = "visit_year::VARCHAR || '-' || lpad(visit_month::VARCHAR, 2, '0')"

_METRICS = f"""SELECT 'yearly' AS section, visit_year::VARCHAR AS item, count(*)::BIGINT AS value FROM valid GROUP BY visit_year
UNION ALL SELECT * FROM (VALUES ('shuffle_setting', '8', 1::BIGINT), ('shuffle_setting', '16', 1),
  ('chart', 'chart_visits_per_year', 1), ('chart', 'chart_mean_visits_per_month', 1), ('chart', 'chart_duration_by_period', 1),
  ('count', 'configurations', 2), ('count', 'bad_seconds', 0)) AS t(section, item, value)
UNION ALL SELECT 'monthly', {_MONTH}, visit_count FROM monthly
UNION ALL SELECT 'top_month', {_MONTH}, r FROM (
  SELECT *, dense_rank() OVER (PARTITION BY visit_year ORDER BY visit_count DESC) AS r FROM monthly) WHERE r <= 3"""

ORACLE: dict[str, str] = {
    "clean_visits": with_visits("SELECT * FROM clean"),
    "fill_missing": with_visits(_FILL),
    "valid_visits": with_visits("SELECT * FROM valid", missing_end=True),
    "valid_visit_count": with_visits("SELECT count(*) AS valid_visits FROM valid", missing_end=True),
    "person_dim": with_visits("SELECT * FROM person", person=True),
    "monthly_visits": with_visits(
        f"SELECT visit_year, visit_month, visit_count, round(avg_duration_days, {R}) AS avg_duration_days FROM monthly",
        monthly=True,
    ),
    "yearly_visits": with_visits(
        "SELECT visit_year, count(visit_occurrence_id) AS visit_count FROM valid GROUP BY visit_year ORDER BY visit_year"
    ),
    "yearly_rows": with_visits(
        "SELECT visit_year, count(*) AS visit_count FROM clean WHERE visit_year IS NOT NULL GROUP BY visit_year ORDER BY visit_year"
    ),
    "visits_person_left": with_visits(
        "SELECT v.*, p.gender_source_value, p.race_source_value FROM valid v LEFT JOIN person p ON v.person_id = p.person_id",
        person=True,
    ),
    "visits_by_gender": with_visits(
        """SELECT p.gender_source_value, count(v.visit_occurrence_id) AS visit_count
FROM valid v LEFT JOIN person p ON v.person_id = p.person_id
GROUP BY p.gender_source_value ORDER BY visit_count DESC, p.gender_source_value NULLS LAST""",
        person=True,
    ),
    "ranked_months": with_visits(
        f"""SELECT visit_year, visit_month, visit_count, round(avg_duration_days, {R}) AS avg_duration_days,
       dense_rank() OVER (PARTITION BY visit_year ORDER BY visit_count DESC)::INTEGER AS month_rank
FROM monthly""",
        monthly=True,
    ),
    "top_months": with_visits(
        f"""SELECT * FROM (
  SELECT visit_year, visit_month, visit_count, round(avg_duration_days, {R}) AS avg_duration_days,
         dense_rank() OVER (PARTITION BY visit_year ORDER BY visit_count DESC)::INTEGER AS month_rank
  FROM monthly) WHERE month_rank <= 3 ORDER BY visit_year, month_rank, visit_month""",
        monthly=True,
    ),
    "top_months_ties": with_visits(
        f"""SELECT * FROM (
  SELECT visit_year, visit_month, visit_count // 100 AS visit_count, round(avg_duration_days, {R}) AS avg_duration_days,
         dense_rank() OVER (PARTITION BY visit_year ORDER BY visit_count // 100 DESC)::INTEGER AS month_rank
  FROM monthly) WHERE month_rank <= 3 ORDER BY visit_year, month_rank, visit_month""",
        monthly=True,
    ),
    "chart_visits_per_year": with_visits(
        "SELECT visit_year, sum(visit_count)::BIGINT AS visit_count FROM monthly GROUP BY visit_year ORDER BY visit_year",
        monthly=True,
    ),
    "chart_mean_visits_per_month": with_visits(
        f"SELECT visit_month, round(avg(visit_count), {R}) AS mean_visit_count FROM monthly GROUP BY visit_month ORDER BY visit_month",
        monthly=True,
    ),
    "chart_duration_by_period": with_visits(
        f"""SELECT visit_year::VARCHAR || '-' || lpad(visit_month::VARCHAR, 2, '0') AS period,
       visit_year, visit_month, round(avg_duration_days, {R}) AS avg_duration_days
FROM monthly ORDER BY visit_year, visit_month""",
        monthly=True,
    ),
    "reconcile_yearly": with_visits(
        """SELECT coalesce(a.visit_year, b.visit_year) AS visit_year, a.visit_count AS all_rows, b.visit_count AS valid_visits
FROM (SELECT visit_year, count(*) AS visit_count FROM clean WHERE visit_year IS NOT NULL GROUP BY visit_year) a
FULL OUTER JOIN (SELECT visit_year, count(visit_occurrence_id) AS visit_count FROM valid GROUP BY visit_year) b
  ON a.visit_year IS NOT DISTINCT FROM b.visit_year
WHERE a.visit_count IS DISTINCT FROM b.visit_count""",
        missing_end=True,
    ),
    "table_profile": _profile_sql(),
    "sample_rows": with_visits(
        """SELECT * FROM clean ORDER BY visit_occurrence_id NULLS FIRST, visit_type_concept_id NULLS FIRST,
  visit_concept_id NULLS FIRST, person_id NULLS FIRST, provider_id NULLS FIRST, care_site_id NULLS FIRST,
  visit_source_value NULLS FIRST, visit_start_datetime NULLS FIRST, visit_end_datetime NULLS FIRST LIMIT 5"""
    ),
    "csv_ingest": with_visits(_QUOTED),
    "csv_ingest_utf16": with_visits(_QUOTED),
    "csv_ingest_line_breaks": with_visits(_BROKEN),
    "csv_ingest_utf16_line_breaks": with_visits(_BROKEN),
    "dropped_rows": with_visits(_DROPPED, missing_end=True),
    "malformed_rows": """SELECT 2 * count(*) FILTER (WHERE l_linenumber % 7 = 3) AS malformed_rows,
       count(*) + count(*) FILTER (WHERE l_linenumber % 7 = 3) AS rows
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "na_tokens": with_visits(_FILL + "\nUNION ALL SELECT 'clean_rows', count(*) FROM clean"),
    "detect_encoding": with_visits(
        """SELECT 'person_utf8' AS file_set, 'UTF-8' AS encoding, count(*) AS person_rows FROM person
UNION ALL SELECT 'person_utf16', 'UTF-16', count(*) FROM person""",
        person=True,
    ),
    "input_manifest": """SELECT * FROM (VALUES
  ('data', 'visit_occurrence_0.csv', true, true),
  ('data', 'visit_occurrence_1.csv', false, false),
  ('data', 'person.csv', true, true),
  ('data', 'total', false, true),
  ('absent', 'visit_occurrence_0.csv', false, false),
  ('absent', 'visit_occurrence_1.csv', false, false),
  ('absent', 'person.csv', false, false),
  ('absent', 'total', false, false)) AS t(folder, file_name, present, has_bytes)
WHERE EXISTS (SELECT 1 FROM lineitem) AND EXISTS (SELECT 1 FROM customer)""",
    "parquet_round_trip": with_visits("SELECT * FROM clean"),
    "run_metrics": with_visits(_METRICS, monthly=True),
    "shuffle_invariance": with_visits(
        """SELECT s AS shuffle_partitions, (SELECT count(*) FROM valid) AS valid_visits, true AS same_answer
FROM (VALUES (1), (8), (16)) AS t(s)"""
    ),
}

def _search() -> dict[str, str]:
    from vistra.plans.queries import SEARCH_GENERATIONS, SEARCH_POP, SWEEP_CONFIGS
    from vistra.plans.search_oracle import search_oracle

    return search_oracle(SEARCH_POP, SEARCH_GENERATIONS, SWEEP_CONFIGS)


ORACLE.update(_search())
