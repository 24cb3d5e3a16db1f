"""The same results as plain SQL over the given tables, computed without JSON, files or loads."""

from __future__ import annotations

from repo_pulse.operators.catalog import DEFAULT_TECHNOLOGIES
from repo_pulse.workload.derived import EVENT_TYPES, LINES_PER_ARCHIVE, REPOSITORIES

# Spelled out here, so that a name lost in the library is missed by the comparison.
_METRICS = (
    "event_count unique_actor_count push_count commit_count pull_request_count "
    "merged_pull_request_count issue_count star_count fork_count release_count"
).split()
_EVENT_MIX = (
    "push_count pull_request_count issue_count star_count fork_count release_count"
).split()
_GOLD_COLUMNS = "technology_id, activity_date, " + ", ".join(_METRICS)
_SILVER_FIELDS = (
    "event_id event_type event_date created_at actor_id actor_login repo_id repo_name org_id "
    "org_login action commit_count is_merged archive_hour"
).split()
_SILVER_COLUMNS = ", ".join([*_SILVER_FIELDS, "source_file", "source_line_number"])


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


_EV = f"""
ev AS (
  SELECT event_id AS n,
         CAST(event_id AS VARCHAR) AS event_id,
         ({_list(EVENT_TYPES)})[event_id % 8 + 1] AS event_type,
         CAST(ts AS DATE) AS event_date,
         ts AS created_at,
         user_id AS actor_id,
         'user-' || user_id AS actor_login,
         user_id % 16 AS repo_id,
         ({_list(REPOSITORIES)})[user_id % 16 + 1] AS repo_name,
         CASE WHEN event_id % 3 = 0 THEN user_id % 7 END AS org_id,
         CASE WHEN event_id % 3 = 0 THEN 'org-' || (user_id % 7) END AS org_login,
         CASE event_id % 8 WHEN 1 THEN CASE WHEN event_id % 16 = 1 THEN 'closed' ELSE 'opened' END
                           WHEN 2 THEN 'opened' WHEN 3 THEN 'started'
                           WHEN 5 THEN 'published' WHEN 6 THEN 'subscribed' END AS action,
         CASE WHEN event_id % 8 = 0 THEN event_id % 5 END AS commit_count,
         CASE WHEN event_id % 8 = 1 THEN event_id % 16 = 1 END AS is_merged,
         date_trunc('hour', ts) + CASE WHEN event_id % 10 = 0 THEN INTERVAL 1 HOUR
                                       ELSE INTERVAL 0 HOUR END AS archive_hour,
         strftime(date_trunc('hour', ts) + CASE WHEN event_id % 10 = 0 THEN INTERVAL 1 HOUR
                                                ELSE INTERVAL 0 HOUR END,
                  '%Y-%m-%d-%-H') || '.json.gz' AS source_file,
         event_id + 1 AS source_line_number
  FROM events
),
days AS (
  SELECT min(event_date) AS first_day, max(event_date) AS last_day,
         min(event_date) + CAST((max(event_date) - min(event_date)) // 2 AS INTEGER) AS middle
  FROM ev
),
repo_index(repository, technology_id) AS (
  VALUES {", ".join(f"('{r}', '{t[0]}')" for t in DEFAULT_TECHNOLOGIES for r in t[3])}
)"""

_COUNTERS = """
         CAST(count(*) AS BIGINT) AS event_count,
         CAST(count(DISTINCT actor_id) AS BIGINT) AS unique_actor_count,
         CAST(count(*) FILTER (event_type = 'PushEvent') AS BIGINT) AS push_count,
         CAST(coalesce(sum(commit_count) FILTER (event_type = 'PushEvent'), 0) AS BIGINT)
           AS commit_count,
         CAST(count(*) FILTER (event_type = 'PullRequestEvent') AS BIGINT) AS pull_request_count,
         CAST(count(*) FILTER (event_type = 'PullRequestEvent' AND is_merged) AS BIGINT)
           AS merged_pull_request_count,
         CAST(count(*) FILTER (event_type = 'IssuesEvent') AS BIGINT) AS issue_count,
         CAST(count(*) FILTER (event_type = 'WatchEvent' AND action = 'started') AS BIGINT)
           AS star_count,
         CAST(count(*) FILTER (event_type = 'ForkEvent') AS BIGINT) AS fork_count,
         CAST(count(*) FILTER (event_type = 'ReleaseEvent') AS BIGINT) AS release_count"""


def _gold_of(condition: str = "true") -> str:
    return f"""
  SELECT technology_id, event_date AS activity_date, {_COUNTERS}
  FROM ev JOIN repo_index ON lower(trim(repo_name)) = repository
  WHERE {condition}
  GROUP BY technology_id, event_date"""


_GOLD = f"{_EV},\ngold AS ({_gold_of()})"


def _on(body: str, *, ctes: str = _EV) -> str:
    return f"WITH {ctes}\n{body}"


_HOURS = """
  SELECT CAST(unnest(generate_series(CAST({first} AS TIMESTAMP),
                                     CAST({last} AS TIMESTAMP) + INTERVAL 23 HOUR,
                                     INTERVAL 1 HOUR)) AS TIMESTAMP) AS hour
  FROM days"""

_PAYLOAD_TEMPLATE = """CASE
           WHEN {broken} AND event_type = 'PushEvent' THEN '{{"size":"many"}}'
           WHEN {broken} AND event_type = 'PullRequestEvent'
             THEN '{{"pull_request":{{"merged":1}}}}'
           WHEN event_type = 'PushEvent'
             THEN '{{"size":' || commit_count || ',"ref":"refs/heads/main"}}'
           WHEN event_type = 'PullRequestEvent'
             THEN '{{"action":"' || action || '","number":' || n || ',"pull_request":{{"merged":'
                  || CASE WHEN is_merged THEN 'true' ELSE 'false' END || ',"body":null}}}}'
           WHEN action IS NOT NULL THEN '{{"action":"' || action || '","note":"é {{x}}"}}'
           ELSE '{{}}' END"""
_PAYLOAD = _PAYLOAD_TEMPLATE.format(broken="n % 89 = 0")
_CLEAN_PAYLOAD = _PAYLOAD_TEMPLATE.format(broken="false")

_AT = "source_file || ':' || source_line_number || ': '"
_ID_ERROR = f"CASE WHEN n % 97 = 0 THEN {_AT} || 'field ''id'' must be str, got int' END"
_SILVER_ERROR = f"""CASE
           WHEN n % 89 = 0 AND event_type = 'PushEvent'
             THEN {_AT} || 'field ''payload.size'' must be int'
           WHEN n % 89 = 0 AND event_type = 'PullRequestEvent'
             THEN {_AT} || 'field ''payload.pull_request.merged'' must be bool' END"""

# Rows after the Bronze errors are set aside, with the values Silver takes from them.
_TYPED = f"""{_EV},
typed AS (
  SELECT event_id, event_type, event_date, created_at, actor_id, actor_login, repo_id,
         repo_name, org_id, org_login,
         CASE WHEN NOT (n % 89 = 0 AND event_type = 'PullRequestEvent') THEN action END AS action,
         CASE WHEN n % 89 <> 0 THEN commit_count END AS commit_count,
         CASE WHEN n % 89 <> 0 THEN is_merged END AS is_merged,
         archive_hour, source_file, source_line_number, {_SILVER_ERROR} AS error
  FROM ev WHERE n % 97 <> 0
)"""

# What each of the faults is, by number; the messages are fixed values.
_BRONZE_FAULTS = (
    "",
    "field 'id' is required",
    "field 'type' must be str, got NoneType",
    "field 'type' must be str, got list",
    "datetime must be timezone-aware",
    "Invalid isoformat string: 'soon'",
    "field 'created_at' must be str, got int",
    "field 'public' must be bool, got str",
    "field 'actor' is required",
    "field 'actor' must be dict",
    "field 'actor.id' must be int, got float",
    "field 'actor.login' is required",
    "field 'repo' must be dict",
    "field 'repo.id' must be int, got str",
    "field 'repo.name' must be str, got dict",
    "field 'payload' is required",
    "field 'payload' must be dict",
    "field 'org' must be dict",
    "field 'org.id' is required",
    "field 'org.login' is required",
    "",
    "invalid JSON",
    "event must be a JSON object",
    "invalid JSON",
)
_QUOTED = [message.replace("'", "''") for message in _BRONZE_FAULTS]
_FAULT = f"nullif(({_list(_QUOTED)})[n % {len(_QUOTED)} + 1], '')"

# Position of an event in the archive file that holds it.
_FILED = f"""{_EV},
files AS (
  SELECT *, CAST(ceil(count(*) OVER (PARTITION BY archive_hour) / {LINES_PER_ARCHIVE}.0) AS BIGINT)
           AS file_count
  FROM ev
),
filed AS (
  SELECT *, row_number() OVER (PARTITION BY archive_hour, n % file_count ORDER BY n) AS line
  FROM files
)"""

_EXPECTED = f"""{_EV},
expected AS (
  SELECT CAST(hour AS DATE) AS event_date, hour
  FROM ({_HOURS.format(first="first_day", last="last_day + 1")})
),
missing AS (
  SELECT expected.event_date, expected.hour,
         strftime(expected.hour, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS archive_hour
  FROM expected
  WHERE NOT EXISTS (SELECT 1 FROM ev
                    WHERE ev.event_date = expected.event_date AND ev.archive_hour = expected.hour)
)"""

_CUSTOMER_INDEX = """
customer_index AS (
  SELECT 'tech-' || c_custkey AS technology_id,
         'org-' || (c_custkey % 10) || '/r-' || c_custkey AS repository FROM customer
  UNION ALL
  SELECT 'tech-' || c_custkey, 'mirror/r-' || c_custkey FROM customer
)"""

_PART_CATALOG = """
ids AS (SELECT 't-' || (p_partkey - p_partkey % 2) AS technology_id FROM part),
repos AS (
  SELECT 'size/' || p_size AS repository FROM part
  UNION ALL
  SELECT CASE WHEN p_size % 5 = 0 THEN 'bad-' || p_partkey
              WHEN p_size % 5 = 1 THEN 'a/b/' || p_partkey
              ELSE 'part/' || p_partkey END FROM part
)"""

_NEGATIVE = " OR ".join(f"{name} < 0" for name in _METRICS)
_TOO_MANY = " OR ".join(f"{name} > event_count" for name in _EVENT_MIX)

_ALL_GOLD = f"SELECT {_GOLD_COLUMNS} FROM gold"
_OLDER = f"""
older AS (
  SELECT technology_id, activity_date, {", ".join(f"{m} + 1000 AS {m}" for m in _METRICS)}
  FROM gold WHERE technology_id NOT IN ('trino', 'duckdb')
)"""

# Three archives of the first date are bad.
_UNDAMAGED = (
    "CAST(archive_hour AS DATE) <> (SELECT first_day FROM days) "
    "OR extract('hour' FROM archive_hour) NOT IN (5, 6, 7)"
)

# At first one hour of the first date is refused, and in another one actors have other ids.
_OLDER_ACTORS = """
  SELECT * REPLACE (CASE WHEN archive_hour = CAST((SELECT first_day FROM days) AS TIMESTAMP)
                                             + INTERVAL 9 HOUR
                         THEN actor_id - 1 ELSE actor_id END AS actor_id)
  FROM ev"""
_REFUSED = "archive_hour = CAST((SELECT first_day FROM days) AS TIMESTAMP) + INTERVAL 5 HOUR"


def _older(condition: str) -> str:
    return f"""
  SELECT technology_id, event_date AS activity_date, {_COUNTERS}
  FROM ({_OLDER_ACTORS}) JOIN repo_index ON lower(trim(repo_name)) = repository
  WHERE {condition} GROUP BY technology_id, event_date"""


_BEFORE = f"SELECT 'before' AS stage, {_GOLD_COLUMNS} FROM ({_older(f'NOT ({_REFUSED})')})"

ORACLES: dict[str, str] = {
    "archive_hours": _on(
        "SELECT CAST(hour AS DATE) AS activity_date, hour "
        f"FROM ({_HOURS.format(first='first_day', last='last_day')})"
    ),
    "archive_coordinates": _on(
        """SELECT DISTINCT archive_hour AS hour, source_file,
       'https://data.gharchive.org/' || source_file AS url,
       'gharchive/' || strftime(archive_hour, 'archive_date=%Y-%m-%d/archive_hour=%H/')
         || source_file AS path
FROM ev"""
    ),
    "hour_normalization": _on(
        """SELECT n AS event_number,
       CASE n % 6
         WHEN 0 THEN strftime(archive_hour, '%Y-%m-%dT%H:%M:%SZ')
         WHEN 1 THEN strftime(archive_hour + INTERVAL 150 MINUTE, '%Y-%m-%dT%H:%M:%S+02:30')
         WHEN 2 THEN strftime(archive_hour, '%Y-%m-%dT%H:%M:%S')
         WHEN 3 THEN strftime(archive_hour, '%Y-%m-%dT%H:30:00+00:00')
         WHEN 4 THEN strftime(archive_hour, '%Y%m%dT%H%M%SZ')
         ELSE strftime(archive_hour, '%G-W%V-%uT%HZ') END AS hour_text,
       CASE WHEN n % 6 IN (0, 1, 4, 5) THEN archive_hour END AS hour,
       CASE n % 6 WHEN 2 THEN 'archive_hour must be timezone-aware'
                  WHEN 3 THEN 'archive_hour must be aligned to a full UTC hour' END AS error
FROM ev"""
    ),
    "archive_landing": _on(
        f"""SELECT CAST(e.hour AS DATE) AS activity_date, e.hour,
       p.archive_hour IS NOT NULL AS landed,
       CAST(coalesce(p.files, 0) AS BIGINT) AS archive_count
FROM ({_HOURS.format(first="first_day - 1", last="last_day + 1")}) e
LEFT JOIN (SELECT archive_hour, ceil(count(*) / {LINES_PER_ARCHIVE}.0) AS files
           FROM ev GROUP BY archive_hour) p ON p.archive_hour = e.hour"""
    ),
    "bronze_archive_scan": _on(
        "SELECT archive_hour, line AS source_line_number, event_id FROM filed", ctes=_FILED
    ),
    "bronze_parse": _on(
        f"""SELECT CASE WHEN n % 97 <> 0 THEN event_id END AS event_id, event_type, created_at,
       true AS is_public, actor_id, actor_login, repo_id, repo_name, org_id, org_login,
       {_PAYLOAD} AS payload_json, archive_hour, source_file, source_line_number,
       {_ID_ERROR} AS error
FROM ev"""
    ),
    "bronze_rejects": _on(
        f"SELECT source_file, source_line_number, {_ID_ERROR} AS error FROM ev WHERE n % 97 = 0"
    ),
    "bronze_faults": _on(
        f"SELECT source_line_number, {_AT} || {_FAULT} AS error FROM ev"
    ),
    "bronze_payload_text": """SELECT CAST(doc_id AS VARCHAR) AS event_id, lang,
       md5(text) AS text_md5, n_chars, CAST(NULL AS VARCHAR) AS error
FROM documents""",
    "bronze_event_members": """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
       ts AS created_at, user_id AS actor_id, CAST(props->>'$.k' AS BIGINT) AS k,
       round(value, 6) AS value, CAST(NULL AS VARCHAR) AS error
FROM events""",
    "silver_events": _on(f"SELECT {_SILVER_COLUMNS}, error FROM typed", ctes=_TYPED),
    "silver_rejects": _on(
        "SELECT source_file, source_line_number, error FROM typed WHERE error IS NOT NULL",
        ctes=_TYPED,
    ),
    "silver_faults": _on(
        f"""SELECT event_id, event_type,
       CASE n % 9 WHEN 0 THEN action WHEN 7 THEN 'closed' END AS action,
       CASE WHEN event_type = 'PushEvent'
            THEN CASE n % 9 WHEN 0 THEN commit_count WHEN 1 THEN 1 WHEN 5 THEN 3 WHEN 7 THEN 7 END
            END AS commit_count,
       CASE WHEN event_type = 'PullRequestEvent'
            THEN CASE n % 9 WHEN 0 THEN is_merged WHEN 1 THEN true WHEN 7 THEN true END
            END AS is_merged,
       {_AT} || CASE
         WHEN n % 9 = 1 THEN 'field ''payload.action'' must be str'
         WHEN event_type = 'PushEvent' AND n % 9 IN (2, 3, 4, 6, 8)
           THEN 'field ''payload.size'' must be int'
         WHEN event_type = 'PullRequestEvent' AND n % 9 IN (2, 3, 4)
           THEN 'field ''payload.pull_request'' must be dict'
         WHEN event_type = 'PullRequestEvent' AND n % 9 IN (5, 6, 8)
           THEN 'field ''payload.pull_request.merged'' must be bool' END AS error
FROM ev"""
    ),
    "catalog_index": _on(
        "SELECT repository, technology_id FROM customer_index", ctes=_CUSTOMER_INDEX
    ),
    "catalog_violations": _on(
        """SELECT 'duplicate_id' AS rule, technology_id AS subject,
       'technology id ''' || technology_id || ''' is duplicated' AS message
FROM ids GROUP BY technology_id HAVING count(*) > 1
UNION ALL
SELECT DISTINCT 'repository_format', repository,
       'repository ''' || repository || ''' must have ''owner/name'' format'
FROM repos WHERE repository LIKE 'bad-%' OR repository LIKE 'a/b/%'
UNION ALL
SELECT 'duplicate_repository', repository,
       'repository ''' || repository || ''' is assigned to multiple technologies'
FROM repos GROUP BY repository HAVING count(*) > 1""",
        ctes=_PART_CATALOG,
    ),
    "classify_events": _on(
        "SELECT event_id, repo_name, technology_id "
        "FROM ev JOIN repo_index ON lower(trim(repo_name)) = repository"
    ),
    "classify_large_catalog": """SELECT o_orderkey, 'tech-' || o_custkey AS technology_id
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "daily_activity": _on(f"{_ALL_GOLD} ORDER BY technology_id, activity_date", ctes=_GOLD),
    "daily_activity_from_lines": _on(_ALL_GOLD, ctes=_GOLD),
    "daily_activity_one_date": _on(
        f"{_ALL_GOLD} WHERE activity_date = (SELECT middle FROM days)", ctes=_GOLD
    ),
    "backfill": _on(_ALL_GOLD, ctes=_GOLD),
    "late_event_rebuild": _on(
        f"""SELECT 'before' AS stage, {_GOLD_COLUMNS} FROM ({_gold_of(
            "event_date = (SELECT middle FROM days) "
            "AND CAST(archive_hour AS DATE) <= (SELECT middle FROM days)"
        )})
UNION ALL
SELECT 'after', {_GOLD_COLUMNS} FROM gold WHERE activity_date = (SELECT middle FROM days)""",
        ctes=_GOLD,
    ),
    "pending_sources": _on(
        f"""SELECT archive_hour AS hour,
       CAST(ceil(count(*) / {LINES_PER_ARCHIVE}.0) AS BIGINT) AS archive_count
FROM ev WHERE CAST(archive_hour AS DATE) > (SELECT middle FROM days) GROUP BY archive_hour"""
    ),
    "run_summary": _on(
        f"""SELECT (SELECT CAST(sum(files) AS BIGINT)
        FROM (SELECT ceil(count(*) / {LINES_PER_ARCHIVE}.0) AS files
              FROM ev GROUP BY archive_hour)) AS archive_count,
       (SELECT count(*) FROM ev) AS bronze_rows,
       (SELECT count(*) FROM ev) AS silver_rows,
       (SELECT count(*) FROM gold) AS gold_rows""",
        ctes=_GOLD,
    ),
    "blocking_checks": _on(
        """SELECT 'complete_archive_hours' AS check_name, passed, count(*) AS check_count
FROM (SELECT count(DISTINCT archive_hour) FILTER (CAST(archive_hour AS DATE) = event_date) = 24
               AS passed
      FROM ev GROUP BY event_date)
GROUP BY passed
UNION ALL SELECT 'unique_gold_keys', true, 1
UNION ALL SELECT 'valid_gold_metrics', true, 1"""
    ),
    "bronze_from_archives": _on(
        f"""SELECT event_id, event_type, created_at, true AS is_public, actor_id, actor_login,
       repo_id, repo_name, org_id, org_login, {_CLEAN_PAYLOAD} AS payload_json, archive_hour,
       line AS source_line_number
FROM filed""",
        ctes=_FILED,
    ),
    "silver_from_archives": _on(
        "SELECT "
        + ", ".join(_SILVER_FIELDS)
        + " FROM ev"
    ),
    "backfill_with_bad_sources": _on(f"SELECT {_GOLD_COLUMNS} FROM ({_gold_of(_UNDAMAGED)})"),
    "load_rejects": """SELECT 'bronze' AS layer, 'file:line: invalid JSON' AS reason,
       CAST(1 AS BIGINT) AS error_count, true AS has_line
FROM events HAVING count(*) > 0
UNION ALL SELECT 'bronze', 'file: cannot be read', 1, false FROM events HAVING count(*) > 0
UNION ALL SELECT 'bronze', 'Bronze source file not found: file', 1, false
FROM events HAVING count(*) > 0""",
    "repaired_source": _on(
        f"{_BEFORE} UNION ALL SELECT 'after', {_GOLD_COLUMNS} FROM gold", ctes=_GOLD
    ),
    "stream_repaired_source": _on(
        f"{_BEFORE} UNION ALL SELECT 'after', {_GOLD_COLUMNS} FROM ({_older('true')})"
    ),
    "distinct_actors_range": _on(
        "SELECT technology_id, count(DISTINCT actor_id) AS actor_count "
        "FROM ev JOIN repo_index ON lower(trim(repo_name)) = repository "
        "WHERE event_date <= (SELECT middle FROM days) GROUP BY technology_id"
    ),
    "materialized_day": _on(
        """SELECT w.activity_date,
       CASE WHEN coalesce(l.hours, 0) < 24 THEN 'hours missing' WHEN coalesce(c.hours, 0) < 24 THEN 'checks failed'
            ELSE 'passed' END AS outcome,
       CASE WHEN l.hours = 24 THEN CAST(t.event_count AS BIGINT) END AS event_count
FROM (SELECT DISTINCT unnest([first_day, middle, last_day + 1]) AS activity_date FROM days) w
LEFT JOIN (SELECT CAST(archive_hour AS DATE) AS d, count(DISTINCT archive_hour) AS hours
           FROM ev GROUP BY 1) l ON l.d = w.activity_date
LEFT JOIN (SELECT event_date AS d, count(DISTINCT archive_hour) AS hours
           FROM ev WHERE CAST(archive_hour AS DATE) = event_date GROUP BY 1) c
       ON c.d = w.activity_date
LEFT JOIN (SELECT event_date AS d, count(*) AS event_count
           FROM ev JOIN repo_index ON lower(trim(repo_name)) = repository
           WHERE CAST(archive_hour AS DATE) = event_date GROUP BY 1) t ON t.d = w.activity_date"""
    ),
    "stream_with_bad_source": _on(f"SELECT {_GOLD_COLUMNS} FROM ({_gold_of(_UNDAMAGED)})"),
    "run_hours": _on(
        f"""SELECT {_GOLD_COLUMNS} FROM ({_gold_of(
            "event_date = (SELECT middle FROM days) "
            "AND CAST(archive_hour AS DATE) = (SELECT middle FROM days) "
            "AND extract('hour' FROM archive_hour) BETWEEN 6 AND 11"
        )})"""
    ),
    "replace_date": _on(
        f"""{_ALL_GOLD}
WHERE activity_date <> (SELECT first_day FROM days)
  AND (activity_date <> (SELECT last_day FROM days) OR technology_id = 'trino')""",
        ctes=_GOLD,
    ),
    "refused_date": _on(
        f"""SELECT {_GOLD_COLUMNS},
       'all Gold rows must match activity_date=' || (SELECT first_day FROM days) AS said
FROM gold""",
        ctes=_GOLD,
    ),
    "command_line": _on(_ALL_GOLD, ctes=_GOLD),
    "silver_archive_hours": _on(
        "SELECT DISTINCT event_date, archive_hour FROM ev ORDER BY event_date, archive_hour"
    ),
    "missing_hours": _on("SELECT event_date, archive_hour FROM missing", ctes=_EXPECTED),
    "check_complete_hours": _on(
        """SELECT e.event_date, CAST(24 AS BIGINT) AS expected_hour_count,
       24 - count(m.hour) AS present_hour_count, count(m.hour) AS missing_hour_count,
       coalesce(string_agg(m.archive_hour, ',' ORDER BY m.hour), '') AS missing_hours,
       count(m.hour) = 0 AS passed
FROM expected e LEFT JOIN missing m ON m.hour = e.hour
GROUP BY e.event_date""",
        ctes=_EXPECTED,
    ),
    "check_unique_keys": _on(
        """SELECT CAST(sum(c) AS BIGINT) AS row_count,
       count(*) FILTER (c > 1) AS duplicate_key_count, count(*) FILTER (c > 1) = 0 AS passed
FROM (SELECT CASE WHEN technology_id IN ('trino', 'duckdb') THEN 2 ELSE 1 END AS c FROM gold)""",
        ctes=_GOLD,
    ),
    "check_valid_metrics": _on(
        f"""SELECT count(*) AS row_count,
       count(*) FILTER (bad) AS invalid_row_count, count(*) FILTER (bad) = 0 AS passed
FROM (SELECT (extract('doy' FROM activity_date) + 7 * length(technology_id)) % 20 < 18
             OR {_NEGATIVE} OR unique_actor_count > event_count
             OR merged_pull_request_count > pull_request_count OR {_TOO_MANY} AS bad
      FROM gold)""",
        ctes=_GOLD,
    ),
    "activity_trend": _on(
        "SELECT activity_date, technology_id, event_count FROM gold", ctes=_GOLD
    ),
    "activity_trend_filtered": _on(
        "SELECT activity_date, technology_id, event_count FROM gold "
        "WHERE technology_id IN ('apache-spark', 'apache-flink', 'duckdb')",
        ctes=_GOLD,
    ),
    "event_mix": _on(
        "\nUNION ALL\n".join(
            f"SELECT activity_date, '{name}' AS measure, CAST(sum({name}) AS BIGINT) "
            "AS event_count FROM gold GROUP BY activity_date"
            for name in _EVENT_MIX
        ),
        ctes=_GOLD,
    ),
    "technology_ranking": _on(
        "SELECT technology_id, CAST(sum(event_count) AS BIGINT) AS event_count FROM gold "
        "GROUP BY technology_id ORDER BY 2 DESC, 1",
        ctes=_GOLD,
    ),
    "technology_totals": _on(
        "SELECT technology_id, "
        + ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in _METRICS)
        + " FROM gold GROUP BY technology_id",
        ctes=_GOLD,
    ),
    "distinct_actors": _on(
        "SELECT technology_id, count(DISTINCT actor_id) AS actor_count "
        "FROM ev JOIN repo_index ON lower(trim(repo_name)) = repository GROUP BY technology_id"
    ),
    "serving_upsert": _on(
        f"""SELECT {_GOLD_COLUMNS} FROM older WHERE activity_date < (SELECT middle FROM days)
UNION ALL
{_ALL_GOLD} WHERE activity_date >= (SELECT middle FROM days)""",
        ctes=f"{_GOLD},{_OLDER}",
    ),
    "serving_replace_date": _on(
        f"""SELECT {_GOLD_COLUMNS} FROM older WHERE activity_date <> (SELECT middle FROM days)
UNION ALL
{_ALL_GOLD} WHERE activity_date = (SELECT middle FROM days) AND technology_id <> 'airbyte'""",
        ctes=f"{_GOLD},{_OLDER}",
    ),
    "stream_bronze": _on(
        "SELECT archive_hour, count(*) AS row_count, max(line) AS last_line, "
        "count(DISTINCT event_id) AS event_count FROM filed GROUP BY archive_hour",
        ctes=_FILED,
    ),
    "stream_refresh": _on(_ALL_GOLD, ctes=_GOLD),
}
