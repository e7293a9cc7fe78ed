"""SQL for each registered query, straight over the provided tables: no event, no JSON.

It states the answer independently of how the operators reach it.
"""

from __future__ import annotations

_AS_OF = "TIMESTAMP '1998-07-01 00:00:00'"
_START = f"({_AS_OF} - INTERVAL 180 DAY)"


def _iso(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%SZ')"


def _repo(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'apache/r0' WHEN 1 THEN 'github/r1' WHEN 2 THEN 'huggingface/r2' ELSE 'other/r3' END"


def _days(since: str, until: str) -> str:
    return f"CAST(floor((epoch({until}) - epoch({since})) / 86400) AS BIGINT)"


_LABELS = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'bug' WHEN '2' THEN 'type: enhancement, p2' ELSE 'question' END"""
_PR_NUMBER = "(l_orderkey * 1000000 + l_linenumber * 10000 + l_suppkey)"
_PR_URL = f"'https://github.com/' || {_repo('l_orderkey')} || '/pull/' || {_PR_NUMBER}"

_ISSUE = f"""
issue AS (
  SELECT o_orderkey, 'https://github.com/' || repo || '/issues/' || o_orderkey AS url, repo,
         'Order ' || o_orderkey AS title, CAST(o_orderkey AS VARCHAR) AS number,
         CASE WHEN closed IS NULL THEN 'open' ELSE 'closed' END AS state,
         o_orderdate AS created, closed, {_iso('o_orderdate')} AS created_at, {_iso('closed')} AS closed_at, labels,
         substr(o_orderpriority, 1, 1) IN ('1', '2') AS labelled
  FROM (SELECT *, {_repo('o_orderkey')} AS repo, {_LABELS} AS labels,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + CAST(o_custkey % 90 AS INTEGER) * INTERVAL 1 DAY END AS closed
        FROM orders)
  WHERE repo <> 'other/r3'
)"""


def _pull(lineitem: str = "lineitem") -> str:
    return f"""
pull AS (
  SELECT {_PR_URL} AS pr_url, 'agent-' || (l_suppkey % 10) AS creator,
         max(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS merged
  FROM {lineitem} GROUP BY ALL
),
link AS (
  SELECT DISTINCT 'https://github.com/' || {_repo('l_orderkey')} || '/issues/' || l_orderkey AS issue_url, {_PR_URL} AS pr_url
  FROM {lineitem} WHERE l_returnflag IN ('R', 'A')
)"""


_AGENT = """
agent AS (
  SELECT CASE WHEN s_suppkey % 10 = 7 THEN 'Supplier#' || lpad(CAST(s_suppkey - 1 AS VARCHAR), 9, '0') ELSE s_name END AS name,
         'org-' || s_nationkey AS organization, 'agent-' || s_suppkey AS github_identifier,
         CASE WHEN s_suppkey % 10 <> 5 THEN 'https://agents.example/' || s_suppkey END AS website,
         CASE s_suppkey % 10 WHEN 8 THEN 'inactive' WHEN 9 THEN 'human' ELSE 'active' END AS status
  FROM supplier
),
active AS (SELECT * FROM agent WHERE status = 'active')"""

_RESOLUTION = """
resolution AS (
  SELECT issue_url, creator AS agent, pr_url, merged
  FROM link JOIN pull USING (pr_url)
  WHERE merged IS NOT NULL AND creator IN (SELECT github_identifier FROM active)
  QUALIFY row_number() OVER (PARTITION BY issue_url ORDER BY merged, pr_url) = 1
)"""


def _outcomes(documented: bool = False) -> str:
    label = "AND labelled" if documented else ""
    after = "AND closed >= merged" if documented else ""
    linked = "" if documented else "AND url IN (SELECT issue_url FROM resolution)"
    return f"""
resolved AS (
  SELECT issue.*, agent, pr_url, merged, strftime(closed, '%Y-%m') AS month
  FROM issue JOIN resolution ON url = issue_url
  WHERE closed BETWEEN {_START} AND {_AS_OF} AND {_days('created', 'closed')} >= 30 {label} {after}
),
wanted AS (
  SELECT * FROM issue
  WHERE state = 'open' AND labelled AND {_days('created', _AS_OF)} >= 30 {linked}
)"""


_MONTHLY = """
monthly AS (
  SELECT coalesce(name, agent) AS agent_name, month, count(*) AS resolved
  FROM resolved LEFT JOIN active ON github_identifier = agent GROUP BY ALL
),
grid AS (
  SELECT a.agent_name, m.month, coalesce(n.resolved, 0) AS resolved
  FROM (SELECT DISTINCT agent_name FROM monthly) a CROSS JOIN (SELECT DISTINCT month FROM monthly) m
  LEFT JOIN monthly n ON n.agent_name = a.agent_name AND n.month = m.month
),
top AS (
  SELECT agent_name, sum(resolved) AS total FROM monthly GROUP BY ALL ORDER BY total DESC, agent_name LIMIT 5
)"""

_BOARD = """
board AS (
  SELECT coalesce(name, 'Unknown') AS name, coalesce(website, 'N/A') AS website, github_identifier,
         coalesce(n, 0) AS resolved_issues
  FROM active LEFT JOIN (SELECT agent, count(*) AS n FROM resolved GROUP BY ALL) ON agent = github_identifier
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_PIPELINE = _with(_ISSUE, _pull(), _AGENT, _RESOLUTION, _outcomes())
_DOCUMENTED = _with(_ISSUE, _pull(), _AGENT, _RESOLUTION, _outcomes(documented=True))
_ISSUE_COLUMNS = "url, repo, title, number, state, created_at, closed_at, labels"
_LEADERBOARD = f"{_PIPELINE}, {_BOARD} SELECT * FROM board"

# What a run sees that opens only the archive days of its window: the opening of an issue and the events of
# pull requests count only on those days, and so does the closing.
_WINDOW_DAYS = f"BETWEEN {_START} AND {_AS_OF}"
_WINDOWED = f"""{_with(
    _ISSUE.replace("WHERE repo <> 'other/r3'", f"WHERE repo <> 'other/r3' AND closed {_WINDOW_DAYS}"),
    _pull(f"(SELECT * FROM lineitem WHERE l_shipdate {_WINDOW_DAYS})"),
    _AGENT, _RESOLUTION, _outcomes())}, {_BOARD} SELECT * FROM board"""

_ISSUE_EVENT = f"""
issue_event AS (
  SELECT o_orderkey, 'https://github.com/' || {_repo('o_orderkey')} || '/issues/' || o_orderkey AS issue_url,
         {_repo('o_orderkey')} AS repo_name, type, moment, o_orderdate AS created, closed, o_orderpriority
  FROM (
    SELECT *, 'IssuesEvent' AS type, o_orderdate AS moment, CAST(NULL AS TIMESTAMP) AS closed FROM orders
    UNION ALL SELECT *, 'IssueCommentEvent', o_orderdate, NULL FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT *, 'IssuesEvent', o_orderdate + CAST(o_custkey % 90 AS INTEGER) * INTERVAL 1 DAY,
           o_orderdate + CAST(o_custkey % 90 AS INTEGER) * INTERVAL 1 DAY
    FROM orders WHERE o_orderstatus = 'F')
)"""

_PULL_EVENT = f"""
pull_event AS (
  SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'PullRequestEvent' ELSE 'IssueCommentEvent' END AS type, l_shipdate AS moment,
         {_PR_URL} AS pr_url, 'agent-' || (l_suppkey % 10) AS pr_creator,
         CASE WHEN l_linestatus = 'F' THEN {_iso('l_shipdate')} END AS merged_at,
         CASE l_returnflag WHEN 'R' THEN 'Fixes #' || l_orderkey
              WHEN 'A' THEN 'See https://github.com/' || {_repo('l_orderkey')} || '/issues/' || l_orderkey
              ELSE 'Refactor' END AS pr_body
  FROM lineitem
)"""

_RAW_LABELS = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '[{"name":"Bug"}]'
  WHEN '2' THEN '[{"name":"Type: Enhancement"},{"name":"P2"}]' ELSE '[{"name":"question"}]' END"""

_PART_ROWS = f"""{_PIPELINE}, {_BOARD}, {_MONTHLY}
SELECT 'leaderboard' AS part, github_identifier AS entry, name || '|' || website AS detail, resolved_issues AS amount FROM board
UNION ALL SELECT 'monthly', agent_name, month, resolved FROM grid
UNION ALL SELECT 'wanted', url, repo || '|' || title || '|' || state || '|' || created_at || '|' || labels, o_orderkey FROM wanted"""

_VALIDATED = f"""{_with(_AGENT)},
submission AS (
  SELECT c_custkey AS submission_id, coalesce(CASE WHEN c_nationkey <> 0 THEN 'agent-' || (c_custkey // 2) END, '') AS id,
         CASE WHEN c_nationkey = 3 THEN '' ELSE c_name END AS name,
         CASE WHEN c_nationkey = 7 THEN '' ELSE c_mktsegment END AS organization,
         CASE WHEN c_nationkey <> 11 THEN 'https://' || c_name END AS website, c_nationkey
  FROM customer
),
checked AS (
  SELECT *, CASE c_nationkey WHEN 0 THEN 'GitHub identifier is required' WHEN 3 THEN 'Agent name is required'
            WHEN 7 THEN 'Organization name is required' WHEN 11 THEN 'Website URL is required' END AS problem
  FROM submission
),
judged AS (
  SELECT *, CASE
      WHEN problem IS NOT NULL THEN problem
      WHEN id NOT IN (SELECT 'agent-' || c_custkey FROM customer WHERE c_acctbal >= 0) THEN 'GitHub identifier not found'
      WHEN id IN (SELECT github_identifier FROM active)
           OR submission_id <> min(submission_id) OVER (PARTITION BY id, problem IS NULL) THEN 'Agent already exists'
    END AS reason
  FROM checked
),
validated AS (
  SELECT submission_id, CASE WHEN c_nationkey <> 0 THEN id END AS identifier, name, organization, website, reason,
         CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status
  FROM judged
)"""

_HOURS = """
hour_grid AS (
  SELECT CAST(d AS DATE) AS day, h
  FROM generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-02', INTERVAL 1 DAY) AS days(d), range(24) AS hours(h)
)"""

_BATCH = "CAST(floor(date_diff('day', CAST(TIMESTAMP '1998-01-02' AS DATE), CAST(moment AS DATE)) / 7) AS INTEGER)"
_IN_WINDOW = "CAST(moment AS DATE) BETWEEN DATE '1998-01-02' AND DATE '1998-07-01'"

ORACLES: dict[str, str] = {
    "issue_snapshots": f"{_with(_ISSUE)} SELECT {_ISSUE_COLUMNS} FROM issue",
    "issue_variants": f"""{_with(_ISSUE_EVENT)}
        SELECT issue_url, repo_name, 'Order ' || o_orderkey AS title, CAST(o_orderkey AS VARCHAR) AS issue_number,
               {_RAW_LABELS} AS labels, min({_iso('created')}) AS created_at, max({_iso('closed')}) AS closed_at
        FROM issue_event GROUP BY ALL""",
    "issue_labels": f"""{_with(_ISSUE)}
        SELECT url, labels, CASE WHEN labels LIKE '%, %' THEN 2 ELSE 1 END AS label_count, labelled AS wanted FROM issue""",
    "pull_versions": f"{_with(_PULL_EVENT)} SELECT DISTINCT pr_url, pr_creator, merged_at, pr_body FROM pull_event",
    "pr_facts": f"""{_with(_pull())}
        SELECT pr_url, creator, {_iso('merged')} AS merged_at, merged IS NOT NULL AS merged FROM pull""",
    "issue_links": f"{_with(_pull())} SELECT issue_url, pr_url FROM link",
    "reference_forms": """
        WITH item AS (
          SELECT l_orderkey || '-' || l_linenumber AS item, l_orderkey AS o, l_partkey AS p, l_suppkey AS s,
                 CASE WHEN l_returnflag = 'N' THEN 'https://short/1'
                      ELSE 'https://github.com/own/' || lower(l_returnflag) || '/pull/9' END AS pr_url,
                 CASE WHEN l_returnflag <> 'N' THEN 'https://github.com/own/' || lower(l_returnflag) || '/issues/' END AS prefix
          FROM lineitem
        ),
        found AS (
          SELECT item, pr_url, '#' || o AS reference, prefix || o AS issue_url FROM item
          UNION ALL SELECT item, pr_url, '#' || p, prefix || p FROM item
          UNION ALL SELECT item, pr_url, 'HTTPS://GitHub.com/a-b/c/issues/' || p, 'HTTPS://GitHub.com/a-b/c/issues/' || p FROM item
          UNION ALL SELECT item, pr_url, 'http://github.com/m/n/issues/' || s, 'http://github.com/m/n/issues/' || s FROM item
        )
        SELECT DISTINCT item, pr_url, reference, issue_url FROM found""",
    "issue_resolution": f"""{_with(_pull(), _AGENT, _RESOLUTION)}
        SELECT issue_url, agent, pr_url, {_iso('merged')} AS merged_at FROM resolution""",
    "resolved_issues": f"{_PIPELINE} SELECT {_ISSUE_COLUMNS}, agent, pr_url, {_iso('merged')} AS merged_at FROM resolved",
    "wanted_issues": f"{_PIPELINE} SELECT {_ISSUE_COLUMNS} FROM wanted",
    "resolved_issues_documented_rule": f"""{_DOCUMENTED}
        SELECT {_ISSUE_COLUMNS}, agent, pr_url, {_iso('merged')} AS merged_at FROM resolved""",
    "wanted_issues_documented_rule": f"{_DOCUMENTED} SELECT {_ISSUE_COLUMNS} FROM wanted",
    "resolved_by_agent": f"""{_PIPELINE}
        SELECT agent, count(*) AS issue_count, CAST(sum(o_orderkey) AS BIGINT) AS number_sum FROM resolved GROUP BY ALL""",
    "resolved_counts": f"{_PIPELINE} SELECT agent, count(*) AS resolved_issues FROM resolved GROUP BY ALL",
    "leaderboard": _LEADERBOARD,
    "leaderboard_view": f"""{_PIPELINE}, {_BOARD}
        SELECT CAST(row_number() OVER (ORDER BY resolved_issues DESC, github_identifier) AS BIGINT) AS rank, name AS "Agent Name", website AS "Website", resolved_issues AS "Resolved Issues" FROM board
        WHERE resolved_issues <> 0
        ORDER BY resolved_issues DESC, github_identifier""",
    "leaderboard_search": f"""{_PIPELINE}, {_BOARD}
        SELECT CAST(row_number() OVER (ORDER BY resolved_issues DESC, github_identifier) AS BIGINT) AS rank, name AS "Agent Name", website AS "Website", resolved_issues AS "Resolved Issues" FROM board
        WHERE resolved_issues <> 0 AND resolved_issues BETWEEN 2 AND 500
          AND (name ILIKE '%supplier#000000006%' OR website ILIKE '%supplier#000000006%')
        ORDER BY resolved_issues DESC, github_identifier""",
    "windowed_leaderboard": _WINDOWED,
    "wanted_view": f"""{_PIPELINE}
        SELECT CAST(row_number() OVER (ORDER BY {_days('created', _AS_OF)} DESC, url) AS BIGINT) AS rank, title AS "Title",
               '<a href="' || url || '" target="_blank">' || repo || '#' || number || '</a>' AS "URL",
               {_days('created', _AS_OF)} AS "Age (days)", labels AS "Labels", url AS issue_url, repo || '#' || number AS issue_name
        FROM wanted ORDER BY "Age (days)" DESC, url""",
    "monthly_long": f"{_PIPELINE}, {_MONTHLY} SELECT agent_name, month, resolved FROM monthly",
    "monthly_dense": f"{_PIPELINE}, {_MONTHLY} SELECT agent_name, month, resolved FROM grid",
    "monthly_matrix": f"""{_PIPELINE}, {_MONTHLY}
        SELECT agent_name, string_agg(month, ',' ORDER BY month) AS months,
               string_agg(CAST(resolved AS VARCHAR), ',' ORDER BY month) AS monthly_resolved
        FROM grid GROUP BY ALL""",
    "months_present": f"{_PIPELINE}, {_MONTHLY} SELECT DISTINCT month FROM monthly",
    "agent_totals": f"""{_PIPELINE}, {_MONTHLY}
        SELECT agent_name, CAST(sum(resolved) AS BIGINT) AS total FROM monthly GROUP BY ALL""",
    "top_agents": f"{_PIPELINE}, {_MONTHLY} SELECT agent_name, CAST(total AS BIGINT) AS total FROM top",
    "top_agents_series": f"""{_PIPELINE}, {_MONTHLY}
        SELECT agent_name, month, resolved FROM monthly WHERE agent_name IN (SELECT agent_name FROM top)""",
    "active_agents": f"{_with(_AGENT)} SELECT github_identifier, name, organization, website, status FROM active",
    "registry_summary": f"""{_with(_AGENT)}
        SELECT count(*) FILTER (status = 'active') AS active_agents, count(*) AS total_files FROM agent""",
    "agent_identifiers": "SELECT c_custkey, 'agent ' || c_custkey || '+[bot]' AS github_identifier FROM customer",
    "submission_validation": f"""{_VALIDATED}
        SELECT submission_id, identifier, name, organization, website, reason, status FROM validated""",
    "registry_of_two_writers": f"""{_VALIDATED}
        SELECT 1 AS writer, submission_id, identifier, reason, status FROM validated
        UNION ALL SELECT 2, submission_id, identifier, coalesce(reason, 'Agent already exists'), 'rejected' FROM validated""",
    "registry_scan": f"{_with(_AGENT)} SELECT name, organization, website, status FROM agent",
    "registry_append": f"""{_VALIDATED}
        SELECT name, organization, github_identifier, website, status FROM agent
        WHERE github_identifier NOT IN (SELECT identifier FROM validated WHERE status = 'accepted')
        UNION ALL SELECT name, organization, identifier, website, 'active' FROM validated WHERE status = 'accepted'""",
    "batch_stats": f"""{_with(_ISSUE_EVENT, _PULL_EVENT)},
        seen AS (
          SELECT {_BATCH} AS batch, moment, 1 AS is_issue FROM issue_event WHERE {_IN_WINDOW}
          UNION ALL SELECT {_BATCH}, moment, 0 FROM pull_event WHERE {_IN_WINDOW}
        ),
        issue_form AS (SELECT DISTINCT {_BATCH} AS batch, issue_url FROM issue_event WHERE {_IN_WINDOW}),
        pull_form AS (
          SELECT DISTINCT {_BATCH} AS batch, pr_url, pr_creator, merged_at, pr_body FROM pull_event WHERE {_IN_WINDOW}
        )
        SELECT batch, count(DISTINCT moment) AS files, CAST(sum(is_issue) AS BIGINT) AS issue_events,
               CAST(sum(1 - is_issue) AS BIGINT) AS pr_events,
               (SELECT count(*) FROM issue_form f WHERE f.batch = seen.batch) AS issue_rows,
               (SELECT count(*) FROM pull_form f WHERE f.batch = seen.batch) AS pr_rows
        FROM seen GROUP BY batch""",
    "run_summary": f"""{_PIPELINE}
        SELECT (SELECT count(*) FROM issue) AS issues_seen, (SELECT count(*) FROM wanted) AS wanted_issues,
               (SELECT count(*) FROM resolved) AS resolved_issues,
               (SELECT count(DISTINCT agent) FROM resolved) AS agents_with_resolved,
               '1998-07-01T00:00:00+00:00' AS last_updated, 180 AS leaderboard_time_frame_days,
               30 AS longstanding_gap_days, 'apache,github,huggingface' AS tracked_orgs,
               'bug,enhancement' AS patch_wanted_labels""",
    "coverage_gaps": f"""{_with(_HOURS)}
        SELECT DISTINCT CAST(day AS VARCHAR) AS archive_date FROM hour_grid
        WHERE day NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    "coverage_missing_hours": f"""{_with(_HOURS)}
        SELECT CAST(day AS VARCHAR) AS archive_date, CAST(h AS INTEGER) AS archive_hour, day || '-' || h AS stamp FROM hour_grid
        WHERE (day, h) NOT IN (SELECT (CAST(ts AS DATE), hour(ts)) FROM events)""",
    "event_props": """
        SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing,
               coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), '') AS k_or_missing
        FROM events""",
    "normalize_timestamps": """
        SELECT o_orderkey, CASE o_orderkey % 10
            WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT01:02:03Z')
            WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT01:02:03Z')
            WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT08:00:00Z')
            WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT01:02:03Z')
            WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00Z')
            WHEN 8 THEN strftime(o_orderdate, 'garbageT%Y-%m-%d')
            WHEN 9 THEN strftime(o_orderdate, '%Y')
            ELSE 'N/A' END AS created_at
        FROM orders""",
    "days_open": f"""
        SELECT o_orderkey,
               {_days("o_orderdate + INTERVAL '23 hours 30 minutes'",
                      "TIMESTAMP '1998-07-01' + CAST(o_custkey % 24 AS INTEGER) * INTERVAL 1 HOUR")} AS days_open
        FROM orders""",
    "scan_roundtrip": f"""{_with(_ISSUE_EVENT, _PULL_EVENT)},
        line AS (
          SELECT type, moment FROM issue_event UNION ALL SELECT type, moment FROM pull_event
          UNION ALL SELECT '(broken)', moment FROM pull_event WHERE type = 'PullRequestEvent'
          UNION ALL SELECT type, moment FROM issue_event WHERE type = 'IssuesEvent' AND closed IS NULL
        )
        SELECT strftime(date_trunc('month', moment), '%Y-%m-%d') AS slot, type, count(*) AS lines FROM line
        WHERE moment >= TIMESTAMP '1998-01-01' AND moment < TIMESTAMP '1998-08-01' GROUP BY ALL""",
    "curated_leaderboard": _LEADERBOARD,
    "incremental_leaderboard": _LEADERBOARD,
    "incremental_windowed_leaderboard": _WINDOWED,
    "document_roundtrip": _PART_ROWS,
    "single_document_roundtrip": _PART_ROWS,
    "ledger_leaderboard": _LEADERBOARD,
    "versioned_leaderboard": _LEADERBOARD,
    "maintained_leaderboard": _LEADERBOARD,
    "damaged_leaderboard": f"{_PIPELINE}, {_BOARD} SELECT *, CAST(1 AS BIGINT) AS dead_letters FROM board",
    "payload_fields": f"""{_with(_ISSUE_EVENT, _PULL_EVENT)}
        SELECT type, CAST(NULL AS VARCHAR) AS author, count(*) AS events, count(*) AS titled FROM issue_event GROUP BY type
        UNION ALL SELECT type, 'ghost', count(*), count(*) FROM issue_event WHERE type = 'IssuesEvent' AND closed IS NULL GROUP BY type
        UNION ALL SELECT type, CASE type WHEN 'IssueCommentEvent' THEN 'account' END, count(*), 0 FROM pull_event GROUP BY type""",
    "oversized_lines": """
        WITH line AS (
          SELECT o_orderkey, length('{"type":"IssuesEvent","id":"' || o_orderkey || '","padding":"' || repeat('x', CAST(o_orderkey % 50 AS INTEGER)) || '"}') AS bytes
          FROM orders
        )
        SELECT 'event' AS kind, count(*) AS lines, CAST(sum(o_orderkey) AS BIGINT) AS amount FROM line WHERE bytes <= 60
        UNION ALL SELECT 'too long', count(*), CAST(sum(bytes) AS BIGINT) FROM line WHERE bytes > 60""",
    "archive_inventory": f"""{_with(_ISSUE_EVENT, _PULL_EVENT)}
        SELECT DISTINCT strftime(date_trunc('month', moment), '%Y-%m-%d') AS archive_date, 0 AS archive_hour, false AS empty
        FROM (SELECT moment FROM issue_event UNION ALL SELECT moment FROM pull_event)
        UNION ALL SELECT '2030-01-01', 0, true""",
    "results_roundtrip": _PART_ROWS,
}
