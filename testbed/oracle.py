"""DuckDB twins of the queries, written independently of the Spark plans."""

from testbed.binding import NOISE, SEEDS, THRESHOLD, TOKEN_THRESHOLD

# Python's whitespace as an RE2 class.
WS = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
PY = r"(?m)^\+([a-zA-Z0-9\-_]+)"
JS = r"\+" + WS + r'*"([^"]+)":'


def _repo(k: str) -> str:
    return (
        f"CASE WHEN {k} % 180 = 7 THEN 'solo' WHEN {k} % 180 = 11 THEN 'ab/cde' "
        f"ELSE 'owner' || ({k} % 20) || '/project' || ({k} % 180) END"
    )


def _entropy(source: str, key: str, text: str) -> str:
    """Entropy per row of ``source``; a row without any character has no line here."""
    return f"""
      SELECT {key},
             CASE WHEN sum(c) > 0
                  THEN abs(sum(CASE WHEN u < 256 THEN -c * log2(c / n) ELSE 0 END) / max(n)) END AS h
      FROM (SELECT *, sum(c) OVER (PARTITION BY {key}) AS n
            FROM (SELECT {key}, unicode(ch) AS u, count(*)::DOUBLE AS c
                  FROM (SELECT {key},
                               unnest(string_split(regexp_replace({text}, '{WS}', '', 'g'), '')) AS ch
                        FROM {source})
                  WHERE ch <> '' GROUP BY ALL))
      GROUP BY {key}"""


_NOISE = ", ".join(f"'{w}'" for w in NOISE)
_SEEDS = ", ".join(
    f"('{sector}', {i}, '{word}')"
    for i, (sector, words) in enumerate(SEEDS.items())
    for word in words
)
_SECTORS = ", ".join(f"('{sector}', {i})" for i, sector in enumerate(SEEDS))

CTES = f"""
WITH raw AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'WatchEvent' ELSE 'PushEvent' END AS type,
         user_id AS repo_id,
         CASE WHEN event_id % 101 = 0 THEN '' ELSE {_repo('k')} END AS name,
         CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 89 = 0 THEN sha1('gone-' || event_id)
              ELSE sha1(k::VARCHAR) END AS head,
         ts AS created_at
  FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS k FROM events)),
push AS (
  SELECT event_id, name, head, created_at AS pushed_at FROM raw
  WHERE type = 'PushEvent' AND name <> '' AND head <> ''),
file AS (
  SELECT * FROM (
    SELECT {_repo('doc_id')} AS repo_name, sha1(doc_id::VARCHAR) AS commit_sha,
           'src/main.py' AS filename, CASE WHEN doc_id % 50 <> 0 THEN text END AS patch
    FROM documents
    UNION ALL
    SELECT {_repo('doc_id')}, sha1(doc_id::VARCHAR),
           CASE doc_id % 4 WHEN 0 THEN 'requirements.txt' WHEN 1 THEN 'web/package.json'
                           WHEN 2 THEN 'dev-requirements.txt' ELSE 'readme.md' END,
           CASE WHEN doc_id % 4 = 1
                  THEN '+  "' || replace(text, ' ', '": "1",' || chr(10) || '+  "') || '": "1"'
                WHEN doc_id % 4 <> 3 THEN '+' || replace(text, ' ', chr(10) || '+')
                WHEN doc_id % 8 = 3 THEN ''
                ELSE '+' || text END
    FROM documents)
  WHERE length(patch) > 0),
score AS ({_entropy('file', 'repo_name, commit_sha, filename', 'patch')}),
found AS (SELECT repo_name, commit_sha, h FROM score WHERE h > {THRESHOLD}),
leak AS (
  SELECT repo_name, commit_sha, round(h, 12) AS entropy_score, pushed_at AS detected_at
  FROM push JOIN found ON name = repo_name AND head = commit_sha),
dep AS (
  SELECT * FROM (
    SELECT lower(unnest(regexp_extract_all(patch, '{PY}', 1))) AS library_name,
           'Python' AS language, repo_name, commit_sha
    FROM file WHERE contains(filename, 'requirements.txt'))
  WHERE library_name NOT IN ('pip', 'setuptools', 'wheel')
  UNION ALL
  SELECT lower(unnest(regexp_extract_all(patch, '{JS}', 1))), 'JavaScript', repo_name, commit_sha
  FROM file
  WHERE contains(filename, 'package.json') AND NOT contains(filename, 'requirements.txt')),
trend AS (
  SELECT library_name, language, repo_name, pushed_at AS detected_at
  FROM push JOIN dep ON name = repo_name AND head = commit_sha),
as_of AS (SELECT max(ts) AS t FROM events),
week AS (
  SELECT library_name, count(*) AS usage_count FROM trend, as_of
  WHERE detected_at > t - INTERVAL 7 DAY GROUP BY 1),
day AS (
  SELECT library_name, count(*) AS usage_count FROM trend, as_of
  WHERE detected_at > t - INTERVAL 24 HOUR GROUP BY 1),
top60 AS (
  SELECT row_number() OVER (ORDER BY usage_count DESC, library_name) AS rank, *
  FROM (SELECT * FROM week ORDER BY usage_count DESC, library_name LIMIT 300)
  WHERE lower(library_name) NOT IN ({_NOISE})
  QUALIFY rank <= 60),
seed(sector, sector_ord, keyword) AS (VALUES {_SEEDS}),
candidate AS (
  SELECT row_number() OVER (ORDER BY usage_count DESC, library_name) AS rank, *
  FROM (SELECT * FROM day ORDER BY usage_count DESC, library_name LIMIT 300)
  WHERE lower(library_name) NOT IN ({_NOISE})
  QUALIFY rank <= 150),
heat AS (
  SELECT dayofweek(detected_at) + 1 AS dow, hour(detected_at) AS hour,
         count(DISTINCT commit_sha) AS leak_count
  FROM leak GROUP BY 1, 2),
wordy AS (
  SELECT *, trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')) AS words FROM documents),
parts AS (
  SELECT doc_id,
         '", "top_libs": ["' || replace(words, ' ', '","') || '"]}}' AS tail,
         '{{"sector": "' || source || '", "theme": "' || lang || '", "summary": "' || words AS first,
         '{{"sector": "Backend & API", "theme": "' || n_chars || '", "summary": "' || lang AS second,
         '{{"sector": "Backend & API", "theme": "' || lang AS cut
  FROM wordy),
answer AS (
  SELECT doc_id, DATE '2024-01-01' + (doc_id % 28)::INTEGER AS answered_on,
         CASE doc_id % 9
           WHEN 0 THEN '```json' || chr(10) || good || chr(10) || '```' || chr(10)
           WHEN 1 THEN 'oops ' || good
           WHEN 2 THEN '[' || first || tail || ', ' || cut || tail || ']'
           WHEN 3 THEN good || ' That is all.'
           WHEN 4 THEN first || tail
           ELSE chr(10) || ' ' || good END AS response
  FROM (SELECT *, '[' || first || tail || ', ' || second || tail || ']' AS good FROM parts)),
bare AS (
  SELECT *, regexp_replace(replace(replace(response, '```json', ''), '```', ''),
                           '\\A{WS}+|{WS}+\\z', '', 'g') AS body
  FROM answer),
item AS (
  SELECT doc_id, answered_on, unnest(items) AS i
  FROM (SELECT *, json_extract(body, '$[*]') AS items FROM bare
        WHERE CASE WHEN json_valid(body) THEN json_type(body) = 'ARRAY' ELSE false END)
  WHERE len(list_filter(items, lambda x: json_extract_string(x, '$.sector') IS NULL
                             OR json_extract_string(x, '$.theme') IS NULL
                             OR json_extract_string(x, '$.summary') IS NULL
                             OR json_extract(x, '$.top_libs') IS NULL)) = 0),
parsed AS (
  SELECT doc_id, answered_on, i->>'$.sector' AS sector, i->>'$.theme' AS theme,
         i->>'$.summary' AS summary, array_to_string(i->>'$.top_libs[*]', ',') AS top_libs
  FROM item),
vibe AS (
  SELECT answered_on AS vibe_date, '[' || sector || '] ' || theme AS theme_name, summary,
         top_libs AS top_libraries
  FROM parsed),
token AS (
  SELECT row_number() OVER () AS id, repo_name, commit_sha, token
  FROM (SELECT repo_name, commit_sha,
               unnest(regexp_split_to_array(patch, '[\\s\\x{{0b}}"''=:,;()]+')) AS token
        FROM file)
  WHERE length(token) > 0),
token_score AS ({_entropy('token', 'id, repo_name, commit_sha, token', 'token')})
"""


def _mask(column: str, segment: int, whole: int) -> str:
    return (
        f"CASE WHEN contains({column}, '/') "
        f"THEN substr(split_part({column}, '/', 1), 1, {segment}) || '**/' || "
        f"substr(split_part({column}, '/', 2), 1, {segment}) || '**' "
        f"ELSE substr({column}, 1, {whole}) || '**' END"
    )


def _segments(column: str) -> str:
    return f"regexp_replace({column}, '([^/]{{3}})[^/]+', '\\1***', 'g')"


def _json_text(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'null' ELSE '\"' || {column} || '\"' END"


def _kpi(hours: int) -> str:
    return f"""
      SELECT count(DISTINCT commit_sha) AS total_leaks, round(avg(entropy_score), 6) AS avg_risk,
             count(*) FILTER (WHERE entropy_score > 4.5) AS critical_count,
             count(DISTINCT repo_name) AS affected_repos
      FROM leak, as_of WHERE detected_at > t - INTERVAL {hours} HOUR"""


def _risk(score: str) -> str:
    return (
        f"CASE WHEN {score} > 4.5 THEN 'CRITICAL' WHEN {score} > 3.5 THEN 'HIGH' ELSE 'LOW' END"
    )


_TIME = "strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')"
_PARSE = """
  SELECT event_id,
         CASE WHEN event_id % 5 <> 0 THEN name END AS name,
         CASE WHEN event_id % 5 <> 0 THEN head END AS head,
         CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', created_at) END AS pushed_at
  FROM raw"""
_UNIQUE = "SELECT event_id, type, created_at FROM raw"
_HOURLY = """
  SELECT date_trunc('hour', detected_at)::TIMESTAMP AS hr,
         round(avg(entropy_score), 6) AS avg_entropy, round(max(entropy_score), 6) AS max_entropy
  FROM leak GROUP BY 1 ORDER BY 1"""
_PATCH = """
  SELECT file.commit_sha, file.filename, round(h, 6) AS entropy_score
  FROM file LEFT JOIN score USING (repo_name, commit_sha, filename)"""
_HOURS = ", ".join(
    f"CASE WHEN count(leak_count) > 0 "
    f"THEN coalesce(sum(leak_count) FILTER (WHERE hour = {h}), 0)::BIGINT END AS h{h:02d}"
    for h in range(24)
)

BODIES = {
    "push_filter": """
      SELECT event_id, type, repo_id, name AS repo_name, created_at FROM raw
      WHERE type = 'PushEvent'""",
    "push_project": "SELECT name, head, pushed_at, event_id FROM push",
    "push_messages": f"""
      SELECT repo_id::VARCHAR AS key,
             '{{"type":"' || type || '","repo":{{"id":' || repo_id || ',"name":"' || name ||
             '"}},"payload":{{"head":' || {_json_text('head')} || '}},"created_at":"' || {_TIME} ||
             '"}}' AS value
      FROM raw WHERE type = 'PushEvent'""",
    "push_messages_flat": """
      SELECT NULL::VARCHAR AS key,
             '{"name":"' || name || '","head":"' || head || '","pushed_at":"' ||
             strftime(pushed_at, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS value
      FROM push""",
    "push_parse": _PARSE,
    "push_batch_summary": """
      SELECT count(*) AS total_events, count(*) FILTER (WHERE type = 'PushEvent') AS push_events,
             (SELECT count(*) FROM push) AS signals
      FROM raw""",
    "push_dedupe": _UNIQUE,
    "file_explode": "SELECT repo_name, commit_sha, filename, patch FROM file",
    "commit_enrich": """
      SELECT pushed_at, event_id, repo_name, commit_sha, filename, length(patch) AS patch_length
      FROM push JOIN file ON name = repo_name AND head = commit_sha""",
    "commit_missing": """
      SELECT name, head, pushed_at, event_id FROM push
      WHERE NOT EXISTS (SELECT 1 FROM documents WHERE sha1(doc_id::VARCHAR) = head)""",
    "not_null_split": """
      SELECT event_id, head IS NOT NULL AS is_valid,
             CASE WHEN head IS NULL THEN 'commit_sha' ELSE '' END AS violations
      FROM raw""",
    "patch_entropy": _PATCH,
    "patch_entropy_native": _PATCH,
    "leak_detect": "SELECT repo_name, commit_sha, round(h, 6) AS entropy_score FROM found",
    "token_entropy": f"""
      SELECT repo_name, commit_sha, token, round(h, 6) AS entropy_score FROM token_score
      WHERE h > {TOKEN_THRESHOLD}""",
    "manifest_kind": """
      SELECT commit_sha, filename,
             CASE WHEN contains(filename, 'requirements.txt') THEN 'Python'
                  WHEN contains(filename, 'package.json') THEN 'JavaScript' END AS language
      FROM file""",
    "py_deps": "SELECT library_name, language, repo_name FROM dep WHERE language = 'Python'",
    "js_deps": "SELECT library_name, language, repo_name FROM dep WHERE language = 'JavaScript'",
    "trend_extract": "SELECT library_name, language, repo_name FROM dep",
    "kpi_24h": _kpi(24),
    "kpi_30d": _kpi(720),
    "kpi_tiles": f"""
      SELECT format('{{:,}}', total_leaks) AS total_leaks, format('{{:.3f}}', avg_risk) AS avg_risk,
             format('{{:,}}', critical_count) AS critical_count,
             format('{{:,}}', affected_repos) AS affected_repos
      FROM ({_kpi(720)})""",
    "kpi_sketch": """
      SELECT hours, round(avg(entropy_score), 6) AS avg_risk,
             count(*) FILTER (WHERE entropy_score > 4.5) AS critical_count,
             count(DISTINCT commit_sha) AS total_leaks, count(DISTINCT repo_name) AS affected_repos,
             true AS leaks_in_bound, true AS repos_in_bound
      FROM leak, as_of, (VALUES (24), (720)) span(hours)
      WHERE date_trunc('hour', detected_at) > date_trunc('hour', t) - to_hours(hours) GROUP BY hours""",
    "entropy_quantiles": """
      SELECT p / 20 AS p, count(*) AS scored, true AS in_bound
      FROM leak, as_of, range(21) asked(p)
      WHERE date_trunc('hour', detected_at) > date_trunc('hour', t) - INTERVAL 720 HOUR GROUP BY 1""",
    "entropy_hourly": _HOURLY,
    "entropy_distribution": """
      SELECT round(entropy_score, 6) AS entropy_score FROM leak, as_of
      WHERE detected_at > t - INTERVAL 24 HOUR""",
    "entropy_histogram": """
      SELECT bin::INTEGER AS bin, round(low + (bin - 1) * (high - low) / 25, 6) AS lo,
             round(low + bin * (high - low) / 25, 6) AS hi, coalesce(n, 0)::BIGINT AS n,
             low + bin * (high - low) / 25 > 4.5 AS is_critical
      FROM range(1, 26) spine(bin)
      CROSS JOIN (SELECT min(entropy_score) AS low, max(entropy_score) AS high
                  FROM leak, as_of WHERE detected_at > t - INTERVAL 720 HOUR)
      LEFT JOIN (SELECT least(floor((entropy_score - low) / (high - low) * 25)::INTEGER + 1, 25) AS bin,
                        count(*) AS n
                 FROM leak, as_of,
                      (SELECT min(entropy_score) AS low, max(entropy_score) AS high
                       FROM leak, as_of WHERE detected_at > t - INTERVAL 720 HOUR)
                 WHERE detected_at > t - INTERVAL 720 HOUR GROUP BY 1) USING (bin)""",
    "top_risky_repos": f"""
      SELECT {_mask('repo_name', 4, 8)} AS repo_name, leak_count,
             round(avg_entropy, 2) AS avg_entropy
      FROM (SELECT repo_name, count(DISTINCT commit_sha) AS leak_count,
                   avg(entropy_score) AS avg_entropy
            FROM leak, as_of WHERE detected_at > t - INTERVAL 24 HOUR GROUP BY 1
            ORDER BY round(avg_entropy, 9) DESC, repo_name LIMIT 10)""",
    "activity_heatmap": """
      SELECT dow, ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dow] AS day_name, hour,
             leak_count
      FROM heat""",
    "activity_heatmap_pivot": f"""
      SELECT day_name, {_HOURS}
      FROM (VALUES ('Mon', 2), ('Tue', 3), ('Wed', 4), ('Thu', 5), ('Fri', 6), ('Sat', 7),
                   ('Sun', 1)) week(day_name, dow)
      LEFT JOIN heat USING (dow) GROUP BY day_name""",
    "live_latest_per_repo": f"""
      SELECT {_mask('repo_name', 3, 6)} AS repository,
             substr(commit_sha, 1, 8) || repeat(chr(183), 16) AS commit_sha,
             round(entropy_score, 2) AS entropy, {_risk('round(entropy_score, 2)')} AS risk,
             strftime(detected_at, '%Y-%m-%d %H:%M') AS detected_at
      FROM (SELECT * FROM leak
            QUALIFY row_number() OVER (PARTITION BY repo_name ORDER BY detected_at DESC,
                                       commit_sha DESC, entropy_score DESC) = 1
            ORDER BY detected_at DESC, repo_name LIMIT 50)""",
    "public_masked_view": f"""
      SELECT {_segments('repo_name')} AS masked_repo,
             substr(commit_sha, 1, 8) || repeat('*', 16) AS masked_sha,
             round(entropy_score, 2) AS entropy_score, detected_at
      FROM leak""",
    "mask_variants": f"""
      SELECT event_id, {_segments('name')} AS segments, {_mask('name', 4, 8)} AS risky,
             {_mask('name', 3, 6)} AS live, substr(head, 1, 8) || repeat('*', 16) AS sha
      FROM raw""",
    "risk_band": f"""
      SELECT commit_sha, filename, {_risk('round(entropy_score, 2)')} AS risk FROM ({_PATCH})""",
    "sql_surface": f"""
      SELECT 'mask' AS kind, event_id::VARCHAR AS key, {_segments('name')} AS a, {_mask('name', 4, 8)} AS b,
             substr(head, 1, 8) || repeat('*', 16) AS c
      FROM raw
      UNION ALL
      SELECT 'score', commit_sha || ':' || filename, {_risk('round(entropy_score, 2)')}, (entropy_score > 0)::VARCHAR, NULL
      FROM ({_PATCH})
      UNION ALL
      SELECT 'dependency', commit_sha, library_name, language, repo_name FROM dep""",
    "trend_counts": "SELECT library_name, usage_count FROM week",
    "noise_anti_join": f"""
      SELECT library_name, usage_count FROM week
      WHERE lower(library_name) NOT IN ({_NOISE})
        AND lower(library_name) NOT IN (SELECT DISTINCT lower(lang) FROM documents)""",
    "tech_trends_top60": """
      SELECT rank::INTEGER AS rank, library_name, usage_count,
             round(usage_count / max(usage_count) OVER (), 6) AS usage_share
      FROM top60""",
    "trend_radar_top12": """
      SELECT rank::INTEGER AS rank, library_name, usage_count,
             round(usage_count / (SELECT max(usage_count) FROM top60), 6) AS usage_share
      FROM top60 WHERE rank <= 12""",
    "category_libs": f"""
      SELECT sector,
             row_number() OVER (PARTITION BY sector ORDER BY usage_count DESC, library_name)::INTEGER
               AS rank,
             library_name, usage_count
      FROM (SELECT DISTINCT sector, library_name, usage_count
            FROM (SELECT * FROM (SELECT * FROM week ORDER BY usage_count DESC, library_name LIMIT 500)
                  WHERE lower(library_name) NOT IN ({_NOISE}))
            JOIN seed ON contains(lower(library_name), keyword))
      QUALIFY rank <= 20""",
    "category_libs_table": f"""
      SELECT sector,
             row_number() OVER (PARTITION BY sector ORDER BY usage_count DESC, library_name)::INTEGER
               AS rank,
             library_name, usage_count
      FROM (SELECT DISTINCT sector, library_name, usage_count
            FROM (SELECT * FROM (SELECT * FROM week ORDER BY usage_count DESC, library_name LIMIT 500)
                  WHERE lower(library_name) NOT IN ({_NOISE}))
            JOIN (SELECT DISTINCT lang AS sector,
                         substr(lower(split_part(text, ' ', 1)), 1, (doc_id % 6 + 1)::INTEGER) AS keyword
                  FROM documents WHERE lang IS NOT NULL) ON keyword <> '' AND contains(lower(library_name), keyword))
      QUALIFY rank <= 20""",
    "trend_topk_summary": "SELECT library_name, usage_count FROM week ORDER BY usage_count DESC, library_name LIMIT 300",
    "llm_candidates": "SELECT rank::INTEGER AS rank, library_name, usage_count FROM candidate",
    "llm_candidate_list": """
      SELECT string_agg(library_name, ', ' ORDER BY rank) AS libraries FROM candidate""",
    "sector_top_libraries": f"""
      SELECT sector, coalesce(top_libraries, '') AS top_libraries
      FROM (VALUES {_SECTORS}) sectors(sector, sector_ord)
      LEFT JOIN (SELECT sector, string_agg(library_name, ',' ORDER BY rank) AS top_libraries
                 FROM (SELECT DISTINCT sector, rank, library_name
                       FROM candidate JOIN seed ON contains(lower(library_name), keyword)
                       QUALIFY dense_rank() OVER (PARTITION BY sector ORDER BY rank) <= 10)
                 GROUP BY sector) USING (sector)""",
    "llm_response_parse": "SELECT sector, theme, summary, top_libs, doc_id FROM parsed",
    "vibe_rows": """
      SELECT vibe_date::VARCHAR AS vibe_date, theme_name, summary, top_libraries FROM vibe""",
    "vibe_latest": """
      SELECT vibe_date::VARCHAR AS vibe_date, theme_name, summary, top_libraries FROM vibe
      ORDER BY vibe.vibe_date DESC, theme_name, summary LIMIT 4""",
    "vibe_sector": f"""
      SELECT CASE WHEN contains(theme_name, ']')
                  THEN trim(replace(split_part(theme_name, ']', 1), '[', ''))
                  ELSE theme_name END AS sector,
             count(*) AS reports
      FROM vibe GROUP BY 1""",
    "leak_table_layout": """
      SELECT repo_name, commit_sha, round(entropy_score, 6) AS entropy_score, detected_at,
             detected_at::DATE::VARCHAR AS detected_date
      FROM leak, as_of WHERE detected_at > t - INTERVAL 7 DAY""",
    "stream_push_parse": _PARSE,
    "stream_leaks_sink": """
      SELECT repo_name, commit_sha, round(entropy_score, 6) AS entropy_score, detected_at
      FROM leak""",
    "stream_trends_sink": """
      SELECT library_name, language, count(*) AS n, count(DISTINCT repo_name) AS repos,
             min(detected_at::DATE)::VARCHAR AS first_day,
             max(detected_at::DATE)::VARCHAR AS last_day
      FROM trend GROUP BY ALL""",
    "stream_dual_sink": """
      SELECT detected_date::VARCHAR AS detected_date, coalesce(trends, 0) AS trends, coalesce(leaks, 0) AS leaks
      FROM (SELECT detected_at::DATE AS detected_date, count(*) AS trends FROM trend GROUP BY 1)
      FULL JOIN (SELECT detected_at::DATE AS detected_date, count(*) AS leaks FROM leak GROUP BY 1)
        USING (detected_date)""",
    "stream_dedupe": _UNIQUE,
    "stream_quarantine": """
      SELECT name AS repo_name, head AS commit_sha, round(value, 6) AS entropy_score, created_at AS detected_at,
             CASE WHEN head IS NULL THEN 'commit_sha' ELSE '' END AS violations
      FROM raw JOIN events USING (event_id) WHERE type = 'PushEvent'""",
    "stream_entropy_hourly": _HOURLY,
    "stream_kpi_sliding": """
      SELECT hr, count(DISTINCT commit_sha) AS total_leaks, round(avg(entropy_score), 6) AS avg_risk,
             count(*) FILTER (WHERE entropy_score > 4.5) AS critical_count,
             count(DISTINCT repo_name) AS affected_repos
      FROM (SELECT unnest(generate_series(date_trunc('hour', min(detected_at)), date_trunc('hour', max(detected_at)),
                                          INTERVAL 1 HOUR)) AS hr FROM leak)
      JOIN leak ON detected_at < hr + INTERVAL 1 HOUR AND detected_at >= hr - INTERVAL 23 HOUR
      GROUP BY hr""",
    "commit_variant_files": f"""
      SELECT {_repo('doc_id')} AS repo_name, sha1(doc_id::VARCHAR) AS commit_sha, 'src/main.py' AS filename,
             text AS patch, lang, n_chars AS changes,
             CASE WHEN lang IS NULL THEN '' ELSE 'lang' END AS commit_fields,
             concat_ws(',', CASE WHEN n_chars IS NOT NULL THEN 'changes' END, 'origin') AS file_fields
      FROM documents WHERE doc_id % 11 > 2 AND doc_id % 13 <> 0 AND length(text) > 0""",
    "commit_variant_rejects": """
      SELECT doc_id, CASE doc_id % 11 WHEN 0 THEN 'no JSON' WHEN 1 THEN 'no object' WHEN 2 THEN 'files are no list'
                                      ELSE 'lacks sha' END AS reason
      FROM documents WHERE doc_id % 11 < 3 OR doc_id % 13 = 0""",
    "llm_response_rejects": """
      SELECT doc_id, CASE WHEN NOT json_valid(body) THEN 'no JSON'
                          WHEN json_type(body) <> 'ARRAY' THEN 'no list'
                          ELSE 'item ' || (list_position(lacking, true)) || ' lacks summary' END AS reason
      FROM (SELECT doc_id, body, CASE WHEN json_valid(body) THEN
                   list_transform(json_extract(body, '$[*]'), lambda x: json_extract_string(x, '$.summary') IS NULL) END AS lacking
            FROM bare)
      WHERE NOT json_valid(body) OR json_type(body) <> 'ARRAY' OR list_contains(lacking, true)""",
}

BODIES |= {
    "stream_findings_sink": BODIES["stream_leaks_sink"],
    "stream_commits_sink": BODIES["stream_leaks_sink"],
    "stream_feed_pages": BODIES["push_dedupe"],
    "stream_live_latest": BODIES["live_latest_per_repo"],
    "stream_batch_metrics": BODIES["push_batch_summary"],
    "feed_dedupe": BODIES["push_dedupe"],
    "commit_table_lookup": BODIES["leak_detect"],
    "vibe_table_roundtrip": BODIES["vibe_rows"],
    "masked_view_sql": BODIES["public_masked_view"],
}

ORACLE = {name: CTES + body for name, body in BODIES.items()}
