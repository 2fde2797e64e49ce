"""SQL for the same results, run by DuckDB on the same parquet files."""

from __future__ import annotations

from checks.exports import NORMALISED_SQL
from palaver.functions import events as ev
from palaver.functions.text import WHITESPACE
from palaver.operators import prompts
from palaver.sources.fixtures import duckdb_ctes

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
WEEK = "TIMESTAMP '2024-01-24 00:00:00'"
MONTH = "TIMESTAMP '2024-01-01 00:00:00'"
TABLES = duckdb_ctes()
LIVE = "live AS (SELECT * FROM messages WHERE NOT is_deleted)"
ORACLES: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def add(name: str, body: str, *ctes: str, recursive: bool = False) -> None:
    parts = ",\n".join([TABLES, LIVE, *ctes])
    ORACLES[name] = f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"


# --- sources -----------------------------------------------------------------------------

add("export_bounds", """
SELECT message_id, created_at FROM messages
WHERE created_at > TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-20'
  AND message_id > 100""")
add("select_scope", """
SELECT message_id, server_id, channel_id FROM messages
WHERE channel_id = 32 OR server_id IN (SELECT server_id FROM servers WHERE active)""")
add("normalised_rows", """
SELECT file_path, server_id, server_name, channel_id, channel_name, message_id, discord_id,
       username, created_at, edited_at, reply_to_message_id, thread_id, reject,
       md5(content) AS content_md5
FROM rows""", NORMALISED_SQL)
add("import_rejects", """
SELECT file_path, 'no guild id' AS reason, CAST(1 AS BIGINT) AS n FROM arrivals WHERE no_guild
GROUP BY file_path
UNION ALL
SELECT file_path, reject, count(*) FROM rows WHERE reject IS NOT NULL GROUP BY file_path, reject
""", NORMALISED_SQL)
add("import_preview", """
SELECT file_path, any_value(server_name) AS server_name, any_value(channel_name) AS channel_name,
       count(*) AS new, any_value(channel_name) = 'purchase' AS is_thread
FROM rows GROUP BY file_path""", NORMALISED_SQL)

# --- merges ------------------------------------------------------------------------------

AUTHORS = """authors AS (
    SELECT * FROM rows WHERE message_id IS NOT NULL AND discord_id IS NOT NULL),
named AS (
    SELECT discord_id, arg_max(username, (file_path, event_id)) AS username
    FROM authors GROUP BY discord_id),
merged_users AS (
    SELECT coalesce(u.user_id, n.discord_id) AS user_id,
           coalesce(u.discord_id, n.discord_id) AS discord_id,
           coalesce(n.username, u.current_username) AS current_username,
           CASE WHEN u.user_id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00'
                ELSE u.created_at END AS created_at,
           CASE WHEN n.discord_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00'
                ELSE u.last_seen END AS last_seen
    FROM users u FULL JOIN named n ON u.discord_id = n.discord_id)"""
MERGED = """stored_rows AS (SELECT * FROM rows WHERE reject IS NULL),
batch AS (
    SELECT message_id,
           arg_min((server_id, channel_id, channel_name, discord_id, created_at,
                    reply_to_message_id, thread_id), (file_path, event_id)) AS f,
           arg_max((content, edited_at), (file_path, event_id)) AS l
    FROM stored_rows GROUP BY message_id),
incoming AS (
    SELECT b.message_id, f[1] AS server_id, f[2] AS channel_id, f[3] AS channel_name, u.user_id,
           l[1] AS content, f[5] AS created_at, l[2] AS edited_at, f[6] AS reply_to_message_id,
           f[7] AS thread_id
    FROM batch b JOIN merged_users u ON u.discord_id = f[4]),
merged AS (
    SELECT message_id, server_id, channel_id, channel_name, user_id, content, created_at,
           edited_at, CAST(NULL AS TIMESTAMP) AS deleted_at, false AS is_deleted,
           reply_to_message_id, thread_id
    FROM incoming WHERE message_id NOT IN (SELECT message_id FROM messages)
    UNION ALL
    SELECT s.message_id, s.server_id, s.channel_id, s.channel_name, s.user_id,
           CASE WHEN i.message_id IS NULL THEN s.content ELSE i.content END, s.created_at,
           CASE WHEN i.message_id IS NULL THEN s.edited_at ELSE i.edited_at END, s.deleted_at,
           i.message_id IS NULL AND s.is_deleted, s.reply_to_message_id, s.thread_id
    FROM messages s LEFT JOIN incoming i ON s.message_id = i.message_id)"""
STATS = """firsts AS (
    SELECT min(file_path) AS file_path FROM rows WHERE reject IS NULL
      AND message_id NOT IN (SELECT message_id FROM messages) GROUP BY message_id),
stats AS (
    SELECT file_path, CAST(sum(new) AS BIGINT) AS new,
           CAST(sum(valid) - sum(new) AS BIGINT) AS updated,
           CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(errors) AS BIGINT) AS errors
    FROM (SELECT file_path, 1 AS new, 0 AS valid, 0 AS skipped, 0 AS errors FROM firsts
          UNION ALL
          SELECT file_path, 0, CASE WHEN reject IS NULL THEN 1 ELSE 0 END,
                 CASE WHEN reject IS NULL THEN 0 ELSE 1 END, 0 FROM rows
          UNION ALL
          SELECT DISTINCT file_path, 0, 0, 0, 1 FROM arrivals WHERE no_guild)
    GROUP BY file_path)"""

add("merge_servers", """
SELECT s.server_id, coalesce(n.server_name, s.server_name) AS server_name, s.created_at,
       s.monitored_from, s.active
FROM servers s
LEFT JOIN (SELECT server_id, arg_max(server_name, file_path) AS server_name FROM rows
           GROUP BY server_id) n USING (server_id)""", NORMALISED_SQL)
add("merge_users", "SELECT * FROM merged_users", NORMALISED_SQL, AUTHORS)
add("username_changes", f"""
SELECT coalesce(u.user_id, c.discord_id) AS user_id, c.username,
       coalesce(c.previous, u.current_username) AS changed_from, {AS_OF} AS changed_at,
       CAST(row_number() OVER (PARTITION BY c.discord_id ORDER BY c.file_path, c.event_id) AS INTEGER) AS change_no
FROM (SELECT discord_id, username, file_path, event_id, lag(username) OVER (
          PARTITION BY discord_id ORDER BY file_path, event_id) AS previous FROM authors) c
LEFT JOIN users u ON u.discord_id = c.discord_id
WHERE coalesce(c.previous, u.current_username) <> c.username""", NORMALISED_SQL, AUTHORS)
add("merge_members", f"""
SELECT server_id, user_id, coalesce(m.joined_at, {AS_OF}) AS joined_at, m.left_at,
       p.seen IS NOT NULL OR m.is_active AS is_active
FROM server_members m
FULL JOIN (SELECT DISTINCT a.server_id, u.user_id, true AS seen
           FROM authors a JOIN merged_users u USING (discord_id)) p
USING (server_id, user_id)""", NORMALISED_SQL, AUTHORS)
add("merge_messages", """
SELECT message_id, server_id, channel_id, channel_name, user_id, created_at, edited_at,
       deleted_at, is_deleted, reply_to_message_id, thread_id, md5(content) AS content_md5
FROM merged""", NORMALISED_SQL, AUTHORS, MERGED)
add("import_stats", "SELECT * FROM stats", NORMALISED_SQL, STATS)
add("import_totals", """
SELECT CAST(sum(new) AS BIGINT) AS new, CAST(sum(updated) AS BIGINT) AS updated,
       CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(errors) AS BIGINT) AS errors,
       (SELECT count(*) FROM merged) AS message_count
FROM stats""", NORMALISED_SQL, AUTHORS, MERGED, STATS)

# --- library queries ---------------------------------------------------------------------

add("users_across_servers", """
SELECT u.discord_id, u.current_username, count(DISTINCT sm.server_id) AS server_count,
       array_to_string(list_sort(list(DISTINCT s.server_name)), '|') AS servers
FROM users u JOIN server_members sm ON u.user_id = sm.user_id
JOIN servers s ON sm.server_id = s.server_id
WHERE sm.is_active GROUP BY u.user_id, u.discord_id, u.current_username
HAVING count(DISTINCT sm.server_id) >= 3""")
CONTEXT = """
SELECT m.message_id, m.created_at, s.server_name, m.channel_name, m.content, m.is_deleted,
       count(r.id) AS reaction_count
FROM live m JOIN servers s ON m.server_id = s.server_id
LEFT JOIN reactions r ON m.message_id = r.message_id
WHERE m.user_id = 8 {window} GROUP BY ALL"""
add("user_message_context", CONTEXT.format(window=""))
add("user_message_context_recent", CONTEXT.format(window=f"AND m.created_at > {WEEK}"))
add("channel_messages", f"""
SELECT m.message_id, m.created_at, u.current_username AS author, m.content,
       m.reply_to_message_id, m.thread_id
FROM live m JOIN users u ON m.user_id = u.user_id
WHERE m.server_id = 3 AND m.channel_id = 32 AND m.created_at > {MONTH}""")
HEALTH = """
SELECT {key} month, CAST(sum(n) AS BIGINT) AS new_members, CAST(sum(l) AS BIGINT) AS left_members,
       CAST(sum(n) - sum(l) AS BIGINT) AS net_change
FROM (SELECT server_id, CAST(date_trunc('month', joined_at) AS DATE) AS month,
             count(DISTINCT user_id) AS n, 0 AS l
      FROM server_members WHERE joined_at IS NOT NULL GROUP BY ALL
      UNION ALL
      SELECT server_id, CAST(date_trunc('month', left_at) AS DATE), 0, count(DISTINCT user_id)
      FROM server_members WHERE left_at IS NOT NULL GROUP BY ALL)
{where} GROUP BY ALL"""
add("server_health", HEALTH.format(key="", where="WHERE server_id = 3"))
add("server_health_all", HEALTH.format(key="server_id,", where=""))
ACTIVITY = f"""
SELECT s.server_id, s.server_name, count(DISTINCT m.message_id) AS total_messages,
       count(DISTINCT m.user_id) AS active_users, count(DISTINCT m.channel_id) AS active_channels
FROM live m JOIN servers s ON m.server_id = s.server_id
WHERE m.created_at > {WEEK} GROUP BY s.server_id, s.server_name"""
TOP_USERS = f"""
SELECT m.server_id, CAST(row_number() OVER (PARTITION BY m.server_id
           ORDER BY count(*) DESC, u.user_id) AS INTEGER) AS rank,
       u.current_username, count(*) AS message_count,
       array_to_string(list_sort(list(DISTINCT m.channel_name)), '|') AS channels
FROM live m JOIN users u ON m.user_id = u.user_id
WHERE m.created_at > {WEEK} GROUP BY m.server_id, u.user_id, u.current_username
QUALIFY rank <= 10"""
add("server_activity", ACTIVITY)
add("summary_top_users", TOP_USERS)
add("server_summary", """
SELECT a.*, (SELECT string_agg(concat(t.current_username, ':', t.message_count, ':',
                                      replace(t.channels, '|', ',')), '|' ORDER BY t.rank)
             FROM top_users t WHERE t.server_id = a.server_id) AS top_users, 7 AS days
FROM activity a WHERE a.server_id = 3""", f"activity AS ({ACTIVITY})", f"top_users AS ({TOP_USERS})")
ACTIVE = f"""
SELECT m.server_id, CAST(row_number() OVER (PARTITION BY m.server_id
           ORDER BY count(*) DESC, u.user_id) AS INTEGER) AS rank,
       u.user_id, u.discord_id, u.current_username, count(*) AS message_count,
       max(m.created_at) AS last_active, count(DISTINCT m.channel_id) AS channels_used
FROM live m JOIN users u ON m.user_id = u.user_id
WHERE m.created_at > {MONTH}
GROUP BY m.server_id, u.user_id, u.discord_id, u.current_username
QUALIFY rank <= 20"""
add("recent_active_users", "SELECT * EXCLUDE (server_id, rank) FROM active WHERE server_id = 3",
    f"active AS ({ACTIVE})")
add("recent_active_users_all", ACTIVE)
SEARCH = """
SELECT m.message_id, m.created_at, s.server_name, m.channel_name, u.current_username AS author,
       m.content
FROM live m JOIN servers s ON m.server_id = s.server_id JOIN users u ON m.user_id = u.user_id
WHERE m.content ILIKE {pattern} {where} ORDER BY m.created_at DESC, m.message_id DESC"""
add("search_messages", SEARCH.format(pattern="'%hack%'", where=""))
add("search_messages_in_server",
    SEARCH.format(pattern="'%N_ght 1%%'", where="AND m.server_id = 10"))
add("find_user", """
SELECT user_id, discord_id, current_username FROM users
WHERE current_username ILIKE '%deleted user%'""")
WEEKLY = """
SELECT {key} CAST(date_trunc('week', created_at) AS DATE) AS week_start,
       count(DISTINCT user_id) AS active_users, count(message_id) AS total_messages
FROM live {where} GROUP BY ALL"""
add("weekly_active_users", WEEKLY.format(key="", where="WHERE server_id = 3"))
add("weekly_active_users_all", WEEKLY.format(key="server_id,", where=""))
add("recent_weeks", WEEKLY.format(key="", where="WHERE server_id = 3")
    + " ORDER BY week_start DESC LIMIT 3")
add("channel_all_messages", """
SELECT m.message_id, m.created_at, u.current_username AS author, m.content
FROM live m JOIN users u ON m.user_id = u.user_id
WHERE m.server_id = 3 AND m.channel_name = 'click' AND m.content <> ''
ORDER BY m.created_at, m.message_id""")
add("all_servers", "SELECT server_id, server_name FROM servers")
add("server_by_id", "SELECT server_id, server_name FROM servers WHERE server_id = 3")
add("user_by_discord_id", "SELECT user_id FROM users WHERE discord_id = 1000008")
SAMPLE = f"""
SELECT m.server_id, CAST(row_number() OVER (PARTITION BY m.server_id
           ORDER BY m.created_at DESC, m.message_id DESC) AS INTEGER) AS rank,
       m.message_id, m.created_at, u.current_username AS author, m.content
FROM live m JOIN users u ON m.user_id = u.user_id
WHERE m.created_at > {MONTH} AND m.content <> '' QUALIFY rank <= 60"""
add("recent_sample",
    "SELECT message_id, created_at, author, content FROM sample WHERE server_id = 3",
    f"sample AS ({SAMPLE})")
add("recent_sample_all",
    "SELECT * EXCLUDE (content), md5(content) AS content_md5 FROM sample",
    f"sample AS ({SAMPLE})")
add("find_channel", """
SELECT DISTINCT channel_id, channel_name FROM messages
WHERE server_id = 3 AND channel_name ILIKE '%i%' ORDER BY channel_id LIMIT 1""")
add("total_messages", "SELECT count(*) AS message_count FROM messages")
add("messages_per_server", """
SELECT s.server_name, count(*) AS message_count FROM servers s JOIN messages m USING (server_id)
GROUP BY s.server_name""")
add("latest_messages", """
SELECT message_id, channel_name, created_at, content FROM messages
ORDER BY created_at DESC, message_id DESC LIMIT 5""")
add("username_lookup", """
SELECT h.user_id, u.discord_id, u.current_username, h.changed_from AS username,
       CAST(NULL AS TIMESTAMP) AS valid_from, h.changed_at AS valid_to
FROM username_history h JOIN users u USING (user_id)
WHERE h.changed_from = 'old_Customer#000000009' AND h.changed_at > TIMESTAMP '2023-01-01'""")
add("username_lookup_renames", """
SELECT h.user_id, u.discord_id, u.current_username, h.username,
       h.changed_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
FROM username_history h JOIN users u USING (user_id)
WHERE h.username = 'Customer#000000009'""")

# --- weekly job --------------------------------------------------------------------------

W1 = f"""
SELECT s.server_id, s.server_name, count(DISTINCT m.message_id) AS total_messages,
       count(DISTINCT m.user_id) AS unique_posters, count(DISTINCT m.channel_id) AS active_channels,
       count(DISTINCT CASE WHEN m.thread_id IS NOT NULL THEN m.message_id END) AS thread_messages
FROM servers s LEFT JOIN messages m ON s.server_id = m.server_id
     AND m.created_at > {WEEK} AND m.is_deleted = false
GROUP BY s.server_id, s.server_name"""
W2 = f"""
SELECT m.server_id, CAST(row_number() OVER (PARTITION BY m.server_id
           ORDER BY count(*) DESC, u.user_id) AS INTEGER) AS rank,
       u.current_username, count(*) AS messages
FROM live m JOIN users u ON m.user_id = u.user_id WHERE m.created_at > {WEEK}
GROUP BY m.server_id, u.user_id, u.current_username QUALIFY rank <= 5"""
W3 = f"""
SELECT server_id, CAST(row_number() OVER (PARTITION BY server_id
           ORDER BY count(*) DESC, channel_name) AS INTEGER) AS rank,
       channel_name, count(*) AS messages
FROM live WHERE created_at > {WEEK} AND thread_id IS NULL
GROUP BY server_id, channel_name QUALIFY rank <= 5"""
W4 = f"""
SELECT m.server_id, count(DISTINCT u.user_id) AS new_users
FROM users u JOIN messages m ON m.user_id = u.user_id WHERE u.created_at > {WEEK}
GROUP BY m.server_id"""
add("server_stats", W1)
add("top_users_per_server", W2)
add("top_channels_per_server", W3)
add("new_users_per_server", W4)
NESTED = f"w1 AS ({W1}), w2 AS ({W2}), w3 AS ({W3}), w4 AS ({W4})"
add("server_stats_nested", """
SELECT w1.*, coalesce(w4.new_users, 0) AS new_users,
       coalesce((SELECT string_agg(concat(current_username, ':', messages), '|' ORDER BY rank)
                 FROM w2 WHERE w2.server_id = w1.server_id), '') AS top_users,
       coalesce((SELECT string_agg(concat(channel_name, ':', messages), '|' ORDER BY rank)
                 FROM w3 WHERE w3.server_id = w1.server_id), '') AS top_channels,
       7 AS days
FROM w1 LEFT JOIN w4 USING (server_id)""", NESTED)
TRENDS = """
SELECT {key} s.server_name, CAST(date_trunc('week', m.created_at) AS DATE) AS week,
       count(*) AS posts, count(DISTINCT m.user_id) AS unique_users
FROM live m JOIN servers s USING (server_id)
WHERE m.created_at > TIMESTAMP '2023-12-06 00:00:00' GROUP BY ALL"""
add("weekly_trends", TRENDS.format(key=""))
add("weekly_trends_by_server", TRENDS.format(key="server_id,"))
add("weekly_trends_nested", """
SELECT server_name,
       string_agg(concat(week, ':', posts, ':', unique_users), '|' ORDER BY week DESC) AS weeks
FROM trends GROUP BY server_name""", f"trends AS ({TRENDS.format(key='')})")

SHORT_MARKED = " OR ".join(f"m.content ILIKE '%{k}%'" for k in ("bit.ly", "tinyurl", "shorturl"))
MARKED = SHORT_MARKED + "".join(
    f" OR m.content ILIKE '%{k}%'" for k in ("drive.google.com", "docs.google.com")
)
LINKS = """
SELECT m.message_id, m.created_at, s.server_name, m.channel_name, u.current_username,
       CAST(u.created_at AS DATE) AS account_created, CAST(m.created_at AS DATE) AS date,
       unnest(regexp_extract_all(m.content, '{pattern}')) AS url
FROM live m JOIN servers s ON m.server_id = s.server_id JOIN users u ON m.user_id = u.user_id
WHERE ({marked}) AND {where}"""
URL = r'https?://[^ \t-\r<>"]+'
SHORT_URL = r'https?://(?:bit\.ly|tinyurl\.com|shorturl\.at)/[^ \t-\r<>"]+'
W7 = LINKS.format(pattern=URL, marked=MARKED, where="u.current_username ILIKE '%deleted%'")
W8 = LINKS.format(pattern=SHORT_URL, marked=SHORT_MARKED, where=f"m.created_at > {WEEK}")
W9 = LINKS.format(
    pattern=URL,
    marked=MARKED,
    where=f"m.created_at > {WEEK} AND m.created_at - u.created_at < INTERVAL '7' DAY",
)
FLAG_TABLES = f"w7 AS ({W7}), w8 AS ({W8}), w9 AS ({W9})"
COLUMNS = "server_name, channel_name, current_username, date, url"
add("links_deleted_accounts", f"SELECT {COLUMNS} FROM w7", FLAG_TABLES)
add("shortlinks", f"SELECT {COLUMNS} FROM w8", FLAG_TABLES)
add("links_new_accounts", f"SELECT {COLUMNS}, account_created FROM w9", FLAG_TABLES)
FLAG_COLUMNS = """server_name, channel_name, current_username, CAST(date AS VARCHAR) AS date, url"""
add("security_flags", f"""
SELECT 'deleted_account_links' AS category, {FLAG_COLUMNS}, '' AS account_created FROM w7
UNION ALL SELECT 'shortlinks', {FLAG_COLUMNS}, '' FROM w8
UNION ALL SELECT 'new_account_links', {FLAG_COLUMNS}, CAST(account_created AS VARCHAR) FROM w9
""", FLAG_TABLES)
add("security_summary", """
SELECT 'deleted_account_links' AS category, count(*) AS flags FROM w7
UNION ALL SELECT 'shortlinks', count(*) FROM w8
UNION ALL SELECT 'new_account_links', count(*) FROM w9
UNION ALL SELECT 'total', (SELECT count(*) FROM w7) + (SELECT count(*) FROM w8)
    + (SELECT count(*) FROM w9)""", FLAG_TABLES)
add("weekly_report_lines", """
SELECT line FROM (
    SELECT unnest(['# Weekly community statistics — 2024-01-31 (last 7 days)', '', '---', '']) AS line
    UNION ALL
    SELECT unnest(['', '---', '', '# Security Scan', '',
                   '_Flags links that warrant manual review._', ''])
    UNION ALL SELECT unnest(['', concat('## ', server_name), '']) FROM w1
    UNION ALL SELECT unnest(['_No activity this period._', '']) FROM w1 WHERE total_messages = 0
    UNION ALL
    SELECT unnest(['| Metric | Value |', '| ------ | ----- |',
                   concat('| Messages | ', total_messages, ' |'),
                   concat('| Unique posters | ', unique_posters, ' |'),
                   concat('| Active channels | ', active_channels, ' |'),
                   concat('| Thread messages | ', thread_messages, ' |'),
                   concat('| New users | ', coalesce(new_users, 0), ' |'), ''])
    FROM w1 LEFT JOIN w4 USING (server_id) WHERE total_messages > 0
    UNION ALL
    SELECT unnest(['', '**Top contributors:**', '', '']) FROM w2 WHERE rank = 1
    UNION ALL SELECT concat('- **', current_username, '** — ', messages, ' messages') FROM w2
    UNION ALL
    SELECT unnest(['', '**Most active channels:**', '', '']) FROM w3 WHERE rank = 1
    UNION ALL SELECT concat('- #', channel_name, ' — ', messages, ' messages') FROM w3
    UNION ALL
    SELECT unnest(['', '**Weekly trend (last 8 weeks):**', '', '| Week | Posts | Unique users |',
                   '| ---- | ----- | ------------ |', ''])
    FROM w1 WHERE total_messages > 0 AND server_id IN (SELECT server_id FROM trends)
    UNION ALL
    SELECT concat('| ', week, ' | ', posts, ' | ', unique_users, ' |')
    FROM trends JOIN w1 USING (server_id) WHERE total_messages > 0
    UNION ALL
    SELECT unnest(['', '## Links from deleted accounts', '',
                   '', '## Shortlinks (destination hidden)', '',
                   '', '## Links from brand-new accounts (<7 days old)', ''])
    UNION ALL SELECT unnest(['| Date | Server | Channel | User | URL |',
                             '| ---- | ------ | ------- | ---- | --- |'])
    FROM (SELECT 1 FROM w7 LIMIT 1)
    UNION ALL SELECT unnest(['| Date | Server | Channel | User | URL |',
                             '| ---- | ------ | ------- | ---- | --- |'])
    FROM (SELECT 1 FROM w8 LIMIT 1)
    UNION ALL SELECT unnest(['| Date | Server | Channel | User | Account created | URL |',
                             '| ---- | ------ | ------- | ---- | --------------- | --- |'])
    FROM (SELECT 1 FROM w9 LIMIT 1)
    UNION ALL SELECT '_None found._' WHERE NOT EXISTS (SELECT 1 FROM w7)
    UNION ALL SELECT '_None found._' WHERE NOT EXISTS (SELECT 1 FROM w8)
    UNION ALL SELECT '_None found._' WHERE NOT EXISTS (SELECT 1 FROM w9)
    UNION ALL SELECT concat('| ', date, ' | ', server_name, ' | #', channel_name, ' | ',
                            current_username, ' | ', url, ' |') FROM w7
    UNION ALL SELECT concat('| ', date, ' | ', server_name, ' | #', channel_name, ' | ',
                            current_username, ' | ', url, ' |') FROM w8
    UNION ALL SELECT concat('| ', date, ' | ', server_name, ' | #', channel_name, ' | ',
                            current_username, ' | ', account_created, ' | ', url, ' |') FROM w9)
""", NESTED, FLAG_TABLES, f"trends AS ({TRENDS.format(key='server_id,')})")

# --- token budgets -----------------------------------------------------------------------

TOKENS = (
    "CASE WHEN coalesce(content, '') = '' THEN 0 ELSE greatest(1, CAST(floor("
    f"len(regexp_extract_all(content, '[^{WHITESPACE}]+')) * CAST(1.3 AS DOUBLE)) AS BIGINT)) END"
)


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WHITESPACE}]+|[{WHITESPACE}]+\\z', '', 'g')"


BODY = strip("content")
add("token_estimates", f"SELECT message_id, CAST({TOKENS} AS BIGINT) AS tokens FROM messages")


def packed(keys: str, source: str, order: str, name: str) -> str:
    """Greedy packing as a recursion over the rows of every key."""
    same = " AND ".join(f"n.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return f"""{name}_rows AS MATERIALIZED (
    SELECT {keys}, message_id, created_at, content, author, CAST({TOKENS} AS BIGINT) AS tokens,
           row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
    FROM {source}),
{name}_fold AS (
    SELECT {keys}, rn, message_id, tokens, tokens AS fill, CAST(0 AS BIGINT) AS chunk_no
    FROM {name}_rows WHERE rn = 1
    UNION ALL
    SELECT {', '.join('n.' + k.strip() for k in keys.split(','))}, n.rn, n.message_id, n.tokens,
           CASE WHEN p.fill + n.tokens > 8000 THEN n.tokens ELSE p.fill + n.tokens END,
           CASE WHEN p.fill + n.tokens > 8000 THEN p.chunk_no + 1 ELSE p.chunk_no END
    FROM {name}_fold p JOIN {name}_rows n ON {same} AND n.rn = p.rn + 1)"""


AUTHORED = """authored AS (
    SELECT m.*, u.current_username AS author FROM live m JOIN users u ON m.user_id = u.user_id)"""
LINE = (
    f"concat('[', strftime(created_at, '%Y-%m-%d %H:%M'), '] ', author, ': ', {BODY})"
)


def texts(name: str, keys: str) -> str:
    return f"""{name}_texts AS (
    SELECT {keys}, f.chunk_no,
           coalesce(string_agg(CASE WHEN {BODY} <> '' THEN {LINE} END, chr(10) ORDER BY f.rn), '')
               AS text
    FROM {name}_fold f JOIN {name}_rows r USING ({keys}, message_id) GROUP BY {keys}, f.chunk_no)"""


BY_CHANNEL = packed("server_id, channel_id", "authored", "created_at, message_id", "channel")
CHANNEL_TEXTS = texts("channel", "server_id, channel_id")
add("chunk_messages", "SELECT server_id, channel_id, message_id, tokens, chunk_no FROM channel_fold",
    AUTHORED, BY_CHANNEL, recursive=True)
add("format_lines", f"""
SELECT message_id, md5(CASE WHEN {BODY} <> '' THEN {LINE} ELSE '' END) AS line_md5
FROM authored""", AUTHORED)
add("chunk_and_format", """
SELECT server_id, channel_id, chunk_no, md5(text) AS text_md5 FROM channel_texts""",
    AUTHORED, BY_CHANNEL, CHANNEL_TEXTS, recursive=True)
add("chunk_stats", f"""
SELECT server_id, channel_id, count(*) AS total_messages, CAST(sum(tokens) AS BIGINT) AS total_tokens,
       greatest(1, CAST(ceil(sum(tokens) / 8000.0) AS BIGINT)) AS estimated_chunks,
       round_even(CAST(sum(tokens) AS DOUBLE) / count(*), 1) AS avg_tokens_per_message
FROM (SELECT *, {TOKENS} AS tokens FROM live) GROUP BY server_id, channel_id""")

# --- event catalogue ---------------------------------------------------------------------


def pattern(text: str) -> str:
    """The other engine's dialect: its 'u' and 'd' flags are always on."""
    for ours, theirs in (("(?iud)", "(?i)"), ("(?iu)", "(?i)"), ("(?d)", "")):
        text = text.replace(ours, theirs)
    return quoted(text)


DATES = ", ".join(
    f"nullif(regexp_extract(content, {pattern(p)}, 1), '')" for p in ev.DATE_PATTERNS
)
FOUND = f"coalesce({DATES}, '')"
DATE = f"trim({strip(FOUND)}, ',')"
SPAN = "s[3:-3]"
TITLED = f"""spans AS (
    SELECT *, list_filter(list_transform(
        regexp_extract_all(content, {pattern(ev.TITLE_PATTERN)}), lambda s: {strip(SPAN)}),
        lambda t: length(t) > 4 AND NOT starts_with(t, '@')) AS found
    FROM live WHERE length({BODY}) >= 10),
titled AS (
    SELECT * EXCLUDE (found), unnest(found) AS title, unnest(range(len(found))) AS pos FROM spans),
announced AS (
    SELECT *, {DATE} AS date, channel_name AS source_channel, content AS raw_text
    FROM titled)"""
QUIET = f"NOT regexp_matches(title, {quoted(f'(?i)^(?:{ev.NOISE_WORDS}|{ev.NOISE_LETTERS})')})"
# Fixed values, written down once more: what ends a line, and the cues of an organising post.
LINE_END = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
FIRST_LINE = strip(f"regexp_extract({BODY}, {quoted(f'^[^{LINE_END}]*')})")
CUE_PATTERNS = (
    "|".join((r"\p{Nd}{1,2}:\p{Nd}{2}", r"at \p{Nd}{1,2}") + ev.CLOCK_CUES), "(?i)" + "|".join(ev.PLACE_CUES + ev.DAY_CUES),
    *ev.DATE_PATTERNS,
)
CUES = " OR ".join(f"regexp_matches(content, {pattern(p)})" for p in CUE_PATTERNS)
PLAYED = f"""played AS (
    SELECT *, 0 AS pos, {DATE} AS date, channel_name AS source_channel,
           content AS raw_text
    FROM (SELECT *, {FIRST_LINE} AS title FROM live WHERE length({BODY}) >= 15)
    WHERE ({CUES}) AND length(title) >= 4
      AND NOT regexp_matches(title, {pattern(ev.REPLY_LINE)})
      AND NOT regexp_matches(title, {pattern(ev.PHONE_LINE)}))"""
RANKS = """channels(channel_name, kind, channel_rank) AS (
    VALUES ('click', 'event', 0), ('view', 'event', 1), ('error', 'event', 2),
           ('signup', 'sports', 3), ('purchase', 'sports', 4))"""
COLLECTED = f"""chosen AS (
    SELECT m.message_id, c.* EXCLUDE (channel_name) FROM live m JOIN channels c USING (channel_name)
    WHERE m.content <> ''),
collected AS (
    SELECT server_id, channel_rank, created_at, message_id, pos, title, date,
           CAST(NULL AS VARCHAR) AS category, source_channel
    FROM announced JOIN chosen USING (message_id) WHERE kind = 'event' AND {QUIET}
    UNION ALL
    SELECT server_id, channel_rank, created_at, message_id, pos, title, date, 'sports',
           source_channel
    FROM played JOIN chosen USING (message_id) WHERE kind = 'sports'),
unique_events AS (
    SELECT * FROM collected
    QUALIFY row_number() OVER (PARTITION BY server_id, {strip("lower(title)")}
                               ORDER BY channel_rank, created_at, message_id, pos) = 1)"""
RULES = ", ".join(
    f"({i * 1000 + j}, {quoted(category)}, {quoted(keyword)})"
    for i, (category, keywords) in enumerate(ev.KEYWORD_RULES)
    for j, keyword in enumerate(keywords)
)


def labelled(source: str) -> str:
    return f"""rules(prio, category, keyword) AS (VALUES {RULES}),
labelled AS (
    SELECT e.* EXCLUDE (category), coalesce(r.category, 'other') AS category,
           coalesce(r.keyword, '') AS matched_keyword
    FROM {source} e LEFT JOIN (
        SELECT title, arg_min(category, prio) AS category, arg_min(keyword, prio) AS keyword
        FROM (SELECT DISTINCT title FROM {source}) JOIN rules ON contains(lower(title), keyword)
        GROUP BY title) r ON e.title = r.title)"""


CATALOGUE = (TITLED, PLAYED, RANKS, COLLECTED)
add("extract_titles", "SELECT message_id, CAST(pos AS INTEGER) AS pos, title FROM titled", TITLED)
add("extract_dates", f"SELECT message_id, {DATE} AS date FROM messages")
add("extract_events", """
SELECT message_id, CAST(pos AS INTEGER) AS pos, title, date, source_channel, raw_text
FROM announced""", TITLED)
add("drop_noise_titles",
    f"SELECT message_id, CAST(pos AS INTEGER) AS pos, title FROM titled WHERE {QUIET}", TITLED)
add("extract_sports", """
SELECT message_id, title, date, 'sports' AS category, source_channel, md5(raw_text) AS raw_text_md5
FROM played""", PLAYED)
add("collect_channel_sets", """
SELECT channel_rank, message_id, CAST(pos AS INTEGER) AS pos, md5(title) AS title_md5, date,
       category, source_channel
FROM collected""", *CATALOGUE)
add("dedup_events", """
SELECT message_id, CAST(pos AS INTEGER) AS pos, md5(title) AS title_md5, date, source_channel
FROM unique_events""", *CATALOGUE)
add("unlabelled_as_other", """
SELECT message_id, CAST(pos AS INTEGER) AS pos, coalesce(category, 'other') AS category
FROM unique_events""", *CATALOGUE)
add("keyword_category", "SELECT message_id, category, matched_keyword FROM labelled",
    PLAYED, labelled("(SELECT *, '' AS category FROM played)"))
LABELLED = (*CATALOGUE, labelled("unique_events"))
add("label_coverage", """
SELECT count(*) AS total, count(*) FILTER (category <> 'other') AS matched,
       count(*) FILTER (category = 'other') AS unmatched,
       CAST(floor(100 * count(*) FILTER (category <> 'other') / count(*)) AS BIGINT) AS percent
FROM labelled""", *LABELLED)
add("unmatched_sample", """
SELECT title FROM labelled WHERE category = 'other'
ORDER BY server_id, channel_rank, created_at, message_id, pos LIMIT 30""", *LABELLED)
add("category_counts", "SELECT category, count(*) AS events FROM labelled GROUP BY category",
    *LABELLED)
add("labelled_catalogue_rows", """
SELECT date, category, matched_keyword, source_channel, md5(title) AS title_md5 FROM labelled
""", *LABELLED)

# --- prompts -----------------------------------------------------------------------------


def filled(template: str, **values: str) -> str:
    text = quoted(template)
    for key, value in values.items():
        text = f"replace({text}, '{{{key}}}', {value})"
    return text


USERS_ROWS = f"""active AS ({ACTIVE}),
chosen_users AS (SELECT * FROM active WHERE server_id = 3 AND rank <= 10),
unnamed AS (
    SELECT m.*, 'unknown' AS author FROM live m
    WHERE created_at > {MONTH} AND user_id IN (SELECT user_id FROM chosen_users))"""
add("user_story_prompts", f"""
SELECT c.user_id, c.current_username, c.message_count, t.chunk_no,
       md5({filled(prompts.USER_STORY, username='c.current_username', messages='t.text')})
           AS prompt_md5
FROM chosen_users c JOIN user_texts t ON c.user_id = t.user_id""",
    USERS_ROWS, packed("user_id", "unnamed", "created_at DESC, message_id DESC", "user"),
    texts("user", "user_id"), recursive=True)
add("channel_faq_prompts", f"""
SELECT server_id, channel_id, channel_name, chunk_no,
       md5({filled(prompts.CHANNEL_FAQ, channel='channel_name', messages='text')}) AS prompt_md5
FROM channel_texts JOIN (SELECT DISTINCT server_id, channel_id, channel_name FROM messages)
USING (server_id, channel_id)""", AUTHORED, BY_CHANNEL, CHANNEL_TEXTS, recursive=True)
TOPIC = "'parties and {messages}'"
add("factcheck_prompts", f"""
SELECT server_id, channel_id, chunk_no,
       md5({filled(prompts.FACTCHECK, topic=TOPIC, messages='text')}) AS prompt_md5
FROM channel_texts""", AUTHORED, BY_CHANNEL, CHANNEL_TEXTS, recursive=True)
BATCHED = f"""numbered AS (
    SELECT *, row_number() OVER (ORDER BY created_at, message_id, pos) - 1 AS n
    FROM announced WHERE {QUIET}),
batched AS (
    SELECT *, CAST(floor(n / 30) AS BIGINT) AS batch_no, CAST(n % 30 AS INTEGER) AS batch_pos
    FROM numbered)"""
add("event_batches", """
SELECT message_id, CAST(pos AS INTEGER) AS pos, batch_no, batch_pos FROM batched""",
    TITLED, BATCHED)
EVENT_LINES = """string_agg(concat(batch_pos + 1, '. Title: ', title, ' | Date: ',
    coalesce(nullif(date, ''), 'unknown')), chr(10) ORDER BY batch_pos)"""
add("event_batch_prompts", f"""
SELECT batch_no, md5({filled(prompts.EVENT_LABELS, events='listed')}) AS prompt_md5
FROM (SELECT batch_no, {EVENT_LINES} AS listed FROM batched GROUP BY batch_no)""", TITLED, BATCHED)
add("model_labels", """
SELECT message_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN batch_pos >= 20 THEN 'other' WHEN batch_pos % 2 = 1 THEN 'tech'
            ELSE 'social' END AS category
FROM batched""", TITLED, BATCHED)
SUMMARY = f"""summary AS (
    SELECT a.*, coalesce((SELECT string_agg(concat('{{', chr(10),
        '    "current_username" : "', t.current_username, '",', chr(10),
        '    "message_count" : ', t.message_count, ',', chr(10),
        '    "channels" : [ "', replace(t.channels, '|', '", "'), '" ]', chr(10), '  }}'),
        ', ' ORDER BY t.rank) FROM top_users t WHERE t.server_id = a.server_id), '') AS listed
    FROM activity a),
digest AS (
    SELECT server_id, server_name, concat('{{', chr(10),
        '  "server_name" : "', server_name, '",', chr(10),
        '  "total_messages" : ', total_messages, ',', chr(10),
        '  "active_users" : ', active_users, ',', chr(10),
        '  "active_channels" : ', active_channels, ',', chr(10),
        '  "top_users" : [ ', listed, ' ],', chr(10),
        '  "days" : 30', chr(10), '}}') AS data,
        coalesce((SELECT string_agg(CASE WHEN {BODY} <> '' THEN {LINE} END, chr(10) ORDER BY rank)
                  FROM sample m WHERE m.server_id = summary.server_id), '') AS lines
    FROM summary),
digests AS (
    SELECT server_id, server_name,
           {filled(prompts.DIGEST, server_data='data', messages='lines')} AS prompt
    FROM digest)"""
DIGESTS = (
    f"activity AS ({ACTIVITY.replace(WEEK, MONTH)})",
    f"top_users AS ({TOP_USERS.replace(WEEK, MONTH)})",
    f"sample AS ({SAMPLE})",
    SUMMARY,
)
add("digest_prompts", "SELECT server_id, server_name, md5(prompt) AS prompt_md5 FROM digests",
    *DIGESTS)
ANSWER = "concat('answer to ', length({}), ' characters')"
STORY = filled(prompts.USER_STORY, username="c.current_username", messages="t.text")
FAQ = filled(prompts.CHANNEL_FAQ, channel="'click'", messages="text")
add("analysis_report_lines", f"""
SELECT unnest(['# NATION_3 — Full Analysis', '_Generated 2024-01-31 00:00 · last 30 days_', '',
               '---', '', '', '', '## Weekly Digest', '', {ANSWER.format('prompt')}, '', '',
               '## Channel FAQ — #click', '',
               '', '', '## User Profiles', '', '', '', '## Server Health — Monthly Trends', '',
               '| Month | Joined | Left | Net |', '| ----- | ------ | ---- | --- |']) AS line
FROM digests WHERE server_id = 3
UNION ALL SELECT {ANSWER.format(FAQ)} FROM one_texts
UNION ALL
SELECT unnest(CASE WHEN t.chunk_no > 0 THEN [] ELSE
               ['', concat('### ', c.current_username, ' (', c.message_count, ' messages)')] END ||
               ['', {ANSWER.format(STORY)}])
FROM chosen_users c JOIN user_texts t ON c.user_id = t.user_id
UNION ALL
(SELECT concat('| ', month, ' | ', new_members, ' | ', left_members, ' | ',
               CASE WHEN net_change >= 0 THEN '+' ELSE '' END, net_change, ' |')
 FROM health ORDER BY month DESC LIMIT 12)""",
    *DIGESTS, USERS_ROWS, packed("user_id", "unnamed", "created_at DESC, message_id DESC", "user"),
    texts("user", "user_id"), AUTHORED,
    f"one AS (SELECT * FROM authored WHERE channel_id = 32 AND created_at > {MONTH})",
    packed("channel_id", "one", "created_at, message_id", "one"), texts("one", "channel_id"),
    "health AS (" + HEALTH.format(key="", where="WHERE server_id = 3") + ")",
    recursive=True)

# --- the same questions by other ways ------------------------------------------------------

ORACLES["search_messages_indexed"] = ORACLES["search_messages_in_server"]
ORACLES["rollup_weekly_active_users"] = ORACLES["weekly_active_users_all"]
ORACLES["rollup_server_stats"] = ORACLES["server_stats"]
ORACLES["rollup_weekly_trends"] = ORACLES["weekly_trends"]
