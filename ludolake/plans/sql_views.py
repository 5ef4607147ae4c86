"""The view definitions of ``views`` in SQL, for the cross-check queries."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-30 23:00:00'"

VIEWS: dict[str, str] = {
    "part_sales": """
        SELECT l_partkey, count(*) AS n,
               sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS pos, min(l_shipdate) AS d
        FROM lineitem GROUP BY l_partkey""",
    "games": """
        SELECT p_partkey AS app_id, p_name || ' ' || p_partkey AS title,
               strftime(d, '%Y-%m-%d') AS date_release,
               true AS win, p_partkey % 3 = 0 AS mac, p_partkey % 5 = 0 AS linux,
               CASE p_type WHEN 'STANDARD' THEN 'Very Positive' WHEN 'SMALL' THEN 'Positive'
                           WHEN 'LARGE' THEN 'Mostly Positive' WHEN 'PROMO' THEN 'Mixed'
                           WHEN 'MEDIUM' THEN 'Mostly Negative' ELSE 'Negative' END AS rating,
               CAST(floor(CAST(100 * pos AS DOUBLE) / n) AS INTEGER) AS positive_ratio,
               CAST(n * n * (p_partkey % 97) AS INTEGER) AS user_reviews,
               CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE (p_size * 5 - 1) / 4.0 END AS DOUBLE) AS price_final,
               CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE (p_size * 5 - 1) / 4.0 END AS DOUBLE)
                   + CAST(p_size % 4 AS DOUBLE) * 5 AS price_original,
               CAST(p_size % 4 AS DOUBLE) * 5 AS discount,
               p_partkey % 2 = 0 AS steam_deck
        FROM part JOIN part_sales ON p_partkey = l_partkey""",
    "gappy_games": """
        SELECT app_id, CASE WHEN app_id % 17 = 0 THEN NULL ELSE title END AS title,
               CASE WHEN app_id % 13 = 0 THEN NULL ELSE date_release END AS date_release,
               win, mac, linux, CASE WHEN app_id % 29 = 0 THEN NULL ELSE rating END AS rating,
               CASE WHEN app_id % 31 = 0 THEN 120 ELSE positive_ratio END AS positive_ratio,
               CASE WHEN app_id % 23 = 0 THEN NULL ELSE user_reviews END AS user_reviews,
               CASE WHEN app_id % 19 = 0 THEN NULL ELSE price_final END AS price_final,
               price_original, CASE WHEN app_id % 11 = 0 THEN NULL ELSE discount END AS discount,
               steam_deck
        FROM games""",
    "featured": """
        SELECT *, CAST(win AS INTEGER) + CAST(mac AS INTEGER) + CAST(linux AS INTEGER) AS platform_count,
               CAST(steam_deck AS INTEGER) AS steam_deck_numeric,
               CASE WHEN user_reviews > 0 THEN log10(user_reviews + 1) ELSE 0.0e0 END AS user_reviews_log,
               CAST(left(date_release, 4) AS INTEGER) AS release_year,
               CASE WHEN price_final = 0 THEN 0 WHEN price_final <= 5 THEN 1 WHEN price_final <= 20 THEN 2
                    WHEN price_final <= 50 THEN 3 ELSE 4 END AS price_category
        FROM games""",
    "clustered": """
        SELECT *, CAST(app_id % 13 AS INTEGER) AS cluster FROM featured""",
    "player_events": """
        SELECT event_id, 'player_' || user_id AS player_id, 'game_' || (event_id % 50) AS game_id,
               user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
               CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN 'game_start'
                    WHEN 'signup' THEN 'achievement_unlock' WHEN 'purchase' THEN 'purchase'
                    ELSE 'game_crash' END AS event_type,
               ts AS timestamp, ts AS processed_at
        FROM events""",
    "server_logs": """
        SELECT event_id,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'DEBUG'
                    WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
               CASE event_type WHEN 'view' THEN 'Player joined server'
                    WHEN 'purchase' THEN 'Player left server' WHEN 'error' THEN 'Connection timeout'
                    ELSE 'Game started' END AS action,
               'srv_' || (event_id % 10) AS server_id, 'player_' || user_id AS player_id,
               value * 20 AS response_time_ms, ts AS timestamp, ts AS processed_at
        FROM events""",
    "game_metrics": """
        SELECT *, CASE WHEN crash_rate_percent > 2.0 THEN 'poor' WHEN crash_rate_percent > 1.0 THEN 'moderate'
                       ELSE 'good' END AS health_status
        FROM (SELECT event_id, 'game_' || (event_id % 50) AS game_id,
                     CAST(event_id % 1000 AS INTEGER) AS concurrent_players,
                     value / 50 AS crash_rate_percent, ts AS processed_at FROM events)""",
    "player_stats": """
        SELECT *, CASE WHEN total_playtime_hours > 1000 THEN 'hardcore'
                       WHEN total_playtime_hours > 100 THEN 'regular' ELSE 'casual' END AS player_category
        FROM (SELECT 'player_' || user_id AS player_id,
                     CAST(count(*) * (user_id % 20) AS DOUBLE) AS total_playtime_hours
              FROM events GROUP BY user_id)""",
    "reviews": """
        SELECT doc_id, 'rev_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS review_id, text,
               strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%S') AS timestamp,
               CAST(n_chars % 200 AS INTEGER) AS playtime_hours,
               CAST(doc_id % 101 AS INTEGER) AS helpful_votes,
               CAST((doc_id * 7) % 151 AS INTEGER) AS total_votes
        FROM documents""",
    "streamed_reviews": """
        SELECT 'msg_' || conv_id || '_' || turn AS review_id, 'player_' || (conv_id % 500) AS player_id,
               'game_' || (conv_id % 50) AS game_id, CAST(1 + (conv_id + turn) % 10 AS INTEGER) AS rating,
               text AS review_text, CAST(conv_id % 101 AS INTEGER) AS helpful_votes,
               CAST((conv_id * 7) % 151 AS INTEGER) AS total_votes,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(conv_id * 10 + turn) AS processed_at,
               CASE WHEN regexp_matches(lower(text), 'amazing|great|fantastic|love') THEN 'positive'
                    WHEN regexp_matches(lower(text), 'terrible|awful|hate|worst') THEN 'negative'
                    ELSE 'neutral' END AS sentiment_indicator
        FROM conversations""",
    "server_configs": """
        SELECT 'game_server_' || s_suppkey AS game_server_name,
               CAST(7000 + s_suppkey % 2000 AS BIGINT) AS game_server_port,
               CAST(16 * (1 + s_suppkey % 8) AS BIGINT) AS game_server_max_players,
               CASE s_nationkey % 4 WHEN 0 THEN 'us-east' WHEN 1 THEN 'us-west'
                    WHEN 2 THEN 'eu-central' ELSE 'asia-pacific' END AS game_server_region,
               s_suppkey % 2 = 0 AS game_settings_friendly_fire,
               CAST(64 * (1 + s_suppkey % 3) AS BIGINT) AS performance_tick_rate
        FROM supplier""",
}


def with_views(sql: str) -> str:
    """The SQL with the definitions of every view it names, directly or through a view."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit_order(name, body)

    def visit_order(name: str, body: str) -> None:
        visit(re.sub(rf"\b{name}\b", " ", body))
        if name not in needed:
            needed.append(name)

    visit(sql)
    sql = sql.strip()
    if not needed:
        return sql
    parts = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    if sql.upper().startswith("WITH "):
        return f"WITH {parts}, {sql[5:]}"
    return f"WITH {parts} {sql}"
