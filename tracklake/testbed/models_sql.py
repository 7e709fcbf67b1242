"""The models as SQL, stated independently of the Spark code, for the check."""

from __future__ import annotations

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def time_text(x: str) -> str:
    return (
        f"strftime({x}, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us({x}) % 1000000 = 0 THEN '' "
        f"WHEN epoch_us({x}) % 1000 = 0 THEN '.' || lpad(CAST((epoch_us({x}) % 1000000) // 1000 AS VARCHAR), 3, '0') "
        f"ELSE '.' || lpad(CAST(epoch_us({x}) % 1000000 AS VARCHAR), 6, '0') END || '+00'"
    )


def double_text(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def key(*parts: str) -> str:
    """``t:`` marks a time, ``d:`` a double; anything else is cast to text."""
    texts = []
    for part in parts:
        kind, _, name = part.rpartition(":")
        text = {"t": time_text, "d": double_text}.get(kind, lambda x: f"CAST({x} AS VARCHAR)")(name)
        texts.append(f"coalesce({text}, '{NULL_TOKEN}')")
    return "md5(" + " || '-' || ".join(texts) + ")"


def as_written(x: str) -> str:
    """A double as the decimal number that its text names."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20))"


def rounded(x: str, digits: int) -> str:
    return f"CAST(round({as_written(x)}, {digits}) AS DOUBLE)"


def exact_sum(x: str) -> str:
    return f"CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12))) AS DOUBLE)"


def clean_title(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x00-\\x7F]+|\"', '', 'g')"


TIMES = "epoch_ms(ts) AS event_datetime, date_trunc('hour', epoch_ms(ts)) AS bucket_ingestion_datetime"
PLACE = """CAST(zip AS VARCHAR) AS postal_code, coalesce(city, 'NO CITY') AS city,
           coalesce(state, 'NO STATE') AS state"""
LISTEN = "event_datetime, user_id, postal_code, city, state, song, artist, duration"
AT = "CAST(event_datetime AS DATE) AS activity_date"
AGE = "date_sub('day', registration_datetime, subscription_upgrade_datetime)"
CATEGORIES = {
    "Platform Information": ("About", "Help"),
    "Landing": ("Home",),
    "Registration": ("Register", "Submit Registration"),
    "Customisation": ("Settings", "Save Settings", "Cancel", "Cancellation Confirmation"),
    "Streaming": ("NextSong",),
    "Advertising": ("PlayAd",),
    "Error": ("Error",),
    "Authentication": ("Login", "Logout"),
    "Subscription": ("Upgrade", "Submit Upgrade", "Downgrade", "Submit Downgrade"),
}


def category(x: str) -> str:
    arms = " ".join(
        f"WHEN {x} IN ({', '.join(repr(p) for p in pages)}) THEN '{name}'" for name, pages in CATEGORIES.items()
    )
    return f"CASE {arms} ELSE 'UNKNOWN' END"


MODELS_SQL = {
    "stg_listen_events": f"""
        SELECT event_datetime, bucket_ingestion_datetime, user_id, postal_code, city, state,
               min(level) AS level, song, artist, duration
        FROM (SELECT {TIMES}, userId AS user_id, {PLACE}, level, {clean_title('song')} AS song, artist,
                     {rounded('duration', 2)} AS duration
              FROM raw_listen)
        GROUP BY ALL""",
    "stg_page_view_events": f"""
        SELECT {TIMES}, userId AS user_id, {PLACE}, level, sessionId AS session_id,
               itemInSession AS item_in_session, page, trim(userAgent, '"') AS user_agent,
               coalesce(ad_revenue, 0.0) AS ad_revenue
        FROM raw_page_view WHERE auth = 'Logged In'""",
    "stg_status_change_events": f"""
        SELECT DISTINCT {TIMES}, userId AS user_id, lower(old_level) AS prev_level FROM raw_status""",
    "stg_users": """
        SELECT epoch_ms(min(ts)) AS event_datetime, date_trunc('hour', epoch_ms(min(ts))) AS bucket_ingestion_datetime,
               userId AS user_id, firstName AS first_name, lastName AS last_name, gender,
               'free' AS level, epoch_ms(registration) AS registration_datetime
        FROM raw_user GROUP BY userId, firstName, lastName, gender, registration""",
    "final_changes": """
        SELECT user_id, CASE prev_level WHEN 'free' THEN 'paid' ELSE 'free' END AS level,
               event_datetime AS row_effective_datetime, TIMESTAMP '9999-01-01 00:00:00' AS row_expiry_datetime
        FROM stg_status_change_events
        QUALIFY event_datetime = max(event_datetime) OVER (PARTITION BY user_id)""",
    "user_history": """
        SELECT u.user_id, u.first_name, u.last_name, u.gender, u.registration_datetime,
               coalesce(s.prev_level, u.level) AS level,
               coalesce(lag(s.event_datetime) OVER (PARTITION BY u.user_id ORDER BY s.event_datetime NULLS FIRST,
                            u.event_datetime, u.first_name, u.last_name, u.gender, s.prev_level),
                        u.registration_datetime) AS row_effective_datetime,
               coalesce(s.event_datetime, TIMESTAMP '9999-01-01 00:00:00') AS row_expiry_datetime
        FROM stg_users u LEFT JOIN stg_status_change_events s ON s.user_id = u.user_id
        WHERE s.event_datetime IS NULL OR s.event_datetime >= u.event_datetime""",
    "dim_users": f"""
        SELECT {key('user_id', 't:row_effective_datetime')} AS pk_user, * FROM (
            SELECT p.*, f.level, f.row_effective_datetime, f.row_expiry_datetime
            FROM (SELECT DISTINCT user_id, first_name, last_name, gender, registration_datetime FROM stg_users) p
            JOIN final_changes f ON f.user_id = p.user_id
            UNION ALL SELECT * FROM user_history)""",
    "dim_songs": f"""
        SELECT {key('artist', 'title', 'd:duration')} AS pk_song, * FROM (
            SELECT DISTINCT artist, {clean_title('title')} AS title, {rounded('duration', 2)} AS duration, genre
            FROM raw_songs)""",
    "dim_locations": f"""
        SELECT DISTINCT {key('country_code', 'postal_code', 'l.city', 'l.state')} AS pk_location, country_code,
               CASE WHEN country_code = 'US' THEN lpad(postal_code, 5, '0') ELSE upper(postal_code) END
                   AS standardised_postal_code,
               postal_code AS raw_postal_code, coalesce(l.city, 'NO CITY') AS city,
               coalesce(l.state, 'NO STATE') AS state, state_code
        FROM raw_locations l""",
    "dim_pages": f"""
        SELECT {key('page_name')} AS pk_page, page_name, {category('page_name')} AS page_category
        FROM (SELECT DISTINCT page AS page_name FROM stg_page_view_events)""",
    "listen_songs": f"""
        SELECT l.*, s.pk_song
        FROM (SELECT DISTINCT {LISTEN} FROM stg_listen_events) l
        LEFT JOIN dim_songs s
          ON replace(l.song, '\\', '') = replace(s.title, '\\', '') AND lower(trim(l.artist)) = lower(trim(s.artist))
         AND abs(coalesce(l.duration, 0) - coalesce(s.duration, 0)) <= CAST(0.01 AS DOUBLE)
        QUALIFY row_number() OVER (PARTITION BY {', '.join('l.' + c.strip() for c in LISTEN.split(','))}
                                   ORDER BY abs(coalesce(l.duration, 0) - coalesce(s.duration, 0)), s.pk_song) = 1""",
    "fact_listen_events": f"""
        SELECT {key('t:event_datetime', 'user_id', 'song', 'artist', 'd:duration', 'postal_code', 'city', 'state')}
                   AS listen_event_key,
               event_datetime, pk_user, pk_location, pk_song
        FROM (SELECT l.*, u.pk_user, g.pk_location
              FROM listen_songs l
              LEFT JOIN dim_users u ON u.user_id = l.user_id AND l.event_datetime >= u.row_effective_datetime
                                   AND l.event_datetime < u.row_expiry_datetime
              LEFT JOIN dim_locations g ON g.city = l.city AND g.state_code = l.state
                                       AND g.raw_postal_code = l.postal_code
              QUALIFY row_number() OVER (
                  PARTITION BY {', '.join('l.' + c.strip() for c in LISTEN.split(','))}
                  ORDER BY u.row_effective_datetime DESC NULLS LAST, u.pk_user, g.pk_location) = 1)""",
    "page_views_once": """
        SELECT * FROM stg_page_view_events
        QUALIFY row_number() OVER (PARTITION BY event_datetime, user_id, session_id, item_in_session, page
                                   ORDER BY postal_code NULLS LAST, city, state, level, user_agent, ad_revenue) = 1""",
    "session_facts": f"""
        SELECT s.session_id, s.user_id, s.postal_code, s.city, s.state, s.level, e.page AS first_page,
               s.num_pages_visited, s.session_start_datetime, s.session_seconds, s.num_ads_served,
               s.total_ad_revenue
        FROM (SELECT session_id, user_id, postal_code, city, state, level, min(item_in_session) AS first_item,
                     count(*) AS num_pages_visited, min(event_datetime) AS session_start_datetime,
                     date_diff('second', min(event_datetime), max(event_datetime)) AS session_seconds,
                     count(*) FILTER (WHERE page = 'PlayAd') AS num_ads_served,
                     {exact_sum('ad_revenue')} AS total_ad_revenue
              FROM page_views_once GROUP BY ALL) s
        JOIN (SELECT session_id, user_id, postal_code, city, state, level, item_in_session, min(page) AS page
              FROM page_views_once GROUP BY ALL) e
          ON (e.session_id, e.user_id, e.postal_code, e.city, e.state, e.level, e.item_in_session)
           = (s.session_id, s.user_id, s.postal_code, s.city, s.state, s.level, s.first_item)
        WHERE s.postal_code IS NOT NULL""",
    "fact_session_events": """
        SELECT f.session_start_datetime, f.session_id, u.pk_user, g.pk_location, p.pk_page AS pk_entry_page,
               f.session_seconds, f.num_pages_visited, f.num_ads_served, f.total_ad_revenue
        FROM session_facts f
        LEFT JOIN dim_users u ON u.user_id = f.user_id AND f.session_start_datetime >= u.row_effective_datetime
                             AND f.session_start_datetime < u.row_expiry_datetime
        LEFT JOIN dim_locations g ON g.city = f.city AND g.state_code = f.state AND g.raw_postal_code = f.postal_code
        LEFT JOIN dim_pages p ON p.page_name = f.first_page
        QUALIFY row_number() OVER (
            PARTITION BY f.session_start_datetime, f.session_id, f.user_id
            ORDER BY u.row_effective_datetime DESC NULLS LAST, u.pk_user, f.level, f.postal_code, f.city, f.state,
                     g.pk_location) = 1""",
    "fact_status_change_events": f"""
        SELECT {key('t:event_datetime', 'user_id', 'prev_level')} AS status_change_event_key, event_datetime,
               pk_user, prev_level, CASE prev_level WHEN 'free' THEN 'paid' ELSE 'free' END AS next_level
        FROM (SELECT s.event_datetime, s.user_id, s.prev_level, u.pk_user
              FROM stg_status_change_events s
              LEFT JOIN dim_users u ON u.user_id = s.user_id AND s.event_datetime >= u.row_effective_datetime
                                   AND s.event_datetime < u.row_expiry_datetime
              QUALIFY row_number() OVER (PARTITION BY s.event_datetime, s.user_id, s.prev_level
                  ORDER BY u.row_effective_datetime DESC NULLS LAST, u.pk_user) = 1)""",
    "mart_daily_trending_songs": f"""
        SELECT *, dense_rank() OVER (PARTITION BY activity_date ORDER BY play_count DESC) AS rank
        FROM (SELECT {AT}, song, artist, count(*) AS play_count, count(DISTINCT user_id) AS unique_listeners
              FROM stg_listen_events WHERE song <> 'NA' GROUP BY ALL)""",
    "mart_fact_song_daily_performance": f"""
        SELECT {key('activity_date', 'song', 'artist')} AS song_daily_fact_key, activity_date, song, artist,
               play_count, unique_listeners, rank AS daily_rank, total_daily_plays, total_daily_unique_listeners,
               {rounded('CAST(play_count AS DOUBLE) / nullif(total_daily_plays, 0)', 4)} AS play_share_pct,
               rank <= 10 AS is_top_10_song
        FROM (SELECT *, CAST(sum(play_count) OVER (PARTITION BY activity_date) AS BIGINT) AS total_daily_plays,
                     CAST(sum(unique_listeners) OVER (PARTITION BY activity_date) AS BIGINT)
                         AS total_daily_unique_listeners
              FROM mart_daily_trending_songs)""",
    "mart_user_behavior_daily": f"""
        SELECT p.*, coalesce(l.total_listening_time, 0.0) AS total_listening_time
        FROM (SELECT user_id, {AT}, count(*) FILTER (page = 'NextSong') AS next_song_clicks,
                     count(*) FILTER (page = 'Settings') AS settings_clicks,
                     count(*) FILTER (page = 'Help') AS help_clicks,
                     count(*) FILTER (page = 'Error') AS error_count,
                     count(DISTINCT session_id) AS total_sessions
              FROM stg_page_view_events GROUP BY ALL) p
        LEFT JOIN (SELECT user_id, {AT}, {exact_sum('duration')} AS total_listening_time
                   FROM stg_listen_events GROUP BY ALL) l
          ON l.user_id = p.user_id AND l.activity_date = p.activity_date""",
    "mart_user_listening_stats": f"""
        SELECT u.user_id, u.first_name, u.last_name, u.gender, u.level AS user_tier, a.activity_date,
               a.total_songs_listened, {rounded('a.seconds / 60', 2)} AS total_listening_minutes,
               a.unique_artists_listened
        FROM (SELECT user_id, {AT}, count(song) AS total_songs_listened, {exact_sum('duration')} AS seconds,
                     count(DISTINCT artist) AS unique_artists_listened
              FROM stg_listen_events GROUP BY ALL) a
        JOIN (SELECT * FROM dim_users QUALIFY row_number() OVER (
                  PARTITION BY user_id ORDER BY row_effective_datetime DESC NULLS LAST,
                  row_expiry_datetime DESC NULLS LAST, level, first_name, last_name, gender) = 1) u
          ON u.user_id = a.user_id""",
    "mart_session_quality_analysis": """
        SELECT *, CASE WHEN session_duration_minutes >= 30 THEN 'High Quality'
                       WHEN session_duration_minutes >= 10 THEN 'Medium Quality'
                       ELSE 'Short Session' END AS session_quality_tier,
               CASE WHEN total_events_in_session > 50 THEN 'Highly Active' ELSE 'Passive' END AS user_engagement_level
        FROM (SELECT user_id, session_id, min(event_datetime) AS session_start_datetime,
                     max(event_datetime) AS session_end_datetime,
                     date_sub('minute', min(event_datetime), max(event_datetime)) AS session_duration_minutes,
                     count(*) AS total_events_in_session
              FROM stg_page_view_events GROUP BY ALL)""",
    "mart_user_subscription_journey": f"""
        SELECT *, {AGE} AS days_to_upgrade,
               CASE WHEN subscription_upgrade_datetime IS NULL THEN 'Free Tier (Never Upgraded)'
                    WHEN {AGE} <= 7 THEN 'Fast Conversion (< 1 Week)'
                    WHEN {AGE} <= 30 THEN 'Standard Conversion (< 1 Month)'
                    ELSE 'Long-term Conversion (> 1 Month)' END AS user_subscription_segment
        FROM (SELECT user_id, min(first_name) AS first_name, min(last_name) AS last_name,
                     min(registration_datetime) AS registration_datetime
              FROM stg_users GROUP BY user_id) r
        LEFT JOIN (SELECT user_id AS upgraded_user, min(event_datetime) AS subscription_upgrade_datetime
                   FROM stg_status_change_events WHERE lower(prev_level) = 'free' GROUP BY user_id) g
          ON g.upgraded_user = r.user_id""",
    "mart_fact_user_daily_activity": f"""
        SELECT {key('b.user_id', 'b.activity_date')} AS user_activity_fact_key, b.user_id, b.activity_date,
               coalesce(j.user_subscription_segment, 'Unknown') AS subscription_segment, j.days_to_upgrade,
               b.total_sessions, b.next_song_clicks, b.settings_clicks, b.help_clicks, b.error_count,
               coalesce(l.total_songs_listened, 0) AS total_songs_listened,
               coalesce(l.unique_artists_listened, 0) AS unique_artists_listened,
               coalesce(l.total_listening_minutes, 0.0) AS total_listening_minutes,
               b.total_listening_time AS total_listening_time_seconds,
               CASE WHEN b.total_sessions = 0 THEN 0.0
                    ELSE {rounded('b.next_song_clicks / b.total_sessions', 2)} END AS avg_next_song_clicks_per_session
        FROM mart_user_behavior_daily b
        LEFT JOIN mart_user_listening_stats l ON l.user_id = b.user_id AND l.activity_date = b.activity_date
        LEFT JOIN mart_user_subscription_journey j ON j.user_id = b.user_id""",
}
