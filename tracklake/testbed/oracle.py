"""SQL for the registered queries, run by another engine over the same parquet tables."""

from __future__ import annotations

from ..operators.quality import Check
from ..plans.checks import CHECKS
from ..schemas import WIRE
from .models_sql import LISTEN, MODELS_SQL, category, clean_title, exact_sum, key, rounded
from .queries import CUT_MILLIS, MODEL_QUERIES
from .shapes_sql import RAW_SQL

CTES = ",\n".join(f"{name} AS ({sql})" for name, sql in {**RAW_SQL, **MODELS_SQL}.items())


def over_models(select: str) -> str:
    return f"WITH {CTES}\n{select}"


# Columns of the loaded tables that come straight from the visit columns, by kind.
TEXTS = ("auth", "level", "city", "state", "userAgent", "lastName", "firstName", "gender")
LONGS = ("sessionId", "itemInSession", "zip", "userId", "registration")
DOUBLES = ("lon", "lat")


def loaded(source: str, columns: str, unruly: bool = False, **given: str) -> str:
    """A load: defaults for NULLs; ``unruly`` states what the careless producer spoils."""
    if unruly:
        given = {
            "ts": "CASE WHEN itemInSession % 50 = 7 THEN 0 ELSE ts END",
            "zip": "CASE WHEN itemInSession % 4 = 1 THEN 0 ELSE coalesce(zip, 0) END",
            "sessionId": "CASE WHEN itemInSession % 6 <> 0 THEN sessionId ELSE 0 END",
            "level": "CASE WHEN itemInSession % 7 <> 0 THEN level ELSE 'NA' END",
            "lat": "CAST(0 AS DOUBLE)",
            **given,
        }
    parts = []
    for c in columns.split():
        default = "'NA'" if c in TEXTS else "0"
        parts.append(f"{given.get(c, f'coalesce({c}, {default})')} AS {c}")
    return over_models(f"SELECT {', '.join(parts)} FROM {source}")


ABSENT = {"auth": "'NA'", "level": "'NA'", "itemInSession": "CAST(0 AS BIGINT)", "lastName": "'NA'", "firstName": "'NA'",
          "gender": "'NA'", "registration": "CAST(0 AS BIGINT)"}
VISIT = "ts sessionId auth level itemInSession city zip state userAgent lon lat userId lastName firstName gender registration"


HELD_BACK = "ts < 1705000000000 AND itemInSession % 5 = 0"
FIRST_STEP = f"(SELECT * FROM raw_listen WHERE ts < {CUT_MILLIS} AND NOT ({HELD_BACK}))"


def staged_listens(source: str) -> str:
    return MODELS_SQL["stg_listen_events"].replace("raw_listen", source)


def late_rows_sql() -> str:
    """Staged rows behind the mark whose key the first step has not stored."""
    late = f"(SELECT * FROM raw_listen WHERE ts <= (SELECT max(ts) FROM {FIRST_STEP}) - 600000)"
    same = " AND ".join(
        f"f.{c} IS NOT DISTINCT FROM l.{c}"
        for c in ("event_datetime", "user_id", "postal_code", "city", "state", "song", "artist", "duration")
    )
    return over_models(f"""
        SELECT 'late' AS reason, event_datetime, user_id, song, artist FROM ({staged_listens(late)}) l
        WHERE NOT EXISTS (SELECT 1 FROM ({staged_listens(FIRST_STEP)}) f WHERE {same})""")


def future_event_sql() -> str:
    ahead = f"""(SELECT * REPLACE (ts + CAST(80 AS BIGINT) * 365 * 86400000 AS ts) FROM raw_listen
                 WHERE ts < {CUT_MILLIS} AND userId % 50 = 0)"""
    return over_models(f"""
        SELECT event_datetime, user_id, song, 'stored' AS part
        FROM ({staged_listens(f"(SELECT * FROM raw_listen UNION ALL SELECT * FROM {ahead})")})
        UNION ALL SELECT epoch_ms(ts), userId, song, 'future' FROM {ahead}""")


def unknown_users_sql() -> str:
    return over_models("""
        SELECT * EXCLUDE (pk_user) FROM dim_users WHERE user_id % 5 <> 0
        UNION ALL BY NAME
        SELECT CAST(0 AS BIGINT) AS user_id, 'NA' AS first_name, 'NA' AS last_name, 'NA' AS gender, 'free' AS level,
               min(registration_datetime) AS registration_datetime, min(registration_datetime) AS row_effective_datetime,
               TIMESTAMP '9999-01-01 00:00:00' AS row_expiry_datetime
        FROM stg_users WHERE user_id % 5 = 0 HAVING count(*) > 0""")


# The raw table behind each topic, and the fields it names or fills in another way.
WIRE_SOURCE = {
    "page_view_events": ("raw_page_view", {"method": "'PUT'", "status": "200", "artist": "NULL", "song": "NULL", "duration": "NULL"}),
    "auth_events": ("raw_auth", {}),
    "session_start_end_events": ("raw_session", {}),
    "status_change_events": ("raw_status", {"level": "old_level"}),
    "user_info": ("raw_user", {"level": "NULL"}),
}
SQL_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def topic_sql(topic: str) -> str:
    source, given = WIRE_SOURCE[topic]
    fields = [
        "epoch_ms(ts) AS ts" if f.name == "ts"
        else f"CAST({given.get(f.name, f.name)} AS {SQL_TYPE[f.dataType.simpleString()]}) AS {f.name}"
        for f in WIRE[topic].fields
    ]
    return over_models(f"SELECT {', '.join(fields)} FROM {source}")


def check_sql(c: Check) -> str:
    """Failures of one declared check."""
    cols = ", ".join(c.columns)
    if c.kind == "not_null":
        count = f"SELECT count(*) FROM {c.model} WHERE {c.column} IS NULL"
    elif c.kind == "accepted_range":
        low, high = (">=", "<=") if c.inclusive else (">", "<")
        tests = [f"{c.column} {op} {bound}" for op, bound in ((low, c.low), (high, c.high)) if bound is not None]
        count = f"SELECT count(*) FROM {c.model} WHERE NOT ({' AND '.join(tests)})"
    elif c.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in c.values)
        count = f"SELECT count(DISTINCT {c.column}) FROM {c.model} WHERE {c.column} NOT IN ({values})"
    elif c.kind == "relationships":
        count = (
            f"SELECT count(*) FROM {c.model} x WHERE x.{c.column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {c.parent} y WHERE y.{c.parent_column} = x.{c.column})"
        )
    else:
        present = f"WHERE {c.column} IS NOT NULL" if c.kind == "unique" else ""
        count = f"SELECT count(*) FROM (SELECT 1 FROM {c.model} {present} GROUP BY {cols} HAVING count(*) > 1)"
    return (
        f"SELECT '{c.model}' AS model, '{c.kind}' AS test, '{cols}' AS column_name, '{c.severity}' AS severity, "
        f"({count}) AS failures"
    )


# The titles of the streamed messages after repair.
STREAMED = """
    SELECT *, CASE WHEN regexp_full_match(song, '[A-Za-z ]+') AND song <> 'NA' AND itemInSession % 4 = 1
                   THEN song || 'é' ELSE song END AS repaired
    FROM raw_listen"""

MATCH_AT = """{event} >= u.row_effective_datetime AND {event} < u.row_expiry_datetime"""
NEWEST_STATUS = f"(SELECT max(ts) FROM raw_status WHERE ts < {CUT_MILLIS})"
NEWEST_LISTEN = f"(SELECT max(ts) FROM raw_listen WHERE ts < {CUT_MILLIS})"
STATUS_VERSION = """
    SELECT s.event_datetime, s.user_id, s.prev_level, u.pk_user, u.level
    FROM stg_status_change_events s
    LEFT JOIN dim_users u ON u.user_id = s.user_id AND s.event_datetime >= u.row_effective_datetime
                         AND s.event_datetime < u.row_expiry_datetime
    QUALIFY row_number() OVER (PARTITION BY s.event_datetime, s.user_id, s.prev_level
        ORDER BY u.row_effective_datetime DESC, u.row_expiry_datetime DESC, u.pk_user DESC, u.level DESC) = 1"""

ORACLE: dict[str, str] = {name: over_models(f"SELECT * FROM {spec[0]}") for name, spec in MODEL_QUERIES.items()}
ORACLE["subscription_journey"] = over_models(
    "SELECT * EXCLUDE (upgraded_user) FROM mart_user_subscription_journey"
)
ORACLE["ts_parts"] = """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
    FROM events"""

ORACLE.update(
    {
        "load_listen_events": loaded(
            "raw_listen",
            f"artist song duration {VISIT}",
            unruly=True,
            artist="artist",
            song="song",
            duration="CASE WHEN itemInSession % 5 <> 0 THEN duration ELSE -1 END",
        ),
        "load_page_view_events": loaded(
            "raw_page_view",
            f"page method status artist song duration ad_revenue {VISIT}",
            unruly=True,
            page="page",
            method="'PUT'",
            status="CAST(200 AS BIGINT)",
            artist="'NA'",
            song="'NA'",
            duration="CAST(-1 AS DOUBLE)",
        ),
        "load_auth_events": loaded(
            "raw_auth",
            f"{VISIT} success".replace(" auth", ""),
            unruly=True,
            success="itemInSession % 8 <> 0 AND success",
        ),
        "load_session_start_end_events": loaded("raw_session", VISIT, **ABSENT),
        "load_status_change_events": loaded(
            "raw_status", VISIT, level="old_level", auth="'NA'", sessionId="CAST(0 AS BIGINT)",
            itemInSession="CAST(0 AS BIGINT)",
        ),
        "load_user_info": loaded("raw_user", "userId lastName firstName gender registration ts"),
        "polymorphic_ts": """
            SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS from_number,
                   epoch_us(o_orderdate) // 1000 AS from_time,
                   CASE WHEN o_orderkey % 3 = 2 THEN 0
                        WHEN o_orderkey % 3 = 1 THEN epoch_ms(date_trunc('second', o_orderdate))
                        ELSE epoch_us(o_orderdate) // 1000 END AS from_text
            FROM orders""",
        "missing_field": "SELECT o_orderkey, o_orderpriority AS priority, 'NA' AS note FROM orders",
        "surrogate_key": f"""
            SELECT event_id, {key('t:ts', 'user_id', 'd:value', 'k')} AS row_key
            FROM (SELECT event_id, ts, user_id, value,
                         nullif(greatest(CAST(json_extract_string(props, '$.k') AS BIGINT), 9), 9) AS k FROM events)""",
        "normalize_title": f"SELECT doc_id, {clean_title('text')} AS normalized FROM documents",
        "match_forms": over_models(
            "SELECT DISTINCT song, artist, replace(song, '\\', '') AS title_form, lower(trim(artist)) AS artist_form "
            "FROM raw_listen"
        ),
        "page_category": over_models(
            f"SELECT page, {category('page')} AS category, count(*) AS views FROM raw_page_view GROUP BY page"
        ),
        "standardise_postal": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'AB' || o_orderkey
                                    ELSE lpad(CAST(o_orderkey * 37 AS VARCHAR), 5, '0') END AS postal
            FROM orders""",
        "trim_quotes": over_models("SELECT 'Mozilla/5.0' AS user_agent, count(*) AS views FROM raw_page_view"),
        "hour_bucket": "SELECT date_trunc('hour', ts) AS bucket, count(*) AS events FROM events GROUP BY 1",
        "time_differences": """
            SELECT l_orderkey, l_linenumber, date_sub('minute', o_orderdate, l_shipdate) AS minutes,
                   date_sub('day', o_orderdate, l_shipdate) AS days,
                   date_diff('second', o_orderdate, l_shipdate) AS seconds
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "guarded_numbers": over_models(f"""
            SELECT event_id, {rounded('value / 7', 2)} AS rounded,
                   CASE WHEN k = 0 THEN 0.0 ELSE {rounded('CAST(user_id AS DOUBLE) / nullif(k, 0)', 2)} END AS ratio,
                   {rounded('CAST(user_id AS DOUBLE) / nullif(k, 0)', 4)} AS share, nullif(k, 0) AS k_or_null
            FROM ev"""),
        "exact_sums": f"SELECT user_id, {exact_sum('value')} AS total FROM events GROUP BY user_id",
        "level_flip": over_models("""
            SELECT prev_level, CASE WHEN prev_level = 'free' THEN 'paid' ELSE 'free' END AS next_level,
                   count(*) AS changes
            FROM stg_status_change_events GROUP BY prev_level"""),
        "string_decode": "SELECT doc_id, trim(text, '\"') AS repaired FROM documents",
        "dedup_row_number": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey
                                       ORDER BY l_shipdate DESC, l_linenumber, l_partkey) = 1""",
        "dedup_status": over_models("""
            SELECT lower(old_level) AS prev_level, count(DISTINCT (ts, userId)) AS changes
            FROM raw_status GROUP BY 1"""),
        "users_collapse": over_models(f"""
            SELECT epoch_ms(min(ts)) AS event_datetime,
                   date_trunc('hour', epoch_ms(min(ts))) AS bucket_ingestion_datetime, userId AS user_id,
                   firstName AS first_name, lastName AS last_name, gender,
                   CASE WHEN userId % 2 = 0 THEN 'paid' ELSE 'free' END AS level,
                   epoch_ms(registration) AS registration_datetime
            FROM raw_user GROUP BY userId, firstName, lastName, gender, registration"""),
        "distinct_dims": over_models("""
            SELECT 'songs' AS dim, count(*) AS members, count(DISTINCT pk_song) AS keys FROM dim_songs
            UNION ALL SELECT 'pages', count(*), count(DISTINCT pk_page) FROM dim_pages
            UNION ALL SELECT 'locations', count(*), count(DISTINCT pk_location) FROM dim_locations"""),
        "latest_per_user": over_models("SELECT * FROM final_changes"),
        "union_all_history": over_models("SELECT * FROM user_history"),
        "rank_within_day": """
            SELECT *, dense_rank() OVER (PARTITION BY day ORDER BY lines DESC) AS place
            FROM (SELECT CAST(l_shipdate AS DATE) AS day, l_partkey, count(*) AS lines FROM lineitem GROUP BY ALL)""",
        "first_upgrade": over_models("""
            SELECT userId AS user_id, epoch_ms(min(ts)) AS first_upgrade FROM raw_status
            WHERE lower(old_level) = 'free' GROUP BY userId"""),
        "session_facts": over_models("SELECT * FROM session_facts"),
        "session_first_page": over_models("""
            SELECT first_page, count(*) AS sessions, CAST(sum(num_pages_visited) AS BIGINT) AS pages
            FROM session_facts GROUP BY first_page"""),
        "session_quality_tuned": over_models("""
            SELECT CASE WHEN session_duration_minutes >= 600 THEN 'High Quality'
                        WHEN session_duration_minutes >= 60 THEN 'Medium Quality'
                        ELSE 'Short Session' END AS session_quality_tier,
                   CASE WHEN total_events_in_session > 3 THEN 'Highly Active' ELSE 'Passive' END
                       AS user_engagement_level,
                   count(*) AS sessions
            FROM mart_session_quality_analysis GROUP BY 1, 2"""),
        "asof_listen": over_models(f"""
            SELECT event_datetime, user_id, song,
                   (SELECT max_by(u.pk_user, u.row_effective_datetime) FROM dim_users u
                    WHERE u.user_id = l.user_id AND {MATCH_AT.format(event='l.event_datetime')}) AS pk_user
            FROM stg_listen_events l"""),
        "asof_session": over_models(f"""
            SELECT session_id, level, postal_code, session_start_datetime,
                   (SELECT max_by(u.pk_user, u.row_effective_datetime) FROM dim_users u
                    WHERE u.user_id = f.user_id AND {MATCH_AT.format(event='f.session_start_datetime')}) AS pk_user
            FROM session_facts f"""),
        "asof_status": over_models(STATUS_VERSION),
        "interval_listen": over_models(f"""
            SELECT l.event_datetime, l.user_id, l.song, u.pk_user FROM stg_listen_events l
            LEFT JOIN (SELECT DISTINCT pk_user, user_id, row_effective_datetime, row_expiry_datetime
                       FROM dim_users) u
              ON u.user_id = l.user_id AND {MATCH_AT.format(event='l.event_datetime')}"""),
        "tolerance_match_best": over_models(
            "SELECT l.event_datetime, l.user_id, l.song, l.artist, l.duration, m.pk_song FROM stg_listen_events l "
            "JOIN listen_songs m ON "
            + " AND ".join(f"l.{c.strip()} IS NOT DISTINCT FROM m.{c.strip()}" for c in LISTEN.split(","))
        ),
        "location_join": over_models("""
            SELECT event_datetime, user_id, song,
                   (SELECT min(pk_location) FROM dim_locations g
                    WHERE g.city = l.city AND g.state_code = l.state AND g.raw_postal_code = l.postal_code)
                       AS pk_location
            FROM stg_listen_events l"""),
        "incremental_since": over_models(
            f"SELECT ts, userId, old_level AS level FROM raw_status WHERE ts > {NEWEST_STATUS} - 600000"
        ),
        "rows_too_late": over_models(
            "SELECT count(*) AS late FROM raw_status WHERE ts <= (SELECT max(ts) FROM raw_status) - 21600000"
        ),
        "value_from_query": """
            SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
        "merge_by_key_listens": over_models(f"""
            SELECT * REPLACE (CASE WHEN event_datetime > epoch_ms({NEWEST_LISTEN} - 600000) THEN 'merged'
                                   ELSE level END AS level)
            FROM stg_listen_events"""),
        "merge_users": over_models("SELECT * FROM stg_users"),
        "schema_sync": """
            SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS s_name,
                   CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END AS nation
            FROM supplier""",
        "raw_hour_append": over_models("""
            SELECT ts, userId, old_level AS level, CAST(0 AS BIGINT) AS sessionId,
                   CAST(year(epoch_ms(ts)) AS INTEGER) AS load_year, CAST(month(epoch_ms(ts)) AS INTEGER) AS load_month,
                   CAST(day(epoch_ms(ts)) AS INTEGER) AS load_day, CAST(hour(epoch_ms(ts)) AS INTEGER) AS load_hour
            FROM raw_status"""),
        "partitioned_clustered_write": over_models("""
            SELECT part, CAST(event_datetime AS DATE) AS event_date, event_datetime, user_id, song, artist, duration
            FROM stg_listen_events, (VALUES ('day'), ('users')) p(part)"""),
        "interleaved_write": over_models("SELECT event_datetime, user_id, song, artist, duration FROM stg_listen_events"),
        "stream_late_rows": over_models("""
            SELECT DISTINCT l.ts, l.userId, l.song, l.artist,
                   CASE WHEN l.held AND l.ts < n.newest - 600000 THEN 'late' ELSE 'on time' END AS side
            FROM (SELECT *, ts < 1705000000000 AND itemInSession % 5 = 0 AS held FROM raw_listen) l
            LEFT JOIN (SELECT userId, max(ts) AS newest FROM raw_listen
                       WHERE NOT (ts < 1705000000000 AND itemInSession % 5 = 0) GROUP BY userId) n ON n.userId = l.userId"""),
        "stream_dedup_native": over_models("SELECT DISTINCT epoch_ms(ts) AS ts, userId, song, artist FROM raw_listen"),
        "dim_users_incremental": over_models("SELECT * FROM dim_users"),
        "fact_listen_changes": over_models("SELECT * FROM fact_listen_events"),
        "fact_status_changes": over_models("SELECT * FROM fact_status_change_events"),
        "arrival_ledger": over_models("""
            SELECT 'staged' AS part, event_datetime, user_id, prev_level, CAST(1 AS BIGINT) AS rows FROM stg_status_change_events
            UNION ALL
            SELECT 'late', date_trunc('hour', epoch_ms(ts)), NULL, NULL, count(*) FROM raw_status
            WHERE day(epoch_ms(ts)) < 10 AND hour(epoch_ms(ts)) % 6 = 2 GROUP BY ALL"""),
        "compacted_sink": over_models("""
            SELECT make_timestamp(ts * 1000) AS ts, userId, old_level AS level, CAST(year(epoch_ms(ts)) AS INTEGER) AS year,
                   CAST(month(epoch_ms(ts)) AS INTEGER) AS month, CAST(day(epoch_ms(ts)) AS INTEGER) AS day
            FROM raw_status"""),
        "raw_hour_insert": over_models(f"""
            SELECT ts, userId, old_level AS level, CAST((ts - {CUT_MILLIS}) // 3600000 AS INTEGER) AS load_hour
            FROM raw_status JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR (ts - {CUT_MILLIS}) // 3600000 = 3
            WHERE ts >= {CUT_MILLIS} AND ts < {CUT_MILLIS} + 4 * 3600000"""),
        "refresh_users": over_models("SELECT * FROM stg_users"),
        "refresh_fact_listen": over_models("SELECT * FROM fact_listen_events"),
        "refresh_fact_status": over_models("SELECT * FROM fact_status_change_events"),
        "refresh_reports_late_rows": late_rows_sql(),
        "refresh_future_event": future_event_sql(),
        "dim_users_unknown": unknown_users_sql(),
        "tolerance_match_not_finite": over_models(
            "SELECT l.event_datetime, l.user_id, l.song, l.artist, "
            "l.user_id % 10 NOT IN (3, 5, 7) AND m.pk_song IS NOT NULL AS matched "
            "FROM stg_listen_events l JOIN listen_songs m ON "
            + " AND ".join(f"l.{c.strip()} IS NOT DISTINCT FROM m.{c.strip()}" for c in LISTEN.split(","))
        ),
        "decode_bad_times": over_models("""
            SELECT '{"ts":' || CASE event_id % 4 WHEN 0 THEN '99999999999999999' WHEN 1 THEN '9223372036854775807'
                                    WHEN 2 THEN '253402300800000' ELSE '-62135596800001' END
                   || ',"userId":' || event_id || '}' AS value, 'event time out of range' AS reason FROM ev
            UNION ALL SELECT '{"ts":' || ms || ',"userId":"x' || event_id || '"}', 'unreadable field' FROM ev
            UNION ALL SELECT CAST(ms AS VARCHAR), 'stored' FROM ev"""),
        **{f"stream_decode_{topic}": topic_sql(topic) for topic in WIRE_SOURCE},
        "songs_feed": over_models("SELECT track_id, artist, title, duration, genre FROM raw_songs"),
        "locations_feed": over_models("""
            SELECT 'US' AS country_code, CAST(zip AS VARCHAR) AS postal_code, city, state, state AS state_code,
                   CAST(person AS VARCHAR) AS borough_county, CAST(NULL AS VARCHAR) AS borough_county_code
            FROM people"""),
        "csv_skips_malformed": """
            SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS segment FROM customer
            WHERE c_custkey % 7 <> 0""",
        "seed_csv": "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer",
        "parquet_views": "SELECT c_custkey AS customer_key, c_name AS customer_name FROM customer",
        "dq_unique": over_models(
            "SELECT pk_song, count(*) AS n_records FROM dim_songs GROUP BY pk_song HAVING count(*) > 1"
        ),
        "dq_not_null": over_models("SELECT * FROM fact_listen_events WHERE pk_song IS NULL"),
        "dq_accepted_values": over_models(f"""
            SELECT page, count(*) AS n_records FROM stg_page_view_events
            WHERE {category('page')} = 'UNKNOWN' GROUP BY page"""),
        "dq_relationships": over_models("""
            SELECT song, count(*) AS n_records FROM stg_listen_events
            WHERE song NOT IN (SELECT title FROM dim_songs) GROUP BY song"""),
        "dq_range": over_models("""
            SELECT event_datetime, user_id, song, duration FROM stg_listen_events
            WHERE duration <= 901 OR duration >= 908.5"""),
        "dq_unique_combo": over_models("""
            SELECT event_datetime, user_id, session_id, item_in_session, count(*) AS n_records
            FROM stg_page_view_events GROUP BY ALL HAVING count(*) > 1"""),
        "dq_report": over_models(" UNION ALL ".join(check_sql(c) for c in CHECKS)),
        "stream_decode": over_models(f"""
            SELECT epoch_ms(ts) AS ts, userId, repaired AS song, artist, duration, city,
                   CAST(zip AS INTEGER) AS zip, level
            FROM ({STREAMED})"""),
        "stream_partition_sink": over_models("""
            SELECT CAST(year(epoch_ms(ts)) AS INTEGER) AS year, CAST(month(epoch_ms(ts)) AS INTEGER) AS month,
                   CAST(day(epoch_ms(ts)) AS INTEGER) AS day, CAST(hour(epoch_ms(ts)) AS INTEGER) AS hour,
                   count(*) AS events
            FROM raw_listen GROUP BY ALL"""),
        "stream_dead_letter": over_models("""
            SELECT CASE WHEN k % 2 = 0 THEN 'not json ' || event_id ELSE '{"userId":' || event_id || '}' END AS value,
                   'listen_events' AS topic,
                   CASE WHEN k % 2 = 0 THEN 'unreadable json' ELSE 'no event time' END AS reason
            FROM ev WHERE event_type = 'purchase'"""),
        "batch_decode": over_models("""
            SELECT false AS unreadable, count(*) AS n, 'rows' AS path FROM raw_listen
            UNION ALL SELECT true, count(*), p.path FROM ev, (VALUES ('rows'), ('letters')) p(path)
            WHERE event_type = 'purchase' GROUP BY p.path"""),
        "stream_archive": over_models("""
            SELECT strftime(date_trunc('hour', epoch_ms(ts)), '%Y-%m-%d %H:00:00+00') AS date, count(*) AS messages,
                   count(*) AS events
            FROM raw_listen GROUP BY 1
            UNION ALL SELECT '1970-01-01 00:00:00+00', count(*), 0 FROM ev WHERE event_type = 'purchase'"""),
        "stream_replay": over_models(f"""
            SELECT epoch_ms(ts) AS ts, userId, repaired AS song, artist FROM ({STREAMED}) WHERE ts >= 1705363200000"""),
        "stream_all_topics": over_models(" UNION ALL ".join(
            f"SELECT '{topic}' AS topic, CAST(epoch_ms(ts) AS DATE) AS day, count(*) AS events FROM {source} GROUP BY ALL"
            for topic, source in [("listen_events", "raw_listen"), *((t, given[0]) for t, given in WIRE_SOURCE.items())]
        )),
        "stream_dedup_watermark": over_models(f"""
            SELECT DISTINCT epoch_ms(ts) AS ts, userId, repaired AS song, artist FROM ({STREAMED})"""),
    }
)
