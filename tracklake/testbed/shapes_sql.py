"""The raw tables of ``shapes`` as common table expressions for the SQL check."""

from __future__ import annotations

PERSON = "p.lastName, p.firstName, p.gender, p.registration"
VISIT = """
    e.ms AS ts, e.user_id * 1000 + dayofyear(e.at) AS sessionId,
    CASE WHEN e.k % 20 = 0 THEN 'Guest' ELSE 'Logged In' END AS auth,
    CASE WHEN e.k >= 50 THEN 'paid' ELSE 'free' END AS level,
    hour(e.at) * 60 + minute(e.at) AS itemInSession,
    CASE WHEN e.k % 25 <> 4 THEN p.city END AS city, CASE WHEN e.k % 50 <> 9 THEN p.zip END AS zip,
    p.state, '"Mozilla/5.0"' AS userAgent, p.lon, p.lat, e.user_id AS userId,
    p.lastName, p.firstName, p.gender, p.registration"""


def copies(every: int) -> str:
    return f"JOIN (VALUES (0), (1)) AS c(copy) ON c.copy = 0 OR e.event_id % {every} = 0"


RAW_SQL = {
    "ev": """
        SELECT event_id, epoch_us(ts) // 1000 AS ms, ts AS at, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "people": """
        SELECT c_custkey AS person, c_name AS lastName, c_mktsegment AS firstName,
               CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               1701410400000 + (c_custkey % 45) * 86400000 AS registration,
               CAST(n_nationkey AS BIGINT) AS zip, n_name AS city, r_name AS state,
               c_acctbal AS lon, -c_acctbal AS lat
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "raw_listen": f"""
        SELECT CASE WHEN e.k % 4 = 1 THEN '  ' || upper(p_brand) || ' ' ELSE p_brand END AS artist,
               CASE WHEN e.k % 10 = 0 THEN 'NA'
                    WHEN e.k % 10 = 3 THEN '"' || p_name || 'é"'
                    WHEN e.k % 10 = 7 THEN p_name || '\\'
                    ELSE p_name END AS song,
               p_retailprice + (e.k % 5 - 2) * CAST(0.004 AS DOUBLE) AS duration, {VISIT}
        FROM ev e JOIN people p ON e.user_id = p.person JOIN part ON p_partkey = e.k {copies(7)}
        WHERE e.event_type IN ('click', 'view')""",
    "raw_page_view": f"""
        SELECT CASE WHEN e.event_type = 'click' AND e.k % 10 = 3 THEN 'Settings'
                    WHEN e.event_type = 'click' AND e.k % 10 = 4 THEN 'Help'
                    WHEN e.event_type = 'click' THEN 'NextSong'
                    WHEN e.event_type = 'view' THEN 'Home'
                    WHEN e.event_type = 'purchase' THEN 'Submit Upgrade'
                    WHEN e.event_type = 'signup' THEN 'PlayAd'
                    WHEN e.event_type = 'error' AND e.k % 10 = 5 THEN 'Lounge'
                    ELSE 'Error' END AS page,
               CASE WHEN e.event_type = 'signup' THEN e.value END AS ad_revenue, {VISIT}
        FROM ev e JOIN people p ON e.user_id = p.person {copies(11)}""",
    "raw_status": f"""
        SELECT CASE WHEN e.event_type = 'purchase' THEN 'FREE' ELSE 'paid' END AS old_level, {VISIT}
        FROM ev e JOIN people p ON e.user_id = p.person {copies(5)}
        WHERE e.event_type IN ('purchase', 'error')""",
    "raw_user": f"SELECT {VISIT} FROM ev e JOIN people p ON e.user_id = p.person WHERE e.event_type = 'signup'",
    "raw_auth": f"""
        SELECT e.event_type = 'signup' AS success, {VISIT}
        FROM ev e JOIN people p ON e.user_id = p.person WHERE e.event_type IN ('signup', 'error')""",
    "raw_session": f"""
        SELECT CASE WHEN e.event_type = 'view' THEN 'start' ELSE 'end' END AS action, {VISIT}
        FROM ev e JOIN people p ON e.user_id = p.person WHERE e.event_type IN ('view', 'purchase')""",
    "raw_songs": """
        SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_brand AS artist,
               CASE WHEN p_partkey % 10 = 3 THEN p_name || 'ü' ELSE p_name END AS title,
               p_retailprice AS duration, p_type AS genre
        FROM part""",
    "raw_locations": """
        SELECT CASE WHEN n_nationkey % 4 = 3 THEN 'ca' ELSE 'US' END AS country_code,
               CAST(n_nationkey AS VARCHAR) AS postal_code, n_name AS city,
               CASE WHEN n_nationkey % 8 <> 6 THEN r_name END AS state, r_name AS state_code
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
}
