"""DuckDB SQL for the registered queries, written against the source tables alone."""

from __future__ import annotations

# Shared layers. Each statement sees all of them; DuckDB runs only those it refers to.
_LAYERS = {
    "raw_channels": """
        SELECT o_orderdate AS ts, 'C' || o_custkey AS channel_id, c_name AS title,
               CASE WHEN c_nationkey % 5 = 0 THEN '   '
                    ELSE '  ' || c_mktsegment || ' channel ' END AS description,
               '@' || lower(c_mktsegment) || c_custkey AS custom_url,
               CAST(floor(o_totalprice / 100) AS BIGINT) AS subscribers,
               CAST(floor(o_totalprice) AS BIGINT) AS views,
               o_orderkey % 1200 AS videos,
               o_orderstatus = 'P' AS hidden,
               CAST(DATE '1995-01-01' + CAST((c_custkey * 7) % 4000 AS INTEGER) AS TIMESTAMP) AS published,
               CASE WHEN c_nationkey % 7 = 0 THEN '' ELSE c_mktsegment END AS country,
               o_orderstatus AS lang,
               replace(o_orderpriority, '-', ',') || ', ' || c_mktsegment AS keywords,
               'UU' || o_custkey AS uploads,
               c_mktsegment || ', ' || o_orderpriority AS topics,
               o_orderkey
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "raw_videos": """
        SELECT l_shipdate AS ts, 'V' || l_partkey AS video_id, p_name || ' ' || p_brand AS title,
               CAST(DATE '1994-01-01' + CAST((p_partkey * 11) % 3000 AS INTEGER) AS TIMESTAMP) AS published,
               replace(p_name, ' ', ', ') AS tags,
               CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 10
                    WHEN 'PROMO' THEN 15 WHEN 'SMALL' THEN 17 WHEN 'STANDARD' THEN 3 END AS BIGINT)
                    AS category_id,
               'C' || (l_partkey % (SELECT count(*) FROM customer)) AS channel_id,
               'PT' || CASE WHEN p_size % 3 > 0 THEN (p_size % 3) || 'H' ELSE '' END
                    || CASE WHEN p_size > 0 THEN p_size || 'M' ELSE '' END
                    || CASE WHEN p_partkey % 60 > 0 THEN (p_partkey % 60) || 'S' ELSE '' END AS duration,
               (p_size % 3) * 3600 + p_size * 60 + p_partkey % 60 AS seconds,
               p_brand AS definition, l_returnflag = 'A' AS caption, p_size % 2 = 0 AS licensed,
               CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE floor(l_extendedprice) END AS BIGINT) AS views,
               CAST(floor(l_quantity) AS BIGINT) AS likes,
               CAST(CASE WHEN l_discount <> 0 THEN l_linenumber END AS BIGINT) AS comments,
               l_linestatus AS license, p_type || ', ' || split_part(p_name, ' ', 1) AS topics,
               lineitem.*
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "day_channels": """
        SELECT *, CAST(ts AS DATE) AS day FROM raw_channels
        QUALIFY row_number() OVER (PARTITION BY channel_id, CAST(ts AS DATE)
                                   ORDER BY ts DESC, o_orderkey DESC) = 1""",
    "day_videos": """
        SELECT *, CAST(ts AS DATE) AS day FROM raw_videos
        QUALIFY row_number() OVER (
            PARTITION BY video_id, CAST(ts AS DATE)
            ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1""",
    # Versions: number the runs of equal state per entity, one row per run.
    "channel_runs": """
        SELECT *, sum(fresh) OVER (PARTITION BY channel_id ORDER BY ts) AS run FROM (
            SELECT *, CASE WHEN lag((title, description, custom_url, hidden, country, lang, topics))
                                OVER (PARTITION BY channel_id ORDER BY ts)
                           IS NOT DISTINCT FROM
                           (title, description, custom_url, hidden, country, lang, topics)
                      THEN 0 ELSE 1 END AS fresh
            FROM day_channels)""",
    "channel_versions": """
        SELECT channel_id, md5(channel_id) AS channel_sk, first_ts AS valid_from,
               lead(first_ts) OVER (PARTITION BY channel_id ORDER BY first_ts) AS valid_to,
               title, description, custom_url, hidden, published, country, lang, uploads, topics
        FROM (SELECT channel_id, run, min(ts) AS first_ts, any_value(title) AS title,
                     any_value(description) AS description, any_value(custom_url) AS custom_url,
                     any_value(hidden) AS hidden, any_value(published) AS published,
                     any_value(country) AS country, any_value(lang) AS lang,
                     any_value(uploads) AS uploads, any_value(topics) AS topics
              FROM channel_runs GROUP BY channel_id, run)""",
    "video_runs": """
        SELECT *, sum(fresh) OVER (PARTITION BY video_id ORDER BY ts) AS run FROM (
            SELECT *, CASE WHEN lag((title, category_id, duration, definition, caption, licensed,
                                     license, topics)) OVER (PARTITION BY video_id ORDER BY ts)
                           IS NOT DISTINCT FROM
                           (title, category_id, duration, definition, caption, licensed, license, topics)
                      THEN 0 ELSE 1 END AS fresh
            FROM day_videos)""",
    "categories": """
        SELECT * FROM (VALUES (1, 'Film & Animation'), (2, 'Autos & Vehicles'), (10, 'Music'),
            (15, 'Pets & Animals'), (17, 'Sports'), (19, 'Travel & Events'), (20, 'Gaming'),
            (22, 'People & Blogs'), (23, 'Comedy'), (24, 'Entertainment'), (25, 'News & Politics'),
            (26, 'Howto & Style'), (27, 'Education'), (28, 'Science & Technology'),
            (29, 'Nonprofits & Activism')) AS c(category_id, category_name)""",
    "video_versions": """
        SELECT video_id, md5(video_id) AS video_sk, first_ts AS valid_from,
               lead(first_ts) OVER (PARTITION BY video_id ORDER BY first_ts) AS valid_to,
               title, published, category_name, duration, seconds, definition, caption, licensed,
               license, topics
        FROM (SELECT video_id, run, min(ts) AS first_ts, any_value(title) AS title,
                     any_value(published) AS published, any_value(category_id) AS category_id,
                     any_value(duration) AS duration, any_value(seconds) AS seconds,
                     any_value(definition) AS definition, any_value(caption) AS caption,
                     any_value(licensed) AS licensed, any_value(license) AS license,
                     any_value(topics) AS topics
              FROM video_runs GROUP BY video_id, run)
        LEFT JOIN categories USING (category_id)""",
    "fact_channels": """
        SELECT md5(channel_id || '-' || day) AS id, channel_sk, day, subscribers, views, videos
        FROM day_channels JOIN (SELECT channel_id, channel_sk FROM channel_versions
                                WHERE valid_to IS NULL) USING (channel_id)""",
    "fact_videos": """
        SELECT md5(d.video_id || '-' || d.day) AS id, v.video_sk, c.channel_sk, d.day, d.views,
               d.likes, d.comments
        FROM day_videos d
        JOIN video_versions v ON v.video_id = d.video_id AND v.valid_to IS NULL
        JOIN channel_versions c ON c.channel_id = d.channel_id AND c.valid_to IS NULL""",
    "channel_words": """
        SELECT channel_id, ts, trim(word) AS word
        FROM (SELECT channel_id, ts, unnest(string_split(keywords, ',')) AS word FROM day_channels)
        WHERE trim(word) <> ''""",
    "video_words": """
        SELECT video_id, ts, trim(word) AS word
        FROM (SELECT video_id, ts, unnest(string_split(tags, ',')) AS word FROM day_videos)
        WHERE trim(word) <> ''""",
    "channel_bridge": """
        SELECT v.channel_sk, md5(w.word) AS keyword_id, w.word, max(w.ts) AS valid_from
        FROM channel_words w JOIN channel_versions v
          ON v.channel_id = w.channel_id AND w.ts >= v.valid_from
         AND (v.valid_to IS NULL OR w.ts < v.valid_to)
        GROUP BY ALL""",
    "video_bridge": """
        SELECT v.video_sk, md5(w.word) AS tag_id, w.word, max(w.ts) AS valid_from
        FROM video_words w JOIN video_versions v
          ON v.video_id = w.video_id AND w.ts >= v.valid_from
         AND (v.valid_to IS NULL OR w.ts < v.valid_to)
        GROUP BY ALL""",
    "last_channels": """
        SELECT channel_sk, arg_max(views, day) AS views, arg_max(subscribers, day) AS subscribers
        FROM fact_channels GROUP BY channel_sk""",
    "last_videos": """
        SELECT * FROM fact_videos f
        WHERE day = (SELECT max(day) FROM fact_videos g WHERE g.video_sk = f.video_sk)""",
    "last_viewed": """
        SELECT video_sk, (coalesce(likes, 0) + coalesce(comments, 0)) / CAST(views AS DOUBLE) AS rate
        FROM (SELECT video_sk, max(day) AS day FROM fact_videos WHERE views > 0 GROUP BY video_sk)
        JOIN fact_videos USING (video_sk, day)""",
    "open_channels": "SELECT * FROM channel_versions WHERE valid_to IS NULL",
    "open_videos": "SELECT * FROM video_versions WHERE valid_to IS NULL",
    # Orders as a history of statuses per customer.
    "day_orders": """
        SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey,
               arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
        FROM orders GROUP BY o_custkey, o_orderdate""",
    # Channel days with untidy cells; every 13th order has none but its key.
    "day_untidy": """
        SELECT channel_id, ts, day, CASE WHEN o_orderkey % 13 <> 0 THEN title END AS title,
               CASE WHEN o_orderkey % 3 <> 0 THEN description END AS description,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL
                    WHEN o_orderkey % 11 = 0 THEN -subscribers ELSE subscribers END AS subscribers,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN -1 ELSE views END
                   AS views,
               CASE WHEN o_orderkey % 13 <> 0 THEN videos END AS videos,
               CASE WHEN o_orderkey % 13 <> 0 THEN hidden END AS hidden,
               CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2002-01-01' ELSE published END AS published,
               CASE WHEN o_orderkey % 2 <> 0 THEN country END AS country
        FROM day_channels""",
    # Newest sighting of each pair within each of three loads.
    "video_sightings": """
        SELECT md5(video_id) AS video_sk, md5(word) AS tag_id, max(ts) AS seen
        FROM video_words
        GROUP BY video_id, word, CASE WHEN ts < TIMESTAMP '1995-06-01' THEN 1
                                      WHEN ts < TIMESTAMP '1998-06-01' THEN 2 ELSE 3 END""",
    "channel_sightings": """
        SELECT md5(channel_id) AS channel_sk, md5(word) AS keyword_id, max(ts) AS seen,
               CASE WHEN ts < TIMESTAMP '1995-06-01' THEN 1
                    WHEN ts < TIMESTAMP '1998-06-01' THEN 2 ELSE 3 END AS load
        FROM channel_words GROUP BY channel_id, word, load""",
    "order_versions": """
        SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
        FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS old
              FROM day_orders)
        WHERE o_orderstatus IS DISTINCT FROM old""",
    "early_versions": """
        SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
        FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS old
              FROM day_orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
        WHERE o_orderstatus IS DISTINCT FROM old""",
    "late_orders": """
        SELECT o_custkey, max(o_orderdate) AS seen,
               arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status
        FROM day_orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY o_custkey""",
    "day_events": """
        SELECT user_id, CAST(ts AS DATE) AS day, max(ts) AS ts, arg_max(event_type, ts) AS event_type,
               arg_max(value, ts) AS value
        FROM events GROUP BY ALL""",
}

_BASE = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in _LAYERS.items())

_STG_CHANNELS = """
    SELECT channel_id, nullif(trim(title), '') AS title,
           nullif(trim(description), '') AS description, custom_url, subscribers,
           views AS total_views, videos AS total_videos, hidden AS hidden_subscribers,
           CAST(CASE WHEN published <= TIMESTAMP '2001-12-31' THEN published END AS VARCHAR)
               AS published_at,
           nullif(trim(country), '') AS country, lang AS default_language, keywords,
           uploads AS uploads_playlist_id, topics, CAST(ts AS VARCHAR) AS loaded_at,
           CAST(day AS VARCHAR) AS date_key
    FROM day_channels"""

_STG_VIDEOS = """
    SELECT video_id, channel_id, title,
           CAST(CASE WHEN published <= TIMESTAMP '2001-12-31' THEN published END AS VARCHAR)
               AS published_at,
           tags, category_id, duration, definition, caption, licensed AS licensed_content,
           '' AS region_restriction, views AS view_count, likes AS like_count,
           comments AS comment_count, 'public' AS privacy_status, license,
           topics AS topic_categories, CAST(ts AS VARCHAR) AS loaded_at,
           CAST(day AS VARCHAR) AS date_key
    FROM day_videos"""

# Versions after one batch of later orders.
_MERGE = """
    SELECT e.o_custkey, e.o_orderstatus, CAST(e.valid_from AS VARCHAR) AS valid_from,
           CAST(CASE WHEN e.valid_to IS NOT NULL THEN e.valid_to
                     WHEN l.status IS NOT NULL AND l.status IS DISTINCT FROM e.o_orderstatus
                     THEN l.seen {gone} END AS VARCHAR) AS valid_to
    FROM early_versions e LEFT JOIN late_orders l USING (o_custkey)
    UNION ALL
    SELECT l.o_custkey, l.status, CAST(l.seen AS VARCHAR), NULL
    FROM late_orders l LEFT JOIN (SELECT * FROM early_versions WHERE valid_to IS NULL) e
         USING (o_custkey)
    WHERE e.o_custkey IS NULL OR e.o_orderstatus IS DISTINCT FROM l.status"""

_CORRELATION = """
    CASE WHEN min({x}) = max({x}) OR min({y}) = max({y}) THEN NULL
         ELSE round(corr({x}, {y}), 4) END"""

_CHANNEL_TOP = """
    SELECT {title}, views FROM last_channels JOIN open_channels USING (channel_sk)
    ORDER BY views DESC, title, channel_sk LIMIT 10"""

_VIDEO_TOP = """
    SELECT {title}, views AS view_count
    FROM (SELECT l.views, v.title, v.category_name, v.video_sk, v.valid_from
          FROM last_videos l JOIN {versions} v USING (video_sk))
    ORDER BY view_count DESC, title, category_name NULLS LAST, video_sk, valid_from LIMIT 10"""


def _check(table: str | None, check: str, column: str, severity: str, failing: str, source: str) -> str:
    lead = f"'{table}' AS \"table\", " if table else ""
    return (
        f"SELECT {lead}'{check}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity, "
        f"CAST({failing} AS BIGINT) AS failing_rows FROM {source}"
    )


def _nulls(table: str | None, column: str, source: str, expr: str, severity: str = "error") -> str:
    failing = f"count(*) FILTER (WHERE {expr} IS NULL)"
    return _check(table, "not_null", column, severity, failing, source)


def _repeats(table: str | None, column: str, source: str, expr: str, severity: str = "error") -> str:
    repeated = f"(SELECT {expr} AS k FROM {source} WHERE {expr} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    return _check(table, "unique", column, severity, "count(*)", repeated)


def _range(
    table: str | None, column: str, source: str, outside: str, severity: str = "error"
) -> str:
    failing = f"count(*) FILTER (WHERE {outside})"
    return _check(table, "accepted_range", column, severity, failing, source)


def _orphans(
    table: str | None,
    column: str,
    source: str,
    expr: str,
    parent: str,
    parent_expr: str,
    severity: str = "error",
) -> str:
    missing = (
        f"(SELECT {expr} AS k FROM {source} WHERE {expr} IS NOT NULL "
        f"AND {expr} NOT IN (SELECT {parent_expr} FROM {parent}))"
    )
    return _check(table, "relationships", column, severity, "count(*)", missing)


def _all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"
_CALENDAR = (
    "(SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), "
    "INTERVAL 1 DAY)) AS DATE) AS day FROM orders)"
)
_KEYWORDS = "(SELECT DISTINCT md5(word) AS id, word FROM channel_words)"
_TAGS = "(SELECT DISTINCT md5(word) AS id, word FROM video_words)"

_STAGING_REPORT = _all(
    [
        _nulls("stg_channels", "channel_id", "day_channels", "channel_id"),
        _nulls("stg_channels", "date_key", "day_channels", "day"),
        _nulls("stg_channels", "loaded_at", "day_channels", "ts"),
        _nulls("stg_channels", "total_views", "day_channels", "views", "warn"),
        _range("stg_channels", "total_views", "day_channels", "views < 0", "warn"),
        _range("stg_channels", "subscribers", "day_channels", "subscribers < 0", "warn"),
        _repeats("stg_channels", "channel_id", "day_channels", "channel_id", "warn"),
        _nulls("stg_videos", "video_id", "day_videos", "video_id"),
        _nulls("stg_videos", "channel_id", "day_videos", "channel_id"),
        _nulls("stg_videos", "date_key", "day_videos", "day"),
        _range("stg_videos", "view_count", "day_videos", "views < 0", "warn"),
        _range("stg_videos", "like_count", "day_videos", "likes < 0", "warn"),
        _range("stg_videos", "comment_count", "day_videos", "comments < 0", "warn"),
        _repeats("stg_videos", "video_id", "day_videos", "video_id", "warn"),
    ]
)

_CHANNEL_STAR_REPORT = _all(
    [
        _nulls("fact_channel_metrics", "id", "fact_channels", "id"),
        _nulls("fact_channel_metrics", "channel_sk", "fact_channels", "channel_sk"),
        _nulls("fact_channel_metrics", "date_key", "fact_channels", "day"),
        _repeats("fact_channel_metrics", "id", "fact_channels", "id"),
        _orphans(
            "fact_channel_metrics", "channel_sk", "fact_channels", "channel_sk", "channel_versions",
            "channel_sk",
        ),
        _orphans("fact_channel_metrics", "date_key", "fact_channels", "day", _DAYS, "day"),
        _nulls("dim_channel", "channel_sk", "channel_versions", "channel_sk"),
        _nulls("dim_channel", "natural_channel_id", "channel_versions", "channel_id"),
        _nulls("dim_channel", "valid_from", "channel_versions", "valid_from"),
        _nulls("dim_channel", "is_current", "channel_versions", "(valid_to IS NULL)"),
        _repeats("dim_channel", "version_sk", "channel_versions", "(channel_id, valid_from)"),
        _nulls("dim_date", "date_key", _DAYS, "day"),
        _repeats("dim_date", "date_key", _DAYS, "day"),
        _nulls("dim_keyword", "keyword_id", _KEYWORDS, "id"),
        _nulls("dim_keyword", "keyword", _KEYWORDS, "word"),
        _repeats("dim_keyword", "keyword_id", _KEYWORDS, "id"),
        _nulls("bridge_channel_keyword", "channel_sk", "channel_bridge", "channel_sk"),
        _nulls("bridge_channel_keyword", "keyword_id", "channel_bridge", "keyword_id"),
        _nulls("bridge_channel_keyword", "valid_from", "channel_bridge", "valid_from"),
        _nulls("bridge_channel_keyword", "is_current", "channel_bridge", "TRUE"),
        _orphans(
            "bridge_channel_keyword", "channel_sk", "channel_bridge", "channel_sk",
            "channel_versions", "channel_sk",
        ),
        _orphans(
            "bridge_channel_keyword", "keyword_id", "channel_bridge", "keyword_id", _KEYWORDS, "id"
        ),
    ]
)

_VIDEO_STAR_REPORT = _all(
    [
        _nulls("fact_video_performance", "id", "fact_videos", "id"),
        _nulls("fact_video_performance", "video_sk", "fact_videos", "video_sk"),
        _nulls("fact_video_performance", "channel_sk", "fact_videos", "channel_sk"),
        _nulls("fact_video_performance", "date_key", "fact_videos", "day"),
        _range("fact_video_performance", "view_count", "fact_videos", "views < 0"),
        _repeats("fact_video_performance", "id", "fact_videos", "id"),
        _orphans(
            "fact_video_performance", "video_sk", "fact_videos", "video_sk", "video_versions", "video_sk"
        ),
        _orphans(
            "fact_video_performance", "channel_sk", "fact_videos", "channel_sk", "channel_versions",
            "channel_sk",
        ),
        _orphans("fact_video_performance", "date_key", "fact_videos", "day", _CALENDAR, "day"),
        _nulls("dim_video", "video_sk", "video_versions", "video_sk"),
        _nulls("dim_video", "video_id", "video_versions", "video_id"),
        _nulls("dim_video", "valid_from", "video_versions", "valid_from"),
        _nulls("dim_video", "is_current", "video_versions", "(valid_to IS NULL)"),
        _repeats("dim_video", "version_sk", "video_versions", "(video_id, valid_from)"),
        _nulls("dim_tag", "tag_id", _TAGS, "id"),
        _nulls("dim_tag", "tag_name", _TAGS, "word"),
        _repeats("dim_tag", "tag_id", _TAGS, "id"),
        _nulls("bridge_video_tag", "video_sk", "video_bridge", "video_sk"),
        _nulls("bridge_video_tag", "tag_id", "video_bridge", "tag_id"),
        _nulls("bridge_video_tag", "valid_from", "video_bridge", "valid_from"),
        _nulls("bridge_video_tag", "is_current", "video_bridge", "TRUE"),
        _orphans(
            "bridge_video_tag", "video_sk", "video_bridge", "video_sk", "video_versions", "video_sk"
        ),
        _orphans("bridge_video_tag", "tag_id", "video_bridge", "tag_id", _TAGS, "id"),
    ]
)

_SQL = {
    "scan_parquet_count": "SELECT count(*) AS row_count FROM lineitem",
    "json_flatten": """
        SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k,
               coalesce(json_extract_string(props, '$.source'), '') AS source
        FROM events""",
    "channel_payload_flatten": """
        SELECT '2001-12-31 00:00:00' AS ts, channel_id AS "channelId", title,
               left(repeat(description, 40), 500) AS description,
               CASE WHEN videos > 100 THEN custom_url ELSE '' END AS "customUrl",
               CASE WHEN videos > 100 THEN subscribers ELSE 0 END AS subscribers, views, videos,
               hidden AS "hiddenSubscribers", CAST(published AS VARCHAR) AS "publishedAt", country,
               lang AS "defaultLanguage", keywords, uploads AS "uploadsPlaylistId",
               CASE WHEN lang <> 'F' THEN country || ', ' || lang ELSE '' END AS topics,
               '2001-12-31' AS loaded_at
        FROM raw_channels WHERE (o_orderkey // 8) % 30 > 4""",
    "payload_rejects": """
        SELECT DISTINCT o_orderkey // 8 AS payload_id,
               CASE WHEN (o_orderkey // 8) % 30 IN (0, 2, 3) THEN 'malformed' ELSE 'no items' END AS reason
        FROM raw_channels WHERE (o_orderkey // 8) % 30 <= 4""",
    "payload_item_rejects": """
        SELECT payload_id, CAST(place AS INTEGER) AS position,
               CASE k WHEN 0 THEN 'not an object' WHEN 1 THEN 'null item' WHEN 2 THEN 'no id'
                      ELSE 'unreadable snippet' END AS item_reason
        FROM (SELECT o_orderkey // 8 AS payload_id, o_orderkey % 17 AS k,
                     row_number() OVER (PARTITION BY o_orderkey // 8 ORDER BY o_orderkey) - 1 AS place
              FROM raw_channels)
        WHERE k < 4""",
    "payload_items_kept": """
        SELECT channel_id AS "channelId", title, views, videos, CAST(published AS VARCHAR) AS "publishedAt",
               CASE WHEN lang <> 'F' THEN country || ', ' || lang ELSE '' END AS topics
        FROM raw_channels WHERE o_orderkey % 17 > 3""",
    "csv_files_drift": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority ELSE '' END AS o_orderpriority,
               CASE WHEN o_orderkey % 3 = 1 THEN 'a "note",' || chr(10) || o_custkey END AS note
        FROM orders""",
    "video_payload_flatten": """
        SELECT '2001-12-31 00:00:00' AS ts, video_id AS "videoId", title,
               CAST(published AS VARCHAR) AS "publishedAt", tags, category_id AS "categoryId",
               channel_id AS "channelId", duration, definition, caption,
               licensed AS "licensedContent",
               CASE WHEN l_linenumber % 3 = 0 THEN 'blocked ' || definition ELSE '' END
                   AS "regionRestriction", views AS "viewCount",
               likes AS "likeCount", coalesce(comments, 0) AS "commentCount",
               'public' AS "privacyStatus", license, topics AS "topicCategories",
               '2001-12-31' AS loaded_at
        FROM raw_videos WHERE (l_orderkey // 4) % 30 > 4""",
    "bronze_latest": """
        SELECT channel_id AS "channelId", CAST(CAST(ts AS DATE) AS VARCHAR) AS loaded_at,
               CAST(max(ts) AS VARCHAR) AS ts, arg_max(subscribers, o_orderkey) AS subscribers,
               arg_max(views, o_orderkey) AS views, arg_max(videos, o_orderkey) AS videos
        FROM raw_channels GROUP BY channel_id, CAST(ts AS DATE)""",
    "monthly_partition_counts": """
        SELECT strftime(l_shipdate, '%Y%m') AS yyyymm, count(*) AS row_count
        FROM lineitem GROUP BY 1""",
    "retention_90d": """
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS loaded_at FROM orders
        WHERE CAST(o_orderdate AS DATE) + INTERVAL 90 DAY
              > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "csv_coercion": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 5 IN (2, 4) THEN o_custkey ELSE 0 END AS subscribers,
               o_orderstatus IN ('F', 'O') AS hidden,
               CASE WHEN o_orderkey % 5 = 0 THEN '2001-12-31 00:00:00'
                    ELSE CAST(o_orderdate AS VARCHAR) END AS published,
               CASE WHEN o_orderkey % 5 = 3 THEN o_orderpriority ELSE '' END AS country
        FROM orders""",
    "tolerant_rows": """
        SELECT o_orderkey, o_custkey AS custkey, CAST(o_orderdate AS VARCHAR) AS ordered FROM orders
        WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "rejected_text_rows": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR) END AS custkey,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'soon' ELSE CAST(o_orderdate AS VARCHAR) END
                   AS ordered
        FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""",
    "union_drop": """
        SELECT event_id, user_id, round(value, 4) AS value,
               CASE WHEN ts < TIMESTAMP '2024-01-21' THEN props END AS props
        FROM events""",
    "schema_evolution": """
        SELECT event_id, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS event_type
        FROM events""",
    "schema_changed_types": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(extract(hour FROM ts) AS BIGINT) AS hour,
               CASE WHEN ts < TIMESTAMP '2024-01-16' THEN CAST(floor(value) AS DOUBLE) ELSE value END AS value
        FROM events""",
    "loads_of_changed_types": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(extract(hour FROM ts) AS DOUBLE) AS hour,
               CASE WHEN ts < TIMESTAMP '2024-01-11' THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00'
                    WHEN ts < TIMESTAMP '2024-01-21' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen
        FROM events""",
    "first_hit_left_join": """
        SELECT s.source, s.videos, s.views, h.lang AS query, h.doc_id
        FROM (SELECT source, count(*) AS videos, CAST(sum(n_chars) AS BIGINT) AS views
              FROM documents GROUP BY source) s
        LEFT JOIN (SELECT DISTINCT ON (source) source, lang, doc_id FROM documents
                   WHERE lang IN ('fr', 'de', 'es')
                   ORDER BY source, list_position(['fr', 'de', 'es'], lang), doc_id) h USING (source)""",
    "array_join_text": """
        SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS INTEGER) AS words,
               replace(text, ' ', ', ') AS joined
        FROM conversations""",
    "truncate_text": """
        SELECT doc_id, CAST(length(text) AS INTEGER) AS full_length, left(text, 500) AS description
        FROM documents""",
    "tag_normalise": """
        SELECT tag, count(*) AS part_count
        FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) WHERE tag <> '' GROUP BY tag""",
    "duration_seconds": """
        SELECT l.p_partkey, d.duration, d.seconds
        FROM part l JOIN (SELECT p_partkey,
               'PT' || CASE WHEN p_size % 3 > 0 THEN (p_size % 3) || 'H' ELSE '' END
                    || CASE WHEN p_size > 0 THEN p_size || 'M' ELSE '' END
                    || CASE WHEN p_partkey % 60 > 0 THEN (p_partkey % 60) || 'S' ELSE '' END AS duration,
               CAST((p_size % 3) * 3600 + p_size * 60 + p_partkey % 60 AS BIGINT) AS seconds
             FROM part) d USING (p_partkey)""",
    "duration_seconds_with_days": """
        SELECT p_partkey, CAST(0 AS BIGINT) AS seconds,
               CAST((p_size % 4) * 86400 + 7200 AS BIGINT) AS seconds_with_days FROM part""",
    "surrogate_key": """
        SELECT o_orderkey, md5(o_custkey || '-' || CAST(o_orderdate AS DATE)) AS day_key,
               md5(o_custkey || '-' || CASE WHEN o_orderstatus = 'P' THEN '_dbt_utils_surrogate_key_null_'
                                            ELSE o_orderpriority END) AS null_key,
               md5(o_custkey || '-' || CASE WHEN o_orderstatus = 'P' THEN ''
                                            ELSE o_orderpriority END) AS empty_key
        FROM orders""",
    "silver_clean": _STG_CHANNELS,
    "silver_videos": _STG_VIDEOS,
    "silver_uncleaned": """
        SELECT channel_id, title, description, custom_url, subscribers, views AS total_views,
               videos AS total_videos, hidden AS hidden_subscribers,
               CAST(published AS VARCHAR) AS published_at, country, lang AS default_language,
               keywords, uploads AS uploads_playlist_id, topics, CAST(ts AS VARCHAR) AS loaded_at,
               CAST(day AS VARCHAR) AS date_key
        FROM day_channels""",
    "channel_cleaning": """
        SELECT o_orderkey, channel_id AS "channelId", title, country, views, videos
        FROM raw_channels
        WHERE videos BETWEEN 1 AND 1000 AND views > 500 AND position('7' IN title) = 0
          AND (country = '' OR upper(country) = 'BUILDING')""",
    "cleaned_channel_head": """
        SELECT o_orderkey, channel_id AS "channelId", videos FROM raw_channels
        WHERE videos BETWEEN 1 AND 1000 AND position('topic' IN title) = 0
          AND (country = '' OR country = 'BUILDING')
        ORDER BY o_orderkey LIMIT 100""",
    "silver_untidy": """
        SELECT channel_id, CAST(day AS VARCHAR) AS date_key, title,
               CASE WHEN subscribers >= 0 THEN subscribers END AS subscribers,
               CASE WHEN views >= 0 THEN views END AS total_views, videos AS total_videos,
               CAST(CASE WHEN published <= TIMESTAMP '2001-12-31' THEN published END AS VARCHAR)
                   AS published_at,
               nullif(trim(country), '') AS country
        FROM day_untidy
        WHERE NOT (title IS NULL AND (subscribers IS NULL OR subscribers < 0)
                   AND (views IS NULL OR views < 0) AND videos IS NULL AND hidden IS NULL)""",
    "history_untidy": """
        SELECT channel_id, description, country, CAST(ts AS VARCHAR) AS valid_from,
               CAST(lead(ts) OVER (PARTITION BY channel_id ORDER BY ts) AS VARCHAR) AS valid_to,
               lead(ts) OVER (PARTITION BY channel_id ORDER BY ts) IS NULL AS is_current
        FROM (SELECT *, row_number() OVER o AS n,
                     lag(description) OVER o IS DISTINCT FROM description
                     OR lag(country) OVER o IS DISTINCT FROM country AS fresh
              FROM (SELECT channel_id, ts, nullif(trim(description), '') AS description,
                           nullif(trim(country), '') AS country
                    FROM day_untidy WHERE title IS NOT NULL)
              WINDOW o AS (PARTITION BY channel_id ORDER BY ts))
        WHERE n = 1 OR fresh""",
    "incremental_upsert": """
        SELECT user_id, event_type, round(value, 4) AS value, CAST(ts AS VARCHAR) AS loaded_at,
               CAST(day AS VARCHAR) AS date_key
        FROM day_events""",
    "daily_latest": """
        SELECT user_id, CAST(day AS VARCHAR) AS date_key, CAST(ts AS VARCHAR) AS ts, event_type,
               round(value, 4) AS value
        FROM day_events""",
    "daily_event_metrics": """
        SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_key, count(*) AS event_count,
               round(sum(value), 4) AS total_value
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "scd2_history": """
        SELECT o_custkey, o_orderstatus, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(valid_to AS VARCHAR) AS valid_to, valid_to IS NULL AS is_current
        FROM order_versions""",
    "scd2_merge": _MERGE.format(gone=""),
    "scd2_hard_delete": _MERGE.format(gone="WHEN l.status IS NULL THEN TIMESTAMP '2001-12-31'"),
    "scd2_timestamp": """
        SELECT o_custkey, o_orderpriority, CAST(early AS VARCHAR) AS valid_from,
               CAST(CASE WHEN newest > early THEN newest END AS VARCHAR) AS valid_to
        FROM (SELECT o_custkey, o_orderpriority, max(o_orderdate) AS newest,
                     max(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01') AS early
              FROM orders GROUP BY ALL)
        WHERE early IS NOT NULL
        UNION ALL
        SELECT o_custkey, o_orderpriority, CAST(max(o_orderdate) AS VARCHAR), NULL
        FROM orders GROUP BY o_custkey, o_orderpriority
        HAVING max(o_orderdate) >= TIMESTAMP '2000-01-01'""",
    "scd2_asof_join": """
        SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS VARCHAR) AS o_orderdate,
               v.o_orderstatus, CAST(v.valid_from AS VARCHAR) AS valid_from,
               CAST(v.valid_to AS VARCHAR) AS valid_to
        FROM orders o ASOF JOIN order_versions v
          ON o.o_custkey = v.o_custkey AND o.o_orderdate >= v.valid_from""",
    "video_tag_loads": """
        SELECT video_sk, tag_id, CAST(seen AS VARCHAR) AS valid_from,
               CAST(lead(seen) OVER p AS VARCHAR) AS valid_to, lead(seen) OVER p IS NULL AS is_current
        FROM video_sightings WINDOW p AS (PARTITION BY video_sk, tag_id ORDER BY seen)""",
    # A pair's versions are its runs of loads without a gap; a run that ends early was closed.
    "channel_keyword_loads": """
        SELECT channel_sk, keyword_id, CAST(min(seen) AS VARCHAR) AS valid_from,
               CASE WHEN max(load) < 3 THEN '2001-12-31 00:00:00' END AS valid_to, max(load) = 3 AS is_current
        FROM (SELECT *, load - row_number() OVER (PARTITION BY channel_sk, keyword_id ORDER BY load) AS run
              FROM channel_sightings)
        GROUP BY channel_sk, keyword_id, run""",
    "calendar_from_start": """
        SELECT CAST(d AS VARCHAR) AS date_key, CAST(d AS VARCHAR) AS date, year(d) AS year,
               quarter(d) AS quarter, month(d) AS month, day(d) AS day, isodow(d) AS week_day,
               isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '2005-01-01', CAST(max(ts) AS DATE), INTERVAL 1 DAY))
                          AS DATE) AS d FROM events)""",
    "shipping_intervals": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               round(CAST(epoch(l_shipdate) - epoch(o_orderdate) AS DOUBLE), 4) AS seconds
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "dim_date": """
        SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(isodow(d) AS INTEGER) AS week_day, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
              FROM orders)""",
    "dim_tag": f"SELECT id AS tag_id, word AS tag_name FROM {_TAGS}",
    "dim_keyword": f"SELECT id AS keyword_id, word AS keyword FROM {_KEYWORDS}",
    "dim_channel": """
        SELECT channel_sk, channel_id AS natural_channel_id, title,
               nullif(trim(description), '') AS description, custom_url,
               hidden AS hidden_subscribers,
               CAST(CASE WHEN published <= TIMESTAMP '2001-12-31' THEN published END AS VARCHAR)
                   AS published_at,
               nullif(country, '') AS country, lang AS default_language,
               uploads AS uploads_playlist_id, topics, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(valid_to AS VARCHAR) AS valid_to, valid_to IS NULL AS is_current
        FROM channel_versions""",
    "dim_video": """
        SELECT video_sk, video_id, title,
               CAST(CASE WHEN published <= TIMESTAMP '2001-12-31' THEN published END AS VARCHAR)
                   AS published_at,
               category_name, duration, definition, caption, licensed AS licensed_content,
               'public' AS privacy_status, license, '' AS region_restriction,
               topics AS topic_categories, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(valid_to AS VARCHAR) AS valid_to, valid_to IS NULL AS is_current
        FROM video_versions""",
    "dim_video_category": """
        SELECT category_name, count(*) AS video_count FROM open_videos GROUP BY category_name""",
    "fact_channel_metrics": """
        SELECT id, channel_sk, CAST(day AS VARCHAR) AS date_key, subscribers, views, videos
        FROM fact_channels""",
    "fact_video_performance": """
        SELECT id, video_sk, channel_sk, CAST(day AS VARCHAR) AS date_key, views AS view_count,
               likes AS like_count, comments AS comment_count
        FROM fact_videos""",
    "fact_channel_asof": """
        SELECT md5(d.channel_id || '-' || d.day) AS id, v.channel_sk,
               CAST(d.day AS VARCHAR) AS date_key, d.subscribers, d.views, d.videos,
               CAST(v.valid_from AS VARCHAR) AS valid_from
        FROM day_channels d ASOF JOIN channel_versions v
          ON d.channel_id = v.channel_id AND d.ts >= v.valid_from""",
    "incremental_fact_append": """
        SELECT id, channel_sk, CAST(day AS VARCHAR) AS date_key, subscribers, views, videos
        FROM (SELECT * FROM fact_channels WHERE day <= DATE '1999-06-30'
              UNION ALL
              SELECT * FROM fact_channels
              WHERE day > (SELECT max(day) FROM fact_channels WHERE day <= DATE '1999-06-30'))""",
    "bridge_channel_keyword": """
        SELECT channel_sk, keyword_id, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(NULL AS VARCHAR) AS valid_to, TRUE AS is_current
        FROM channel_bridge""",
    "bridge_video_tag": """
        SELECT video_sk, tag_id, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(NULL AS VARCHAR) AS valid_to, TRUE AS is_current
        FROM video_bridge""",
    "latest_metric": "SELECT channel_sk, views, subscribers FROM last_channels",
    "latest_positive_metric": "SELECT video_sk, round(rate, 4) AS engagement_rate FROM last_viewed",
    "top_10_channels": """
        SELECT title, CAST(sum(views) AS BIGINT) AS total_views
        FROM last_channels JOIN open_channels USING (channel_sk)
        GROUP BY title ORDER BY total_views DESC, title LIMIT 10""",
    "top_10_videos": """
        SELECT v.title, v.category_name, CAST(sum(l.views) AS BIGINT) AS total_views
        FROM last_videos l JOIN open_videos v USING (video_sk)
        GROUP BY v.title, v.category_name
        ORDER BY total_views DESC, v.title, v.category_name NULLS LAST LIMIT 10""",
    "popular_keywords": """
        SELECT word AS keyword, CAST(sum(subscribers) AS BIGINT) AS total_subscribers,
               count(DISTINCT channel_sk) AS channel_count
        FROM channel_bridge JOIN last_channels USING (channel_sk)
        GROUP BY word ORDER BY total_subscribers DESC, keyword LIMIT 10""",
    "duration_view_corr": f"""
        SELECT {_CORRELATION.format(x="v.seconds", y="l.views")} AS duration_view_correlation
        FROM last_videos l JOIN open_videos v USING (video_sk)""",
    "tag_engagement": """
        SELECT word AS tag_name, round(avg(rate), 4) AS avg_engagement_rate,
               count(DISTINCT video_sk) AS video_count
        FROM video_bridge JOIN last_viewed USING (video_sk)
        GROUP BY word HAVING count(DISTINCT video_sk) >= 10
        ORDER BY avg(rate) DESC, word LIMIT 10""",
    "category_performance": """
        SELECT v.category_name, round(avg(v.seconds) / 60, 4) AS avg_duration_minutes,
               CAST(sum(l.views) AS BIGINT) AS total_views, CAST(sum(l.likes) AS BIGINT) AS total_likes,
               count(DISTINCT v.video_sk) AS video_count
        FROM last_videos l JOIN open_videos v USING (video_sk)
        GROUP BY v.category_name HAVING count(DISTINCT v.video_sk) >= 50""",
    "top_categories": """
        SELECT v.category_name, CAST(sum(l.views) AS BIGINT) AS total_views,
               count(DISTINCT v.video_sk) AS video_count
        FROM last_videos l JOIN open_videos v USING (video_sk)
        GROUP BY v.category_name
        ORDER BY total_views DESC, v.category_name NULLS LAST LIMIT 10""",
    "optimal_length": """
        SELECT round_even(v.seconds / 60.0, 0) AS duration_minutes,
               round(avg(rate), 4) AS avg_engagement_rate, count(DISTINCT video_sk) AS video_count
        FROM last_viewed JOIN open_videos v USING (video_sk)
        GROUP BY 1 HAVING count(DISTINCT video_sk) > 10
        ORDER BY avg(rate) DESC, 1 LIMIT 10""",
    "secure_top_channels": _CHANNEL_TOP.format(title="title"),
    "masked_top_channels": _CHANNEL_TOP.format(title="sha256('registered' || title) AS channel_title_masked"),
    "secure_top_videos": _VIDEO_TOP.format(title="title, category_name", versions="open_videos"),
    "secure_top_videos_every_version": _VIDEO_TOP.format(
        title="title, category_name", versions="video_versions"
    ),
    "masked_top_videos": _VIDEO_TOP.format(
        title="sha256('registered' || title) AS video_title_masked, '***' AS category_title_masked",
        versions="open_videos",
    ),
    "legacy_top_topic": """
        SELECT trim(topic) AS topic, CAST(sum(subscribers) AS BIGINT) AS total_subscribers
        FROM (SELECT subscribers, unnest(string_split(topics, ',')) AS topic FROM day_channels)
        WHERE topic ILIKE '%machin%'
        GROUP BY trim(topic) ORDER BY total_subscribers DESC, trim(topic) LIMIT 1""",
    "legacy_top_channels_topic": """
        SELECT DISTINCT channel_id, title, subscribers, views AS total_views FROM day_channels
        WHERE len(list_filter(string_split(lower(topics), ','), lambda t: contains(t, 'machin'))) > 0
        ORDER BY subscribers DESC, channel_id, title, total_views LIMIT 10""",
    "legacy_best_category": """
        SELECT category_id, count(video_id) AS video_count, CAST(sum(views) AS BIGINT) AS total_views,
               round(avg(views), 4) AS avg_views
        FROM day_videos WHERE views IS NOT NULL GROUP BY category_id""",
    "legacy_category_duration": """
        SELECT category_id, round(avg(seconds) / 60, 4) AS avg_duration_minutes,
               round(avg(views), 4) AS avg_views, round(avg(likes), 4) AS avg_likes,
               count(*) AS video_count
        FROM day_videos WHERE duration IS NOT NULL GROUP BY category_id""",
    "legacy_duration_corr": f"""
        SELECT {_CORRELATION.format(x="seconds", y="views")} AS duration_view_correlation
        FROM day_videos WHERE duration IS NOT NULL AND views IS NOT NULL""",
    "legacy_tag_engagement": """
        SELECT tag, round(gain / nullif(views, 0), 4) AS engagement_rate
        FROM (SELECT trim(tag) AS tag, CAST(sum(coalesce(likes, 0) + coalesce(comments, 0)) AS DOUBLE) AS gain,
                     sum(views) AS views
              FROM (SELECT likes, comments, views, unnest(string_split(tags, ',')) AS tag FROM day_videos)
              WHERE trim(tag) <> '' GROUP BY trim(tag))
        ORDER BY gain / nullif(views, 0) DESC NULLS LAST, tag LIMIT 20""",
    "legacy_optimal_length": """
        SELECT round(seconds / 60.0, 0) AS duration_minutes,
               round(avg((coalesce(likes, 0) + coalesce(comments, 0)) / CAST(views AS DOUBLE)), 4)
                   AS avg_engagement_rate
        FROM day_videos WHERE duration IS NOT NULL AND views > 0 AND category_id IN (1, 3, 10)
        GROUP BY 1
        ORDER BY avg((coalesce(likes, 0) + coalesce(comments, 0)) / CAST(views AS DOUBLE)) DESC, 1
        LIMIT 10""",
    "legacy_top_videos_ilike": """
        SELECT video_id, title, views AS view_count, likes AS like_count, comments AS comment_count,
               topics AS topic_categories
        FROM day_videos WHERE topics ILIKE '%promo%'
        ORDER BY view_count DESC, video_id, title, like_count NULLS LAST, comment_count NULLS LAST,
                 topic_categories
        LIMIT 10""",
    "dq_not_null": _all(
        [
            _nulls(None, "video_id", "day_videos", "video_id"),
            _nulls(None, "channel_id", "day_videos", "channel_id"),
            _nulls(None, "date_key", "day_videos", "day"),
            _nulls(None, "category_id", "day_videos", "category_id"),
            _nulls(None, "comment_count", "day_videos", "comments"),
        ]
    ),
    "dq_unique": _all(
        [
            _repeats(None, "id", "fact_channels", "id"),
            _repeats(None, "channel_id", "day_channels", "channel_id", "warn"),
        ]
    ),
    "dq_accepted_range": _all(
        [
            _range(None, "view_count", "day_videos", "views < 0"),
            _range(None, "like_count", "day_videos", "likes < 10 OR likes > 40", "warn"),
            _range(None, "comment_count", "day_videos", "comments < 2", "warn"),
        ]
    ),
    "dq_relationships": _all(
        [
            _orphans(None, "l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
            _orphans(
                None, "doc_id", "labels", "doc_id", "documents WHERE lang = 'fr'", "doc_id", "warn"
            ),
        ]
    ),
    "dq_expression": _all(
        [
            _check(None, "expression_is_true", name, severity, f"count(*) FILTER (WHERE {bad})", "day_videos")
            for name, severity, bad in (
                ("view_count", "error", "views < 0"),
                ("comment_count", "warn", "comments < 3"),
                ("comment_count_or_null", "error", "comments < 3 OR comments IS NULL"),
            )
        ]
    ),
    "dq_staging_report": _STAGING_REPORT,
    "dq_channel_star_report": _CHANNEL_STAR_REPORT,
    "dq_video_star_report": _VIDEO_STAR_REPORT,
}


_SQL["scd2_late_rows"] = _SQL["scd2_history"]
# Extending history load by load gives what all rows at once give, with the columns of a snapshot.
_SQL["channel_history_loads"] = _SQL["dim_channel"]
_SQL["video_history_loads"] = """
    SELECT md5(r.video_id) AS video_sk, r.video_id, r.title,
           CAST(CASE WHEN r.published <= TIMESTAMP '2001-12-31' THEN r.published END AS VARCHAR)
               AS published_at,
           r.category_id, r.duration, r.definition, r.caption, r.licensed AS licensed_content,
           'public' AS privacy_status, r.license, '' AS region_restriction,
           r.topics AS topic_categories, CAST(v.valid_from AS VARCHAR) AS valid_from,
           CAST(v.valid_to AS VARCHAR) AS valid_to, v.valid_to IS NULL AS is_current
    FROM video_versions v JOIN day_videos r ON r.video_id = v.video_id AND r.ts = v.valid_from"""


def oracle_sql() -> dict[str, str]:
    """One self-contained statement per registered query."""
    return {name: f"{_BASE}\n{sql}" for name, sql in _SQL.items()}
