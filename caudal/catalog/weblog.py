"""Web analytics on ``events``: view renders, click plays, purchase is a checkout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.operators import audience as A
from caudal.operators import paths
from caudal.operators import selection
from caudal.operators import sessions as S
from caudal.session import work_dir
from caudal.sources import checked
from caudal.sources.readers import parse_hits
from caudal.streaming import sessions as streamed

catalog = Catalog()

STEPS = {"R": "view", "P": "click", "C": "purchase"}
COLUMNS = {"user": "user_id", "timestamp": "ts"}
EVENT = {"event": "event_type", "events": STEPS}


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _sessions(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    return S.sessionize(_hits(spark, sf_dir), minutes, amount="value", **COLUMNS, **EVENT)


def _sessions_sql(minutes: int) -> str:
    return f"""
    flagged AS (
      SELECT *, CASE WHEN (floor(epoch(ts) / 60) - floor(epoch(lag(ts) OVER w) / 60)) > {minutes} THEN 1 ELSE 0 END AS opens
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (
      SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session
      FROM flagged),
    sessions AS (
      SELECT user_id AS userid, min(ts) AS "start", max(ts) AS "end",
             count(*) FILTER (event_type = 'view') AS renders,
             count(*) FILTER (event_type = 'click') AS plays,
             count(*) FILTER (event_type = 'purchase') AS checkouts,
             sum(value) AS amount
      FROM numbered GROUP BY user_id, session)"""


def _add_sessions(minutes: int) -> None:
    catalog.add(
        f"sessions_{minutes}",
        lambda spark, sf: _sessions(spark, sf, minutes).withColumn("amount", F.round("amount", 2)),
        f"""WITH {_sessions_sql(minutes)}
        SELECT userid, "start", "end", renders, plays, checkouts, round(amount, 2) AS amount FROM sessions""",
    )


_add_sessions(30)
_add_sessions(720)


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as raw log lines: errors carry no amount, sign-ups an unreadable one."""
    amount = (
        F.when(F.col("event_type") == "error", F.lit(""))
        .when(F.col("event_type") == "signup", F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
    )
    line = F.concat_ws(
        "\t", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id").cast("string"), F.col("event_type"), amount
    )
    return _hits(spark, sf_dir).select(line.alias("value"))


catalog.add(
    "hits",
    lambda spark, sf: parse_hits(_log_lines(spark, sf)),
    """SELECT date_trunc('second', ts) AS "timestamp", user_id::VARCHAR AS userid, event_type AS event,
              CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE value END AS amount
       FROM events WHERE event_type <> 'error'""",
)

catalog.add(
    "daily_users",
    lambda spark, sf: S.daily_users(_hits(spark, sf), **COLUMNS),
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)

catalog.add(
    "returning_users",
    lambda spark, sf: S.returning_users(_sessions(spark, sf, 30)),
    f"""WITH {_sessions_sql(30)},
    per_user AS (SELECT strftime("start", '%Y-%m-%d') AS day, userid, count(*) AS n FROM sessions GROUP BY 1, 2)
    SELECT day, count(*) AS users FROM per_user WHERE n > 1 GROUP BY day""",
)

catalog.add(
    "avg_duration",
    lambda spark, sf: S.mean_duration(_sessions(spark, sf, 720)).select(F.round("minutes", 6).alias("minutes")),
    f"""WITH {_sessions_sql(720)}
    SELECT round(avg(floor(epoch("end") / 60) - floor(epoch("start") / 60)), 6) AS minutes FROM sessions""",
)

catalog.add(
    "median_events",
    lambda spark, sf: S.median_events(_sessions(spark, sf, 720)),
    f"""WITH {_sessions_sql(720)}
    SELECT median(renders) AS renders, median(plays) AS plays, median(checkouts) AS checkouts FROM sessions""",
)

catalog.add(
    "visits_per_hour",
    lambda spark, sf: S.visits_per_hour(_sessions(spark, sf, 30)),
    f"""WITH {_sessions_sql(30)}
    SELECT strftime("start", '%Y-%m-%d') AS day, strftime("start", '%H') AS hour, count(*) AS visits
    FROM sessions GROUP BY 1, 2 ORDER BY 1, 2""",
)

catalog.add(
    "avg_checkout",
    lambda spark, sf: S.mean_checkout(_sessions(spark, sf, 30)).select(
        F.round("per_session", 6).alias("per_session"), F.round("per_checkout", 6).alias("per_checkout")
    ),
    f"""WITH {_sessions_sql(30)}
    SELECT round(avg(amount), 6) AS per_session, round(sum(amount) / sum(checkouts), 6) AS per_checkout
    FROM sessions""",
)

_FUNNEL_SQL = """
    days AS (
      SELECT user_id AS userid, strftime(ts, '%Y-%m-%d') AS day,
             string_agg(CASE event_type WHEN 'view' THEN 'R' WHEN 'click' THEN 'P' WHEN 'purchase' THEN 'C' ELSE '' END,
                        '' ORDER BY ts, event_id) AS path
      FROM events GROUP BY 1, 2),
    funnel AS (SELECT userid, day FROM days WHERE regexp_matches(path, 'R.*P.*C'))"""

catalog.add(
    "funnel",
    lambda spark, sf: S.funnel(_hits(spark, sf), sequence="event_id", **COLUMNS, **EVENT),
    f"WITH {_FUNNEL_SQL} SELECT userid, day FROM funnel",
)

catalog.add(
    "conversion_rate",
    lambda spark, sf: S.conversion_rate(_hits(spark, sf), sequence="event_id", **COLUMNS, **EVENT).withColumn(
        "rate", F.round("rate", 9)
    ),
    f"""WITH {_FUNNEL_SQL}, counted AS (
      SELECT (SELECT count(*) FROM funnel) AS conversions,
             (SELECT count(*) FROM (SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') FROM events)) AS visitors)
    SELECT conversions, visitors, round(conversions / visitors, 9) AS rate FROM counted""",
)


# Patterns over the steps of a user and day, in their order.
PATHS = {
    "as_funnel": "R.*P.*C",
    "no_click_before_purchase": "^[^P]*C",
    "twice_then_leaves": "(RP.?){2,}.*[^C]$",
    "steps_between": "C.{3,5}(P+C|RR)",
}


def _add_path(name: str, pattern: str) -> None:
    catalog.add(
        f"path_{name}",
        lambda spark, sf: paths.match_days(_hits(spark, sf), pattern, sequence="event_id", **COLUMNS, **EVENT),
        f"""WITH days AS (
          SELECT user_id AS userid, strftime(ts, '%Y-%m-%d') AS day,
                 string_agg(CASE event_type WHEN 'view' THEN 'R' WHEN 'click' THEN 'P' ELSE 'C' END, '' ORDER BY ts, event_id) AS path
          FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2)
        SELECT userid, day FROM days WHERE regexp_matches(path, '{pattern}')""",
    )


for _name, _pattern in PATHS.items():
    _add_path(_name, _pattern)


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events arrive in four parts, by day, each taken in by a run of its own; closed and open sessions at the end."""
    folder = work_dir(spark)
    hits = _hits(spark, sf_dir)
    first, days = hits.agg(F.min("ts").cast("date"), F.datediff(F.max("ts"), F.min("ts")) + 1).first()
    part = F.least(F.lit(3), F.floor(F.datediff(F.col("ts").cast("date"), F.lit(first)) * 4 / (days or 1)))
    hits.withColumn("part", part.cast("int")).write.partitionBy("part").parquet(f"{folder}/parts")
    for n in range(4):
        arrived = spark.read.schema(hits.schema).parquet(f"{folder}/parts/part={n}")
        arrived.write.mode("append").parquet(f"{folder}/hits")
        streamed.update_sessions(spark, f"{folder}/hits", hits.schema, f"{folder}/sessions", f"{folder}/state", amount="value", **COLUMNS, **EVENT)
    return streamed.all_sessions(spark, f"{folder}/sessions", f"{folder}/state").withColumn("amount", F.round("amount", 2))


catalog.add(
    "sessions_streamed",
    _streamed,
    f"""WITH {_sessions_sql(30)}
    SELECT userid, "start", "end", renders, plays, checkouts, round(amount, 2) AS amount FROM sessions""",
)


def _audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users per day, week and month, all from the bitmaps of the days."""
    hits = _hits(spark, sf_dir)
    return A.audience(A.daily_bitmaps(hits, A.user_numbers(hits, "user_id"), **COLUMNS))


catalog.add(
    "audience",
    _audience,
    " UNION ALL ".join(
        f"SELECT '{level}' AS level, strftime(date_trunc('{level}', ts), '%Y-%m-%d') AS start, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2"
        for level in ("day", "week", "month")
    ),
)

_SHARES = (0.1, 0.5, 0.9)

catalog.add(
    "amount_quantiles",
    lambda spark, sf: selection.exact_quantiles(_hits(spark, sf), "value", _SHARES).withColumn("value", F.round("value", 6)),
    " UNION ALL ".join(f"SELECT {q}::DOUBLE AS share, round(quantile_cont(value, {q}), 6) AS value FROM events" for q in _SHARES),
)


def _session_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = (F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 1e6
    lengths = _sessions(spark, sf_dir, 720).select(length.alias("seconds"))
    return selection.exact_quantiles(lengths, "seconds", _SHARES).withColumn("value", F.round("value", 3))


catalog.add(
    "session_length_quantiles",
    _session_lengths,
    f"WITH {_sessions_sql(720)}, lengths AS (SELECT (epoch_us(\"end\") - epoch_us(\"start\")) / 1e6 AS s FROM sessions) "
    + " UNION ALL ".join(f"SELECT {q}::DOUBLE AS share, round(quantile_cont(s, {q}), 3) AS value FROM lengths" for q in _SHARES),
)


def _hit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as log files, read back: hits, and lines of errors, which lack a field, counted as unreadable."""
    folder = work_dir(spark)
    _log_lines(spark, sf_dir).write.text(f"{folder}/log")
    read = checked.read_hits(spark, f"{folder}/log")
    good = read.good.select("timestamp", "userid", "event", "amount", F.lit(None).cast("long").alias("unreadable"))
    bad = read.bad.agg(F.count(F.lit(1)).alias("unreadable"))
    none = [F.lit(None).cast(t).alias(c) for c, t in read.good.dtypes]
    return good.unionByName(bad.select(*none, "unreadable"))


catalog.add(
    "hit_files",
    _hit_files,
    """SELECT date_trunc('second', ts) AS "timestamp", user_id::VARCHAR AS userid, event_type AS event,
              CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE value END AS amount, NULL::BIGINT AS unreadable
       FROM events WHERE event_type <> 'error'
       UNION ALL SELECT NULL, NULL, NULL, NULL, count(*) FROM events WHERE event_type = 'error'""",
)
