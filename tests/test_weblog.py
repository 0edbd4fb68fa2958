import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caudal.operators import sessions as S
from caudal.plans.weblog import run_sessionization, session_report
from caudal.sources.readers import parse_hits
from tests.conftest import rows

R, P, C = (S.EVENT_IDS[s] for s in "RPC")

LOG = [
    f"2016-08-02 10:00:00\tu1\t{R}\tx",
    f"2016-08-02 10:30:59\tu1\t{P}\t0",
    f"2016-08-02 10:31:10\tu1\t{C}\t12.5",
    f"2016-08-02 23:50:00\tu1\t{R}\t0",
    f"2016-08-02 10:00:59\tu2\t{R}\t0",
    f"2016-08-02 10:31:00\tu2\t{R}\t0",
    f"2016-08-02 12:00:00\tu3\t{C}\t",
    f"2016-08-02 12:00:00\tu3\t{R}\t0",
    f"2016-08-02 12:00:00\tu3\t{P}\t0",
    "",
    "not a hit",
]


@pytest.fixture(scope="module")
def hits(spark):
    return parse_hits(spark.createDataFrame([(line,) for line in LOG], "value string")).cache()


@pytest.fixture(scope="module")
def sessions(hits):
    return S.sessionize(hits, 30).cache()


def test_lines_without_four_fields_are_dropped_and_bad_amounts_are_zero(hits):
    assert hits.count() == 8
    assert hits.where((F.col("event") == R) & (F.col("amount") == 0.0)).count() == 5


def test_sessions(sessions):
    got = rows(sessions.select("userid", F.date_format("start", "HH:mm:ss"), F.date_format("end", "HH:mm:ss"),
                               "renders", "plays", "checkouts", "amount"))
    assert got == [
        ("u1", "10:00:00", "10:31:10", 1, 1, 1, 12.5),
        ("u1", "23:50:00", "23:50:00", 1, 0, 0, 0.0),
        ("u2", "10:00:59", "10:00:59", 1, 0, 0, 0.0),
        ("u2", "10:31:00", "10:31:00", 1, 0, 0, 0.0),
        ("u3", "12:00:00", "12:00:00", 1, 1, 0, 0.0),
    ]


def test_measures(hits, sessions):
    report = session_report(hits, sessions)
    assert rows(report["daily_users"]) == [("2016-08-02", 3)]
    assert rows(report["returning_users"]) == [("2016-08-02", 2)]
    assert report["mean_duration"].first()[0] == pytest.approx(6.2)
    assert rows(report["median_events"]) == [(1.0, 0.0, 0.0)]
    assert rows(report["visits_per_hour"]) == [("2016-08-02", "10", 3), ("2016-08-02", "12", 1), ("2016-08-02", "23", 1)]
    assert rows(report["mean_checkout"]) == [(2.5, 12.5)]
    assert rows(report["funnel"]) == [("u1", "2016-08-02")]
    assert report["conversion_rate"].first() == (1, 3, pytest.approx(1 / 3))


def test_median_of_an_even_number_is_the_mean_of_the_middle_two(spark):
    frame = spark.createDataFrame([(1, 5, 0), (2, 5, 0), (9, 6, 0), (4, 7, 1)], "renders int, plays int, checkouts int")
    assert rows(S.median_events(frame)) == [(3.0, 5.5, 0.0)]


def test_minutes_must_be_positive(hits):
    with pytest.raises(ValueError):
        S.sessionize(hits, 0)


def _random_log(spark, n=3000, hot=0.5):
    """Hits of 20 users over three days, half of them of one user; sequence numbers break ties."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    data = [
        (
            start + timedelta(seconds=rng.randrange(3 * 86400 // 20) * 20),
            "hot" if rng.random() < hot else f"u{rng.randrange(20)}",
            rng.choice([R, P, C, "other"]),
            float(rng.randrange(100)),
            i,
        )
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, "timestamp timestamp_ntz, userid string, event string, amount double, seq long")


def test_sessions_of_a_busy_user_match_a_plain_loop(spark):
    data, log = _random_log(spark)
    want, last, current = [], {}, {}
    for at, user, event, amount, _ in sorted(data, key=lambda r: (r[1], r[0], r[4])):
        minute = int((at - datetime(1970, 1, 1)).total_seconds()) // 60
        if user not in last or minute - last[user] > 5:
            current[user] = [user, at, at, 0, 0, 0, 0.0]
            want.append(current[user])
        session = current[user]
        session[2] = at
        session[3] += event == R
        session[4] += event == P
        session[5] += event == C
        session[6] += amount
        last[user] = minute
    assert rows(S.sessionize(log, 5)) == sorted((tuple(s) for s in want), key=repr)
    assert S.sessionize(log, 5).agg(F.sum(F.col("renders") + F.col("plays") + F.col("checkouts"))).first()[0] == sum(
        e != "other" for _, _, e, _, _ in data
    )


@pytest.mark.parametrize("steps", ["RPC", "RC", "RRC", "CPRP"])
def test_funnel_matches_the_event_string(spark, steps):
    import re

    data, log = _random_log(spark, n=400, hot=0.1)
    letters = {R: "R", P: "P", C: "C"}
    strings = {}
    for at, user, event, _, seq in sorted(data, key=lambda r: (r[0], r[4])):
        strings.setdefault((user, at.strftime("%Y-%m-%d")), []).append(letters.get(event, ""))
    want = sorted(k for k, v in strings.items() if re.search(".*".join(steps), "".join(v)))
    got = rows(S.funnel(log, tuple(steps), sequence="seq", spread=3))
    assert got == want and 0 < len(want) < len(strings)


def test_job_writes_both_tables_from_a_directory(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a.txt").write_text("\n".join(LOG[:5]) + "\n")
    (log / "b.txt").write_text("\n".join(LOG[5:]) + "\n")
    out = run_sessionization(spark, str(log), str(tmp_path / "out"), 30)
    assert out.count() == 5
    assert spark.read.parquet(str(tmp_path / "out" / "hitsDataset.parquet")).count() == 8
    with pytest.raises(Exception, match="already exists"):
        run_sessionization(spark, str(log), str(tmp_path / "out"), 30)


def test_text_and_zoned_timestamps_give_the_same_sessions(spark, hits):
    as_text = hits.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    zoned = hits.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    counts = [
        rows(S.sessionize(h, 30).select("userid", F.date_format("start", "HH:mm:ss"), "renders", "amount"))
        for h in (hits, as_text, zoned)
    ]
    assert counts[0] == counts[1] == counts[2]


def test_days_and_hours_do_not_depend_on_the_zone_of_the_session(spark, hits):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        sessions = S.sessionize(hits, 30)
        assert rows(S.visits_per_hour(sessions)) == [("2016-08-02", "10", 3), ("2016-08-02", "12", 1), ("2016-08-02", "23", 1)]
        assert rows(S.funnel(hits)) == [("u1", "2016-08-02")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
