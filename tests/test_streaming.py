"""Sessions of hits that arrive in parts are those of all hits at once."""

import datetime as dt
import random

from caudal.operators.sessions import sessionize
from caudal.streaming.sessions import all_sessions, session_stream, update_sessions
from tests.conftest import rows

SCHEMA = "userid string, timestamp timestamp_ntz, event string, amount double"
EVENTS = {"R": "r", "P": "p", "C": "c"}
START = dt.datetime(2024, 1, 1)


def hit(user, minutes, event="r", amount=1.0):
    return (user, START + dt.timedelta(minutes=minutes), event, amount)


def arrive(spark, folder, hits):
    spark.createDataFrame(hits, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/hits")


def run(spark, folder, minutes=30, lateness="1 day"):
    schema = spark.createDataFrame([], SCHEMA).schema
    return update_sessions(spark, f"{folder}/hits", schema, f"{folder}/out", f"{folder}/state", minutes, lateness, events=EVENTS)


def test_parts_add_up_to_the_whole(spark, tmp_path):
    rng = random.Random(1)
    folder, hits = str(tmp_path), []
    for day in range(4):
        own = [hit(rng.choice("abcd"), day * 1440 + rng.random() * 1440, rng.choice("rpcx"), rng.randint(0, 9) / 2) for _ in range(150)]
        # gaps of just the limit, ties, and a busy user; a session that goes on over midnight
        own += [hit("e", day * 1440 + 31 * k + 0.5) for k in range(20)] + [hit("f", day * 1440 + 30 * k + 0.9) for k in range(49)]
        own += [hit("hot", day * 1440 + k % 7, "p") for k in range(300)]
        own += [(None, START, "r", 1.0), ("a", None, "r", 1.0)]
        rng.shuffle(own)
        hits += own
        arrive(spark, folder, own)
        assert run(spark, folder) == (len(own), 0)
    whole = spark.createDataFrame([h for h in hits if h[0] is not None], SCHEMA)
    want = rows(sessionize(whole, 30, events=EVENTS))
    assert rows(all_sessions(spark, f"{folder}/out", f"{folder}/state")) == want
    closed = spark.read.parquet(f"{folder}/out").count()
    assert 0 < closed < len(want)
    # nothing new, nothing more
    assert run(spark, folder)[0] == 0
    assert rows(all_sessions(spark, f"{folder}/out", f"{folder}/state")) == want


def test_late_hits_are_counted_and_left_out(spark, tmp_path):
    folder = str(tmp_path)
    arrive(spark, folder, [hit("a", 0), hit("a", 5), hit("b", 2000)])
    run(spark, folder, lateness="1 hour")
    arrive(spark, folder, [hit("a", 10), hit("b", 2010), hit("c", 1990)])
    rows_read, late = run(spark, folder, lateness="1 hour")
    assert rows_read == 3 and late == 1
    got = [(r["userid"], r["renders"]) for r in all_sessions(spark, f"{folder}/out", f"{folder}/state").collect()]
    assert sorted(got) == [("a", 2), ("b", 2), ("c", 1)]


def test_the_stream_keeps_state_per_session_only(spark, tmp_path):
    stream = session_stream(spark.readStream.schema(SCHEMA).parquet(str(tmp_path)), events=EVENTS)
    assert stream.isStreaming and stream.columns == ["userid", "start", "end", "renders", "plays", "checkouts", "amount"]
