"""Patterns over events, against regular expressions over gathered texts."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from caudal.operators import paths
from tests.conftest import rows

PATTERNS = ["R.*P.*C", "^R[^C]*$", "(RP){2,}", "P+C|RR$", "C.{3,5}(P+C|RR)", "^(R|P?C){2,4}$", "", "^$", "[P-R]C??R", "(?:R*P)*C", "C{0}R{2}", "^[^RP]", "R^P", "(^|P)R(C|$)"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_automata_find_what_patterns_find(pattern):
    rng = random.Random(1)
    machine = paths.automaton(pattern, "CPR")
    for _ in range(400):
        text = "".join(rng.choice("CPR") for _ in range(rng.randint(0, 12)))
        state = 0
        for letter in text:
            state = machine.moves["CPR".index(letter)][state]
        assert (int(state) in machine.accepting) == bool(re.search(pattern, text)), text


def test_patterns_that_are_not_known():
    for pattern in (r"(R)\1", r"R(?=P)", "." * 9 + "[RP].{9}C$"):
        with pytest.raises(ValueError):
            paths.automaton(pattern, "CPR")


def test_maps_are_composed_in_order():
    rng = np.random.default_rng(2)
    maps = rng.integers(0, 5, (200, 5)).astype(np.uint8)
    group = np.sort(rng.integers(0, 30, 200))
    want = []
    for g in np.unique(group):
        whole = np.arange(5)
        for m in maps[group == g]:
            whole = m[whole]
        want.append(whole.tolist())
    assert paths.compose(maps, group).tolist() == want


@pytest.mark.parametrize("pattern", ["R.*P.*C", "^R[^C]*$", "(RP){3,}", "P+C$"])
def test_user_days_of_every_size(spark, pattern):
    rng = random.Random(3)
    hits = []
    for i in range(6000):
        # one user-day has most of the hits, so several tasks hold a part of it
        user = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None, "c"])
        day = 1 if user == "hot" else rng.randint(1, 3)
        hits.append((user, f"2024-01-{day:02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00", rng.choice("rpcx"), i))
    hits += [("a", None, "r", 7001), ("d", "2024-01-01 00:00:00", "x", 7002), ("e", "2024-01-01 00:00:00", "p", 7003)]
    days = defaultdict(list)
    for user, time, event, place in hits:
        if time and event != "x":
            days[user, time[:10]].append((time, place, event.upper()))
    want = [key for key, found in days.items() if re.search(pattern, "".join(e for *_, e in sorted(found)))]
    frame = spark.createDataFrame(hits, "userid string, timestamp string, event string, place int").repartition(5)
    got = paths.match_days(frame, pattern, sequence="place", events={"R": "r", "P": "p", "C": "c"})
    assert rows(got) == sorted(want, key=repr)
    assert paths.match_days(frame.limit(0), pattern, events={"R": "r", "P": "p", "C": "c"}).count() == 0


def test_a_busy_day_is_cut_between_tasks(spark):
    hits = spark.range(40000).selectExpr("if(id < 0, 'v', 'u') AS userid", "timestamp_seconds(id) AS timestamp", "if(id = 39999, 'c', 'r') AS event")
    got = paths.match_days(hits, "^R+C$", events={"R": "r", "C": "c"})
    assert rows(got) == [("u", "1970-01-01")]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"rangepartitioning\(userid\S* ASC NULLS FIRST, day\S* ASC NULLS FIRST, at", text)
