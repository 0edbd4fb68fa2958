"""Readers that keep unreadable lines, quantiles by narrowing, and users that roll up."""

import json
import random
import statistics

import numpy as np
import pytest

from caudal.operators import selection
from caudal.operators.audience import audience, daily_bitmaps, distinct_users, roll_up, user_numbers
from caudal.sources import checked
from tests.conftest import rows


def test_projects_with_unreadable_lines(spark, tmp_path):
    good = [{"id": str(i), "summary": "ñ", "signers": [{"congressman": "c"}], "results": None} for i in range(5)]
    lines = [json.dumps(g) for g in good]
    (tmp_path / "a.json").write_text("\n".join([*lines[:3], "{bad json", "", '{"id": "x", "signers": 3}', "null"]) + "\n")
    (tmp_path / "b.json").write_text("\n".join([*lines[3:], "  "]) + "\n")
    read = checked.read_projects(spark, str(tmp_path))
    assert sorted(r["id"] for r in read.good.collect()) == list("01234")
    assert read.good.first()["signers"][0]["congressman"] == "c" and "_unreadable" not in read.good.columns
    assert sorted(r["line"] for r in read.bad.collect()) == sorted(["{bad json", '{"id": "x", "signers": 3}', "null"])
    assert [(r["file"].rsplit("/", 1)[1], r["bad"]) for r in read.counts().collect()] == [("a.json", 3)]
    read.quarantine(str(tmp_path / "out"))
    again = spark.read.json(str(tmp_path / "out"))
    assert again.count() == 3 and {r["name"] for r in again.collect()} == {"a.json"}


def test_logs_with_unreadable_lines(spark, tmp_path):
    (tmp_path / "hits").write_text("2024-01-01 00:00:00\tu\te\t1.5\n2024-01-01\tu\te\tx\nnever\tu\te\t1\nshort\tu\n\n")
    hits = checked.read_hits(spark, str(tmp_path / "hits"))
    assert [(r["userid"], r["amount"]) for r in hits.good.orderBy("amount").collect()] == [("u", 0.0), ("u", 1.5)]
    assert sorted(r["line"] for r in hits.bad.collect()) == ["never\tu\te\t1", "short\tu"]
    (tmp_path / "log").write_text("d\t10.1/x\ti\tES\tM\t1,2\nd\t10.1/y\t\tES\tM\t\ntoo\tfew\n")
    log = checked.read_downloads(spark, str(tmp_path / "log"))
    assert rows(log.good) == [("d", "10.1/x", "i", "ES", "M", "1,2"), ("d", "10.1/y", None, "ES", "M", None)]
    assert [r["line"] for r in log.bad.collect()] == ["too\tfew"]


@pytest.mark.parametrize(("kind", "held"), [("spread", 50), ("ties", 20), ("two", 10), ("one", 10), ("spread", 100_000)])
def test_quantiles_are_exact(spark, monkeypatch, kind, held):
    monkeypatch.setattr(selection, "SORTED", held)
    rng = random.Random(5)
    values = {
        "spread": [rng.gauss(0, 1e6) for _ in range(4001)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3, 50])) for _ in range(3000)],
        "two": [1.0] * 999 + [2.0] * 1001,
        "one": [7.5] * 500,
    }[kind]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(6)
    got = {r["share"]: r["value"] for r in selection.exact_quantiles(frame, "v", (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    assert got == pytest.approx({q: float(np.quantile(values, q)) for q in got}, rel=1e-12)
    assert got[0.5] == pytest.approx(statistics.median(values))


def test_quantiles_of_nothing(spark):
    assert selection.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v").count() == 0


def test_users_roll_up_from_days(spark):
    rng = random.Random(6)
    hits = [(rng.choice(["a", "b", "c", None, f"u{rng.randint(0, 400)}"]), f"2024-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d} 10:00:00") for _ in range(3000)]
    hits += [("hot", "2024-01-01 00:00:00")] * 3000 + [("late", None)]
    frame = spark.createDataFrame(hits, "userid string, timestamp string")
    bitmaps = daily_bitmaps(frame, user_numbers(frame)).cache()
    users = {(u, t[:10]) for u, t in hits if u and t}
    assert {(r["day"].isoformat(), r["users"]) for r in distinct_users(bitmaps).collect()} == {(d, len({u for u, e in users if e == d})) for d in {d for _, d in users}}
    months = {(r["start"], r["users"]) for r in audience(bitmaps, ("month",)).collect()}
    assert months == {(f"{m}-01", len({u for u, d in users if d[:7] == m})) for m in {d[:7] for _, d in users}}
    year = roll_up(roll_up(bitmaps, "month"), "year")
    assert [r["users"] for r in distinct_users(year).collect()] == [len({u for u, _ in users})]
    assert audience(bitmaps.limit(0)).count() == 0
