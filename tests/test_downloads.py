from pyspark.sql import functions as F

from caudal.operators import downloads as D
from caudal.plans.downloads import download_report
from caudal.sources.readers import read_downloads, read_prefixes
from tests.conftest import rows

LOG = [
    "2015-09-01 00:00:01\t10.1126/a.1\ti1\tAR\tCordoba\t-31.4,-64.2",
    "2015-09-01 10:00:00\t10.1126/a.2\ti2\tAR\tCordoba\t-31.40, -64.20",
    "2015-10-01 10:00:00\t10.9999/z\ti3\tCL\tSantiago\tN/A",
]


def test_whole_report(spark, tmp_path):
    files = []
    for i, part in enumerate((LOG[:2], LOG[2:])):
        path = tmp_path / f"log{i}.tab"
        path.write_text("\n".join(part) + "\n")
        files.append(str(path))
    (tmp_path / "prefixes.csv").write_text('10.1126,"Science, ""AAAS"""\n')
    metadata = spark.createDataFrame(
        [("10.1126/a.2", "T", 2015, "P", "B", "S"), ("10.0/x", "U", 1, "P", "B", "S")],
        "doi string, title string, year int, publisher string, book string, subject string",
    )
    assert read_downloads(spark, files[0]).count() == 2
    report = download_report(spark, files, str(tmp_path / "prefixes.csv"), metadata, str(tmp_path / "out"))
    day = report["by_day"].withColumn("day", F.col("day").cast("string"))
    assert rows(day) == [("2015-09-01", 2), ("2015-10-01", 1)]
    assert rows(report["by_month"]) == [("2015-09", 2), ("2015-10", 1)]
    assert rows(report["by_weekday"]) == [(2, 2), (4, 1)]
    assert rows(report["by_doi"]) == [("10.1126/a.1", 1), ("10.1126/a.2", 1), ("10.9999/z", 1)]
    assert rows(report["by_prefix"]) == [("10.1126", 'Science, "AAAS"', 2), ("10.9999", None, 1)]
    assert rows(report["by_publisher"]) == [('Science, "AAAS"', 2), (None, 1)]
    assert rows(report["by_country"]) == [("AR", 2), ("CL", 1)]
    assert rows(report["by_place"]) == [(-31.4, -64.2, 2)]
    top = report["top_articles"].collect()
    assert [r.doi for r in top] == ["10.1126/a.1", "10.1126/a.2", "10.9999/z"]
    assert [r.title for r in top] == [None, "T", None]


def test_prefix_header(spark, tmp_path):
    (tmp_path / "p.csv").write_text("prefix,publisher\n10.1,A\n")
    assert rows(read_prefixes(spark, str(tmp_path / "p.csv"), header=True)) == [("10.1", "A")]


def test_places_off_the_globe_do_not_count(spark):
    log = spark.createDataFrame([("91,0",), ("0,181",), ("a,b",), ("1,2,3",), (None,), ("-90,180",)], "coords string")
    assert rows(D.downloads_by_place(log)) == [(-90.0, 180.0, 1)]


def test_unreadable_dates_add_up_under_null(spark):
    log = spark.createDataFrame([("date",), ("",), ("2015-09-01 10:00:00",), ("2015-09-01",), (None,)], "date string")
    assert {(str(r["day"]), r["downloads"]) for r in D.downloads_by_day(log).collect()} == {("None", 3), ("2015-09-01", 2)}
