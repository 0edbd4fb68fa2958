import random

from caudal.operators import keyed as K
from caudal.sources.readers import local_rows, parse_triples
from tests.conftest import rows


def collections(spark):
    data = [[("a", 1), ("b", 4)], [("a", 2), ("b", 2), ("c", 5), ("a", 7)], [("a", 2), ("b", 2), ("c", 5)]]
    return [local_rows(spark, d, "key string, value int") for d in data]


def test_sums_over_collections(spark):
    want = [("a", 12), ("b", 8), ("c", 10)]
    assert rows(K.sum_by_key(*collections(spark))) == want
    grouped = K.cogroup_sum(*collections(spark))
    assert rows(grouped.select("key", "total")) == want
    assert rows(grouped) == [("a", 1, 9, 2, 12), ("b", 4, 2, 2, 8), ("c", 0, 5, 5, 10)]


def test_triples(spark):
    lines = ["# junk", "", '<s1> <name> "Alp Arslan"@en .', '<s2> <born> "1900" .', "  <s3> <x> <y> ."]
    properties = parse_triples(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(properties) == [("<s1>", "<name>", '"Alp Arslan"@en'), ("<s2>", "<born>", '"1900"')]
    types = parse_triples(
        spark.createDataFrame([("<s1> <type> <Person> .",), ("<s1> <type> <Agent>.",), ("<s1> <type> <Agent> .",)], "value string")
    )
    got = rows(K.enrich_triples(properties, types))
    assert got == [
        ("<s1>", ["<Agent>", "<Agent>", "<Person>"], "<name>", '"Alp Arslan"@en'),
        ("<s2>", [], "<born>", '"1900"'),
    ]


def test_friends_in_common(spark):
    lists = [("A", "BCD"), ("B", "ACDE"), ("C", "ABDE"), ("D", "ABCE"), ("E", "BCD")]
    adjacency = spark.createDataFrame([(p, list(f)) for p, f in lists], "person string, friends array<string>")
    got = {a + b: "".join(f) for a, b, f in rows(K.common_friends(adjacency))}
    assert got == {
        "AB": "CD", "AC": "BD", "AD": "BC", "BC": "ADE", "BD": "ACE", "BE": "CD", "CD": "ABE", "CE": "BD", "DE": "BC",
    }


def test_a_person_who_knows_everybody(spark):
    rng = random.Random(5)
    pairs = {(0, i) for i in range(1, 60)} | {
        tuple(sorted(rng.sample(range(1, 60), 2))) for _ in range(120)
    }
    know = {}
    for a, b in pairs:
        know.setdefault(a, set()).add(b)
        know.setdefault(b, set()).add(a)
    edges = spark.createDataFrame(sorted(pairs), "a long, b long")
    got = {(a, b): f for a, b, f in rows(K.shared_lists(edges))}
    assert got == {(a, b): sorted(know[a] & know[b]) for a, b in pairs}
