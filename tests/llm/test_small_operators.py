"""URL filters, exact copies, quality rules, mixing, packing, personal data."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.llm import exact, mixing, packing, parcels, pii, quality, urls
from caudal.llm.queries import URL_RULES, tokenizer
from caudal.llm.stage import Stage
from tests.llm.frames import corpus, documents, quality as plain_quality

# urls


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host) or not rule.host) and path.startswith(rule.path)


def test_urls_are_judged_as_by_trying_every_rule(spark):
    rng = random.Random(1)
    hosts = ["com", "example.com", "www.example.com", "notexample.com", "a.net", "net", "x-y.example.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/a", "/english/", "/fr/x", "/es/", "/en/a.b", "/a(b/"]
    rules = [*URL_RULES, urls.Rule("", "/a(b", "block"), urls.Rule("example.com", "/en", "allow"), urls.Rule("y.example.com", "", "block")]
    pages = [(i, f"http://{rng.choice(hosts).upper() if i % 3 else rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=://z/', '#f'])}") for i in range(300)]
    pages += [(300, None), (301, ""), (302, "no scheme/en/"), (None, "http://a.net/es/"), (5, pages[5][1])]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("rule", F.lit("x")).withColumn("host", F.lit("y"))
    got = Counter(tuple(r) for r in urls.judge_urls(frame, rules).collect())
    want = Counter()
    for page, url in pages:
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = host.lower()
        found = sorted((r for r in rules if fits(r, host, path)), key=lambda r: (-len(r.text), r.verdict != "block", r.text))
        want[(page, host, path, found[0].text if found else None, found[0].verdict if found else "allow")] += 1
    assert got == want


def test_rules_stand_under_their_rarest_whole_token():
    rules = [urls.Rule("ads.example.com", "/en/x", "block"), urls.Rule("", "/q", "block"), urls.Rule("com", "", "allow")]
    assert rules[0].tokens() == {"ads", "example", "com", "en"}
    index = urls.index_rules(rules, {"com": 9, "example": 5, "ads": 1, "en": 4})
    assert {t: [r.text for r in under] for t, under in index.items()} == {"ads": ["ads.example.com/en/x"], "": ["/q"], "com": ["com"]}
    with pytest.raises(ValueError):
        urls.Rule("a.com", "x", "block")


# exact copies


def test_exact_copies(spark):
    rows = corpus(2) + [(100, "a  b"), (101, "a\tb"), (102, "a b "), (103, None), (3, "one")]
    got = sorted((tuple(r) for r in exact.exact_groups(documents(spark, rows)).collect()), key=repr)
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    ids = defaultdict(list)
    for d, t in norm:
        ids[t].append(d)
    want = [(d, min(ids[t]), len(ids[t]), d == min(ids[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in norm]
    assert got == sorted(want, key=repr)
    kept = exact.keep_exact(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([min(v) for v in ids.values()] + [3])


# quality


def test_statistics_are_those_of_a_loop(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    texts += ["x\nx\n \nx y\n\nx y", "#a |b <c>\r\n", "a b c d e a b c d e", "漢 字 é " * 5, "w" * 50_000, "a b c d " * 4_000, None, ""]
    rows = corpus(4) + [(200 + i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in quality.judge_quality(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        r = got[d]
        assert (*(r[c] for c in quality.STATISTICS), r["base_failed"]) == plain_quality(text), text
        assert not (r["base_failed"] and r["kept"])


def plain_robust(x):
    """Deterministic concentration with numpy, as the operator does it."""
    floor = np.array(quality.FLOOR)

    def moments(rows):
        c = np.cov(rows.T, bias=True)
        c[np.diag_indices(5)] = np.maximum(np.diag(c), floor**2)
        return rows.mean(0), c

    def distances(m, c):
        low = np.linalg.cholesky(c)
        return (np.linalg.solve(low, (x - m).T) ** 2).sum(0)

    bucket = lambda d: np.floor(np.log(d + 1e-6) * 100)
    m, c = moments(x)
    for _ in range(quality.STEPS):
        b = bucket(distances(m, c))
        edge = np.sort(b)[int(np.ceil(quality.SUPPORT * len(b))) - 1]
        m, c = moments(x[b <= edge])
    d = distances(m, c)
    middle = np.sort(bucket(d))[int(np.ceil(len(d) / 2)) - 1]
    return d * min(1.0, quality.MEDIAN / np.exp((middle + 1) / 100))


def test_distances_are_those_of_numpy_and_find_outliers(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5))
    x[:40] += 30
    rows = [(i, "de", "s", *map(float, row)) for i, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "id long, _lang string, _source string, x0 double, x1 double, x2 double, x3 double, x4 double")
    got = {r["id"]: r["d"] for r in quality.robust_distances(frame, Stage(spark)).collect()}
    want = plain_robust(x)
    assert np.allclose([got[i] for i in range(400)], want, rtol=1e-6)
    assert (want[:40] > quality.CUTOFF).all() and (want[40:] < quality.CUTOFF).all()


def test_strange_documents_go_and_clean_ones_stay(spark):
    rng = random.Random(6)
    prose = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 300)))
    clean = [(i, prose()) for i in range(80)]
    strange = [(100 + i, " ".join(w + "###" for w in prose().split())) for i in range(8)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge_quality(documents(spark, clean + strange)).collect()}
    assert all(got[d] for d, _ in clean) and not any(got[d] for d, _ in strange)
    few = quality.judge_quality(documents(spark, clean[:5] + strange[:2])).collect()
    assert all(r["kept"] for r in few)  # too few to tell
    kept = quality.keep_quality(documents(spark, clean + strange + [(None, prose())]))
    assert kept.count() == 81 and "digest" in kept.columns


def test_small_groups_are_judged_by_what_they_belong_to(spark):
    rng = random.Random(13)
    prose = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 300)))
    junk = lambda: " ".join(w + "###" for w in prose().split())
    groups = [("en", "hot")] * 60 + [("en", f"s{i}") for i in range(20)] + [("xx", "s1")] * 3 + [(None, None)] * 3 + [("l", "")] * 2
    rows = [(i, prose(), *g) for i, g in enumerate(groups)]
    rows += [(100 + i, junk(), *g) for i, g in enumerate([("en", "hot"), ("en", "s1"), ("en", None), ("xx", "s1"), (None, None), ("yy", "z")])]
    got = {r["doc_id"]: r for r in quality.judge_quality(documents(spark, rows)).collect()}
    assert len(got) == len(rows) and all(r["distance"] is not None for r in got.values())
    assert {d for d, r in got.items() if not r["kept"]} == set(range(100, 106))


# mixing


def test_no_source_is_a_block_away_from_its_share(spark):
    rng = random.Random(7)
    rows = [(i, "t", "en", rng.choice(["a"] * 12 + ["b"] * 5 + ["c", "d", None])) for i in range(900)] + [(5, "t", "en", "a"), (None, "t", "en", "b")]
    frame = documents(spark, rows)
    got = mixing.mix(frame, resolution=20, block=4).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((d, s or "") for d, _, _, s in rows)
    assert len({r["place"] for r in got}) == len(got)
    blocks = sorted({(r["slot"], r["source"], r["block"]) for r in got})
    shares = {r["source"]: r["share"] for r in mixing.target_shares(frame, Stage(spark), "source", 0.5, 20, 4).collect()}
    period = sum(shares.values())
    full = min(-(-n // 4) // shares[s] for s, n in Counter(s or "" for *_, s in rows).items()) * period
    done = Counter()
    for slot, source, block in blocks:
        assert block == done[source]  # a source's blocks come in order
        done[source] += 1
        if slot < full:
            for s, share in shares.items():
                assert abs(done[s] - (slot + 1) * share / period) < 1
    mixed = mixing.mixed(frame, resolution=20, block=4)
    assert mixed.columns == frame.columns and mixed.count() == len(rows)


# packing


def test_best_fit_places_as_one_document_at_a_time():
    rng = random.Random(8)
    for _ in range(30):
        capacity = rng.choice([7, 30, 100])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 150))), reverse=True)
        bins = []
        for length in lengths:
            fitting = [(room, i) for i, room in enumerate(bins) if room >= length]
            if fitting:
                room, i = min(fitting)
                bins[i] -= length
            else:
                bins.append(capacity - length)
        used = defaultdict(list)
        for p in packing.best_fit_decreasing(Counter(lengths), capacity):
            for n in range(p.count):
                used[p.bin + n // p.each].append((p.offset + n % p.each * p.length, p.length))
        assert sorted(capacity - sum(x for _, x in items) for items in used.values()) == sorted(bins)
        for items in used.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= capacity


def check_pieces(got, texts, capacity):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer())
    held, bins = Counter(), defaultdict(list)
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(pieces, key=repr) == sorted(texts, key=repr)
    for d, rows in pieces.items():
        ids = np.array([*own.encode(texts[d] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n, r in enumerate(sorted(rows, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(ids[at : at + r["length"]].tobytes()))
            assert n == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids)
        held[d] = at
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(held.values()) // capacity)


def test_packing_keeps_every_id(spark):
    rows = corpus(9) + [(90, "x " * 500), (91, "<|endoftext|> a <|endoftext|>"), (92, "don't 12 !? \n\n  tail  "), (93, "a" * 3000)]
    used, least = check_pieces(packing.pack(documents(spark, rows), tokenizer(), 64).collect(), dict(rows), 64)
    assert used <= 1.1 * least + 1


def test_sequences_follow_the_mix(spark, tmp_path):
    """Sources that stand one after another by id are dealt out evenly over the sequences once they are mixed."""
    rows = [(d, f"text number {d} " * (1 + d % 7), "en", "ab"[d // 400]) for d in range(800)]
    frame = documents(spark, rows)
    mixing.mixed(frame).write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    shares = {}
    for name, docs in (("mixed", mixed), ("as it stands", frame.coalesce(1).sort("doc_id"))):
        got = packing.pack_in_order(docs, tokenizer(), 64, window=64).collect()
        used, least = check_pieces(got, {d: t for d, t, *_ in rows}, 64)
        assert used <= 1.1 * least + 13
        windows = defaultdict(set)
        for r in got:
            windows[r["sequence_id"] >> 32].add(r["doc_id"])
        assert sorted(windows) == list(range(13))  # 12 of 64 documents, one of the last 32
        assert all(len(windows[w]) == 64 for w in range(12))
        shares[name] = [sum(d < 400 for w in range(n + 1) for d in windows[w]) for n in range(12)]
    assert all(abs(first - 32 * (n + 1)) <= 16 for n, first in enumerate(shares["mixed"]))
    assert shares["as it stands"][:6] == [64, 128, 192, 256, 320, 384]
    assert packing.pack_in_order(documents(spark, []), tokenizer()).count() == 0


# personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def luhn(digits):
        twice = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
        return sum(t - 9 if t > 9 else t for t in twice) % 10 == 0

    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(10)
    bits = ["1", "2", "45", "4111111111111111", " ", "-", ".", "+", "(", ")", "@", "a", "b.", "@x", ".com", "é", "255.1", "+1 (", "0255", "%_"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text)] == plain_spans(text), text


def test_long_runs_take_no_square_time():
    for text in ("1" * 300_000, "a" * 300_000, "a" * 100_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000):
        pii.find_spans(text)


def test_candidates_are_added_where_labelers_agree(spark):
    rng = random.Random(11)
    rows = []
    for i in range(200):
        kind = i % 5
        phone = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        rows.append((i, (
            f"my phone is {phone}.", f"write an e-mail to bob{i} (at) mail{i} (dot) example (dot) com, please",
            f"reach +1 {phone} by phone", f"mail a{i}@b.example.com or host 10.0.0.{i}", f"version 12 345 {rng.randint(1000, 9999)} of order",
        )[kind]))
    rows += [(500, None), (501, ""), (None, "x@y.zz")]
    got = {r["doc_id"]: r for r in pii.personal_data(documents(spark, rows)).collect()}
    for d, text in rows:
        base = plain_spans(text or "")
        assert got[d]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[d][f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        assert set(base) <= set(filter(None, got[d]["spans"].split(",")))
    added = Counter(d % 5 for d, r in got.items() if d is not None and d < 200 and r["n_added"])
    assert added[0] == 40 and added[1] == 40 and added[4] == 0


def test_spelt_addresses_are_searched_in_every_form():
    for at in (" (at) ", "[at]", " {at} ", " at "):
        for dot in (" (dot) ", "[dot]", " {dot} ", " dot "):
            text = f"john{at}example{dot}com"
            assert [(c.kind, c.start, c.end) for c in pii.find_spans(text)] == [(0, 0, len(text))], text


def test_reliable_labelers_are_told_from_noise():
    rng = np.random.default_rng(12)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) for p in (0.95, 0.9, 0.85, 0.55)], 1)
    votes = np.where(votes, 1, 2)
    probability, table = pii.reliabilities(votes, np.ones(4000))
    assert ((probability > 0.5) == truth).mean() > 0.93
    assert table[1, 0, 1] > 0.9 > 0.65 > table[1, 3, 1]


# tables without rows


def test_empty_tables(spark):
    none = documents(spark, [])
    for frame in (
        exact.exact_groups(none), quality.judge_quality(none), mixing.mix(none), packing.pack(none, tokenizer()), pii.personal_data(none),
        urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES),
    ):
        assert frame.count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_parcels_give_back_what_was_sealed(n):
    draw = np.random.default_rng(n)
    for numbers in (np.sort(draw.integers(0, 1 << 20, n)), draw.integers(0, 1 << 32, n)):
        sender, (got, column) = parcels.unseal(parcels.seal(-5, numbers, np.arange(n)), np.int64)
        assert sender == -5 and got.tolist() == numbers.tolist() and column.tolist() == list(range(n))
