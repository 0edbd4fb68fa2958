"""Small tables and plain loops that the operators are compared with."""

import random
import re
import string
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: columns whose names the operators use inside
CLASHES = (
    "id", "digest", "node", "component", "places", "bucket", "kind", "parcel", "region", "hash", "norm", "words", "line",
    "gone", "kept", "rank", "place", "length", "host", "path", "rule", "verdict", "d", "x0", "_lang", "rows", "found", "_text",
)


def documents(spark, rows, parts=3):
    """Rows of (doc_id, text[, lang, source]) as ``documents`` with many more columns."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1]) if r[1] is not None else None) for r in rows]
    frame = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES:
        frame = frame.withColumn(name, frame["doc_id"].cast("string"))
    return frame.repartition(parts) if rows else frame


def corpus(seed, n=40):
    """Texts with shared passages and lines, copies and near copies, white space of all kinds, nulls and empty ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    prose = lambda k: rng.choice((" ", "  ")).join(rng.choice(vocabulary) for _ in range(k))
    passages = [prose(rng.randint(15, 60)) for _ in range(4)]
    texts = [None, "", " \n\t ", "one", "A b", "\x0b"]
    while len(texts) < n:
        lines = [rng.choice(passages) if rng.random() < 0.3 else prose(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))]
        texts.append("\n".join(lines))
    for _ in range(n // 4):
        words = rng.choice(texts[6:]).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [texts[10], texts[10].upper(), passages[0] * 40]
    return list(enumerate(texts))


def words(text):
    return WORD.findall(text or "")


def union_find(items, links):
    parent = {x: x for x in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in items}


def similar(a, b, percent):
    common = len(a & b)
    return bool(common) and 100 * common >= percent * (len(a) + len(b) - common)


def shingles(text, k):
    found = words((text or "").translate(LOWER))
    if len(found) < k:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + k]) for i in range(len(found) - k + 1)}


def jaccard_components(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and similar(sets[a], sets[b], percent)]
    return {d: (len(sets[d]), c) for d, c in union_find(sets, links).items()}


def without_lines(rows, k=7, percent=80):
    """Texts without repeated lines, as the line operator defines them."""
    places = defaultdict(list)
    for d, text in rows:
        for n, line in enumerate(text.split("\n") if text is not None else []):
            if WORD.search(line):
                places[line].append((d, n))
    lines = sorted(places)
    sets = [{x[i : i + k] for i in range(max(1, len(x) - k + 1))} for x in lines]
    numbers = range(len(lines))
    roots = union_find(numbers, [(a, b) for a in numbers for b in range(a) if similar(sets[a], sets[b], percent)])
    groups = defaultdict(list)
    for n, line in enumerate(lines):
        groups[roots[n]] += places[line]
    gone = {p for group in groups.values() for p in group if p != min(group)}
    return {
        d: text if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (d, n) not in gone) for d, text in rows
    }


def quality(text):
    """The five statistics and whether the base rules fail."""
    found = words(text)
    windows = defaultdict(list)
    for i in range(len(found) - 4):
        windows[tuple(found[i : i + 5])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text or ""),
        sum(Counter(lines).values()) - len(set(lines)),
        len(covered),
    )
    return (*counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
