"""Collocations by multikey three-way quicksort of suffix pointers.

The words of a piece of text, from each word on and as far as a phrase may reach, are a suffix. Suffixes are
routed by their leading words, so that one task holds all that begin alike; there pointers to them are sorted by a
three-way quicksort that goes one word deeper inside the part equal to the pivot. The size of such a part is the
number of occurrences of a phrase, and a part smaller than the least count is not sorted on.

Leading words that begin very many suffixes are followed by one more word in the route, and so on. Their own
phrases are then counted in parts, which are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.stage import Stage

#: A word of a language under 64 bits; a lead is a fingerprint of the leading words of a suffix.
COUNTS = "lead boolean, id long, lang string, word string, n long"
SENT = "bucket int, parcel binary"
FOUND = "phrase array<long>, n long"
#: bytes of text a task takes at a time, and suffixes a group of leads holds on average
SIZE, GROUP = 1 << 22, 1 << 20
#: a lead is hot from this part of a shuffle partition on
HOT = 8
_MARKS = np.zeros(256, np.uint8)
_MARKS[[9, 32]] = 1
_MARKS[[10, 11, 12, 13, *b".,;:!?"]] = 2


def whole_pieces(batches: Iterator[pa.RecordBatch], size: int = SIZE) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of text; a longer text is cut where a piece ends, so no phrase is cut."""
    for batch in A.chunks(batches, size=size):
        data, bounds = A.text_bytes(batch["text"])
        if batch.num_rows > 1 or len(data) <= size:
            yield batch
            continue
        ends = np.append(np.flatnonzero(_MARKS[data] == 2) + 1, len(data))
        begin = 0
        while begin < len(data):
            fits = int(np.searchsorted(ends, begin + size, "right")) - 1
            end = int(ends[fits]) if fits >= 0 and ends[fits] > begin else int(ends[fits + 1])
            text = pa.array([data[begin:end].tobytes().decode()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["lang"], text], ["lang", "text"])
            begin = end


class Suffixes:
    """Words of a batch: their ids, and how many words a suffix has from each on, at most ``depth``."""

    def __init__(self, batch: pa.RecordBatch, depth: int) -> None:
        data, bounds = A.text_bytes(batch["text"])
        self.data = A.ascii_lower(data)
        marks = _MARKS[data]
        outside = np.ones(len(data) + 2, bool)
        outside[1:-1] = marks > 0
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        self.starts = np.flatnonzero(~outside[1:] & (outside[:-1] | cut))
        self.ends = np.flatnonzero(~outside[:-1] & (outside[1:] | cut))
        text = np.searchsorted(bounds, self.starts, "right") - 1
        langs = batch["lang"].to_pylist()
        seeds = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
        seed = np.array([seeds[x] for x in langs], U)
        self.langs, self.text = langs, text
        self.ids = A.mix(A.hashes(A.prefix_sums(self.data), self.starts, self.ends) ^ seed[text]) if len(text) else np.zeros(0, U)
        self.ids[self.ids == 0] = 1
        piece = np.cumsum(marks == 2)[self.starts] + text if len(text) else text
        n = len(text)
        follows = np.zeros(n + depth, bool)
        follows[: max(n - 1, 0)] = piece[1:] == piece[:-1]
        self.length = np.ones(n, np.int8)
        more = np.ones(n, bool)
        for k in range(depth - 1):
            more &= follows[k : k + n]
            self.length += more
        self.padded = np.append(self.ids, np.zeros(depth, U))

    def columns(self, at: np.ndarray, depth: int) -> np.ndarray:
        """The ids of the suffixes from ``at`` on, in rows; 0 after their end."""
        wide = self.padded[at[:, None] + np.arange(depth)]
        wide[np.arange(depth) >= self.length[at][:, None]] = 0
        return wide


def leads(wide: np.ndarray) -> Iterator[np.ndarray]:
    """Fingerprints of the first word of each row, the first two, and so on."""
    h = np.full(len(wide), U(0x5851F42D4C957F2D))
    for k in range(wide.shape[1]):
        h = A.mix((h + wide[:, k]) * U(0x9FB21C651E98DF25) + U(k))
        yield h


def _count(depth: int, parts: int):
    """Words by number, and the leads that are many in a batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_pieces(batches):
            s = Suffixes(batch, depth)
            if not len(s.ids):
                continue
            ids, first, n = np.unique(s.ids, return_index=True, return_counts=True)
            words = [s.data[a:b].tobytes().decode() for a, b in zip(s.starts[first].tolist(), s.ends[first].tolist(), strict=True)]
            langs = [s.langs[t] for t in s.text[first].tolist()]
            yield _counts(False, ids, langs, words, n)
            at = np.flatnonzero(s.length > 1)
            wide = s.columns(at, depth)
            kept = np.arange(len(at))
            for k, lead in enumerate(leads(wide)):
                kept = kept[wide[kept, k] > 0]
                if k == depth - 1 or not len(kept):
                    break
                many, inverse, n = np.unique(lead[kept], return_inverse=True, return_counts=True)
                hot = n * HOT * parts >= len(s.ids)
                yield _counts(True, many[hot], [None] * int(hot.sum()), [None] * int(hot.sum()), n[hot])
                kept = kept[hot[inverse]]

    return count


def _counts(lead: bool, ids: np.ndarray, langs: list, words: list, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), lead)), pa.array(ids.view(np.int64)), pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n.astype(np.int64))],
        ["lead", "id", "lang", "word", "n"],
    )


def pack(wide: np.ndarray, weight: np.ndarray, route: np.ndarray) -> bytes:
    """Rows of ids with weight and route; ids are numbered within the parcel."""
    own, at = np.unique(wide, return_inverse=True)
    kind = np.uint16 if len(own) < 1 << 16 else np.uint32
    head = np.array([len(own), len(wide), wide.shape[1], np.dtype(kind).itemsize], np.int64)
    columns = at.reshape(wide.shape).T.astype(kind)
    return b"".join(x.tobytes() for x in (head, own, np.ascontiguousarray(columns), weight.astype(np.uint32), route.astype(np.uint8)))


def unpack(parcel: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n_own, rows, depth, width = np.frombuffer(parcel, np.int64, 4).tolist()
    at = 32
    own = np.frombuffer(parcel, U, n_own, at)
    at += own.nbytes
    columns = np.frombuffer(parcel, np.uint16 if width == 2 else np.uint32, rows * depth, at)
    at += columns.nbytes
    weight = np.frombuffer(parcel, np.uint32, rows, at)
    return own[columns.reshape(depth, rows)].T, weight, np.frombuffer(parcel, np.uint8, rows, at + weight.nbytes)


def _send(depth: int, buckets: int, hot: np.ndarray):
    """Suffixes of two words or more, equal ones of a batch as one with a weight, to the bucket of their lead."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_pieces(batches):
            s = Suffixes(batch, depth)
            at = np.flatnonzero(s.length > 1)
            if not len(at):
                continue
            wide = s.columns(at, depth)
            every = list(leads(wide))
            _, first, weight = np.unique(every[-1], return_index=True, return_counts=True)
            wide = wide[first]
            route, key = np.ones(len(first), np.uint8), every[0][first]
            longer = np.ones(len(first), bool)
            for k in range(depth - 1):
                longer &= (wide[:, k] > 0) & np.isin(every[k][first], hot)
                route[longer] = k + 2
                key = np.where(longer, every[k + 1][first], key)
            bucket = (A.mix(key) % U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            starts = P.groups(bucket[order])
            for a, b in zip(starts, np.append(starts, len(order))[1:], strict=True):
                o = order[a:b]
                parcel = pack(wide[o], weight[o], route[o])
                yield pa.RecordBatch.from_arrays([pa.array([int(bucket[o[0]])], pa.int32()), pa.array([parcel], pa.binary())], ["bucket", "parcel"])

    return send


def multikey_counts(wide: np.ndarray, weight: np.ndarray, route: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, a pointer each, and counts of the phrases that begin at least ``least`` of the suffixes.

    Quicksort of pointers, all open partitions of a round at a time: each takes a pivot at its depth and falls into
    less, equal and greater; the equal part goes one word deeper, its weight being a phrase's count. A part under
    the least count is abandoned, but for phrases whose suffixes are routed by more words than they have: of these
    this is a part of the count only.
    """
    pointers = np.arange(len(wide))
    begin, end, depth = np.array([0]), np.array([len(wide)]), np.array([0])
    deepest = wide.shape[1]
    while len(begin):
        sizes = end - begin
        base = np.cumsum(sizes) - sizes
        seg = np.repeat(np.arange(len(begin)), sizes)
        at = np.arange(len(seg)) - np.repeat(base - begin, sizes)
        own = pointers[at]
        key = wide[own, depth[seg]]
        probes = np.sort(np.stack([key[base], key[base + sizes // 2], key[base + sizes - 1]]), axis=0)
        pivot = probes[1][seg]
        side = (key >= pivot).astype(np.int8) + (key > pivot)
        moved = np.empty_like(own)
        parts = []
        offset = np.zeros(len(begin), np.int64)
        for c in range(3):
            here = side == c
            rank = np.cumsum(here)
            before = rank[base] - here[base]
            number = rank[base + sizes - 1] - before
            to = (base + offset - before)[seg] + rank - 1
            moved[to[here]] = own[here]
            parts.append((offset, number))
            offset = offset + number
        pointers[at] = moved
        totals = np.append(0, np.cumsum(weight[moved], dtype=np.int64))
        beyond = np.append(0, np.cumsum(route[moved] > depth[seg] + 1))
        opened: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for c, (offset, number) in enumerate(parts):
            a, b = base + offset, base + offset + number
            count = totals[b] - totals[a]
            kept = (number > 0) & ((count >= least) | (beyond[b] > beyond[a]))
            deeper = depth.copy()
            if c == 1:
                kept &= probes[1] > 0
                deeper += 1
                for k in np.unique(deeper[kept & (deeper > 1)]).tolist():
                    found = kept & (deeper == k)
                    yield k, moved[a[found]], count[found]
                kept &= deeper < deepest
            opened.append(((begin + offset)[kept], (begin + offset + number)[kept], deeper[kept]))
        begin, end, depth = (np.concatenate(x) for x in zip(*opened, strict=True))


def _sort(least: int):
    """The phrases of each bucket of a partition; buckets come one after another."""

    def found(parcels: list[bytes]) -> Iterator[pa.RecordBatch]:
        wide, weight, route = (np.concatenate(x) for x in zip(*map(unpack, parcels), strict=True))
        for k, at, count in multikey_counts(wide, weight, route, least):
            for a in range(0, len(at), 1 << 16):
                ids = wide[at[a : a + (1 << 16)], :k]
                offsets = pa.array(np.arange(0, ids.size + 1, k, dtype=np.int32))
                phrase = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(ids).view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([phrase, pa.array(count[a : a + (1 << 16)])], ["phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, parcel in zip(batch["bucket"].to_pylist(), batch["parcel"].to_pylist(), strict=True):
                if b != bucket and held:
                    yield from found(held)
                    held = []
                bucket = b
                held.append(parcel)
        if held:
            yield from found(held)

    return run


def count_phrases(docs: DataFrame, stage: Stage, depth: int = 5, least: int = 100, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Words (id, lang, word, n) and phrases of two to ``depth`` words (phrase, n); phrases with ``least`` occurrences or more."""
    parts = P.partitions(docs)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    counted = texts.mapInArrow(_count(depth, parts), COUNTS).groupBy("lead", "id", "lang", "word").agg(F.sum("n").alias("n"))
    counted = stage.put(counted, "counts")
    words = counted.where("NOT lead").drop("lead")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # a lead with a share of 1 in HOT * parts has it in some batch; those counted reach half of twice that share
    hot = counted.where(F.col("lead") & (F.col("n") * HOT * parts >= total)).select("id").toPandas()["id"]
    buckets = parts * max(1, -(-total // (parts * GROUP)))
    sent = texts.mapInArrow(_send(depth, buckets, np.sort(hot.to_numpy(np.int64).view(U))), SENT)
    dealt = sent.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    phrases = dealt.mapInArrow(_sort(least), FOUND).groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return words, stage.put(phrases, "phrases")


def collocations(
    docs: DataFrame, depth: int = 5, least: int = 100, top: int = 2000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """The phrases of each language whose words stand together more often than their parts would by chance.

    One row per phrase: lang, rank, phrase, a, l, r, n, score. Texts are lower-cased (A-Z) and cut into pieces at
    ``[.,;:!?\\x0A-\\x0D]``, pieces into words at spaces and tabs; ``n`` counts a language's words, ``a`` the
    phrase's occurrences within pieces, overlaps included, ``l`` and ``r`` those of its two parts at the cut with the
    lowest score floor(1000 * a * n / (l * r)), the first of equal ones. Phrases have 2 to ``depth`` words and at least
    ``least`` occurrences; one that always stands in the same longer phrase is left out. A language's first ``top`` by
    score, occurrences and phrase are returned.

    A null language is ``und``, a null or empty text has no words; rows count as often as they are there. A text is cut
    between pieces where it is longer than a task takes at a time. Other columns are not read. Two frequent words
    under one 64-bit id end the job with an error; so does a score beyond 64 bits.
    """
    stage = Stage(docs.sparkSession)
    words, phrases = count_phrases(docs, stage, depth, least, lang_col, text_col)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    one = F.min(F.struct("lang", "word")) == F.max(F.struct("lang", "word"))
    known = words.where(F.col("n") >= least).groupBy("id").agg(
        F.when(one, F.min("lang")).otherwise(F.raise_error(F.lit("two words have one id"))).alias("lang"), F.min("word").alias("word"), F.sum("n").alias("n")
    )
    known = stage.put(known, "words", free=False)
    every = phrases.union(known.select(F.array("id"), "n"))
    # what stands in a longer phrase as often as by itself: it is enough to look one word further
    shorter = phrases.where(F.size("phrase") > 2).select(
        F.explode(F.array(F.expr("slice(phrase, 1, size(phrase) - 1)"), F.expr("slice(phrase, 2, size(phrase) - 1)"))).alias("phrase"), F.col("n").alias("longer")
    )
    kept = (
        phrases.withColumn("longer", F.lit(0).cast("long")).unionByName(shorter.withColumn("n", F.lit(0).cast("long")))
        .groupBy("phrase").agg(F.max("n").alias("a"), F.max("longer").alias("longer")).where("longer < a").drop("longer")
    )
    cuts = kept.select("phrase", "a", F.expr("explode(sequence(1, size(phrase) - 1)) AS k")).select(
        "phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("first"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("rest")
    )
    parts = cuts.join(every.select(F.col("phrase").alias("first"), F.col("n").alias("l")), "first")
    parts = parts.join(every.select(F.col("phrase").alias("rest"), F.col("n").alias("r")), "rest")
    texts = kept.select("phrase", F.posexplode("phrase").alias("at", "id")).join(known.select("id", "lang", "word"), "id")
    texts = texts.groupBy("phrase").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    texts = texts.select("phrase", "lang", F.concat_ws(" ", "words.word").alias("text")).join(totals, "lang")
    scored = parts.join(texts, "phrase").withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = scored.groupBy("phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.min("a").alias("a"), F.min("n").alias("n"), F.min("lang").alias("lang"), F.min("text").alias("text")
    )
    best = best.select("lang", F.col("text").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits."""
    big = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", (big(a) * big(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"), big(l) * big(r))
