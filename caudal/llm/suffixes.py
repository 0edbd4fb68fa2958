"""Suffix-array deduplication by a common-prefix-aware distributed merge sort.

Sorting a suffix for every byte would send hundreds of bytes for each. Two windows of equal bytes, however,
choose the same place as their anchor: the k-gram with the least fingerprint among the first ones. So only the
suffixes that begin at anchors are sorted, and of these only those whose first bytes, which all windows of an
anchor share, have a fingerprint that occurs twice.

A task sorts the suffixes it holds into runs and sends them front-coded: how much each has in common with the
one before, and the rest. What meets is dealt by the fingerprint of the common first bytes. The runs of a
bucket are merged by a loser tree that carries the common prefixes along and never compares a byte of them
again; neighbours that have their first bytes in common are one group, in which the windows are compared, byte
by byte, at each distance from the anchor.

A suffix that a task has several times, with the same bytes before it, is sent once. A group in which very
many suffixes differ is not gathered: its windows are compared by 96-bit fingerprints, dealt by window.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.stage import Stage

#: k-gram of an anchor, and how many places an anchor is chosen from. Half as many bytes lie between anchors.
GRAM, CHOICE = 16, 193
#: Groups with more different contexts are compared window by window.
CROWD = 512
#: Bytes of text whose suffixes a task sorts at a time.
RUN = 8 << 20
_HIGH = U(32)


class Anchors(NamedTuple):
    """Anchor, and the first and last window that chose it, as places in the bytes of several texts."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def find_anchors(sums: np.ndarray, bounds: np.ndarray, window: int, choice: int) -> Anchors:
    """The anchors of all windows inside texts; the leftmost of equal fingerprints."""
    n = len(sums) - 1
    grams = n - GRAM + 1
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    if grams < choice or not counts.any():
        return Anchors(*[np.zeros(0, np.int64)] * 3)
    at = np.arange(grams)
    low = U((1 << 28) - 1)
    keys = (A.hashes(sums, at, at + GRAM) & ~low) | (at.astype(U) & low)
    # least of each stretch of ``choice`` places: from the end of one block and from the start of the next
    size = -(-grams // choice) * choice
    padded = np.full(size, ~U(0))
    padded[:grams] = keys
    blocks = padded.reshape(-1, choice)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(behind[: grams - choice + 1], ahead[choice - 1 : grams])
    text = np.repeat(np.arange(len(counts)), counts)
    windows = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[text]
    # the low bits tell the place among its nearest 2^28
    chosen = windows + ((least[windows] - windows.astype(U)) & low).astype(np.int64)
    new = P.groups(chosen, text)
    ends = np.append(new, len(windows))[1:]
    return Anchors(chosen[new], windows[new], windows[ends - 1])


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, P.Documents]:
    data, bounds = A.text_bytes(batch["text"])
    ids, digests = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "digest"))
    return data, bounds, P.Documents(ids, digests, np.diff(bounds))


def _held(batches: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Gather items, the first of which is bytes, up to a size."""
    held, n = [], 0
    for item in batches:
        if n and n + len(item[0]) > size:
            yield held
            held, n = [], 0
        held.append(item)
        n += len(item[0])
    if n:
        yield held


def _offsets(held: list[tuple]) -> list[int]:
    return [0, *np.cumsum([len(item[0]) for item in held]).tolist()]


def _send_keys(window: int, choice: int, parts: int):
    """Sends the fingerprint of every anchor's first bytes, once a task; those it has twice are found."""
    prefix = window - choice + 1

    def read(batches):
        for batch in A.chunks(batches):
            data, bounds, docs = _texts(batch)
            sums = A.prefix_sums(data)
            anchors = find_anchors(sums, bounds, window, choice)
            yield data, docs, anchors.at, A.hashes(sums, anchors.at, anchors.at + prefix)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(read(batches), RUN):
            docs = P.merge([h[1] for h in held])
            numbers = np.concatenate([h[2] + at for h, at in zip(held, _offsets(held), strict=False)])
            keys = np.concatenate([h[3] for h in held])
            order = np.argsort(keys, kind="stable")
            key = keys[order]
            starts = P.groups(key)
            sizes = np.diff(np.append(starts, len(key)))
            twice = order[np.repeat(sizes > 1, sizes)]
            sent = order[starts]
            bucket = (keys[sent] % U(parts)).astype(np.int64)
            yield P.parcels(docs, bucket, numbers[sent], [(keys[sent] >> _HIGH).astype(np.uint32)], (numbers[twice],), parts)

    return send


def _twice(kinds: tuple[type, ...], stretches: bool):
    """Finds the places whose values came from two senders."""

    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[tuple[int, int, bytes]] = []
        found = [np.zeros(0, np.int64)] * 2
        values = P.received(batches, answers, *kinds)
        if values is not None:
            senders, numbers, *keys = values
            order = np.lexsort(keys)
            starts = P.groups(*[k[order] for k in keys])
            sizes = np.diff(np.append(starts, len(order)))
            hit = order[np.repeat(sizes > 1, sizes)]
            found = [senders[hit], numbers[hit].astype(np.int64)]
        yield from P.answer_rows(answers, P.FOUND, *found, *[found[1] + 1] * stretches)

    return twice


# runs of suffixes


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, which is known to be ``start`` at least."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (differ.bit_length() + 7) // 8


class Suffix(NamedTuple):
    """A suffix from its anchor on, the bytes before it, how often the task has both, and its number there."""

    after: bytes
    before: bytes
    times: int
    number: int


def front_code(suffixes: list[Suffix], sender: int) -> bytes:
    """Sorted suffixes, each as what it doesn't have in common with the one before."""
    heads = np.zeros((len(suffixes), 5), np.uint32)
    bodies, last = [], b""
    for i, s in enumerate(suffixes):
        shared = common(last, s.after)
        heads[i] = shared, len(s.after) - shared, len(s.before), min(s.times, 2), s.number
        bodies += [s.after[shared:], s.before]
        last = s.after
    return b"".join((np.array([sender, len(suffixes)]).tobytes(), heads.tobytes(), *bodies))


def decode(run: bytes) -> Iterator[tuple[int, Suffix]]:
    """The suffixes of a run, each with the length of what it has in common with the one before."""
    _, n = np.frombuffer(run, np.int64, 2)
    heads = np.frombuffer(run, np.uint32, 5 * n, 16).reshape(-1, 5).tolist()
    at, last = 16 + 20 * int(n), b""
    for shared, rest, before, times, number in heads:
        last = last[:shared] + run[at : at + rest]
        yield shared, Suffix(last, run[at + rest : at + rest + before], times, number)
        at += rest + before


def merge_runs(runs: list[bytes]) -> Iterator[tuple[int, int, Suffix]]:
    """All suffixes in order: the length in common with the one before, the sender, the suffix.

    A loser tree in which each loser keeps the length it has in common with the winner of its match. The new
    candidate knows what it shares with the last winner, as it followed it in its run. Of two that share
    different lengths with the last winner the longer one comes first, and what they share is the shorter
    length; only at equal lengths are bytes compared, from there on.
    """
    streams = [decode(run) for run in runs]
    senders = [int(np.frombuffer(run, np.int64, 1)[0]) for run in runs]
    size = 1 << max(0, len(runs) - 1).bit_length()
    # one head per stream, with the length in common with the last winner; None when the stream has ended
    heads: list[tuple[int, Suffix] | None] = [next(s, None) for s in streams] + [None] * (size - len(runs))
    heads = [h and (0, h[1]) for h in heads]

    def match(a: tuple | None, b: tuple | None, i: int, j: int) -> tuple[int, tuple | None, int, tuple | None]:
        """Winner with its length in common with the last winner, loser with its length in common with this winner."""
        if a is None or b is None:
            return (i, a, j, b) if b is None else (j, b, i, a)
        if a[0] != b[0]:
            return (i, a, j, b) if a[0] > b[0] else (j, b, i, a)
        x, y = a[1].after, b[1].after
        shared = common(x, y, a[0])
        if shared == len(x) or (shared < len(y) and x[shared] < y[shared]):
            return i, a, j, (shared, b[1])
        return j, b, i, (shared, a[1])

    losers: list[tuple[int, tuple | None]] = [(0, None)] * size
    level = [(i, heads[i]) for i in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        above = []
        for k in range(0, len(level), 2):
            (i, a), (j, b) = level[k], level[k + 1]
            w, winner, l, loser = match(a, b, i, j)
            losers[node + k // 2] = (l, loser)
            above.append((w, winner))
        level = above
    w, winner = level[0]
    while winner is not None:
        yield winner[0], senders[w], winner[1]
        candidate, i = next(streams[w], None), w
        at = (size + w) // 2
        while at:
            j, other = losers[at]
            i, candidate, l, loser = match(candidate, other, i, j)
            losers[at] = (l, loser)
            at //= 2
        w, winner = i, candidate


def _send_runs(window: int, choice: int, crowd: int, parts: int):
    """Sends the sorted suffixes of the anchors that were found, with the bytes before them."""
    prefix = window - choice + 1

    def read(batches):
        for batch in A.chunks(batches):
            data, bounds, docs = _texts(batch)
            sums = A.prefix_sums(data)
            anchors = find_anchors(sums, bounds, window, choice)
            asked = _asked(batch, bounds)
            mine = np.isin(anchors.at, asked)
            at, first, last = (x[mine] for x in anchors)
            yield data, docs, at, first, last, (A.hashes(sums, at, at + prefix) % U(parts)).astype(np.int64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(read(batches), RUN):
            docs = P.merge([h[1] for h in held])
            sender, rows = docs.sender, []
            places = defaultdict(list)
            buckets = {}
            for (data, _, *columns), offset in zip(held, _offsets(held), strict=False):
                raw = data.tobytes()
                for at, first, last, bucket in zip(*(c.tolist() for c in columns), strict=True):
                    places[raw[at : last + window], raw[first:at]].append((offset + at, offset + first, offset + last + 1))
                    buckets[raw[at : at + prefix]] = bucket
            found = [(first, stop) for same in places.values() if len(same) > 1 for _, first, stop in same]
            runs = defaultdict(list)
            crowds = defaultdict(list)
            for (after, before), same in places.items():
                crowds[after[:prefix]].append(Suffix(after, before, len(same), same[0][0]))
            again = []
            for head, group in crowds.items():
                if len(group) > crowd:
                    # the group is asked about again; others that have suffixes in it learn so from an empty sign
                    again += [s.number for s in group if s.times == 1] + [n for s in group for n, _, _ in places[s.after, s.before][: s.times > 1]]
                    group = [Suffix(head, b"", 0, 0)]
                runs[buckets[head]] += group
            rows += [(bucket, P.VALUES, front_code(sorted(run), sender)) for bucket, run in runs.items()]
            starts, stops = (np.array(c, np.uint32) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.uint32),) * 2
            rows += P.own_rows(docs, (starts, stops), parts)
            if again:
                rows.append((sender % parts, P.AGAIN, P.seal(sender, np.array(again), np.array(again, np.uint32))))
            yield P.parcel_rows(rows)

    return send


def _asked(batch: pa.RecordBatch, bounds: np.ndarray) -> np.ndarray:
    """The places asked about in each text, which are pairs if so said, as places in the bytes of all."""
    parts = [np.zeros(0, np.int64)]
    for blob, width, begin in zip(batch["places"].to_pylist(), batch["width"].to_pylist(), bounds[:-1], strict=True):
        parts.append(P.place_array(blob)[::width] + begin)
    return np.concatenate(parts)


def repeated_windows(group: list[tuple[int, Suffix]], window: int, crowd: int = CROWD) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """For suffixes with their first bytes in common: (sender, begin, end) of stretches of windows that occur twice.

    Second result: (sender, number) of the anchors whose windows have yet to be compared one by one.
    """
    contexts = defaultdict(list)
    for sender, s in group:
        contexts[s.after, s.before].append((sender, s.times, s.number))
    crowded = any(s.times == 0 for _, s in group) or len(contexts) > crowd
    alone = {c: members for c, members in contexts.items() if sum(m[1] for m in members) == 1}
    found = []
    for (after, before), members in contexts.items():
        if (after, before) not in alone:
            found += [(sender, n - len(before), n + len(after) - window + 1) for sender, times, n in members if times]
    if crowded:
        return found, [(sender, n) for members in contexts.values() for sender, times, n in members if times]
    if len(contexts) > 1 and alone:
        hits = defaultdict(list)
        for distance in range(max(len(before) for _, before in contexts) + 1):
            seen = {}
            for context in contexts:
                after, before = context
                if window - len(after) <= distance <= len(before):
                    key = before[len(before) - distance :] + after[: window - distance]
                    other = seen.setdefault(key, context)
                    if other is not context:
                        hits[context].append(distance)
                        hits[other].append(distance)
        for context, distances in hits.items():
            if context in alone:
                sender, _, number = alone[context][0]
                starts = np.unique(distances)
                cut = np.flatnonzero(np.diff(starts) > 1)
                for low, high in zip(np.append(starts[0], starts[cut + 1]), np.append(starts[cut], starts[-1]), strict=True):
                    found.append((sender, number - int(high), number - int(low) + 1))
    return found, []


def _merge(window: int, choice: int, crowd: int):
    prefix = window - choice + 1

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, answers = defaultdict(list), []
        for batch in batches:
            for bucket, kind, parcel in zip(*(batch[c].to_pylist() for c in ("bucket", "kind", "parcel")), strict=True):
                if kind == P.VALUES:
                    runs[bucket].append(parcel)
                else:
                    answers.append((P.unseal(parcel)[0], kind, parcel))
        found, again = [], []
        for own in runs.values():
            group: list[tuple[int, Suffix]] = []
            for shared, sender, suffix in merge_runs(own):
                if shared < prefix and group:
                    if len(group) > 1:
                        more, ask = repeated_windows(group, window, crowd)
                        found += more
                        again += ask
                    group = []
                group.append((sender, suffix))
            if len(group) > 1:
                more, ask = repeated_windows(group, window, crowd)
                found += more
                again += ask
        if again:
            senders, numbers = (np.array(c) for c in zip(*again, strict=True))
            answers += [tuple(r) for b in P.answer_rows([], P.AGAIN, senders, numbers, numbers) for r in zip(*b.to_pydict().values(), strict=True)]
        columns = [np.array(c, np.int64) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        yield from P.answer_rows(answers, P.FOUND, *columns)

    return merge


def _send_windows(window: int, choice: int, parts: int):
    """Sends the windows of the anchors asked about again, once a task; those it has twice are found."""

    def read(batches):
        for batch in A.chunks(batches):
            data, bounds, docs = _texts(batch)
            sums = A.prefix_sums(data)
            anchors = find_anchors(sums, bounds, window, choice)
            mine = np.isin(anchors.at, _asked(batch, bounds))
            first, last = anchors.first[mine], anchors.last[mine]
            counts = last - first + 1
            at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
            _, down = A.powers(len(sums))
            check = A.mix((sums[at + window] - sums[at]) * down[at] ^ U(0xA5A5A5A5A5A5A5A5))
            yield data, docs, at, A.hashes(sums, at, at + window), (check >> _HIGH).astype(np.uint32)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(read(batches), RUN):
            docs = P.merge([h[1] for h in held])
            numbers = np.concatenate([h[2] + at for h, at in zip(held, _offsets(held), strict=False)])
            keys, checks = (np.concatenate([h[i] for h in held]) for i in (3, 4))
            order = np.lexsort((checks, keys))
            starts = P.groups(keys[order], checks[order])
            sizes = np.diff(np.append(starts, len(order)))
            twice, sent = numbers[order[np.repeat(sizes > 1, sizes)]], order[starts]
            bucket = (keys[sent] % U(parts)).astype(np.int64)
            found = (twice.astype(np.uint32), (twice + 1).astype(np.uint32))
            yield P.parcels(docs, bucket, numbers[sent], [keys[sent], checks[sent]], found, parts)

    return send


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            kept, n_bytes, n_removed, spans = [], [], [], []
            for text, blobs in zip(batch["text"].to_pylist(), batch["places"].to_pylist(), strict=True):
                raw = (text or "").encode()
                stretches = np.frombuffer(b"".join(blobs or []), np.int32).reshape(-1, 2)
                gone = A.within(stretches[:, 0], stretches[:, 1] + window - 1, len(raw)) if len(stretches) else np.zeros(len(raw), bool)
                begins, ends = A.spans(gone) if len(stretches) else ((), ())
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if len(stretches) else raw)
                n_bytes.append(len(raw))
                n_removed.append(int(gone.sum()))
                spans.append([[int(a), int(b)] for a, b in zip(begins, ends, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "kept", "n_bytes", "n_removed", "spans"],
            )

    return cut


def remove_repeats(
    docs: DataFrame, window: int = 400, choice: int = CHOICE, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, kept (bytes), n_bytes, n_removed, spans.

    Every byte goes that lies in a string of ``window`` bytes which begins at another place too, in the same
    document or in another one; strings are judged on the input and never cross documents. ``spans`` are the
    maximal runs removed. A null text counts as empty. Rows that repeat a document repeat its strings. Ids are
    whole numbers or null. Other columns are not carried.
    """
    if not GRAM <= choice + GRAM - 1 <= window:
        raise ValueError("an anchor must lie inside its window")
    stage = Stage(docs.sparkSession)
    parts = P.partitions(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("own_id"), F.col(text_col).alias("text"))
    # a null id is as good as any number here, as the digest of the text stands beside it
    rows = rows.select("own_id", F.coalesce("own_id", F.lit(-1)).alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    some = rows.where(F.octet_length("text") >= window).drop("own_id")
    deal = lambda sent: sent.repartitionById(parts, "bucket")
    keys = some.mapInArrow(_send_keys(window, choice, parts), P.PARCELS)
    hits = stage.put(deal(keys).mapInArrow(_twice((np.uint32,), False), P.ANSWERS), "hits")
    asked = some.join(P.by_document(hits).withColumn("width", F.lit(1)), ["doc_id", "digest"])
    runs = stage.put(deal(asked.mapInArrow(_send_runs(window, choice, crowd, parts), P.PARCELS)).mapInArrow(_merge(window, choice, crowd), P.ANSWERS), "runs")
    again = some.join(P.by_document(runs, P.AGAIN, True).withColumn("width", F.lit(2)), ["doc_id", "digest"])
    crowds = stage.put(
        deal(again.mapInArrow(_send_windows(window, choice, parts), P.PARCELS)).mapInArrow(_twice((np.uint64, np.uint32), True), P.ANSWERS), "crowds"
    )
    found = P.by_document(runs, P.FOUND, True).union(P.by_document(crowds, P.FOUND, True))
    found = found.groupBy("doc_id", "digest").agg(F.collect_list("places").alias("places"))
    judged = rows.join(found, ["doc_id", "digest"], "left").select(F.col("own_id").alias("doc_id"), "text", "places")
    return judged.mapInArrow(_cut(window), "doc_id long, kept binary, n_bytes long, n_removed long, spans array<array<long>>")
