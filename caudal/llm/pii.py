"""Personal data in texts by weak supervision.

Fixed patterns give the base spans, which always stay. Looser patterns give candidates. Labelers of three
kinds (regular expressions, gazetteers, words around) vote on base and candidate spans; expectation
maximisation over all votes of the corpus estimates how far each labeler can be trusted, and a logistic
regression trained on the resulting probabilities decides which candidates are added.

Votes and features are small whole numbers, so the corpus reaches the driver as one count per combination
of them: a table whose size is bounded by the number of combinations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.arrays import chunks
from caudal.llm.stage import Stage

KINDS = ("email", "ip", "card", "phone")

# base patterns, as specified; possessive and anchored where that changes nothing but the time on long runs
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

# looser patterns
_SPELT_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}| at ) ?"
    r"[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z0-9-]{1,63}){1,8}"
)
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-][0-9]{3,4}[\x20./-][0-9]{4}(?![0-9]|[.-][0-9])")
_CUT_CARD = re.compile(r"(?<![0-9.])[0-9]{4}(?:[.\x20-][0-9]{4}){3}(?![0-9])")
_PORT_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])")

# gazetteers
_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu ch at it nl be co us ca".split())
_CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "61", "81", "86", "91")
_ISSUERS = ("34", "35", "36", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
_PRIVATE = ("10.", "127.", "172.", "192.168.")

# words around
_HINTS = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|login|adresse)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|credit|karte|carte|tarjeta|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telefon|call|mobile|fax|teléfono|téléphone)\b"),
}
_AGAINST = re.compile(r"(?i)\b(?:version|isbn|order|invoice|id|no|nr|page|section|license|date)\b")
AROUND = 30


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    votes: int  # base 3, one digit a labeler: 0 abstains, 1 for, 2 against
    features: int


LABELERS = 4
FEATURES = 8


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    found = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return found


def _loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    if "at)" in text or "at]" in text or "at}" in text or " at " in text and "dot" in text:
        for m in _SPELT_EMAIL.finditer(text):
            if " at " not in m.group() or "dot" in m.group():
                yield 0, *m.span()
    if _DIGIT.search(text):
        for kind, pattern in ((1, _PORT_IP), (2, _CUT_CARD), (3, _LOCAL_PHONE)):
            for m in pattern.finditer(text):
                yield kind, *m.span()


def _describe(text: str, kind: int, start: int, end: int, base: bool) -> Candidate:
    body, name = text[start:end], KINDS[kind]
    around = text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND]
    digits = _NOT_DIGIT.sub("", body)
    if kind == 0:
        well, known = base, re.split(r"[^A-Za-z]+", body.lower())[-1] in _ENDINGS
    elif kind == 1:
        well, known = all(map(_small, re.findall("[0-9]+", body))), not body.startswith(_PRIVATE)
    elif kind == 2:
        well, known = 13 <= len(digits) <= 19 and _luhn(digits), digits.startswith(_ISSUERS)
    else:
        well, known = base or body.startswith("("), digits.startswith(_CALLING) if base else len(digits) == 10
    hint, against = bool(_HINTS[name].search(around)), bool(_AGAINST.search(around))
    votes = 0
    for vote in (1 if well else 2, 1 if known else 2, 1 if hint else 0, 2 if against else 0):
        votes = votes * 3 + vote
    alone = (start == 0 or text[start - 1].isspace()) and (end == len(text) or text[end].isspace() or text[end] in ".,;")
    flags = (well, known, hint, against, alone, base, len(body) > 16, not set(body).isdisjoint(" ()[]-"))
    return Candidate(kind, start, end, base, votes, sum(f << i for i, f in enumerate(flags)))


def find_spans(text: str) -> list[Candidate]:
    """Base spans and, where no base span is, candidates; in order of kind and start."""
    base = base_spans(text)
    found = [_describe(text, *span, True) for span in base]
    taken = sorted((s, e) for _, s, e in base)
    for kind, start, end in _loose_spans(text):
        if not any(s < end and start < e for s, e in taken):
            found.append(_describe(text, kind, start, end, False))
            taken.append((start, end))
    return sorted(found, key=lambda c: (c.kind, c.start))


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Two-class model of independent labelers by expectation maximisation.

    votes: a row per pattern, 0 abstains, 1 for, 2 against. Gives each pattern's probability of being
    personal data, and for each labeler how it votes on either class. Starts from the majority.
    """
    truth = np.clip(0.5 + 0.4 * np.sign((votes == 1).sum(1) - (votes == 2).sum(1)), 0.1, 0.9)
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        for c, weight in enumerate((counts * (1 - truth), counts * truth)):
            for v in range(3):
                table[c, :, v] = ((votes == v) * weight[:, None]).sum(0) + 1
            table[c] /= table[c].sum(1, keepdims=True)
        prior = (counts @ truth + 1) / (counts.sum() + 2)
        score = np.log(prior / (1 - prior)) * np.ones(len(votes))
        for j in range(votes.shape[1]):
            score += np.log(table[1, j, votes[:, j]] / table[0, j, votes[:, j]])
        truth = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return truth, table


def logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the constant last, by Newton steps; y are probabilities."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - y)) + penalty * w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def train(patterns: list[tuple[int, int, int, int]]) -> dict[int, np.ndarray]:
    """Classifier weights per kind from (kind, votes, features, count) of the whole corpus."""
    models = {}
    for kind in range(len(KINDS)):
        own = np.array([p[1:] for p in sorted(patterns) if p[0] == kind], np.int64).reshape(-1, 3)
        if len(own):
            votes = np.stack([own[:, 0] // 3**j % 3 for j in reversed(range(LABELERS))], 1)
            truth, _ = reliabilities(votes, own[:, 2].astype(float))
            models[kind] = logistic(_bits(own[:, 1]), truth, own[:, 2].astype(float))
    return models


def _bits(features: np.ndarray) -> np.ndarray:
    return (features[:, None] >> np.arange(FEATURES) & 1).astype(float)


_SPAN = "array<struct<kind:int,start:int,end:int,base:boolean,votes:int,features:int>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest are of base spans; ``spans`` holds all, as kind:start:end joined by commas.
    A null text counts as empty. Repeated rows are judged alike. Other columns are not carried. A corpus
    without candidates adds none.
    """
    stage = Stage(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        element = pa.struct(
            [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("features", pa.int32())]
        )
        for batch in chunks(batches, "text"):
            found = [[c._asdict() for c in find_spans(t)] if t else [] for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, pa.list_(element))], ["id", "found"])

    found = stage.put(rows.mapInArrow(search, f"id {kind}, found {_SPAN}"), "found")
    combinations = (
        found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count("*").alias("n"))
    )
    models = train([tuple(r) for r in combinations.collect()])  # at most 4 x 3^4 x 2^8 rows

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, added = [], [], [], []
            for row in batch["found"].to_pylist():
                base = [(c["kind"], c["start"], c["end"]) for c in row if c["base"]]
                new = [
                    (c["kind"], c["start"], c["end"])
                    for c in row
                    if not c["base"] and (np.append(_bits(np.array([c["features"]])), 1.0) @ models[c["kind"]]) > 0
                ]
                counts.append([sum(k == i for k, _, _ in base) for i in range(len(KINDS))])
                digests.append(hashlib.sha256(_digest(base).encode()).hexdigest())
                spans.append(_digest(sorted(base + new)))
                added.append(len(new))
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *[pa.array(c) for c in columns], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.mapInArrow(decide, f"id {kind}, {counts}, base_sha256 string, spans string, n_added long").withColumnRenamed("id", id_col)
