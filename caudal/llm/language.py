"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

The weights are learned by follow-the-regularised-leader with an elastic net, so grams that tell nothing have none.
A bounded sample of labelled rows is fitted in shards whose leaders are averaged after each pass; document frequencies
are those of all labelled rows. At last a temperature is fitted on rows that were kept out, so that a score is a
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm.arrays import U
from caudal.llm.stage import Stage

#: Features are grams of one to three characters of a word and the gaps around it, under one of so many numbers.
BITS = 16
DIMS = 1 << BITS
#: Code points taken at a time; documents counted at a time.
WINDOW, DOCUMENTS = 1 << 18, 64
#: Rate, its offset, and the strengths of the two penalties of the regularised leader.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
#: Term frequencies are shares of a document's grams, so they are made larger by this much.
SCALE = 20.0
#: A model holds DIMS numbers a language.
LANGUAGES = 256
GAP, BETWEEN = 2, 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), bool)


def pieces(text: str, size: int) -> Iterator[str]:
    """A text, cut after characters that are no letters where it is long. Only a longer word is cut inside."""
    begin = 0
    while len(text) - begin > size:
        end = begin + size
        while end > begin + size // 2 and text[end - 1].isalpha():
            end -= 1
        end = end if end > begin + size // 2 else begin + size
        yield text[begin:end]
        begin = end
    yield text[begin:]


def gram_windows(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and of the gram, for each gram of all texts; texts come in order."""
    held: list[str] = []
    owners: list[int] = []
    size = 0

    def grams() -> tuple[np.ndarray, np.ndarray]:
        joined = " \0 ".join(["", *(p.lower().replace("\0", " ") for p in held), ""])
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        between = points == 0
        symbols = np.where(_letters()[points], points, np.where(between, BETWEEN, GAP)).astype(np.uint32)
        kept = np.ones(len(symbols), bool)
        kept[1:] = (symbols[1:] != GAP) | (symbols[:-1] != GAP)
        symbols, doc = symbols[kept], np.cumsum(between)[kept] - 1
        letter, inside = symbols > GAP, symbols >= GAP
        h = np.zeros(len(symbols), U)
        found = []
        for k in range(3):
            n = len(symbols) - k
            h = A.mix(h[:n] * U(0x9E3779B97F4A7C15) + symbols[k:])
            ok = inside[:n] & inside[k:]
            ok &= (letter[:n], letter[:n] | letter[k:], letter[1 : 1 + n])[k]
            at = np.flatnonzero(ok)
            found.append((doc[at], (h[at] >> U(64 - BITS)).astype(np.int64)))
        docs, numbers = (np.concatenate(x) for x in zip(*found, strict=True))
        return np.array(owners)[docs], numbers

    for i, text in enumerate(texts):
        for piece in pieces(text or "", WINDOW):
            if size and size + len(piece) > WINDOW:
                yield grams()
                held, owners, size = [], [], 0
            held.append(piece)
            owners.append(i)
            size += len(piece) + 3
    if held:
        yield grams()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, documents = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        texts = batch["text"]
        for a in range(0, len(texts), DOCUMENTS):
            group = texts.slice(a, DOCUMENTS).to_pylist()
            has = np.zeros((len(group), DIMS), bool)
            for doc, gram in gram_windows(group):
                has[doc, gram] = True
            total += np.add.reduce(has, axis=0, dtype=np.uint8)
            documents += len(group)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at).astype(np.int32)), pa.array(np.append(documents, total[at]))], ["gram", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """ln((n + 1) / (df + 1)) + 1 for each gram, over all texts. A task gives a row for each gram it has seen."""
    counted = texts.mapInArrow(_document_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros(DIMS + 1, np.int64)
    totals[counted["gram"]] = counted["n"]  # the number of texts stands last, under -1
    return np.log((totals[-1] + 1) / (totals[:-1] + 1)) + 1


def _features(inverse: np.ndarray):
    """Label, grams and their TF-IDF of each text."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                counts = np.zeros(DIMS, np.int64)
                for _, gram in gram_windows(one["text"].to_pylist()):
                    counts += np.bincount(gram, minlength=DIMS)
                at = np.flatnonzero(counts)
                values = SCALE * counts[at] / max(counts.sum(), 1) * inverse[at]
                yield pa.RecordBatch.from_arrays(
                    [one["lang"], one["shard"], one["place"], pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([values.astype(np.float32).tobytes()], pa.binary())],
                    ["lang", "shard", "place", "grams", "tf_idf"],
                )

    return features


FEATURES = "lang string, shard int, place long, grams binary, tf_idf binary"


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights of the regularised leader: none where the sum of gradients stays within the first penalty."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow(z: np.ndarray, n: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """One pass over rows of (label, grams, values), in order; ``z`` and ``n`` are changed."""
    for label, grams, values in rows:
        w = leader(z[grams], n[grams])
        wrong = softmax(values @ w)
        wrong[label] -= 1
        g = values[:, None] * wrong
        z[grams] += g - (np.sqrt(n[grams] + g * g) - np.sqrt(n[grams])) / ALPHA * w
        n[grams] += g * g


def _rows(batch: pa.RecordBatch, languages: list[str]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    return [
        (languages.index(lang), np.frombuffer(grams, np.uint16), np.frombuffer(values, np.float32))
        for lang, grams, values in zip(batch["lang"].to_pylist(), batch["grams"].to_pylist(), batch["tf_idf"].to_pylist(), strict=True)
    ]


def _shard(languages: list[str], z: np.ndarray, n: np.ndarray):
    """What a shard's rows add to the state, with the number of rows."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_z, own_n, count = z.copy(), n.copy(), 0
        for batch in batches:
            follow(own_z, own_n, _rows(batch, languages))
            count += batch.num_rows
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([(own_z - z).tobytes()], pa.binary()), pa.array([(own_n - n).tobytes()], pa.binary())], ["z", "n"])

    return shard


def _scores(languages: list[str], weights: np.ndarray):
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(label, (values @ weights[grams]).tobytes()) for label, grams, values in _rows(batch, languages)]
            if found:
                labels, blobs = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(blobs, pa.binary())], ["label", "scores"])

    return scores


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores that makes the labels likeliest, between 1/20 and 20, by golden section; 1 without rows.

    One label more than there are is taken to be wrong, so that rows without a mistake don't ask for certainty.
    """
    if not len(labels) or scores.shape[1] < 2:
        return 1.0
    doubt = 1 / (len(labels) + 2)
    wanted = np.full(scores.shape, doubt / (scores.shape[1] - 1))
    wanted[np.arange(len(labels)), labels] = 1 - doubt

    def surprise(x: float) -> float:
        return -float((wanted * np.log(np.maximum(softmax(scores / np.exp(x)), 1e-300))).sum())

    a, b, ratio = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if surprise(c) <= surprise(d) else (c, b)
    return float(np.exp((a + b) / 2))


class Model(NamedTuple):
    languages: list[str]
    #: a row for each gram, a column for each language; inverse frequencies are in it
    weights: np.ndarray
    temperature: float


def fit(labelled: DataFrame, stage: Stage, fit_rows: int, shards: int, passes: int) -> Model:
    """Learn from (doc_id, text, lang)."""
    counts = labelled.groupBy("lang").count().orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = [r["lang"] for r in counts]
    if not languages:
        return Model([], np.zeros((DIMS, 0)), 1.0)
    inverse = inverse_frequencies(labelled.select("text"))
    each = max(1, fit_rows // len(languages))
    # ids are drawn before any text is moved; a row that is there many times counts once
    keys = labelled.select("lang", "doc_id", F.xxhash64("text").alias("digest"))
    ranked = keys.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "digest")))
    ranked = ranked.where(F.col("place") <= each).groupBy("lang", "doc_id", "digest").agg(F.min("place").cast("long").alias("place"))
    drawn = labelled.withColumn("digest", F.xxhash64("text")).join(F.broadcast(ranked), ["lang", "doc_id", "digest"])
    drawn = drawn.dropDuplicates(["lang", "doc_id", "digest"])
    # of every five rows of a language one is kept out for the temperature (shard -1)
    shard = F.when(F.col("place") % 5 == 0, -1).otherwise(F.floor(F.col("place") / 5) % shards).cast("int")
    drawn = drawn.select("lang", shard.alias("shard"), "place", "text")
    sample = stage.put(drawn.repartition(shards).mapInArrow(_features(inverse), FEATURES), "sample")
    z = np.zeros((DIMS, len(languages)))
    n = np.zeros_like(z)
    dealt = sample.where("shard >= 0").repartitionById(shards, "shard").sortWithinPartitions("place", "lang")
    for _ in range(passes):
        parts = dealt.mapInArrow(_shard(languages, z, n), "z binary, n binary").collect()
        for row in parts:
            z = z + np.frombuffer(row["z"]).reshape(z.shape) / len(parts)
            n = n + np.frombuffer(row["n"]).reshape(n.shape) / len(parts)
    weights = leader(z, n)
    kept_out = sample.where("shard < 0").mapInArrow(_scores(languages, weights), "label int, scores binary").collect()
    scores = np.array([np.frombuffer(r["scores"]) for r in kept_out]).reshape(-1, len(languages))
    heat = temperature(scores, np.array([r["label"] for r in kept_out], np.int64))
    return Model(languages, (SCALE * inverse[:, None] * weights).astype(np.float32), heat)


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The likeliest language of each text and its probability; ``und`` and 0 without a letter or a model."""
    names, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores
    sums, grams = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    for doc, gram in gram_windows(texts):
        grams += np.bincount(doc, minlength=len(texts))
        for k in range(len(model.languages)):
            sums[:, k] += np.bincount(doc, model.weights[gram, k], len(texts))
    at = np.flatnonzero(grams)
    p = softmax(sums[at] / grams[at, None] / model.temperature)
    best = p.argmax(axis=1)
    for i, k, score in zip(at.tolist(), best.tolist(), p[np.arange(len(at)), best].tolist(), strict=True):
        names[i], scores[i] = model.languages[k], score
    return names, scores


def _predictions(model: Model):
    def predictions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            names, scores = predict(model, batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"]
            )

    return predictions


def identify_languages(
    docs: DataFrame, fit_rows: int = 8_000, shards: int = 8, passes: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    A document is held out if the CRC-32 of its id, written as text, leaves 2 when divided by 4. Learned from are the
    others with a language: gram frequencies from all of them, weights from the at most ``fit_rows`` that come first
    by a hash of their id, as many of each language. ``lang_pred`` is the likeliest of the languages learned, ``score`` its
    probability (0 to 1) and of equal ones the first in order counts; only the text is looked at.

    A null text, or one without a letter, is ``und`` with score 0, as is every text when there is nothing to learn
    from. Rows with a null id are neither held out nor learned from. A text is whole however long, and taken piece by
    piece. More than LANGUAGES different languages end the job with an error. Other columns are not carried.
    """
    stage = Stage(docs.sparkSession)
    remainder = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    )
    labelled = rows.where("NOT held_out AND doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    model = fit(labelled.select("doc_id", "text", "lang"), stage, fit_rows, shards, passes)
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predictions(model), "doc_id long, held_out boolean, lang_pred string, score double")
