"""Expectation maximisation of topics and the topics of a document, over batches of sparse documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Documents that are worked on at a time, few so that their numbers stay near the processor.
ROWS = 256


class Batch(NamedTuple):
    """Entries of documents in a row: document, term, and how often; where each document that has entries begins."""

    document: np.ndarray
    term: np.ndarray
    n: np.ndarray
    starts: np.ndarray


def _list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return sizes, column.flatten().to_numpy(zero_copy_only=False)


def entries(batch: pa.RecordBatch, steps: bool = False) -> Batch:
    """Of rows (indices, n); with ``steps`` each index is what it has more than the one before."""
    sizes, term = _list(batch["indices"])
    document = np.repeat(np.arange(len(sizes)), sizes)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    term = term.astype(np.int64)
    if steps and len(term):
        ends = np.cumsum(term)
        term = ends - np.repeat((ends - term)[starts], sizes[sizes > 0])
    return Batch(document, term, _list(batch["n"])[1].astype(np.float64), starts)


def _steps(b: Batch, column: pa.Array) -> pa.Array:
    term = np.diff(b.term, prepend=0)
    term[b.starts] = b.term[b.starts]
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(term, pa.int32())).cast(column.type)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> U(30)) * U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> U(27)) * U(0x94D049BB133111EB)
    return x ^ x >> U(31)


def drawn(b: Batch, documents: int, k: int, seed: int) -> np.ndarray:
    """Random shares of the topics in every entry; they depend on the document's own terms, not on where it lies."""
    own = np.zeros(documents, U)
    one = _mix(b.term.astype(U) * U(0x9E3779B97F4A7C15) + b.n.view(U))
    own[b.document[b.starts]] = np.add.reduceat(one, b.starts) if len(one) else one
    at = _mix(own[b.document] + U(seed) * U(0xD1342543DE82EF95)) + b.term.astype(U) * U(0x2545F4914F6CDD1D)
    draws = _mix(at[:, None] + np.arange(1, k + 1).astype(U) * U(0x9E3779B97F4A7C15))
    shares = (draws >> U(11)).astype(np.float64) + 1
    return shares / shares.sum(1, keepdims=True)


def step(k: int, terms: int, alpha: float, eta: float, seed: int, model: Callable[[], np.ndarray | None]):
    """A round: the documents with the new weights of their topics, then the terms with what this task adds to theirs.

    ``model`` gives the weights of all terms, or None before the first round, in which the shares are drawn. From then
    on documents have steps from index to index, which take less room.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = model()
        total, added = None if found is None else found.sum(0), np.zeros((terms, k))
        schema = None
        for batch in _pieces(batches):
            b, schema, size = entries(batch, found is not None), batch.schema, len(batch)
            if found is None:
                shares = drawn(b, size, k, seed)
            else:
                weights = _list(batch["weights"])[1].reshape(size, k)
                shares = (found[b.term] + (eta - 1)) * (weights[b.document] + (alpha - 1)) / (total + terms * (eta - 1))
                shares /= shares.sum(1, keepdims=True)
            shares *= b.n[:, None]
            weights = np.zeros((size, k))
            if len(b.starts):
                weights[b.document[b.starts]] = np.add.reduceat(shares, b.starts)
                order = np.argsort(b.term, kind="stable")
                term = b.term[order]
                first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
                added[term[first]] += np.add.reduceat(shares[order], first)
            new = pa.FixedSizeListArray.from_arrays(pa.array(weights.ravel()), k).cast(pa.list_(pa.float64()))
            indices = _steps(b, batch["indices"]) if found is None else batch["indices"]
            none = pa.nulls(size, pa.int32())
            yield pa.RecordBatch.from_arrays([none, batch["id"], indices, batch["n"], new], ["term", "id", "indices", "n", "weights"])
        some = np.flatnonzero(added.any(1))
        for at in range(0, len(some), 1 << 16):
            own = some[at : at + (1 << 16)]
            nulls = [pa.nulls(len(own), schema.field(name).type) for name in ("id", "indices", "n")]
            sums = pa.FixedSizeListArray.from_arrays(pa.array(added[own].ravel()), k).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *nulls, sums], ["term", "id", "indices", "n", "weights"])

    return run


def digamma(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        y = x + 6
        low = sum(1 / (x + i) for i in range(6))
        r = 1 / (y * y)
        return np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132)))) - low


def _expected(x: np.ndarray, axis: int) -> np.ndarray:
    """exp(E[log p]) for Dirichlet parameters along an axis."""
    return np.exp(digamma(x) - digamma(x.sum(axis, keepdims=True)))


def infer(b: Batch, documents: int, beta: np.ndarray, alpha: float, change: float = 1e-3) -> np.ndarray:
    """Topic shares of each document by variational inference, until its weights change by less than ``change``; 0 without terms."""
    k = beta.shape[1]
    shares = np.zeros((documents, k))
    numbers = b.document[b.starts]
    sizes = np.diff(np.append(b.starts, len(b.term)))
    likely, n = np.ascontiguousarray(beta[b.term].T), b.n
    gamma = np.repeat(alpha + np.add.reduceat(n, b.starts)[:, None] / k, k, 1) if len(n) else np.ones((0, k))
    while len(numbers):
        at, starts = np.repeat(np.arange(len(numbers)), sizes), np.cumsum(sizes) - sizes
        theta = _expected(gamma, 1)
        # a row for each topic: sums along rows are many times as fast
        norm = np.einsum("ij,ij->j", likely, theta.T.take(at, 1)) + 1e-100
        new = theta * np.add.reduceat(likely * (n / norm), starts, 1).T + alpha
        ready = np.abs(new - gamma).mean(1) <= change
        shares[numbers[ready]] = new[ready] / new[ready].sum(1, keepdims=True)
        gamma, numbers = new[~ready], numbers[~ready]
        if ready.any():
            going = ~ready[at]
            likely, n, sizes = likely[:, going], n[going], sizes[~ready]
    return shares


def shares_of(alpha: float, model: Callable[[], np.ndarray]):
    """(id, shares) of documents that have gone through a round, given the weights of all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta = _expected(model(), 0)
        for batch in _pieces(batches):
            shares = infer(entries(batch, True), len(batch), beta, alpha)
            own = pa.FixedSizeListArray.from_arrays(pa.array(shares.ravel()), beta.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["id"], own], ["id", "shares"])

    return run
