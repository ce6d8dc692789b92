"""Distances between vectors, and the nearest of them."""

from __future__ import annotations

import numpy as np
import pandas as pd

# Distances held at once by a task.
MAX_PAIRS = 4_000_000


def matrix(vectors: pd.Series) -> np.ndarray:
    if not len(vectors):
        return np.empty((0, 0))
    return np.stack(vectors.to_numpy()).astype(np.float64)


def estimated_distances(q: np.ndarray, x: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Distances of all pairs by matrix product, and how far they may be off per question."""
    dot = q @ x.T
    qq, xx = (q * q).sum(1), (x * x).sum(1)
    if metric == "cosine":
        norm = np.sqrt(np.outer(qq, xx))
        off = np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0)
        return 1.0 - off, np.full(len(q), 1e-9)
    return qq[:, None] + xx[None, :] - 2.0 * dot, 1e-9 * (1.0 + qq + xx.max())


def exact_distances(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row of ``q`` to the same row of ``x``: squared Euclidean, or one minus cosine."""
    if metric == "cosine":
        norm = np.sqrt((q * q).sum(1) * (x * x).sum(1))
        dot = (q * x).sum(1)
        return 1.0 - np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0)
    return ((q - x) ** 2).sum(1)


class Best:
    """The ``k`` nearest rows seen so far for each question."""

    def __init__(self, questions: pd.DataFrame, qid: list[str], cid: list[str], k: int, metric: str, limit: np.ndarray | None = None):
        self.ids, self.cid, self.qid, self.k, self.metric = questions[qid], cid, qid, k, metric
        self.matrix = matrix(questions["_qv"])
        self.found = pd.DataFrame({c: [] for c in ["_q", "distance", *cid]})
        # Distances above it are of no use to the question.
        self.limit = np.full(len(questions), np.inf) if limit is None else limit.copy()

    def add(self, batch: pd.DataFrame) -> None:
        """Take in corpus rows, a slice at a time so that memory stays bounded."""
        if not len(batch) or not len(self.ids):
            return
        step = max(self.k + 1, MAX_PAIRS // len(self.ids))
        for start in range(0, len(batch), step):
            self._add_slice(batch.iloc[start : start + step])

    def _add_slice(self, batch: pd.DataFrame) -> None:
        rows = matrix(batch["_cv"])
        # A fast estimate rules most pairs out; survivors are measured exactly.
        estimate, slack = estimated_distances(self.matrix, rows, self.metric)
        if rows.shape[0] > self.k:
            kth = np.partition(estimate, self.k - 1, axis=1)[:, self.k - 1]
            limit = np.minimum(self.limit, kth)
        else:
            limit = self.limit
        q, r = np.nonzero(estimate <= (limit + slack)[:, None])
        if not len(q):
            return
        fresh = batch[self.cid].iloc[r].reset_index(drop=True)
        fresh.insert(0, "distance", exact_distances(self.matrix[q], rows[r], self.metric))
        fresh.insert(0, "_q", q)
        pool = pd.concat([self.found, fresh]) if len(self.found) else fresh
        pool = pool.sort_values(["_q", "distance", *self.cid])
        self.found = pool.groupby("_q", sort=False).head(self.k)
        full = self.found.groupby("_q")["distance"].agg(["size", "max"])
        full = full[full["size"] == self.k]
        at = full.index.to_numpy(dtype=np.int64)
        self.limit[at] = np.minimum(self.limit[at], full["max"].to_numpy())

    def rows(self) -> pd.DataFrame:
        asked = self.ids.iloc[self.found["_q"].astype(np.int64)].reset_index(drop=True)
        found = self.found.reset_index(drop=True)
        ids = pd.concat([asked, found[self.cid]], axis=1).astype(object)
        return ids.assign(distance=found["distance"].astype(np.float64))
