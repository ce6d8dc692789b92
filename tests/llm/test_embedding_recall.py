"""Recall of the Hamming tables where vectors share a direction and tables are large."""

import numpy as np
import pytest

from touchline.llm import embedding_dedup as e


def vectors(rng, n, common):
    """Unit vectors of which two have a cosine of ``common`` in the mean."""
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.sqrt(1 - common) * x + np.sqrt(common) * np.eye(64)[0]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("common", [0, 0.5, 0.8])
@pytest.mark.parametrize("rows", [2**10, 2**17, 2**26])
def test_recall_does_not_depend_on_rows(common, rows):
    rng = np.random.default_rng(5)
    index = e.learn(vectors(rng, 4_000, common), 0.95, rows, rounds=10)
    assert index.recall >= 0.99
    x, move = vectors(rng, 3_000, common), rng.standard_normal((3_000, 64))
    move -= np.einsum("ij,ij->i", move, x)[:, None] * x
    move /= np.linalg.norm(move, axis=1, keepdims=True)
    cosine = rng.uniform(0.95, 0.97, (3_000, 1))
    a, b = (e.words_of(v, index) for v in (x, cosine * x + np.sqrt(1 - cosine**2) * move))
    differ = (a ^ b).view("u8")
    mask, met = np.uint64(2**index.width - 1), np.zeros(len(x), bool)
    for t in range(index.tables):
        part = differ[:, t // index.per_word] >> np.uint64(t % index.per_word * index.width) & mask
        met |= np.bitwise_count(part) <= index.radius
    assert met.mean() >= 0.98


def test_links_with_a_common_direction(spark):
    rng = np.random.default_rng(6)
    base = vectors(rng, 1_500, 0.6)
    near = base[:300] + rng.normal(0, 0.03, (300, 64))
    x = np.vstack([base, near])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    found = e.near_duplicates(frame).orderBy("vec_id").toPandas()
    assert (found.n_links <= close.sum(1)).all()
    assert found.n_links.sum() >= 0.98 * close.sum() > 0


def test_few_or_flat_vectors_can_be_coded():
    for sample in (np.ones((1, 1)), np.eye(3)[:1], np.tile([0.6, 0.8], (5, 1)), np.eye(70)[:4]):
        index = e.learn(sample, 0.95, len(sample), rounds=2)
        assert e.words_of(sample, index).shape == (len(sample), len(index.words))
