from __future__ import annotations

import numpy as np
import pytest

from clicklens.llm.embeddings import embedding_groups, plan_tables
from tests.llm.test_duplicates import groups_of


def vectors():
    rng = np.random.default_rng(8)
    made = []
    for _ in range(60):
        centre = rng.normal(size=16)
        made += [centre + s * rng.normal(size=16) for s in (0, 0.1, 0.3, 0.5)]
    made += [made[0]] * 30 + [2 * made[4]]
    return [v.astype(np.float32).tolist() for v in made]


@pytest.mark.parametrize("block_rows", [4096, 8])
def test_links_against_all_pairs(spark, block_rows):
    rows = list(enumerate(vectors()))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = embedding_groups(frame, block_rows=block_rows).collect()
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.9
    np.fill_diagonal(near, False)
    links = {r["vec_id"]: r["n_links"] for r in found}
    assert all(links[i] <= near[i].sum() for i in links)
    assert sum(links.values()) >= 0.98 * near.sum()
    if sum(links.values()) == near.sum():
        wanted = groups_of(links, [(a, b) for a, b in np.argwhere(near).tolist() if a < b])
        assert {r["vec_id"]: r["component_id"] for r in found} == wanted
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("bucket_rows, bits", [(512, 10), (0.25, 13)])
def test_recall_just_above_the_threshold(spark, bucket_rows, bits):
    rng = np.random.default_rng(9)
    first, other = rng.normal(size=(2, 1000, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.901, 0.92, size=(1000, 1))
    second = cosine * first + np.sqrt(1 - cosine**2) * other
    rows = list(enumerate(np.concatenate([first, second]).tolist()))
    assert plan_tables(len(rows), 0.9, bucket_rows)[1] == bits
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = embedding_groups(frame, bucket_rows=bucket_rows).filter("not kept").collect()
    assert all(r["vec_id"] - 1000 == r["component_id"] for r in found)
    assert len(found) >= 990


def test_buckets_stay_small_as_the_table_grows():
    assert plan_tables(0, 0.9, 512) == plan_tables(500_000, 0.9, 512) == (28, 10)
    tables, bits = plan_tables(10**9, 0.9, 512)
    same = (1 - np.arccos(0.9) / np.pi) ** bits
    assert 10**9 / 2**bits <= 512 and (1 - same) ** tables <= 0.0013


def test_vectors_without_direction_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 7), (1, [1.0, 2.0], None), (2, None, 1), (3, [], 1),
        (4, [0.0, 0.0], 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1),
        (8, [1.0, None], 1), (9, [1.0, 2.0, 0.0], 1), (None, [5.0, 1.0], 1), (1, [1.0, 2.0], None),
        (11, [1e-30, 2e-30], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n_links int")
    found = embedding_groups(frame).collect()
    assert len(found) == len(rows)
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    assert links[0] == links[1] == (3, 0) and links[11] == (3, 0)
    assert all(links[i] == (0, i) for i in (2, 3, 4, 5, 6, 7, 8, 9))
    assert links[None] == (0, None)
    assert embedding_groups(frame.limit(0)).count() == 0
