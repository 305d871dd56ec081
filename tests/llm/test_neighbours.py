import numpy as np
import pytest

from textfeat.llm import neighbours


def ranked(ids, data, query_id, query, k):
    score = (data * query).sum(1)
    return [(int(ids[j]), float(score[j])) for j in np.lexsort((ids, -score)) if ids[j] != query_id][:k]


def test_own_rows_do_not_fill_the_candidates(spark):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((1500, 16))
    query = data[0]
    near = query + 0.01 * rng.standard_normal((1200, 16))  # of the query's id, each another vector
    ids = np.array([*range(1500), *[0] * 1200])
    data = np.vstack([data, near])
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id long, embedding array<double>")
    asked = rows.where("vec_id = 0")
    least = min(map(tuple, data[ids == 0]))
    found = neighbours.search(rows, asked, 20).orderBy("rank").collect()
    assert [r.rank for r in found] == list(range(1, 21))
    wanted = ranked(ids, data, 0, np.array(least), 20)
    assert len({r.vec_id for r in found} & {i for i, _ in wanted}) >= 18


def test_equal_rows_are_one_until_they_are_ranked(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((300, 16))
    ids = np.array([*range(300), *[0] * 2000, *[1] * 7])
    data = np.vstack([base, np.repeat(base[:1], 2000, 0), np.repeat(base[1:2], 7, 0)])
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id long, embedding array<double>")
    found = neighbours.search(rows, rows.where("vec_id IN (0, 1)"), 20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank) for r in found] == [(q, i) for q in (0, 1) for i in range(1, 21)]
    assert [(r.vec_id, r.score) for r in found] == ranked(ids, data, 0, base[0], 20) + ranked(ids, data, 1, base[1], 20)


def test_no_limit_of_candidates_is_exact(spark):
    rng = np.random.default_rng(7)
    data = rng.standard_normal((3000, 16)) * rng.uniform(0.1, 5, (3000, 1))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    for candidates, k in ((None, 20), (1, 5)):
        found = neighbours.search(rows, rows.where("vec_id % 100 = 0"), k, candidates=candidates).orderBy("query_id", "rank").collect()
        assert len(found) == 30 * k
        if candidates is None:
            for q in range(0, 3000, 100):
                assert [r.vec_id for r in found if r.query_id == q] == [i for i, _ in ranked(np.arange(3000), data, q, data[q], k)]


def made(kind: str, n: int) -> np.ndarray:
    rng = np.random.default_rng(8)
    data = rng.standard_normal((n, 64))
    if "clusters" in kind:
        data = rng.standard_normal((20, 64))[rng.integers(0, 20, n)] + 0.5 * data
    if "mixed" in kind:
        data *= np.exp(0.7 * rng.standard_normal((n, 1)))
    return data


@pytest.mark.parametrize("kind", ["even", "mixed", "clusters", "mixed clusters"])
def test_few_rows_of_a_block_are_reranked(kind):
    """Recall and the share reranked in one whole block."""
    n, k = neighbours.BLOCK_ROWS, 20
    data = made(kind, n)
    codes = neighbours.Codes(data[: n // 2], float(np.linalg.norm(data, axis=1).max()))
    block = neighbours.Block(codes, data)
    asked = np.arange(0, n, 200)
    found = reranked = 0
    for i, code in zip(asked, codes.of_queries(data[asked])):
        near = block.candidates(code, neighbours.CANDIDATES, np.arange(n) == i)
        assert len(set(near)) == len(near) >= neighbours.CANDIDATES and i not in near
        score = data @ data[i]
        score[i] = -np.inf
        found += len(np.intersect1d(np.argsort(-score)[:k], near))
        reranked += len(near)
    assert found >= 0.9 * k * len(asked)
    assert reranked < 0.1 * n * len(asked)


@pytest.mark.parametrize("kind", ["even", "mixed"])
def test_every_code_within_the_radius_is_found(kind):
    """Probing by the pigeonhole against the estimates of all codes."""
    data = made(kind, 3000)
    codes = neighbours.Codes(data, float(np.linalg.norm(data, axis=1).max()))
    block, bands = neighbours.Block(codes, data), codes.bands(data)
    bits = np.unpackbits(codes.of_rows(data, bands), axis=1)
    own = np.arange(3000) % 7 == 0
    for code in codes.of_queries(data[:30]):
        distance = (bits != np.unpackbits(code)).sum(1)
        estimate = codes.tops[bands] * np.cos(np.pi / neighbours.BITS * np.arange(neighbours.BITS + 2))[distance]
        for least in (1, 40, 1000, 3000):
            last = np.sort(estimate[~own])[::-1][min(least, (~own).sum()) - 1]
            wanted = np.flatnonzero(~own & (estimate >= last))
            assert sorted(block.candidates(code, least, own)) == wanted.tolist()


def test_columns_of_other_names_and_few_rows(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], 1, 0.5), (2, [0.0, 2.0], 2, 0.5), (3, None, 3, 0.5), (None, [1.0, 1.0], 4, 0.5)], "vec_id long, embedding array<double>, rank int, score double")
    found = neighbours.search(rows, rows, 20).orderBy("query_id").collect()
    assert [tuple(r) for r in found] == [(1, 1, 2, 0.0), (2, 1, 1, 0.0)]
    assert neighbours.search(rows.where("rank = 3"), rows, 20).isEmpty()
    assert neighbours.search(rows, rows.where("rank = 3"), 20).isEmpty()


@pytest.mark.parametrize("partitions", [1, 13, 211])
def test_blocks_meet_chunks_in_any_number_of_partitions(spark, monkeypatch, partitions):
    """Many blocks and chunks, their tasks not merged: every query has its neighbours, as brute force."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 300)
    monkeypatch.setattr(neighbours, "CHUNK_QUERIES", 20)
    data = np.random.default_rng(9).standard_normal((1000, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        found = neighbours.search(rows, rows.where("vec_id % 20 = 0"), 20, candidates=None).orderBy("query_id", "rank").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    wanted = [i for q in range(0, 1000, 20) for i, _ in ranked(np.arange(1000), data, q, data[q], 20)]
    assert [r.vec_id for r in found] == wanted
