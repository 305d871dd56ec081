import hashlib

import numpy as np
import pytest

from textfeat.llm import codebooks, queries

SF = "/root/testdata/sf0.001"


def brute(rows, entries=64, rounds=2, parts=16):
    """Codes, errors and codebooks of ``(vec_id, vector)`` by full search."""
    rows = sorted(rows)
    data = np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64)
    cut = data.reshape(len(data), parts, -1)
    books = cut[:entries].transpose(1, 0, 2).copy()
    for last in range(rounds + 1):
        away = ((cut[:, :, None] - books[None]) ** 2).sum(-1)
        codes, errors = away.argmin(2), away.min(2).sum(1)
        if last < rounds:
            for p in range(parts):
                for j in np.unique(codes[:, p]):
                    members = cut[codes[:, p] == j, p]
                    books[p, j] = members.sum(0) // len(members)
    return [i for i, _ in rows], codes, errors, books


def test_op11_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, codes, errors, books = brute([(r.vec_id, r.embedding) for r in table])
    found = {r.vec_id: r for r in queries.op11_codebooks(spark, SF).collect()}
    assert sorted(found) == ids
    assert [found[i].code for i in ids] == [bytes(c.tolist()).hex() for c in codes]
    assert [found[i].error for i in ids] == errors.tolist()
    label = {r.vec_id: r.label for r in table}
    for i in ids:
        assert found[i].label_error == sum(e for k, e in zip(ids, errors.tolist()) if label[k] == label[i])
    digest = hashlib.sha256(",".join(str(x) for x in books.reshape(-1)).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in found.values()} == {digest}


def test_balls_leave_most_distances_out_and_change_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (64, 1, 4))
    data = (centres[rng.integers(0, 64, 5000)] + rng.integers(-900, 900, (5000, 1, 4))).astype(np.int64)
    book = centres.transpose(1, 0, 2) + rng.integers(-200, 200, (1, 64, 4))
    codes, apart = codebooks.Balls.of(book, None).first(data)
    radii = np.zeros((1, 64))
    np.maximum.at(radii[0], codes[:, 0], np.sqrt(apart[:, 0]))
    moved = book + rng.integers(-200, 200, book.shape)
    balls = codebooks.Balls.of(moved, radii + np.sqrt(((moved - book) ** 2).sum(-1)))
    again, near, computed = balls.again(data, codes)
    wanted, distance = codebooks.Balls.of(moved, None).first(data)
    assert (again == wanted).all() and (near == distance).all()
    assert (again != codes).any()
    assert computed < 0.2 * 64 * 5000  # stable cores and rings
    assert sum(map(len, balls.around[0])) < 64 * 63 / 2  # radii leave neighbours out


def test_ties_go_to_the_lower_index():
    book = np.array([[[4, 0], [0, 0], [0, 0], [2, 0]]])
    data = np.array([[[1, 0]], [[3, 0]], [[0, 0]], [[2, 5]]])
    balls = codebooks.Balls.of(book, np.full((1, 4), 9.0))
    for before in range(4):
        codes, apart, _ = balls.again(data, np.full((4, 1), before))
        assert codes[:, 0].tolist() == [1, 0, 1, 3] and apart[:, 0].tolist() == [1, 1, 0, 25]


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    plain = [(i, rng.standard_normal(32).tolist(), i % 3 if i % 5 else None) for i in range(40)]
    odd = [(50, None, 1), (51, [None] * 32, 1), (52, [float("nan")] * 32, 1), (53, [float("inf")] * 32, 1), (54, [1.0], 1), (55, [], 1)]
    again = [(7, plain[7][1], 9)] * 3 + [(None, [0.5] * 32, 2)]
    schema = "vec_id long, embedding array<double>, label long, whole string, code int, apart long"
    rows = spark.createDataFrame([(*r, "x", 1, 2) for r in plain + odd + again], schema)
    found = codebooks.with_label_errors(codebooks.compress(rows, "label", "whole", entries=16).rows).collect()
    assert sorted(r.vec_id for r in found if r.vec_id is not None) == sorted([*range(40), 7, 7, 7])
    # A null id comes last, so it begins no entry here.
    ids, codes, errors, _ = brute([(i if i is not None else 99, v) for i, v, _ in plain + again], entries=16)
    for i, code, error in zip(ids, codes, errors):
        assert {(bytes(r.code), r.error) for r in found if r.vec_id == (None if i == 99 else i)} == {(bytes(code.tolist()), error)}
    sums = {}
    for r in found:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] and r.whole == "x" for r in found)
    assert codebooks.compress(rows.limit(0), "label").rows.count() == 0
    few = codebooks.compress(rows.where("vec_id = 1"), "label")
    assert few.entries.shape == (16, 1, 2) and [r.error for r in few.rows.collect()] == [0]
    with pytest.raises(Exception, match="or larger"):
        codebooks.compress(rows.selectExpr("vec_id", "transform(embedding, x -> 1e9D) AS embedding"))


def test_components_that_do_not_divide_are_filled(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0, -2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    found = codebooks.compress(rows, parts=2, entries=2, rounds=1)
    assert found.entries.shape == (2, 2, 2) and found.entries[1].tolist() == [[-512, 0], [-512, 0]]
    assert len(found.rows.first().code) == 2
