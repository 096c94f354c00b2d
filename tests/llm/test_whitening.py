import math
import random

import numpy as np
import pytest

from ledgerline.llm import queries, whitening
from ledgerline.llm.common import read

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, count=32):
    kept = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    deviation = [sum(c * c for c in v) for v in centred]
    cov = np.array([[sum(v[a] * v[b] for v in centred) / n**3 for b in range(len(sums))] for a in range(len(sums))])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    whitened = (np.array(centred, float) / n) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    return [i for i, _ in kept], n, deviation, whitened, values / np.trace(cov)


def check(got, rows, count=32):
    ids, n, deviation, whitened, explained = brute(rows, count)
    width = whitened.shape[1]
    table = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(table) == len(ids) * width
    assert {r.n for r in got} == {n}
    own = np.array([[table[i, k + 1].whitened for k in range(width)] for i in ids])
    for k in range(width):
        assert min(np.abs(own[:, k] - whitened[:, k]).max(), np.abs(own[:, k] + whitened[:, k]).max()) < 1e-6
        assert table[ids[0], k + 1].explained == pytest.approx(explained[k], rel=1e-9)
    assert [table[i, 1].deviation for i in ids] == deviation
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    assert np.abs(own.T @ own / n - np.eye(width)).max() < 1e-9


def test_query_equals_brute_force(spark, sf_small):
    rows = [tuple(r) for r in read(spark, sf_small, "embeddings").collect()]
    check(queries.op12_embedding_whitening(spark, sf_small).collect(), rows)


def test_left_out_vectors_and_few_dimensions(frame):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1), r.gauss(3, 5), r.uniform(-700, 9000)], 0) for i in range(300)]
    rows += [(300, None, None), (301, [1.0, None, 2.0], 1), (302, [1.0, float("nan"), 2.0], 1), (303, [float("inf"), 0.0, 0.0], 1)]
    got = whitening.whiten(frame(rows, SCHEMA)).collect()
    check(got, rows)
    assert max(r.component for r in got) == 3


def test_bit_planes_give_products_of_any_width(frame):
    r = random.Random(9)
    rows = [(i, [r.uniform(-1e9, 1e9), float(r.randint(0, 3)), 7.0], 0) for i in range(500)]
    vectors = whitening.usable(frame(rows, SCHEMA))
    n, sums, low, high = whitening.dimension_figures(vectors)
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v, _ in rows]
    assert n == 500 and sums == [sum(c) for c in zip(*x, strict=True)] and low[2] == high[2]
    assert whitening.cross_products(vectors, low, high) == [
        [sum((v[a] - low[a]) * (v[b] - low[b]) for v in x) for b in range(3)] for a in range(3)]
    got = whitening.whiten(frame(rows, SCHEMA)).collect()
    # one dimension is constant, and beside the widest another vanishes in double precision
    assert {r.component for r in got if r.whitened is not None} == {1}
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert max(deviation.values()) > 2**63
    assert all(r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 2**63 else None) for r in got)


def test_chunks_add_up(spark, sf_small):
    vectors = whitening.usable(read(spark, sf_small, "embeddings"))
    _, _, low, high = whitening.dimension_figures(vectors)
    bits = [(b - a).bit_length() for a, b in zip(low, high, strict=True)]
    x = whitening.quantised(np.array([r.vector for r in vectors.collect()]))
    planes = whitening.Planes(np.array(low), bits)
    for part in np.split(x, [1, 64, 65, 200]):
        planes.add(part)
    sums = sum(planes.sums[k].astype(object) << (whitening.LIMB_BITS * k) for k in range(len(planes.sums)))
    y = (x - np.array(low)).astype(object)
    assert (np.triu(sums) == np.triu(y.T @ y)).all()


def test_other_lengths_repeats_nulls_and_clashing_names(frame, clashing):
    rows = [(1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (None, [5.0, 1.0], None), (3, [2.0, -3.0], 0), (4, [1.0], 0), (5, [], 0)]
    df = clashing(frame(rows, SCHEMA), "vector", "component", "n", "deviation", "whitened", "size", "at", "total", "low", "high")
    got = whitening.whiten(df).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((v, c) for v in ("1", "1", "None", "3") for c in (1, 2))
    assert {r.n for r in got} == {4}


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)]])
def test_nothing_usable(frame, rows):
    assert whitening.whiten(frame(rows, SCHEMA)).collect() == []


def test_equal_vectors_have_no_variance(frame):
    got = whitening.whiten(frame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, None, None)}
