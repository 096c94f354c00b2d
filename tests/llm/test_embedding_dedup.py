import numpy as np
import pytest

from ledgerline.llm import embedding_dedup as e


def brute(rows, threshold=0.95):
    out, good = {}, []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((i, np.array(v, dtype=np.float64) / np.abs(v).max()))
        else:
            out[i] = (0, i, i is not None)
    least = {i: i for i, _ in good}
    links = {i: [j for j, w in good if j != i and len(w) == len(v)
                 and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= threshold] for i, v in good}
    changed = True
    while changed:
        changed = False
        for i, near in links.items():
            m = min([least[i], *(least[j] for j in near)])
            changed |= m < least[i]
            least[i] = m
    return out | {i: (len(links[i]), least[i], least[i] == i) for i, _ in good}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in e.near_duplicates(df).collect()}


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(3)
    rows = []
    for spread in (0.01, 0.15, 0.22, 0.3):
        for _ in range(4):
            centre = r.standard_normal(12)
            rows += [(centre + r.standard_normal(12) * spread).tolist() for _ in range(20)]
    rows += [rows[0]] * 15 + r.standard_normal((150, 12)).tolist()
    rows = [(int(i), v) for i, v in zip(r.permutation(len(rows)), rows)]
    rows += [(9000, None), (9001, []), (9002, [0.0] * 12), (9003, [1.0, None]), (9004, [float("nan")] * 12), (9005, [float("inf")] * 12),
             (None, rows[0][1]), (9006, [1e300] * 12), (9007, [1e-300] * 12), (9008, [1.0, 2.0]), (9009, [2.0, 4.1])]
    return rows


def test_equals_brute_force(frame, vectors):
    df = frame([(i, v, 1, "own") for i, v in vectors], "vec_id bigint, embedding array<double>, label int, node string")
    assert found(df) == brute(vectors)


def test_large_dense_component_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(e, "MEET", 24)
    r = np.random.default_rng(4)
    centre = r.standard_normal(8)
    rows = [(i, (centre + r.standard_normal(8) * s).tolist()) for i, s in enumerate([0.05] * 60 + [0.35] * 80)]
    assert found(frame(rows, "vec_id bigint, embedding array<double>")) == brute(rows)


def test_two_dense_groups_that_touch(frame):
    """Every list is full of the own group; the links to the other group lie beyond them."""
    r = np.random.default_rng(5)
    a = np.zeros(10)
    a[0] = 1
    b = np.array([0.962, np.sqrt(1 - 0.962**2), *[0] * 8])
    rows = [(i, (c + r.standard_normal(10) * 1e-3).tolist()) for i, c in enumerate([a] * 60 + [b] * 60)]
    got = found(frame(rows, "vec_id bigint, embedding array<double>"))
    assert got == brute(rows) and {x[1] for x in got.values()} == {0}


def test_equal_ids_and_empty_table(frame):
    got = e.near_duplicates(frame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01])], "vec_id bigint, embedding array<float>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]
    assert found(frame([], "vec_id bigint, embedding array<float>")) == {}


def test_every_audit_draws_other_nodes_and_gaps_are_not_returned(frame, monkeypatch):
    """Pairs that the trees never find: audits of the same two nodes would pass once these are repaired."""
    monkeypatch.setattr(e, "AUDITED", 2)
    monkeypatch.setattr(e, "MAX_SEARCHES", 3)
    compared = e.compared
    monkeypatch.setattr(e, "compared", lambda rows, pairs: compared(rows, pairs).filter("false"))
    r = np.random.default_rng(6)
    rows = [(2 * i + j, (c + r.standard_normal(16) * 1e-3).tolist()) for i, c in enumerate(r.standard_normal((20, 16))) for j in (0, 1)]
    with pytest.raises(RuntimeError, match="audited"):
        found(frame(rows, "vec_id bigint, embedding array<double>"))


def test_trees_follow_their_depth():
    for count in (100, 51_000, 15_000_000, 10**9):
        apart = 1 - (1 - np.arccos(0.95) / np.pi) ** e.depth(count)
        assert apart ** e.trees_for(count, 0.95) <= 0.01 + 1e-9


def test_one_pair_joins_two_groups_larger_than_a_part(frame, monkeypatch):
    """All lists are full of the own group, and the pair is unlikely to meet where leaves are cut into parts of ``MEET``."""
    monkeypatch.setattr(e, "MEET", 24)
    monkeypatch.setattr(e, "PART", 100, raising=False)
    monkeypatch.setattr(e, "AUDITED", 4)
    r = np.random.default_rng(8)
    at = lambda angle: np.array([np.cos(angle), np.sin(angle), *[0] * 8])
    rows = [(i, (at(a) + r.standard_normal(10) * 1e-3).tolist()) for i, a in enumerate([0] * 1000 + [0.36] * 1000)]
    rows += [(5000, at(0.03).tolist()), (5001, at(0.33).tolist())]
    got = e.near_duplicates(frame(rows, "vec_id bigint, embedding array<double>")).collect()
    x = np.array([v for _, v in rows])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    linked = x @ x.T >= e.THRESHOLD
    assert linked[:1000, 1000:2000].sum() == linked[2000, 1000:2000].sum() == linked[2001, :1000].sum() == 0 and linked[2000, 2001]
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, int(n) - 1, 0) for (i, _), n in zip(rows, linked.sum(axis=1))}
