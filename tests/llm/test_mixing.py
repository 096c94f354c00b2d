import random

import pytest

from ledgerline.llm import mixing as m


def water_fill(sizes, weights=m.WEIGHTS, most=m.MAX_EPOCHS):
    """Share by weight, cap, share the excess again until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(7)
    sources = [None, "a", "b", "B", "é", "z", "tiny"]
    rows = []
    for i in range(900):
        source = r.choices(sources, [3, 30, 5, 5, 5, 1, 0])[0]
        rows.append((i, " ".join("w$" if r.random() < 0.1 else "w" for _ in range(r.randint(0, 60))), source))
    rows += [(1000, "only three words", "tiny"), (1001, None, "empty"), (1002, "", "empty"), (None, "x y", "a"), (5, *rows[5][1:]), (1003, "w " * 900, "b")]
    return rows


def test_targets_and_shares(frame, corpus):
    rows = m.mix(frame([(*r, 1, "own") for r in corpus], "doc_id bigint, text string, source string, target int, epochs string").select("doc_id", "text", "source")).collect()
    sizes = {}
    for _, text, source in corpus:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want, taken = water_fill(sizes), dict.fromkeys(sizes, 0)
    largest = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.size * r.copies and r.copies <= 3
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert len(rows) == len(corpus)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1, s
        epochs = {r.copies for r in rows if r.source == s and r.size}
        assert not epochs or max(epochs) - min(epochs) <= 1


def test_reruns_agree_whatever_the_partitions(frame, corpus):
    a = m.mix(frame(corpus, "doc_id bigint, text string, source string", 2)).collect()
    b = m.mix(frame(corpus[::-1], "doc_id bigint, text string, source string", 7)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_better_documents_are_drawn_more_often(frame):
    rows = [(i, "w " * 20 if i % 2 else "w# " * 20, s) for i in range(2000) for s in ("a", "b")]
    got = m.mix(frame(rows, "doc_id bigint, text string, source string")).collect()
    good = sum(r.copies for r in got if r.source == "a" and r.doc_id % 2)
    bad = sum(r.copies for r in got if r.source == "a" and not r.doc_id % 2)
    assert good > 2.5 * bad > 0  # a third of all words: two thirds of source a


def test_documents_of_the_mix(frame, corpus, clashing):
    docs = clashing(frame(corpus, "doc_id bigint, text string, source string"), "target", "epochs", "rest", "last", "mix_size", "copies", "copy")
    plan = {}
    for r in m.mix(docs).collect():
        plan[r.doc_id, r.source] = plan.get((r.doc_id, r.source), 0) + r.copies
    mixed = m.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = {}
    for r in mixed.collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + 1
    assert got == {k: n for k, n in plan.items() if n}


def test_empty_table(frame):
    none = frame([], "doc_id bigint, text string, source string")
    assert m.mix(none).count() == 0 and m.mixed_documents(none).count() == 0
    assert [r.taken for r in m.mix(frame([(1, None, None)], "doc_id bigint, text string, source string")).collect()] == [0]
