import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import periodic_runs, queries
from ledgerline.llm.common import read


def runs_by_definition(words, least_length=6, least_exponent=4):
    """Stretches that keep period q and can't be extended; q is the smallest period of the stretch."""
    known = {}
    codes, out = np.array([known.setdefault(w, len(known)) for w in words], int), {}
    for q in range(1, len(words) // least_exponent + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).tolist()
        for i, j in zip(edges[::2], edges[1::2], strict=True):
            out.setdefault((i, j + q - i), q)  # smaller periods come first
    return sorted((s, length, q) for (s, length), q in out.items() if length >= max(least_length, least_exponent * q))


def collapsed_by_definition(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def texts():
    r = random.Random(11)
    out = [None, "", " \n\t", "a", "a a a a a", "a " * 6, "a b " * 4, "a b c " * 4, "x " + "a b " * 9 + "y " + "a b " * 5, "a b " * 8,
           "ab " * 20 + "ba " * 20, "word " * 5000, " ".join(map(str, range(3000)))]
    for _ in range(300):
        n, k = r.randint(1, 60), r.randint(1, 3)
        out.append(" ".join(r.choice("abc"[:k]) for _ in range(n)))
    for _ in range(150):
        block = " ".join(r.choice("ab") for _ in range(r.randint(1, 9)))
        out.append(" ".join([r.choice("ab") for _ in range(r.randint(0, 9))] + [block] * r.randint(2, 9) + [r.choice("abc") for _ in range(9)]))
    return out


def test_runs_equal_the_definition(frame):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in periodic_runs.collapse(frame(rows, "doc_id bigint, text string")).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        words = split(text)
        runs = runs_by_definition(words)
        assert got[i].n_words == len(words)
        assert [tuple(r) for r in got[i].runs] == runs, text
        assert got[i].collapsed == collapsed_by_definition(words, runs)


def test_squares_of_any_exponent(frame):
    rows = list(enumerate(texts()[13:113]))
    got = periodic_runs.collapse(frame(rows, "doc_id bigint, text string"), least_length=1, least_exponent=2).collect()
    want = {i: runs_by_definition(split(t), 1, 2) for i, t in rows}
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in got} == want


def test_blocks_do_not_change_the_runs(frame, monkeypatch):
    rows = list(enumerate(texts()))
    whole = periodic_runs.block_runs([(t or "").encode().split() for _, t in rows], 6, 4)
    one_by_one = [periodic_runs.block_runs([(t or "").encode().split()], 6, 4) for _, t in rows]
    assert [c.tolist() for c in whole[1:]] == [[v for d in one_by_one for v in d[k].tolist()] for k in (1, 2, 3)]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_equals_brute_force(spark, sf_small):
    docs = {r.doc_id: r.text for r in read(spark, sf_small, "documents").collect()}
    got = queries.op11_periodic_runs(spark, sf_small).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    some = 0
    for r in got:
        words = planted(r.doc_id, split(docs[r.doc_id]))
        runs = runs_by_definition(words)
        some += len(runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_definition(words, runs).encode()).hexdigest()
    assert some > 10


def test_a_third_of_a_long_text_repeats(frame):
    r = random.Random(2)
    words = [f"w{r.randint(0, 50_000)}" for _ in range(100_000)]
    words[40_000:] = [words[40_000 + i % 7_001] for i in range(60_000)]
    [got] = periodic_runs.collapse(frame([(1, " ".join(words))], "doc_id bigint, text string")).collect()
    assert (40_000, 60_000, 7_001) in [tuple(x) for x in got.runs]


@pytest.mark.parametrize("rows", [[], [(None, "a " * 9)], [(3, "a " * 9), (3, "a " * 9)], [(1, None)]])
def test_defined_cases(frame, clashing, rows):
    df = clashing(frame(rows, "doc_id bigint, text string"), "runs", "n_words", "collapsed", "start")
    got = periodic_runs.collapse(df).collect()
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (i, [(0, 9, 1)] if t else [], "a" if t else "") for i, t in rows]
