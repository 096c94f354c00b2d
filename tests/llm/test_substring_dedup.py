import hashlib
import random

import pytest

from ledgerline.llm import substring_dedup as s


def brute(rows):
    first, words = {}, [(t or "").encode().split() for _, t in rows]
    last = 1 << 63
    for (doc, _), ws in zip(rows, words):
        for p in range(len(ws) - 12):
            key = tuple(ws[p:p + 13])
            first[key] = min(first.get(key, last), last if doc is None else doc)
    out = []
    for (doc, _), ws in zip(rows, words):
        gone = [False] * len(ws)
        for p in range(len(ws) - 12):
            if first[tuple(ws[p:p + 13])] < (last if doc is None else doc):
                gone[p:p + 13] = [True] * 13
        kept = [w for w, g in zip(ws, gone) if not g]
        out.append((str(doc), len(ws), len(ws) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in s.remove_repeats(df).collect())


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    few, many = ["a", "b", "c"], [f"w{i}" for i in range(500)]
    passages = [[r.choice(v) for _ in range(60)] for v in (few, few, many, many)]
    rows = []
    for i in range(250):
        words = []
        for _ in range(r.randint(0, 5)):
            if r.random() < 0.6:
                at = r.randint(0, 40)
                words += r.choice(passages)[at:at + r.randint(5, 30)]
            else:
                words += [r.choice(r.choice([few, many])) for _ in range(r.randint(0, 20))]
        rows.append((i, " ".join(words) if r.random() > 0.1 else "x " * r.randint(0, 60)))
    rows += [(300 + i, rows[i * 3][1]) for i in range(40)]
    rows += [(400, None), (401, ""), (402, " ".join(passages[2][:13])), (403, " ".join(passages[2][:12])),
             (404, " ".join(passages[3]) + " tail"), (None, " ".join(passages[2])), (None, " ".join(passages[2])),
             (405, " ".join(r.choice(many) for _ in range(5000)) + " " + " ".join(passages[3])),
             (5, rows[5][1]), (6, " ".join(passages[2]))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_bytes", [3_000, s.BLOCK_BYTES])
def test_equals_brute_force(frame, corpus, monkeypatch, block_bytes):
    monkeypatch.setattr(s, "BLOCK_BYTES", block_bytes)
    docs = frame([(*row, "own") for row in corpus], "doc_id bigint, text string, block string")
    assert found(docs) == brute(corpus)


def test_paths_carry_their_source(frame):
    shared = [f"s{i}" for i in range(40)]
    rows = [(9, " ".join([*["p"] * 3, *shared, "q"])), (4, " ".join(["a", *shared, "b"])), (12, " ".join(shared[5:30]))]
    blocks = [s.Block.of({"bodies": __import__("zstandard").compress(t.encode()),
                          "sizes": __import__("numpy").array([len(t)], dtype="<i8").tobytes()}) for _, t in rows]
    assert [len(b.words) for b in blocks] == [44, 42, 25]
    got = {r.doc_id: r.n_removed for r in s.remove_repeats(frame(rows, "doc_id bigint, text string")).collect()}
    assert got == {4: 0, 9: 40, 12: 25}


def test_no_table_is_left(spark, frame):
    s.remove_repeats(frame([(1, "a b")], "doc_id bigint, text string"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("substring_blocks")]


def test_empty_table(frame):
    assert found(frame([], "doc_id bigint, text string")) == []
