import random

import pytest

from ledgerline.llm import quality_rules as q

WORDS = "amber basin cedar delta ember fjord grove haven inlet jetty".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99999)) for _ in range(n))


def brute(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    inside = set()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= {i, i + 1, i + 2}
    earlier = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), earlier, len(inside))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    rows = [(i, prose(r, r.randint(60, 120)), "x") for i in range(300)]
    rows += [(300 + i, " ".join(w + "%%%" for w in prose(r, 80).split()), "x") for i in range(40)]
    rows += [(400, None, "x"), (401, "", "x"), (402, "a b c a b c\n\na b c\n \na b c", "x"), (403, "é# <b> x\x1cy", "x"),
             (404, "same words here " * 40, "x"), (None, prose(r, 70), "x"), (7, rows[7][1], "x")]
    return rows


def test_counts_equal_brute_force(frame, corpus):
    got = q.document_stats(frame(corpus, "doc_id bigint, text string, kept string")).collect()
    want = sorted((str(i), *brute(t)) for i, t, _ in corpus)
    assert sorted((str(r.doc_id), *r[1:6]) for r in got) == want


def test_odd_documents_go_and_good_ones_stay(frame, corpus):
    docs = frame(corpus, "doc_id bigint, text string, kept string")
    labels = frame([(i, 0 if 300 <= i < 320 else 1) for i in list(range(200)) + list(range(300, 320))], "doc_id bigint, quality int")
    rows = {}
    for r in q.quality_rules(docs, labels).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert all(rows[i][0].kept for i in range(300)) and not any(rows[i][0].kept for i in range(300, 340))
    assert len(rows[7]) == 2 and rows[7][0] == rows[7][1]
    assert [rows[i][0].base_failed for i in (400, 401, 402, 404)] == [True] * 4
    kept = q.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(i) for i, found in rows.items() for r in found if r.kept)


def test_without_labels_only_the_base_rule_counts(frame, corpus):
    docs = frame(corpus, "doc_id bigint, text string, kept string")
    none = frame([], "doc_id bigint, quality int")
    assert all(r.kept != r.base_failed for r in q.quality_rules(docs, none).collect())
    only_good = frame([(i, 1) for i in range(200)] + [(None, 0), (9, None)], "doc_id bigint, quality int")
    assert all(r.kept != r.base_failed for r in q.quality_rules(docs, only_good).collect())


def test_empty_table(frame):
    docs = frame([], "doc_id bigint, text string")
    assert q.quality_rules(docs, frame([], "doc_id bigint, quality int")).count() == 0
    assert q.kept_documents(docs, frame([], "doc_id bigint, quality int")).count() == 0
