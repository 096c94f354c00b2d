import random

import numpy as np
import pytest

import xxhash
from ledgerline.llm import simhash as s
from ledgerline.llm.links import components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(x, 42) >> bit & 1 for x in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out if shingles else 0


def reach(fps, bits=3):
    """The least index that links reach from each."""
    least = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= bits and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    rows, words = [], [f"w{i}" for i in range(300)]
    for i in range(25):
        text = [r.choice(words) for _ in range(200)]
        for j in range(4):
            rows.append((i * 4 + j, " ".join(text).upper() if j == 1 else " ".join(text)))
            text = [*text[:50], r.choice(words), *text[51:]]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (3, rows[3][1]), (None, rows[0][1]), (None, "alone")]
    r.shuffle(rows)
    return rows


def test_groups_equal_brute_force(frame, corpus):
    got = sorted((str(x.doc_id), x.fingerprint, str(x.component_id)) for x in s.near_duplicates(
        frame([(*r, "own") for r in corpus], "doc_id bigint, text string, fp string")).collect())
    fps = [brute_fingerprint(t) for _, t in corpus]
    least = reach(fps)
    ids = {root: min((d for (d, _), x in zip(corpus, least) if x == root and d is not None), default=None) for root in least}
    assert got == sorted((str(d), f"{f:016x}", str(ids[root])) for (d, _), f, root in zip(corpus, fps, least))


def test_one_document_of_each_group_stays(frame, corpus, clashing):
    docs = clashing(frame(corpus, "doc_id bigint, text string"), "near_id", "fp", "component", "n")
    kept = s.deduplicated(docs)
    assert kept.columns == docs.columns
    groups = {(x.doc_id, x.component_id) for x in s.near_duplicates(docs).collect()}
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(
        [str(c) for c in {c for _, c in groups if c is not None}] + ["None"])  # the null doc_id that is alone


@pytest.mark.parametrize("shard_rows", [4, 64])
def test_crowded_shards_lose_no_pair(frame, shard_rows):
    r = np.random.default_rng(1)
    centres = r.integers(0, 1 << 63, 6)
    fps = {int(c) ^ sum(1 << int(b) for b in r.choice(63, int(r.integers(0, 6)), replace=False)) for c in centres for _ in range(60)}
    fps |= {int(x) for x in r.integers(0, 1 << 63, 100)}
    fps = sorted(fps)
    least = reach(fps)
    found = components(s.near_links(frame([(x,) for x in fps], "fp bigint"), shard_rows=shard_rows)).collect()
    of = {x.node: x.component for x in found}
    assert [of.get(x, x) for x in fps] == [fps[i] for i in least]


def test_dense_shards_are_not_split_for_nothing_and_large_ones_are_dealt(spark, frame):
    r = np.random.default_rng(3)
    fps = sorted({sum(1 << int(b) for b in r.choice(20, int(r.integers(0, 5)), replace=False)) for _ in range(500)})
    one_shard = frame([(x, 7) for x in fps], "fp bigint, shard bigint")
    dealt = s.dealt_pairs(one_shard, 50)
    sizes = [x["count"] for x in dealt.groupBy("shard").count().collect()]
    assert max(sizes) < 2 * 50 * 1.6 and len(sizes) > 20
    met = dealt.alias("a").join(dealt.alias("b"), "shard").selectExpr("a.fp as x", "b.fp as y").distinct().count()
    assert met == len(fps) ** 2
    found = components(s.near_links(frame([(x,) for x in fps], "fp bigint"), shard_rows=16, task_rows=40)).collect()
    least = reach(fps)
    of = {x.node: x.component for x in found}
    assert [of.get(x, x) for x in fps] == [fps[i] for i in least]


def test_one_large_shard_in_windows():
    r = np.random.default_rng(2)
    fp = r.integers(0, 1 << 16, 700).astype(np.uint64)
    member, root = s._windows(np.unique(fp), 1)
    least = reach([int(x) for x in np.unique(fp)], 1)
    pairs = {tuple(sorted(p)) for p in zip(member.tolist(), root.tolist())}
    label = s._forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), len(least))
    assert label.tolist() == least


def test_long_chain_of_links(frame):
    links = frame([(i, i + 1) for i in range(200)] + [(500, 500), (601, 600)], "a bigint, b bigint")
    got = {x.node: x.component for x in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 600: 600, 601: 600}


def test_empty_table(frame):
    docs = frame([], "doc_id bigint, text string")
    assert s.near_duplicates(docs).count() == 0 and s.deduplicated(docs).count() == 0
