from collections import Counter

import pytest

from ledgerline.llm import sharding as s


def brute(shards, slots):
    table = [None] * slots
    walks = {n: iter([(s._number(n, "offset") + k * (s._number(n, "skip") % (slots - 1) + 1)) % slots for k in range(slots)]) for n in shards}
    while None in table:
        for name in sorted(shards):
            place = next((p for p in walks[name] if table[p] is None), None)
            if place is not None:
                table[place] = name
    return table


@pytest.mark.parametrize(("n", "slots"), [(1, 2), (3, 7), (5, 101), (10, 1009)])
def test_table_equals_brute_force(n, slots):
    shards = [f"s{i}" for i in range(n)]
    assert [shards[i] for i in s.lookup_table(shards, slots)] == brute(shards, slots)


def test_shares_are_even_and_few_slots_move():
    before = s.lookup_table(s.SHARDS)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = s.SHARDS[:-1]
    after = s.lookup_table(fewer)
    moved = sum(a != b for a, b in zip(before, after))
    assert moved < 3 * s.SLOTS / len(s.SHARDS)
    assert s.lookup_table(s.SHARDS[::-1])[0] == len(s.SHARDS) - 1 - before[0]


@pytest.mark.parametrize(("shards", "slots"), [((), 7), (("a", "a"), 7), (("a",), 8), (("a", "b", "c"), 2)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        s.lookup_table(shards, slots)


def test_rows_are_placed_by_their_key(spark, frame):
    from pyspark.sql import functions as F

    rows = [(i, "x", "own") for i in range(500)] + [(None, "y", "own"), (3, "z", "own")]
    df = frame(rows, "doc_id bigint, text string, shard string")
    got = s.with_shard(df, "doc_id")
    assert got.columns == ["doc_id", "text", "shard_slot", "shard_no", "shard"] and got.count() == 502
    table = s.lookup_table(s.SHARDS)
    slots = {r[0]: r[1] for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(s.SLOTS))).collect()}
    assert all(r.shard_slot == slots[r.doc_id] and r.shard_no == table[r.shard_slot] and r.shard == s.SHARDS[r.shard_no] for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert s.with_shard(df.limit(0), "doc_id").count() == 0
