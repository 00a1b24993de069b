"""J4: map join with skip counts and orphans, against brute force."""

import random

from seriesmart.operators import map_join, orphan_counts, orphans, skip_counts
from seriesmart.operators.joins import bounded_broadcast


def _data(spark):
    rnd = random.Random(3)
    facts = [(rnd.randint(0, 40), i) for i in range(500)]
    mapping = [(k, f"a{k % 4}") for k in range(0, 40, 3)]
    return (spark.createDataFrame(facts, "sid int, v int"),
            spark.createDataFrame(mapping, "key int, area string"), facts, dict(mapping))


def test_map_join_and_counts(spark):
    f, m, facts, mp = _data(spark)
    for max_rows in (None, 0):           # broadcast and shuffled
        got = sorted(tuple(r) for r in map_join(f, m, "sid", "key", max_rows=max_rows)
                     .select("sid", "v", "area").collect())
        assert got == sorted((s, v, mp[s]) for s, v in facts if s in mp)
        c = skip_counts(f, m, "sid", "key", max_rows=max_rows).first()
        hit = sum(1 for s, _ in facts if s in mp)
        assert (c["loaded"], c["skipped"]) == (hit, len(facts) - hit)
        assert orphans(f, m, "sid", "key", max_rows=max_rows).count() == len(facts) - hit
        per_key = {r["sid"]: r["n"] for r in orphan_counts(f, m, "sid", "key", max_rows=max_rows).collect()}
        want = {}
        for s, _ in facts:
            if s not in mp:
                want[s] = want.get(s, 0) + 1
        assert per_key == want


def test_duplicate_mapping_keys_do_not_multiply_counts(spark):
    f, m, facts, mp = _data(spark)
    doubled = m.unionByName(m)
    c = skip_counts(f, doubled, "sid", "key").first()
    assert c["loaded"] + c["skipped"] == len(facts)


def test_join_choice(spark):
    # over the broadcast bound but within the hash budget: shuffled hash join hint
    plan = bounded_broadcast(spark.range(100), max_rows=10, rows=100)._jdf.queryExecution().analyzed().toString()
    assert "shuffle_hash" in plan.lower()
    plan = bounded_broadcast(spark.range(100), max_rows=1000, rows=100)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()
    # without a count: no hint
    plan = bounded_broadcast(spark.range(100), max_rows=10)._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan.lower()
