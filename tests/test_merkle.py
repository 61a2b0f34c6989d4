"""Trees of hashes against plain counts."""

import random
from collections import Counter

import pytest

from talkmill.operators import merkle


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "compare_key string").repartition(4)


def test_roots_and_differences(spark, monkeypatch):
    draw = random.Random(1)
    monkeypatch.setattr(merkle, "LEAF_KEYS", 3)
    base = [f"key {draw.randrange(400)}" for _ in range(600)] + ["hot"] * 300 + [None, ""]
    changed = base[3:] + ["hot", "new key", base[9], ""]
    shuffled = draw.sample(base, len(base))
    trees = [merkle.tree(keys(spark, v), digits=3) for v in (base, shuffled, changed)]
    roots = [t.roots().first().hash for t in trees]
    assert roots[0] == roots[1] != roots[2]
    assert merkle.differing_leaves(trees[0], trees[1]).count() == 0 == merkle.difference(trees[0], trees[1]).count()
    a, b = (Counter(x for x in v if x is not None) for v in (base, changed))
    want = {k: a[k] - b[k] for k in a | b if a[k] != b[k]}
    assert {r.key: r.delta for r in merkle.difference(trees[0], trees[2]).collect()} == want
    leaves = merkle.differing_leaves(trees[0], trees[2]).count()
    assert 0 < leaves <= len(want) < trees[0].leaves.count()
    # Other folders than those of the differing leaves are not read.
    near = merkle.difference(trees[0], trees[2])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    report = {r.direction: (r.keys, r.total, [(s.key, s.delta) for s in r.samples]) for r in merkle.comparison(trees[0], trees[2], 2).collect()}
    for direction, sign in (("missing", 1), ("extra", -1)):
        mine = sorted(((-abs(d), k) for k, d in want.items() if d * sign > 0))
        assert report[direction] == (len(mine), -sum(d for d, _ in mine), [(k, -d) for d, k in mine[:2]])


def test_groups_and_odd_trees(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), ("g", "a"), ("g", "b"), ("h", "b"), ("h", "a")], "session string, compare_key string")
    roots = {r.session: r.hash for r in merkle.tree(rows, by=["session"], digits=1).roots().collect()}
    assert len(roots) == 3 and roots["g"] == roots["h"] != roots[None]
    nothing = merkle.tree(rows.where("false"), digits=2)
    assert nothing.roots().count() == 0
    some = merkle.tree(rows.drop("session"), digits=2)
    assert {(r.key, r.delta) for r in merkle.difference(nothing, some).collect()} == {("a", -4), ("b", -2)}
    other = merkle.tree(rows.where("session = 'g'"), by=["session"], digits=1)
    assert {(r.session, r.key, r.delta) for r in merkle.difference(merkle.tree(rows, by=["session"], digits=1), other).collect()} == {(None, "a", 2), ("h", "a", 1), ("h", "b", 1)}
    with pytest.raises(ValueError):
        merkle.differing_leaves(some, other)
    assert [merkle.digits_for(n) for n in (0, 500, 501, 8000, 8001)] == [0, 0, 1, 1, 2]
    one = merkle.tree(keys(spark, ["x"] * 5), digits=0)
    assert merkle.difference(one, merkle.tree(keys(spark, ["x"] * 4), digits=0)).collect()[0].delta == 1
