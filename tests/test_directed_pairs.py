"""Pairs that lie with their items: as many and the same as by brute force, also for heavy users and items."""

from collections import Counter

import pytest

from cooccur import Indicator
from cooccur.operators import similarity


def _log():
    """Forty users of thirty items; one user did everything, one item was bought by all."""
    rows = {("buy", f"u{u}", f"i{(u * 7 + k * k) % 30:02d}") for u in range(40) for k in range(4)}
    rows |= {("view", f"u{u}", f"i{(u * 3 + k * 5) % 30:02d}") for u in range(45) for k in range(5)}
    rows |= {("buy", "u0", f"i{i:02d}") for i in range(30)} | {("view", "u0", f"i{i:02d}") for i in range(30)}
    return sorted(rows | {("buy", f"u{u}", "i03") for u in range(40)})


@pytest.mark.parametrize(("tile", "most"), [(512, 1_000_000), (4, 1_000_000), (512, 20), (4, 7)])
def test_pairs_equal_brute_force(spark, tile, most):
    log = _log()
    specs = [Indicator("buy"), Indicator("view")]
    found = similarity._numbered(spark.createDataFrame(log, "event string, user string, item string"), specs, 1, tile)
    named = similarity.named(similarity.directed_pairs(found, 2, tile, most), found.names)
    got = named.select("event", "item", "correlator", "k11", "ca", "cb", "llr").collect()
    buyers = {u for e, u, _ in log if e == "buy"}
    log = [r for r in log if r[1] in buyers]
    users = Counter((e, i) for e, _, i in log)
    want = Counter((("buy", "view").index(f), i, j) for e, u, i in log if e == "buy" for f, v, j in log if v == u and (f, j) != (e, i))
    assert {(r[0], r[1], r[2]): tuple(r[3:6]) for r in got} == {
        (f, i, j): (n, users["buy", i], users[("buy", "view")[f], j]) for (f, i, j), n in want.items()}
    assert len(got) == len(want)
    llr = {tuple(r[:3]): r["llr"] for r in got}
    assert all(llr[0, i, j] == llr[0, j, i] for f, i, j in llr if f == 0)


def test_pairs_are_not_shuffled_one_by_one(spark):
    actions = spark.createDataFrame(_log(), "event string, user string, item string")
    top = similarity.indicators(actions, [Indicator("buy"), Indicator("view")], 1)
    plan = top._jdf.queryExecution().executedPlan().toString()
    pairs_dealt = [line for line in plan.split("\n") if "hashpartitioning(event" in line and "correlator" in line]
    assert not pairs_dealt and "_part" in plan
