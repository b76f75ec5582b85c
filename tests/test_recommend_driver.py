"""What recommend asks of the driver's memory: no tables with a row for each query, no garbage of earlier steps."""

import pytest
import test_recommend as direct

from cooccur import session
from cooccur.plans import recommend as rec


def full_collections(spark):
    found = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in found if "Young" not in b.getName() and "Concurrent" not in b.getName())


@pytest.mark.parametrize("share, most", [(0.0, True), (1.0, False)])
def test_garbage_is_collected_once_it_is_much(spark, monkeypatch, share, most):
    monkeypatch.setattr(session, "GARBAGE_SHARE", share)
    before = full_collections(spark)
    session.collect_garbage(spark)
    assert (full_collections(spark) > before) == most


def test_queries_are_not_sent_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(session, "GARBAGE_SHARE", 0.0)
    before, plans = full_collections(spark), {}

    def noted(name):
        plain = getattr(rec, name)

        def call(*args):
            found = plain(*args)
            plans[name] = found._jdf.queryExecution().executedPlan().toString()
            return found

        monkeypatch.setattr(rec, name, call)

    for name in ("user_history", "similar_items", "exclusions"):
        noted(name)
    direct.test_equals_direct_evaluation(spark, monkeypatch, "plain", 4)
    assert len(plans) == 3
    assert all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for plan in plans.values())
    assert full_collections(spark) - before >= 5
