import random
import uuid

import pytest
from pyrelake.llm import common
from pyrelake.llm.common import components


def brute(edges):
    name = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            if name[u] != name[v]:
                name[u] = name[v] = min(name[u], name[v])
                changed = True
    return name


@pytest.mark.parametrize("few", [0, 40, 10**6])
def test_components_whether_few_or_many(spark, monkeypatch, few):
    """Chains, stars and chance edges, either way round and twice, by joins, by broadcasts and by the one after the other."""
    monkeypatch.setattr(common, "FEW", few)
    monkeypatch.setattr(common, "A_TASK", 7)
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 130)] + [(200, k) for k in range(201, 230)] + [(rng.randrange(300, 380), rng.randrange(300, 380)) for _ in range(35)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges if e[0] != e[1]]
    df = spark.createDataFrame([*edges, *edges[:9], (7, 7), (None, 3)], "u long, v long")
    rows = components(df).collect()
    assert {r.node: r.component for r in rows} == brute(edges) and len({r.node for r in rows if r.node != r.component}) == len([r for r in rows if r.node != r.component])
    assert components(df.where("u = v")).collect() == []


def test_few_edges_take_few_tasks(spark):
    """Though a shuffle has 50 partitions: a step over a hundred edges isn't worth fifty tasks for each time it reads them."""
    held = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, group, sc = {k: spark.conf.get(k) for k in held}, uuid.uuid4().hex, spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup(group, "components")
        got = components(spark.createDataFrame([(k, k + 1) for k in range(100)], "u long, v long")).collect()
        stages = {s for job in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(job).stageIds}
        infos = [sc.statusTracker().getStageInfo(s) for s in stages]
        assert {r.component for r in got} == {0} and sum(i.numCompletedTasks for i in infos if i) < 2_000
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
