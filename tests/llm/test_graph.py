import random

from tessera.llm import graph, shared


def jobs_of(spark, name, f):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return f(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_graphs_take_few_jobs(spark):
    rng = random.Random(3)
    ends = [rng.getrandbits(63) - (1 << 62) for _ in range(400)]
    edges = [*zip(ends[:150], ends[1:150]), *((rng.choice(ends[200:]), rng.choice(ends[200:])) for _ in range(150)), (ends[0], ends[0]), (ends[5], None), (ends[1], ends[0])]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    found, jobs = jobs_of(spark, "small graph", lambda: graph.connected_components(df))
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, graph.connected_components(df, few=0).collect()))
    assert {r for n, r in got if n in ends[:150]} == {min(ends[:150])}
    assert jobs <= 6  # rounds of contraction took over 30
    assert graph.connected_components(df.limit(0)).count() == 0


def test_names_are_contracted(spark):
    df = spark.createDataFrame([("b", "c"), ("a", "c"), ("é", "z"), ("d", "d")], "a string, b string")
    assert sorted(map(tuple, graph.connected_components(df).collect())) == [("a", "a"), ("b", "a"), ("c", "a"), ("z", "z"), ("é", "z")]


def test_the_drivers_jvm_is_trimmed(spark):
    called = []
    keep, shared.trim = shared.trim, lambda s: called.append(keep(s))
    try:
        shared.release(spark)
    finally:
        shared.trim = keep
    java = tuple(map(int, spark._jvm.java.lang.System.getProperty("java.version").split(".")[:3]))
    assert called == [java >= (17, 0, 9)]
