"""Links inside crowded buckets, by leaders.

Of a bucket's members a few leaders are compared with all others; what they
join is one component from then on. Members that aren't in their bucket's
largest component lead in later rounds, more of them each round, until every
member has led or is in that component. So each link that would change a
component is looked at, while a bucket of like members costs a few comparisons
for each of them. No round gathers a bucket in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .shared import discard, materialise, release

#: Leaders of a bucket in the first two rounds, and how many times as many in each later one.
LEADERS, MORE = (8, 64), 1 << 24


def crowd_links(members: DataFrame, links: DataFrame, verify: Callable[[DataFrame], DataFrame], columns: list[str] = (), central: str | None = None, near: str = "true") -> DataFrame:
    """``links`` and those found among ``members``: (a, b), a written table.

    members: ``bucket``, ``id`` and ``columns``, a written table. links: what is
    known already, written too; it is discarded. verify: gets pairs (a, b) and
    returns the linked ones. central: the column that is small for members near
    the middle of their bucket; they lead first. near: SQL over the columns of
    one, and of the other with ``_b`` after their names: what a linked pair
    fulfils in one of its buckets at least.
    """
    own = list(columns)
    led, lanes, turn = None, LEADERS[0], 0
    while True:
        roots = connected_components(links)
        comps = roots.toDF("id", "comp")
        slim = members.select("bucket", "id", *([central] if central else []))
        placed = materialise(slim.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "placed")
        most = placed.groupBy("bucket", "comp").count().groupBy("bucket").agg(F.max(F.struct("count", "comp")).alias("x")).select("bucket", F.col("x.comp").alias("main"))
        waiting = placed.join(most, "bucket").where("comp <> main").drop("main")
        if led is not None:
            waiting = waiting.join(led, ["bucket", "id"], "left_anti")
        lane = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(lanes))
        leaders = waiting.groupBy("bucket", lane.alias("lane")).agg(F.min(F.struct(*([central] if central else []), "id", "comp")).alias("x"), F.count("*").alias("waiting"))
        leaders = materialise(leaders.select("bucket", "waiting", "x.id", "x.comp"), "leaders")
        release(members.sparkSession)
        waits, leads = leaders.agg(F.sum("waiting"), F.count("*")).first()
        if not leads:
            discard(roots, placed, leaders, *([led] if led is not None else []))
            return links
        # buckets without a leader have nothing left to compare; what comparing takes is fetched for the others only
        asked = placed.join(leaders.select("bucket").distinct(), "bucket", "left_semi").select("bucket", "id", "comp")
        others = asked.join(members.select("bucket", "id", *own), ["bucket", "id"]) if own else asked
        one = leaders.select("bucket", "id", "comp").join(members.select("bucket", "id", *own), ["bucket", "id"]) if own else leaders.select("bucket", "id", "comp")
        others = others.select("bucket", F.col("id").alias("b"), F.col("comp").alias("comp_b"), *(F.col(c).alias(f"{c}_b") for c in own))
        pairs = one.withColumnRenamed("id", "a").join(others, "bucket").where("comp <> comp_b").where(near).select("a", "b")
        pairs = materialise(pairs.distinct(), "pairs")
        release(members.sparkSession)
        found = verify(pairs)
        more = materialise(links.select("a", "b").union(found.select("a", "b")), "links")
        new = leaders.select("bucket", "id")
        now = materialise(new if led is None else led.union(new), "led")
        discard(roots, placed, leaders, pairs, links, *([led] if led is not None else []))
        release(members.sparkSession)
        if waits == leads:  # all that were waiting have led
            discard(now)
            return more
        links, led, lanes, turn = more, now, lanes * MORE if turn else LEADERS[1], turn + 1
