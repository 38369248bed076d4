"""From buckets to connected groups, without emitting the pairs of a bucket.

``connect`` takes items that share bucket keys and tests which of them link:

1. Star round. In each bucket every member is tested against one leader, the
   smallest id. A bucket of n members costs n tests, however large it is.
2. Rest round. Buckets whose members are still in several components: each
   member outside the leader's component (a "seeker") is tested against all
   members of other components. Seekers are packed into batches bounded in
   bytes and members are streamed past them, so a task holds one batch and
   one member; only links found are emitted, and a pair already connected in
   the task is not tested again. Large buckets are dealt out by salt.

Together every pair that shares a bucket is either tested or already in one
component, so the components are exact for the given buckets.

``components`` finds connected components by alternating large and small
stars (Kiveris et al., 2014), one stored edge table per step.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import drop, free_shuffles, store, with_group

#: members of one bucket that one salt takes, and bytes of one batch of seekers
SALT_ROWS = 4096
BATCH_BYTES = 8 << 20


class Matcher(Protocol):
    """How items compare. Sent to the tasks, so it must pickle."""

    def prepare(self, payload: bytes) -> Any:
        """An item from its stored payload."""

    def stack(self, items: list) -> Any:
        """What ``screen`` needs of a batch of items (arrays)."""

    def screen(self, stacked: Any, item: Any, band: int) -> Iterable[int]:
        """Positions of the items worth an exact test against ``item``,
        without those that share the bucket of a band before ``band``
        (they are tested there)."""

    def link(self, a: Any, b: Any) -> bool:
        """The exact test."""


def _find(parent: dict, x: int) -> int:
    while (p := parent.get(x, x)) != x:
        parent[x] = parent.get(p, p)
        x = p
    return x


def _tested(rows: DataFrame, payload: DataFrame, matcher: Matcher) -> DataFrame:
    """``rows``: batch, salt, role (0 seeker, 1 member), band, id, comp. The
    tests are CPU work, so there are as many tasks as the session's shuffles
    have, however few the bytes."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = (
        rows.join(payload, "id")
        .select("batch", "salt", "role", "id", "comp", "band", "payload")
        .repartition(parts, "batch", "salt")
        .sortWithinPartitions("batch", "salt", "role", "id")
    )

    def run(it):
        at, seekers, stacked, parent = None, [], None, {}
        for batch, salt, role, i, comp, band, data in it:
            if at != (batch, salt):
                at, seekers, stacked, parent = (batch, salt), [], None, {}
            item = matcher.prepare(data)
            if role == 0:
                seekers.append((i, comp, item))
                continue
            if stacked is None:
                stacked = matcher.stack([x[2] for x in seekers])
            for k in matcher.screen(stacked, item, band):
                j, other, seeker = seekers[k]
                a, b = _find(parent, comp), _find(parent, other)
                if a != b and matcher.link(seeker, item):
                    parent[max(a, b)] = min(a, b)
                    yield i, j

    return map_rows(ready, run, "u long, v long")


def connect(members: DataFrame, payload: DataFrame, matcher: Matcher, known: DataFrame | None = None) -> DataFrame:
    """Stored (id, comp) for every item that links with another: comp is the
    smallest id of its component.

    ``members``: stored (key, band, id), distinct, keys with two ids or more.
    ``payload``: stored (id, payload) of those ids.
    ``known``: (id, comp) found before, which the result takes in; ``members``
    then has a column comp (the id itself where there is none), and items of
    one component are not tested.
    """
    own = F.col("id" if known is None else "comp")
    led = store(with_group(members.withColumn("comp", own), "key", [F.min("id").alias("leader"), F.min_by(own, "id").alias("main"), F.count(F.lit(1)).alias("n")]), "led")
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / SALT_ROWS))
    tested = (
        led.filter("id <> leader and comp <> main")
        .groupBy("leader", "main", "id", "comp")
        .agg(F.max("n").alias("n"))
        .select(F.col("leader").alias("batch"), "main", salt.alias("salt"), "id", "comp")
    )
    star = tested.select("batch", "salt", F.lit(1).alias("role"), F.lit(0).alias("band"), "id", "comp").unionByName(
        tested.select("batch", "salt", "main").distinct().select("batch", "salt", F.lit(0).alias("role"), F.lit(0).alias("band"), F.col("batch").alias("id"), F.col("main").alias("comp"))
    )
    stored_led, led = led, led.drop("comp", "main")
    first = store(_tested(star, payload, matcher), "star")
    free_shuffles(members)
    linked = first if known is None else first.unionByName(known.select(F.col("id").alias("u"), F.col("comp").alias("v")))
    comps = components(linked)

    # buckets that still hold several components; two members were fully tested
    more = led.filter("n > 2").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    open_keys = more.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("key")
    unsettled = store(more.join(open_keys, "key", "left_semi"), "open")
    if unsettled.isEmpty():
        drop(stored_led, unsettled, first)
        return comps
    leader_comp = unsettled.filter("id = leader").select("key", F.col("comp").alias("main"))
    sized = payload.select("id", F.length("payload").alias("bytes"))
    seekers = unsettled.join(leader_comp, "key").filter("comp <> main").join(sized, "id")
    per_key = seekers.groupBy("key").agg(F.sum("bytes").alias("bytes")).select("key", F.ceil(F.col("bytes") / BATCH_BYTES).alias("batches"))
    spread = store(unsettled.join(per_key, "key"), "spread")
    n_salts = F.ceil(F.col("n") / SALT_ROWS)
    sought = (
        spread.join(leader_comp, "key")
        .filter("comp <> main")
        .select(
            "key",
            "band",
            "id",
            "comp",
            F.pmod(F.xxhash64("id"), F.col("batches")).alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), n_salts - 1)).alias("salt"),
        )
    )
    offered = spread.filter("id <> leader").select(
        "key",
        "band",
        "id",
        "comp",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1)).alias("part"),
        F.pmod(F.xxhash64("id"), n_salts).alias("salt"),
    )
    both = sought.withColumn("role", F.lit(0)).unionByName(offered.withColumn("role", F.lit(1)))
    both = both.withColumn("batch", F.xxhash64("key", "part"))
    drop(stored_led)
    second = store(_tested(both, payload, matcher), "rest")
    free_shuffles(members)
    if second.isEmpty():
        drop(unsettled, spread, first, second)
        return comps
    # components of the first round act as nodes already joined
    joined = comps.select(F.col("id").alias("u"), F.col("comp").alias("v")).filter("u <> v").unionByName(second)
    out = components(joined)
    drop(unsettled, spread, first, second, comps)
    return out


def shared_buckets(keys: DataFrame) -> DataFrame:
    """The distinct (key, id) rows whose key has two ids or more, from rows
    (key, id) with repeats: one shuffle, one sort, and a pass over the sorted
    rows that holds one batch and the last row before it."""
    dealt = keys.select("key", "id").repartition("key").sortWithinPartitions("key", "id")

    def run(batches):
        last: tuple[int, int, bool] | None = None  # key, id, whether it was given out
        for batch in batches:
            if not batch.num_rows:
                continue
            key, i = (c.to_numpy() for c in batch.columns)
            new = np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1])]
            if last and (key[0], i[0]) == last[:2]:
                new[0] = False
            key, i = key[new], i[new]
            if not len(key):
                continue
            before = np.r_[last is not None and key[0] == last[0], key[1:] == key[:-1]]
            after = np.r_[key[:-1] == key[1:], False]
            out = before | after
            ks, ids = key[out], i[out]
            if before[0] and not last[2]:  # the row before this batch turns out to share its key
                ks, ids = np.r_[np.int64(last[0]), ks], np.r_[np.int64(last[1]), ids]
            last = (int(key[-1]), int(i[-1]), bool(out[-1]))
            if len(ks):
                yield pa.RecordBatch.from_arrays([pa.array(ks), pa.array(ids)], names=["key", "id"])

    return dealt.mapInArrow(run, "key long, id long")


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """Stored (id, comp) of every node of ``edges`` (u, v): comp is the
    smallest id of its connected component. An empty input gives no rows."""
    now = store(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_group(both, "u", [F.min("v").alias("m")], rows=2 * mark[0])
        large = store(
            large.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large"
        )
        small = with_group(large, "u", [F.min("v").alias("m")])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        nxt = store(small.filter("u <> v").distinct(), "edges")
        new = _mark(nxt)
        drop(now, large)
        now, done, mark = nxt, new == mark, new
        if done:
            break
    # at the end every edge points from a node to the smallest of its component
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("comp"))
    out = store(now.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots), "components")
    drop(now)
    return out
