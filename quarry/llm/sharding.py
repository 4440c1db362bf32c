"""Sharding: balanced label propagation under the law that shards differ by at most one row.

Links join documents of the same group (for the registered query: equal texts);
a group stands for the clique of its members, so pairs are never made.  Every
document starts in a shard drawn by a hash.  In each round the members of a group
are counted per shard and its shards ordered, the one that holds most of it
first; its targets are as many from the front as its members need, each with
what it holds and has room for.  A document outside of them, or in the last of
them, wants one with room further in front, drawn in proportion to the room and
no more of it than documents ask, so that the front is filled first.  Requests are
summed per (shard, strength of the gain) in the driver (shards times 64
numbers); a shard admits the strongest ones up to its quota, where the last
class that fits only in part is admitted by a hash of the document.  Rounds end
when fewer than one in a thousand linked documents moves, and after as many
rounds as there are shards at the latest (eight for fewer shards).

Then counts are made exact: every shard has a quota of n/k rows, rounded up for
the first n mod k; documents are numbered inside their shard, linked ones of
large local groups first, and those beyond the quota (unlinked ones, as far as
there are any) are numbered together and dealt to the shards with room.

A group larger than a shard asks for all the shards that it needs at once; no
step holds a group in one place: counts are combined before the shuffle, the
windows are over the at most k counts of a group, and numbering is done in blocks.

Defined results: a null text has size 16 and counts as an empty one; rows
without id and repeated rows are placed like any other; fewer rows than shards
leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import frozen, numbered

#: Rounds at most, where there are fewer shards.
ROUNDS = 8
#: Moves below this share of the linked documents end the rounds.
SETTLED = 0.001


def propagate(rows: DataFrame, shards: int, rounds: int | None = None) -> DataFrame:
    """``(row, group, shard, held)``: a shard for every row, and how many of its group its shard holds.

    ``rows`` (row, group) is frozen; a null group means no links.
    """
    spark = rows.sparkSession
    n = rows.count()
    quota = -(-n // shards)
    # grouped tables are written before they are joined back, so that Spark can split the join at a hot group
    members = frozen(rows.filter("group is not null").groupBy("group").agg(F.count("*").alias("members")).filter("members > 1"), "members")
    linked = rows.join(members, "group", "left")
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    state = frozen(linked.select("row", F.when(F.col("members").isNotNull(), F.col("group")).alias("group"), start.alias("shard")), "start")
    alone, live = state.filter("group is null"), state.filter("group is not null")
    total = live.count()
    for turn in range(rounds or max(ROUNDS, shards)):
        if not total:
            break
        held = frozen(live.groupBy("group", "shard").agg(F.count("*").alias("held")), "held")
        sizes = {r.shard: r.n for r in held.groupBy("shard").agg(F.sum("held").alias("n")).collect()}  # one row per shard
        room = [s for s in range(shards) if sizes.get(s, 0) < quota]
        # a group's shards, the fullest first; ties by a hash of group and shard, so that groups spread and two halves don't swap for ever
        left = F.broadcast(spark.createDataFrame([(s, max(0, quota - sizes.get(s, 0))) for s in range(shards)], "shard int, left long"))
        group = Window.partitionBy("group")
        order = group.orderBy(F.desc("held"), F.desc(F.xxhash64("group", "shard")), "shard").rowsBetween(Window.unboundedPreceding, -1)
        before = lambda c: F.coalesce(F.sum(c).over(order), F.lit(0))
        ranked = frozen(held.join(left, "shard").select("group", "shard", "held", "left", before(F.col("held") + F.col("left")).alias("place"), before("left").alias("lo"), F.sum("held").over(group).alias("members"))
                        .withColumn("target", F.col("place") < F.col("members")).withColumn("last", F.col("target") & (F.col("place") + F.col("held") + F.col("left") >= F.col("members"))), "ranked")
        door = F.struct("lo", "left", "shard", "held")  # one per shard and group at most
        open_ = F.col("target") & (F.col("left") > 0)
        aims = frozen(ranked.groupBy("group").agg(F.collect_list(F.when(open_, door)).alias("doors"), F.sum(F.when(open_, F.col("left"))).alias("room"),
                                                  F.sum(F.when(F.col("target"), F.lit(0)).otherwise(F.col("held"))).alias("outside")).filter("room > 0"), "aims")
        wish = live.join(ranked.select("group", "shard", "held", "target", "last", "lo"), ["group", "shard"]).join(aims, "group", "left")
        # front shards are filled first: by the documents outside, then by those in the last target
        drawn = lambda n: F.pmod(F.xxhash64("row", F.lit("door"), F.lit(turn)), F.greatest(n, F.lit(1)))
        ahead = F.col("outside") + drawn(F.col("held"))
        wish = wish.withColumn("pick", F.when(~F.col("target"), drawn(F.least("room", "outside"))).when(F.col("last") & (ahead < F.col("lo")), ahead))
        wish = wish.withColumn("to", F.get(F.filter("doors", lambda d: (d["lo"] <= F.col("pick")) & (F.col("pick") < d["lo"] + d["left"])), F.lit(0)))
        wish = wish.select("row", "group", "shard", F.col("to.shard").alias("to"), F.floor(F.log2(F.col("to.held") - F.col("held") + 1)).cast("int").alias("class"))
        wish = frozen(wish, "wish")
        asked = {(r.to, r["class"]): r.n for r in wish.filter("class is not null").groupBy("to", "class").agg(F.count("*").alias("n")).collect()}
        admit = []  # (shard, class, share)
        for s in room:
            free = quota - sizes.get(s, 0)
            for c in sorted((c for t, c in asked if t == s), reverse=True):
                admit.append((s, c, min(1.0, free / asked[s, c])))
                free -= min(free, asked[s, c])
                if not free:
                    break
        if not admit:
            break
        doors = F.broadcast(spark.createDataFrame(admit, "to int, class int, share double"))  # shards x 64 rows at most
        draw = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        moved = frozen(wish.join(doors, ["to", "class"], "left")
                       .select("row", "group", F.when(draw < F.col("share"), F.col("to")).otherwise(F.col("shard")).alias("shard"), (draw < F.col("share")).alias("moved")), "moved")
        moves = moved.filter("moved").count()
        live = moved.select("row", "group", "shard")
        if moves < SETTLED * total:
            break
    held = frozen(live.groupBy("group", "shard").agg(F.count("*").alias("held")), "held")
    return frozen(live.join(held, ["group", "shard"]).select("row", "group", "shard", "held")
                  .unionByName(alone.withColumn("held", F.lit(0).cast("long"))), "propagated")


def balanced(placed: DataFrame, shards: int) -> DataFrame:
    """``(row, shard, slot)`` with shard counts at most one apart; as few linked rows as possible leave their shard."""
    spark = placed.sparkSession
    # linked rows first: class 0 of a shard, then the unlinked ones
    keyed = frozen(placed.select("row", "shard", (F.col("shard") * 2 + (F.col("held") <= 1).cast("int")).alias("part")), "keyed")
    n = keyed.count()
    per_part = {r.part: r.n for r in keyed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    sizes = [per_part.get(2 * s, 0) + per_part.get(2 * s + 1, 0) for s in range(shards)]
    bounds = [(2 * s + k, k * per_part.get(2 * s, 0), quota[s]) for s in range(shards) for k in (0, 1)]
    marks = F.broadcast(spark.createDataFrame(bounds, "part int, base long, quota long"))
    inside = (numbered(keyed, "part", ["row"], "rank").join(marks, "part")
              .select("row", "shard", (F.col("rank") + F.col("base")).alias("slot"), "quota"))
    inside = frozen(inside, "slots")
    over = inside.filter(F.col("slot") >= F.col("quota")).select("row", F.lit(0).alias("all"))
    gaps, at = [], 0
    for s in range(shards):
        free = max(0, quota[s] - sizes[s])
        if free:
            gaps.append((at, at + free, s, sizes[s]))
        at += free
    room = F.broadcast(spark.createDataFrame(gaps, "lo long, hi long, shard int, first long"))
    dealt = (numbered(over, "all", ["row"], "rank").join(room, (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
             .select("row", "shard", (F.col("rank") - F.col("lo") + F.col("first")).alias("slot")))
    return inside.filter(F.col("slot") < F.col("quota")).select("row", "shard", "slot").unionByName(dealt)


def shard(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (row, group, ...) with columns shard and slot; row must be unique, rows with a common group are linked."""
    rows = frozen(rows, "to-shard")
    return rows.join(balanced(propagate(rows.select("row", "group"), shards), shards), "row")


def cut_edges(sharded: DataFrame) -> DataFrame:
    """Linked pairs in all, and those whose ends are in different shards."""
    pairs = lambda c: F.col(c) * (F.col(c) - 1) / 2
    per = sharded.filter("group is not null").groupBy("group", "shard").agg(F.count("*").alias("held")).withColumn("inside", pairs("held"))
    return (per.groupBy("group").agg(F.sum("held").alias("members"), F.sum("inside").alias("inside"))
            .agg(F.sum(pairs("members")).alias("edges"), F.sum(pairs("members") - F.col("inside")).alias("cut")))
