"""Balanced label propagation: documents move towards the shards of the documents linked to them.

Documents are linked by a group key (equal texts, unless the caller names another column). A
group larger than a shard is first cut into fragments by a hash of its rows. In each round the
rows of a group vote for the shard where most of them live; the fragments of one group ask for it
and the shards after it, or for a shard with room where it has none. A fragment is admitted whole
and settles, as far as the shard's capacity goes. What is not settled after the rounds stays with
most of its rows. Then labels are rounded to exact quotas: a shard keeps the rows of its label,
settled fragments first and unlinked rows last, up to its quota, and the rest fills the shards
that have too few. Counts differ by one at most.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.llm.common import materialize, table, text_or_empty

SHARDS = 40
ROUNDS = 3
#: Settled fragments may fill a shard to so many times its even share in the last round.
SLACK = 1.1
#: Other fragments are admitted to a shard by their hash, in so many steps.
STEPS = 256
#: Fragments of at least a share divided by this are large.
LARGE = 16
#: Bytes counted for each document besides its text.
OVERHEAD = 16


def _open_steps(moves: DataFrame, room: list[float]) -> list[tuple[int, int]]:
    """The (shard, admission step) pairs that fit, in order of steps (at most shards x STEPS sums are read)."""
    wanted = sorted((step, target, n) for target, step, n in moves.groupBy("target", "step").agg(F.sum("n")).collect())
    left, fit = list(room), []
    for step, target, n in wanted:
        if n <= left[target]:
            left[target] -= n
            fit.append((target, step))
    return fit


def propagate(fragments: DataFrame, shards: int, share: int, capacity: float, rounds: int) -> DataFrame:
    """Settle fragments (link, fragment, part, n, held, shard) for some rounds.

    held has the shards and counts of the rows, shard is null until the fragment is settled. Only
    the last round fills a shard beyond its share, up to the capacity.
    """
    spark = fragments.sparkSession
    for k in range(rounds):
        loads = {s: n for s, n in fragments.where("shard IS NOT NULL").groupBy("shard").agg(F.sum("n")).collect()}
        limit = capacity if k + 1 == rounds else min(share, capacity)
        room = [limit - loads.get(s, 0) for s in range(shards)]
        votes = fragments.select("link", "part", F.explode("held").alias("h")).groupBy("link", F.pmod(F.col("h.shard") - F.col("part"), F.lit(shards)).alias("base")).agg(F.sum("h.n").alias("n"))
        base = votes.groupBy("link").agg((-F.max(F.struct("n", (-F.col("base")).alias("first")))["first"]).alias("base"))
        asked = fragments.join(base, "link").withColumn("first", F.pmod(F.col("base") + F.col("part"), F.lit(shards)).cast("int")).drop("base")
        asked = asked.withColumn("large", F.col("n") * LARGE >= share)
        settled = []
        # Large fragments, at most LARGE x shards of them, are placed one by one before the others.
        for fragment, n, target in sorted(asked.where("shard IS NULL AND large").select("fragment", "n", "first").collect(), key=lambda r: (-r[1], r[0])):
            if room[target] < n:
                target = max(range(shards), key=room.__getitem__)
            if room[target] >= n:
                room[target] -= n
                settled.append((fragment, target))
        roomy = sorted(range(shards), key=lambda s: (-room[s], s))[: max(1, shards // 4)]
        second = F.get(F.array(*[F.lit(s) for s in roomy]), F.pmod(F.xxhash64("fragment", F.lit(k)), F.lit(len(roomy))).cast("int"))
        fits = F.get(F.array(*[F.lit(float(x)) for x in room]), F.col("first")) >= F.col("n")
        asked = asked.withColumns({"target": F.when(fits, F.col("first")).otherwise(second), "step": F.pmod(F.xxhash64("fragment", F.lit(k), F.lit("step")), F.lit(STEPS)).cast("int")})
        fit = spark.createDataFrame(_open_steps(asked.where("shard IS NULL AND NOT large"), room), "target int, step int").withColumn("open", F.lit(True))
        placed = spark.createDataFrame(settled, "fragment long, chosen int")
        admitted = asked.join(F.broadcast(fit), ["target", "step"], "left").join(F.broadcast(placed), "fragment", "left")
        admitted = admitted.withColumn("shard", F.coalesce("shard", "chosen", F.when(F.col("open") & ~F.col("large"), F.col("target"))))
        held = F.when(F.col("shard").isNotNull(), F.array(F.struct("shard", "n"))).otherwise(F.col("held"))
        fragments = materialize(admitted.select("link", "fragment", "part", "n", held.alias("held"), "shard"), "shard-fragments")
    return fragments


def shard_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: Column | None = None,
    shards: int = SHARDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Give every row a shard and a slot: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: shard sizes, in rows, are at most one apart. Rows with a null text count as
    empty and are linked with the other empty ones; a null doc_id is a value like any other;
    repeated rows are placed each for itself; an empty table gives an empty result. Other columns
    are neither read nor returned. grown_shard is null, as this law does not provide for growth.
    """
    text = text_or_empty(text_col)
    key = F.md5(text.cast("binary")) if group is None else group
    nodes = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(key).alias("link"),
        ).withColumn("salt", F.xxhash64("doc_id", "text_crc32", "size")),
        "shard-nodes",
    )
    total = nodes.count()
    share = max(1, -(-total // shards))
    # Groups of at least two rows; each is cut into fragments of a shard at most.
    groups = (
        nodes.groupBy("link").agg(F.count("*").alias("rows")).where("rows > 1")
        .select("link", F.ceil(F.col("rows") / F.lit(share)).cast("long").alias("parts"))
    )
    start = F.pmod(F.xxhash64("salt", F.lit("start")), F.lit(shards)).cast("int")
    part = F.pmod(F.xxhash64("salt", F.lit("part")), F.coalesce("parts", F.lit(1)))
    placed = materialize(
        nodes.join(groups, "link", "left").withColumn("part", part)
        .select("doc_id", "size", "text_crc32", "salt", "link", F.col("parts").isNotNull().alias("linked"), "part", F.xxhash64("link", "part").alias("fragment"), start.alias("start")),
        "shard-placed",
    )
    cells = placed.where("linked").groupBy("link", "fragment", "part", F.col("start").alias("shard")).agg(F.count("*").alias("n"))
    fragments = cells.groupBy("link", "fragment", "part").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("held"))  # at most one cell for each shard
    fragments = propagate(materialize(fragments.withColumn("shard", F.lit(None).cast("int")), "shard-fragments"), shards, total // shards, SLACK * share, rounds)
    # What no shard has admitted follows most of its rows and yields to settled fragments.
    most = -F.array_max(F.transform("held", lambda h: F.struct(h["n"], (-h["shard"]).alias("first"))))["first"]
    labels = fragments.select("fragment", F.coalesce("shard", most).cast("int").alias("label"), F.col("shard").isNull().cast("int").alias("loose"), (-F.col("n")).alias("least"))
    labelled = placed.join(labels, "fragment", "left").select(
        "doc_id", "size", "text_crc32", "fragment", "salt", F.coalesce("label", "start").alias("label"), F.coalesce("loose", F.lit(2)).alias("loose"), F.coalesce("least", F.lit(0)).alias("least")
    )
    return _round(labelled, total, shards)


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _round(labelled: DataFrame, total: int, shards: int) -> DataFrame:
    """Give each shard the first rows of its label in the order (loose, least, fragment, salt), up to
    its quota, and fill the others with what is left; quotas are at most one apart."""
    spark = labelled.sparkSession
    order = ["label", "loose", "least", "fragment", "salt", "doc_id"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 1_000_000)
    # Ranges are written before they are counted, so that counts and ranks see the same ranges.
    ranged = materialize(labelled.repartitionByRange(parts, *order[:-1]).withColumn("part", F.spark_partition_id()), "shard-ranges")
    in_part, in_label = Counter(), Counter()
    for part, label, n in ranged.groupBy("part", "label").count().collect():  # ranges follow labels: ranges + shards rows
        in_part[part] += n
        in_label[label] += n
    before, firsts = 0, []
    for part, n in sorted(in_part.items()):
        firsts.append((part, before))
        before += n
    small, more = divmod(total, shards)
    at, over, hole, quotas, holes = 0, 0, 0, [], []
    for s in range(shards):
        quota, n = small + (s < more), in_label[s]
        quotas.append((s, at, quota, over))
        at += n
        over += max(0, n - quota)
        if n < quota:
            holes.append((hole, s, n))
            hole += quota - n
    starts, where, have = (_longs(list(c)) for c in zip(*(holes or [(0, 0, 0)]), strict=True))
    offsets = F.broadcast(spark.createDataFrame(firsts, "part int, before long"))  # one row for each range
    of_label = F.broadcast(spark.createDataFrame(quotas, "label int, at long, quota long, over long"))  # one row for each shard
    rank = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    ranked = ranged.join(offsets, "part").join(of_label, "label").withColumn("place", rank - F.col("at"))
    extra = F.col("over") + F.col("place") - F.col("quota")
    ranked = ranked.withColumn("extra", F.when(F.col("place") >= F.col("quota"), extra)).withColumn("hole", F.size(F.filter(starts, lambda h: h <= F.col("extra"))) - 1)
    stays = F.col("extra").isNull()
    shard = F.when(stays, F.col("label")).otherwise(F.get(where, F.col("hole")))
    slot = F.when(stays, F.col("place")).otherwise(F.get(have, F.col("hole")) + F.col("extra") - F.get(starts, F.col("hole")))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "fragment")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
