"""Documents in shards of equal counts, with equal texts together, by balanced label propagation.

Every document starts in a shard by the hash of its id. Documents with equal texts are linked. A unit is what a group has
in one shard. In every round each unit asks for a shard in which its group has more documents and which has
room (equal numbers: first a shard with room, then by hash); a shard grants the requests in order of the documents that it already has of a group, as far as its room goes. The
rounds end when nothing moves. Documents without links then fill the shards up to their exact sizes.

Members of a group are alike, so the rounds move numbers of documents, and single documents take their places once at the
end. Ranks are counts per hash bucket, added up, and ranks within a bucket, so no shard or group is sorted as a whole.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscope.llm.shared import Held

SHARDS = 24
#: Most rounds of propagation. What has not moved by then stays where it is.
ROUNDS = 40
#: Documents in a hash bucket, about.
BUCKET = 20_000
#: Requests for a shard are ordered by gain in powers of two, and within one by so many hash values.
SLOTS = 64
#: Units in a file of the tables between rounds, at most about.
UNITS = 1_000_000

GROUP = ["text_crc32", "text_hash", "size"]


def _ranked(df: DataFrame, keys: list[str], buckets: int, name: str) -> DataFrame:
    """Adds the rank (from 0) of each row within its keys, in an order by hash bucket and doc_id."""
    df = df.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    counts = df.groupBy(*keys, "bucket").agg(F.count("*").alias("members"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "bucket", F.coalesce(F.sum("members").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy(*keys, "bucket").orderBy("doc_id", "text_hash", "size"))
    ranked = df.withColumn("within", within).join(counts, [*keys, "bucket"])
    return ranked.withColumn(name, F.col("before") + F.col("within") - 1).drop("bucket", "within", "before")


def _round(units: DataFrame, room: dict[int, int]) -> DataFrame:
    """(group, shard, target, moved): the documents of each unit that move, under the room of the shards."""
    free = [shard for shard, places in room.items() if places > 0]
    tie = F.xxhash64(*GROUP, "shard")
    units = units.withColumn("place", F.struct("n", F.col("shard").isin(free).alias("open"), tie.alias("tie"), "shard"))
    group = units.groupBy(*GROUP).agg(F.max(F.when(F.col("place.open"), F.col("place"))).alias("best"))
    asked = units.join(group, GROUP).where("best > place")
    level = F.floor(F.log2("best.n")).cast("int")
    asked = asked.select(
        *GROUP, "shard", "n", F.col("best.shard").alias("target"), level.alias("level"),
        F.pmod(tie, F.lit(SLOTS)).alias("slot"),
        F.struct("n", tie.alias("tie")).alias("rank"),
    )
    # At most shards x levels x slots rows.
    sums = asked.groupBy("target", "level", "slot").agg(F.sum("n").alias("total"), F.max("rank").alias("lead"))
    order = Window.partitionBy("target").orderBy(F.desc("level"), "slot")
    sums = sums.withColumn("before", F.sum("total").over(order) - F.col("total"))
    places = F.create_map(*[F.lit(x) for pair in room.items() for x in pair])
    sums = sums.withColumn("left", F.greatest(F.lit(0), F.least("total", places[F.col("target")] - F.col("before"))))
    granted = asked.join(sums.where("left > 0"), ["target", "level", "slot"])
    # The slot at the end of the room is granted in part: to its largest unit, if that can fill the room, or else half
    # of it to that unit and the same share to every other.
    share = """CASE WHEN left = total THEN n WHEN lead.n >= left THEN if(rank = lead, left, 0L)
        WHEN rank = lead THEN least(n, left - left div 2) ELSE n * (left div 2) div total END"""
    return granted.select(*GROUP, "shard", "target", F.expr(share).alias("moved")).where("moved > 0")


def propagated(held: Held, units: DataFrame, capacity: int) -> DataFrame:
    """Units (group, shard, n) after the last round."""
    files = max(1, -(-units.count() // UNITS))
    for _ in range(ROUNDS):
        load = {row["shard"]: row["n"] for row in units.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = {shard: max(0, capacity - load.get(shard, 0)) for shard in range(SHARDS)}
        moves = held.table(_round(units, room).coalesce(files))
        if not moves.head(1):
            held.drop(moves)
            break
        gone = moves.select(*GROUP, "shard", (-F.col("moved")).alias("n"))
        come = moves.select(*GROUP, F.col("target").alias("shard"), F.col("moved").alias("n"))
        after = units.unionByName(gone).unionByName(come).groupBy(*GROUP, "shard").agg(F.sum("n").alias("n"))
        after = held.table(after.where("n > 0").coalesce(files))
        held.drop(units, moves)
        units = after
    return units


def sharded(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law ('rows'), shard, slot and grown_shard (null).

    The counts of the shards differ by one at most; slots are gapless from 0 in each shard. `docs` needs doc_id and text;
    other columns are ignored. Null texts have size 8 and the checksum of no bytes and are linked with nothing; empty
    texts are linked with each other. Repeated rows are placed each for itself. An empty table gives no rows.
    """
    held = Held(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    base = held.table(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("text_hash"), F.col("text").isNull().alias("lone"),
    ))
    count = base.count()
    buckets = max(1, -(-count // BUCKET))
    capacity = {shard: count // SHARDS + (shard < count % SHARDS) for shard in range(SHARDS)}

    start = F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int").alias("shard")
    parts = base.where("NOT lone").groupBy(*GROUP, start).agg(F.count("*").alias("n"))
    linked = parts.groupBy(*GROUP).agg(F.sum("n").alias("copies")).where("copies > 1").select(*GROUP)
    units = propagated(held, held.table(parts.join(linked, GROUP)), count // SHARDS)

    by_shard = Window.partitionBy(*GROUP).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    quotas = units.withColumn("from", F.coalesce(F.sum("n").over(by_shard), F.lit(0)))
    quotas = quotas.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.struct("from", "shard"))).alias("quotas"))
    members = base.where("NOT lone").join(quotas.select(*GROUP), GROUP, "left_semi")
    members = _ranked(members, GROUP, buckets, "member").join(quotas, GROUP)
    shard = F.element_at(F.filter("quotas", lambda q: q["from"] <= F.col("member")), -1)["shard"]
    members = held.table(_ranked(members.withColumn("shard", shard).drop("quotas", "member"), ["shard"], buckets, "slot"))

    full = F.create_map(*[F.lit(x) for pair in capacity.items() for x in pair])
    inside = members.where(F.col("slot") < full[F.col("shard")])
    used = {row["shard"]: row["count"] for row in inside.groupBy("shard").count().collect()}  # a row per shard
    pool = base.where("lone").unionByName(base.where("NOT lone").join(quotas.select(*GROUP), GROUP, "left_anti"))
    pool = pool.unionByName(members.where(F.col("slot") >= full[F.col("shard")]).drop("shard", "slot"))
    pool = _ranked(pool, [], buckets, "place")
    spans, at = [], 0
    for shard_id in range(SHARDS):
        taken = used.get(shard_id, 0)
        spans.append((at, shard_id, taken))
        at += capacity[shard_id] - taken
    # The last shard whose span begins at or before the place; shards without free places share a beginning with the next.
    target = F.lit(None).cast("struct<start:long,shard:int,taken:long>")
    for (begin, shard_id, taken), end in zip(spans, [*(s[0] for s in spans[1:]), at]):
        span = F.struct(F.lit(begin).cast("long").alias("start"), F.lit(shard_id).alias("shard"), F.lit(taken).cast("long").alias("taken"))
        target = F.when((F.col("place") >= begin) & (F.col("place") < end), span).otherwise(target)
    pool = pool.withColumn("t", target).select(
        "doc_id", "size", "text_crc32", F.col("t.shard").alias("shard"), (F.col("place") - F.col("t.start") + F.col("t.taken")).alias("slot")
    )
    every = inside.select("doc_id", "size", "text_crc32", "shard", "slot").unionByName(pool)
    return every.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
