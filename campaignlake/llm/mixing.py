"""Mixing sources to target weights with a low-discrepancy schedule.

Slot i of the mix falls on the point frac(i * golden ratio); the sources'
blocks, laid end to end over the points in their order, map it to a source.  A
source with words to take has one block or more: its target is cut into equally
long ones (to a word), about as long as those of the others, so that its slots
hold its target whole.  A source's documents are shuffled by a hash and laid end
to end; the r-th slot of a source takes its r-th block (the second round of a
source follows the first).  Any stretch of the schedule therefore holds the
sources in their target shares.

Only DataFrame functions are used.  Ranks and running sums are two-level
(bucket sums, then inside a bucket), so that a source with a third of all rows
is not one task.

Defined cases: null text has size 0 and is never taken; a null source is a
source of its own, last in order; repeated rows count one by one; an empty
table gives an empty mix; if no text has a word nothing is taken; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, written

WEIGHTS = (5.0, 2.0, 1.0)  # by source in code-point order, repeating
SHARE = 1.5                # of all words
MOST = 2                   # times a document may be taken
SLOTS_PER_SOURCE = 2000    # mean number of blocks that a source gets
MOST_BLOCK = 4096          # words
MOST_ROUTES = 1_000_000     # rows of a broadcast table of stretches (about 60 bytes each); beyond, a join on its keys
GOLDEN = 0.6180339887498949
SEED = 17


def word_count(text: Column) -> Column:
    """Runs of anything but blank and the control characters 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source of ``sized`` (source, size): source_size, target.

    Targets share ``share`` of all words by weight and stop at ``most`` times
    the source's words, the excess shared again by weight.  With sources in
    order of cap/weight, those before the first one whose cap exceeds the level
    (rest / weight of the rest) are capped.  The windows run over one row per
    source."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(place) - 1) % len(weights)
    rows = rows.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * most)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * share
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    rows = rows.withColumn("open", F.col("cap") / F.col("w") > F.col("level"))
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.select("source", "source_size", "w",
                       F.when(F.col("cap") / F.col("w") >= F.coalesce(level, F.lit(float("inf"))), level * F.col("w"))
                       .otherwise(F.col("cap")).alias("target"))


def _running(df: DataFrame, key: str, bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same key before
    this one, by (bucket, order).  Bucket sums first, then inside a bucket."""
    df = df.withColumn("_v", value)
    sums = df.groupBy(key, bucket).agg(F.sum("_v").alias("_s"))
    ahead = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("_k"), F.col(bucket).alias("_b"),
                       F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return (df.join(sums, (F.col(key) == F.col("_k")) & (F.col(bucket) == F.col("_b")))
            .withColumn(name, F.col("_before") + F.col("_in")).drop("_v", "_k", "_b", "_before", "_in"))


def block_count(words: Column, block: int) -> Column:
    """Blocks of about ``block`` words (1 or more) that ``words`` are cut into."""
    return F.when(words > 0, F.greatest(F.lit(1), F.round(words / block))).otherwise(0).cast("long")


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """(slot, source_no, rank): which block of which source each slot takes.
    ``targets`` needs source_no and target; there is a slot for every block."""
    spark = targets.sparkSession
    counts = targets.select("source_no", block_count(F.round("target"), block).alias("n")).where("n > 0")
    slots = counts.agg(F.sum("n")).first()[0] or 0
    width = max(1, round(slots ** 0.5))
    out = (spark.range(slots).withColumnRenamed("id", "slot")
           .withColumn("u", (F.col("slot") * F.lit(GOLDEN)) % 1.0)
           .withColumn("all", F.lit(0)).withColumn("bucket", F.floor(F.col("u") * width)))
    out = _running(out, "all", "bucket", ["u", "slot"], F.lit(1).cast("long"), "place")
    # the sources' stretches of places, once for each stretch of ``width`` places that they touch
    upto = F.sum("n").over(Window.orderBy("source_no"))
    cuts = counts.select("source_no", (upto - F.col("n")).alias("from"), upto.alias("upto")).withColumn(
        "stretch", F.explode(F.sequence(F.floor(F.col("from") / width), F.floor((F.col("upto") - 1) / width))))
    out = (out.select("slot", F.floor(F.col("slot") / width).alias("bucket"), "place",
                      F.floor(F.col("place") / width).alias("stretch")).join(cuts, "stretch")
           .where((F.col("place") >= F.col("from")) & (F.col("place") < F.col("upto")))
           .select("slot", "bucket", "source_no"))
    return _running(out, "source_no", "bucket", ["slot"], F.lit(1).cast("long"), "rank").select("slot", "source_no", "rank")


def _buckets(n_docs: int) -> int:
    return max(1, round(n_docs ** 0.5))


def _order(doc_id: str, text_hash: str) -> Column:
    """A source's documents are shuffled by ``_bucket`` of this, then by itself."""
    return F.xxhash64(F.lit(SEED), doc_id, text_hash)


def _bucket(order: Column, buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(order, 20), F.lit(buckets))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Documents with what the mix takes of them: doc_id, source, text_hash,
    size, source_size, target, first (position in the shuffled source), taken
    and ``pieces``: array of (slot, round, lo, hi), word offsets of the
    document in schedule order."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        F.xxhash64(F.col("text")).alias("text_hash"))
    sized = written(sized, "sized")
    targets = source_targets(sized, weights, share, most)
    targets = written(targets.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")), "targets")
    n_docs = sized.count()
    n_sources, total = targets.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    block = int(min(MOST_BLOCK, max(1, total // (max(1, n_sources) * SLOTS_PER_SOURCE))))
    slots = schedule(targets, block)
    buckets = _buckets(n_docs)
    # ``words`` to take in ``n`` blocks: the first ``longer`` hold a word more than ``short``
    t = targets.withColumn("words", F.least(F.round("target"), F.col("source_size") * most).cast("long"))
    t = t.withColumn("n", block_count(F.col("words"), block)).select(
        F.col("source").alias("_source"), "source_no", "source_size", "target", "n",
        F.expr("words div greatest(n, 1)").alias("short"), (F.col("words") % F.greatest("n", F.lit(1))).alias("longer"))
    rows = sized.join(t, sized["source"].eqNullSafe(t["_source"])).drop("_source")
    rows = rows.withColumn("order", _order("doc_id", "text_hash"))
    rows = rows.withColumn("bucket", _bucket(F.col("order"), buckets))
    rows = _running(rows, "source_no", "bucket", ["order", "doc_id", "size"], F.col("size"), "first")
    # every document's stretch of each round, cut at the block edges
    rows = rows.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    begin = F.col("round") * F.col("source_size") + F.col("first")
    def block_of(word: str) -> Column:  # n beyond the last one
        return F.least("n", F.expr(f"CASE WHEN {word} < longer * (short + 1) THEN {word} div (short + 1) "
                                   f"ELSE longer + ({word} - longer * (short + 1)) div greatest(short, 1) END"))

    rows = rows.withColumn("begin", begin.cast("long")).withColumn("block", F.explode(F.sequence(
        block_of("begin"), block_of("(begin + greatest(size, 1) - 1)"))))
    edge = F.col("block") * F.col("short") + F.least("block", "longer")
    after = edge + F.col("short") + F.when(F.col("block") < F.col("longer"), 1).otherwise(0)
    rows = (rows.join(slots.withColumnRenamed("rank", "block"), ["source_no", "block"], "left")
            .withColumn("lo", F.greatest(F.lit(0), edge - F.col("begin")))
            .withColumn("hi", F.least(F.col("size"), after - F.col("begin"))))
    used = F.col("slot").isNotNull() & (F.col("hi") > F.col("lo"))
    return (rows.groupBy("doc_id", "source", "text_hash", "size", "source_size", "target", "first")
            .agg(F.sum(F.when(used, F.col("hi") - F.col("lo")).otherwise(0)).alias("taken"),
                 F.count(F.when((F.col("round") == 0) & (F.col("lo") == 0), 1)).alias("rows"),
                 F.array_sort(F.collect_list(F.when(used, F.struct("slot", "round", "lo", "hi")))).alias("pieces"))
            .withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).drop("_", "rows"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix as rows of ``docs``, in schedule order: a document stands once
    for every round of which the mix takes half its words or more, whole.
    Partitions hold equal stretches of the slots, in order.  Rows of the same
    id, source and text are one document here.

    A source's slots ascend with its shuffled documents, so a partition takes
    one stretch of them in each round.  The ends of these stretches (one row
    per source, cell of the shuffled order and partition) tell every text where
    it goes: texts move once, to the partitions that take them, and meet their
    slots there.  Rows that are repeated are told apart by their keys first,
    and one of them is sent."""
    spark, key = docs.sparkSession, ["doc_id", "source", "text_hash"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = _buckets(docs.count())
    cells = min(parts, buckets)

    def placed(df: DataFrame) -> DataFrame:
        """Adds source (never null), cell and place of ``__mix_key``; the place
        ascends with the shuffled order, ties only send a text too often."""
        df = df.withColumn("__mix_order", _order("__mix_key.doc_id", "__mix_key.text_hash"))
        df = df.withColumn("__mix_bucket", _bucket(F.col("__mix_order"), buckets))
        return df.select("*", F.struct("__mix_key.source").alias("__mix_source"),
                         F.floor(F.col("__mix_bucket") * cells / buckets).alias("__mix_cell"),
                         (F.col("__mix_bucket") * F.lit(2 ** 32) + F.shiftright("__mix_order", 32)).alias("__mix_place")
                         ).drop("__mix_order", "__mix_bucket")

    taken = (mix(docs, weights, share, most).select(*key, "first", "size", F.explode("pieces").alias("p"))
             .groupBy(*key, "first", "size", F.col("p.round").alias("round"))
             .agg(F.sum(F.col("p.hi") - F.col("p.lo")).alias("n"), F.min("p.slot").alias("slot"))
             .where(F.col("n") * 2 >= F.col("size"))
             .select(F.struct(*key).alias("__mix_key"), "round", F.col("slot").alias("__mix_slot")))
    taken = written(taken, "taken")
    repeated = written(taken.groupBy("__mix_key", "round").count().where("count > 1").select("__mix_key").distinct(),
                       "repeated")
    slots = (taken.agg(F.max("__mix_slot")).first()[0] or 0) + 1
    taken = taken.withColumn("__mix_part", F.floor(F.col("__mix_slot") * parts / slots).cast("int"))
    taken = taken.drop("round")
    texts = docs.withColumn("__mix_key", F.struct("doc_id", "source", F.xxhash64("text").alias("text_hash")))
    many = None
    if not repeated.isEmpty():  # the same row several times: one of them meets all the slots
        known = bounded_broadcast(repeated, MOST_ROUTES)
        many = (texts.join(known, "__mix_key", "left_semi").dropDuplicates(["__mix_key"])
                .join(taken, "__mix_key").select("__mix_part", "__mix_key", "__mix_slot", F.struct(*docs.columns).alias("__mix_row")))
        texts, taken = texts.join(known, "__mix_key", "left_anti"), taken.join(known, "__mix_key", "left_anti")
    routes = written(placed(taken).groupBy("__mix_source", "__mix_cell", "__mix_part").agg(
        F.min("__mix_place").alias("__mix_from"), F.max("__mix_place").alias("__mix_upto")), "routes")
    sent = (placed(texts).join(bounded_broadcast(routes, MOST_ROUTES), ["__mix_source", "__mix_cell"])
            .where(F.col("__mix_place").between(F.col("__mix_from"), F.col("__mix_upto")))
            .select("__mix_part", "__mix_key", F.struct(*docs.columns).alias("__mix_row")))
    met = sent.unionByName(taken, allowMissingColumns=True)
    if many is not None:
        met = met.unionByName(many)
    met = met.repartitionById(parts, "__mix_part")
    row = F.first("__mix_row", ignorenulls=True).over(Window.partitionBy("__mix_part", "__mix_key"))
    return (met.withColumn("__mix_row", row).where(F.col("__mix_slot").isNotNull())
            .sortWithinPartitions("__mix_slot", "__mix_row.doc_id").select("__mix_row.*"))
