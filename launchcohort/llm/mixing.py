"""A mix of sources to target weights: exact quotas per source, split over blocks by hypergeometric draws.

Documents are hashed to output shards, so each shard holds one block of every source. A source's
target gives whole passes over all its documents, and a rest. The rest is split over its blocks by
a binary tree over the shards: a node's quota goes to its two halves by a hypergeometric draw of
words, so that all draws together are a multivariate one, the quotas of a source's blocks sum to
its rest exactly and none exceeds its block. In its block, documents come in the order of their
hashes until the quota is used; the last one is taken in part. A shard's rows come in a random order.

Draws come from hashes of source, node and seed, so reruns agree. Every draw is made by its exact
probabilities, over a wide range summed between bounds (Bernstein's) that it leaves with less than
2 * exp(-40), which is below what a number of 53 bits can tell. Everything is built-in functions. Tables that are joined have a row per source, node or block;
a block holds about `DOCS_PER_BLOCK` documents whatever a source's share, and sums are made before
each shuffle. Only two numbers reach the driver: the count of the largest source and so the depth.

Defined results: a document's size is its number of words [^\\x20\\x09-\\x0D]+ (null: 0) and documents
of no words take 0; a null source is a source of its own, last in order; rows that repeat a doc_id
are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from launchcohort.session import written

# The contract's weights, repeating over the sources in their order.
WEIGHTS = (3, 1, 2)
EXACT_RANGE = 32
DOCS_PER_BLOCK = 4096


def words(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`sources` (source, size) with weight and target.

    Shares of the total by weight, where no target exceeds `most` times its source: in the order of
    the ratio at which sources fill up, those that fill are full and the others share what is left.
    """
    # One row per source; a null source sorts last.
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    s = sources.withColumn("weight", w).withColumn("cap", most * F.col("size"))
    total = Window.partitionBy()
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "left": share * F.sum("size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    # The level at which the others share, if all before this source are full; the first that is not full sets it.
    level = F.when(F.col("cap") * F.col("open") > F.col("left") * F.col("weight"), F.col("left") / F.col("open"))
    s = s.withColumn("level", F.first(level, ignorenulls=True).over(full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return s.select("source_key", "size", "weight", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("level"))).alias("target"))


def uniform(k: int) -> str:
    """A number in (0, 1) from a hash of the node, as SQL."""
    return f"((pmod(xxhash64(source_key, node, seed, {k}), 9007199254740991) + 0.5D) / 9007199254740992D)"


def hypergeometric() -> str:
    """SQL for how many of `q` draws fall to the `n` among `n + m`; columns lo and hi bound them."""
    # Logarithms of the weights of lo, lo + 1, ..., each from the one before, for a narrow range.
    logs = """aggregate(sequence(lo, hi), named_struct('w', 0D, 'all', cast(array() as array<double>)),
        (s, k) -> named_struct('w', s.w + ln(greatest((n - k) * double(q - k), 1D) / ((k + 1D) * greatest(m - q + k + 1D, 1D))),
                               'all', concat(s.all, array(s.w))), s -> s.all)"""
    pick = f"""aggregate(w, named_struct('left', {uniform(1)} * aggregate(w, 0D, (a, x) -> a + x), 'k', lo),
        (s, x) -> named_struct('left', s.left - x, 'k', if(s.left > x, least(s.k + 1, hi), s.k)), s -> s.k)"""
    exact = f"aggregate(array({logs}), lo, (_, l) -> aggregate(array(transform(l, x -> exp(x - array_max(l)))), lo, (__, w) -> {pick}))"
    # Over a wide range no list is kept: probabilities of from, from + 1, ... relative to the first's are summed, then run through again up to the draw.
    mean, all_ = "double(q) * n / (n + m)", "double(n + m)"
    variance = f"({mean} * (m / {all_}) * ({all_} - q) / greatest({all_} - 1, 1))"
    off = f"(27 + 9 * sqrt({variance}))"
    steps = f"sequence(greatest(lo, bigint(floor({mean} - {off}))), least(hi, bigint(ceil({mean} + {off}))))"
    next_ = "s.w * ((n - k) * double(q - k)) / ((k + 1D) * (m - q + k + 1D))"
    sum_ = f"aggregate(at, named_struct('w', 1D, 'sum', 0D), (s, k) -> named_struct('w', {next_}, 'sum', s.sum + s.w), s -> s.sum)"
    wide = f"""aggregate(array({steps}), lo, (_, at) -> aggregate(at, named_struct('w', 1D, 'left', {uniform(1)} * {sum_}, 'k', at[0]),
        (s, k) -> named_struct('w', {next_}, 'left', s.left - s.w, 'k', if(s.left > s.w, least(k + 1, at[size(at) - 1]), s.k)), s -> s.k))"""
    return f"case when hi <= lo then lo when hi - lo <= {EXACT_RANGE} then {exact} else {wide} end"


def block_quotas(blocks: DataFrame, rests: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source_key, shard, quota): `rests` (source_key, quota) split over `blocks` (source_key, shard, size)."""
    now = rests.select("source_key", F.lit(0).cast("long").alias("node"), "quota")
    for k in range(depth):
        child = F.shiftright("shard", depth - k - 1)
        halves = (blocks.groupBy("source_key", F.shiftright("shard", depth - k).alias("node"))
                  .agg(F.sum(F.when(child % 2 == 0, F.col("size")).otherwise(0)).alias("n"), F.sum(F.when(child % 2 == 1, F.col("size")).otherwise(0)).alias("m")))
        drawn = (now.join(halves, ["source_key", "node"]).select("source_key", "node", F.col("quota").alias("q"), "n", "m", F.lit(seed).alias("seed"))
                 .withColumns({"lo": F.greatest(F.lit(0), F.col("q") - F.col("m")), "hi": F.least("q", "n")}).withColumn("left", F.expr(hypergeometric())))
        now = drawn.select("source_key", F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quota")),
                                                           F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("q") - F.col("left")).alias("quota")))).alias("x"))
        now = now.select("source_key", "x.node", "x.quota")
    return now.withColumnRenamed("node", "shard")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 7, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """`row` (a struct of all input columns but the text), size, source_size, target, taken and shard.

    Rows are dealt by shard and come in a random order within it.
    """
    if most != int(most) or most < share:
        raise ValueError("most is a whole number of at least the share")
    kept = F.struct(*[docs[c] for c in docs.columns if c != text])
    key = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    sized = written(docs.select(kept.alias("row"), F.col(doc_id).alias("id"), key.alias("source_key"), F.col(source).cast("string").alias("source"), words(text).alias("size")), "sized")
    per_source = written(sized.groupBy("source_key", "source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")), "sources")
    largest = per_source.agg(F.max("docs")).first()[0] or 0
    depth = max(0, (-(-largest // docs_per_block) - 1).bit_length())
    shard = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << depth)).alias("shard")
    # The target in whole words: so many whole passes, and a rest.
    aim = F.round("target").cast("long")
    passes = F.when(F.col("size") > 0, F.floor(aim / F.col("size"))).otherwise(0).cast("long")
    goal = written(targets(per_source.select("source_key", "source", "size"), weights, share, most)
                   .withColumn("passes", passes).withColumn("rest", aim - F.col("passes") * F.col("size")), "targets")
    blocks = written(sized.select("source_key", shard, "size").groupBy("source_key", "shard").agg(F.sum("size").alias("size")), "blocks")
    quotas = written(block_quotas(blocks, goal.select("source_key", F.col("rest").alias("quota")), depth, seed), "quotas")
    plan = quotas.join(goal.select("source_key", F.col("size").alias("source_size"), "target", "passes"), "source_key")
    order = F.xxhash64("id", "source_key", F.lit(seed + 1))
    before = Window.partitionBy("source_key", "shard").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.select("row", "id", "source_key", "size", shard, order.alias("order")).join(plan, ["source_key", "shard"])
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("quota") - F.coalesce(F.sum("size").over(before), F.lit(0))))
    taken = rows.withColumn("taken", (F.col("passes") * F.col("size") + part).cast("long"))
    return (taken.withColumn("shuffled", F.xxhash64("id", F.lit(seed + 2))).repartition("shard").sortWithinPartitions("shard", "shuffled")
            .select("row", "size", "source_size", "target", "taken", "shard"))
