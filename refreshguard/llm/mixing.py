"""A mix of sources by target weights, dealt to output shards by a splitting tree.

The rows of a source fall into blocks by a hash.  A source's target says how
often all its blocks are taken whole and which part of them once more; that
part is a prefix of the blocks in a random order, and the last block of it is
cut between two documents.  Up to ``FILLERS`` single documents, the largest that
fit, fill what the cut leaves.

The blocks to be taken, over all sources, are tickets.  A binary tree over the
shards splits them: each node draws half of its tickets without replacement,
which gives each side's count per source the multivariate hypergeometric law.
The leaves hold exact quotas (shard, source).  Each shard then draws its quota
of blocks from the source's permuted order, next to the blocks of the shards
before it, so the draws are disjoint; a hash orders the rows of a shard.

Everything is column functions.  Texts are not shuffled: the tables that meet
the documents have a row per block and pass; they are broadcast if they are small.
A source with a third of all rows is spread over its blocks, of ``BLOCK_ROWS`` rows
or less on average.

Defined cases: a null text has size 0; null is a source of its own, after all
others; sources of size 0 have target 0 and take nothing; repeated rows fall
into the same block and are taken equally often, but at a block's cut, where all
of them stay out if they do not fit together; without rows the result is empty;
further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import sent

WEIGHTS = (1, 2, 3)
MOST = 3  # times that a document may be taken
BLOCKS, BLOCK_ROWS = 128, 100_000  # blocks of a source: so many, or more, of so many rows on average
FILLERS = 3  # single documents that follow a cut
LEVELS = 3  # of the splitting tree: 8 shards
SEED = 17
MIX_COLUMNS = ["size", "source_size", "target", "taken", "shards"]
WORD = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _key(text: Column, doc_id: Column) -> Column:
    return F.xxhash64(doc_id.cast("string"), F.coalesce(text, F.lit("")), F.lit(SEED))


def blocks_of(docs: DataFrame) -> int:
    """Blocks that keep what a cut divides, a block, small however many rows one source has."""
    return max(BLOCKS, -(-docs.count() // BLOCK_ROWS))


def sized(docs: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, source, size, block, key) of each row."""
    key = _key(F.col("text"), F.col("doc_id"))
    return docs.select("doc_id", "source", size(F.col("text")).alias("size"), key.alias("key")) \
        .withColumn("block", F.pmod("key", F.lit(blocks)))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size) with target: shares of the total by weight, at most ``MOST`` times a source.

    With the sources in the order of their limit per weight, those that reach
    their limit are a prefix: a source reaches it if the words that the ones
    before leave over, spread by weight over it and all later ones, exceed it.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    rows = sources.withColumn("weight", F.element_at(
        weights, ((F.row_number().over(named) - 1) % len(WEIGHTS) + 1).cast("int")))
    rows = rows.withColumn("limit", F.lit(float(MOST)) * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.select(
        "source", "source_size", "weight", "limit",
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("used"),
        F.sum("weight").over(after).alias("left_weight"))
    rows = rows.withColumn("level", (F.col("total") - F.col("used")) / F.col("left_weight"))
    rows = rows.withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    # Behind the first open source the column counts open ones as used, which only lowers it.
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("limit"))
                       .otherwise(level * F.col("weight")).alias("target"))


def plan_blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets by source, the blocks' part in them, and single documents beside the blocks.

    Of a block, ``whole`` counts takes of all of it, ``cut`` is the greatest key
    taken once more (null: none beyond the whole takes), ``rank`` its place in
    the source's random order.
    """
    blocks = stored(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    sources = stored(targets(blocks.groupBy("source").agg(
        F.sum("words").alias("source_size"))), "targets")
    joined = blocks.alias("b").join(sent(sources).alias("s"),
                                    F.col("b.source").eqNullSafe(F.col("s.source")))
    order = Window.partitionBy("source").orderBy(F.xxhash64("block", F.lit(SEED)), "block")
    passes = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = joined.select(
        "b.source", "block", "words", passes.alias("passes"), "target", "source_size").select(
        "source", "block", "words", F.floor("passes").cast("long").alias("full"),
        (F.col("target") - F.floor("passes") * F.col("source_size")).alias("part"),
        F.row_number().over(order).alias("rank"),
        F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    placed = placed.withColumn("rest", F.col("part") - (F.col("upto") - F.col("words")))
    placed = stored(placed.withColumn("whole", F.col("full") + F.when(
        F.col("rest") >= F.col("words"), 1).otherwise(0)), "placed")
    keyed = stored(rows.groupBy("source", "block", "key").agg(F.sum("size").alias("words")), "keyed")
    inside = _by_block(keyed, placed.filter("rest > 0 and rest < words")
                       .select("source", "block", "rest"))
    run = Window.partitionBy("source", "block").orderBy("key")
    cuts = inside.withColumn("upto", F.sum("words").over(run)).filter(
        F.col("upto") <= F.col("rest")).groupBy("source", "block").agg(
        F.max("key").alias("cut"), F.max("upto").alias("got"))
    plan = placed.alias("p").join(cuts.alias("k"), F.col("p.source").eqNullSafe(F.col("k.source"))
                                  & (F.col("p.block") == F.col("k.block")), "left").select(
        "p.source", "p.block", "p.words", "rest", "whole", "full", "rank", "cut", "got")
    plan = stored(plan, "plan")
    return sources, plan, _fillers(keyed, plan)


def _by_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with what is known of their block."""
    r, b = rows.alias("r"), sent(blocks).alias("b")
    known = [f"b.{c}" for c in blocks.columns if c not in rows.columns]
    return r.join(b, F.col("r.source").eqNullSafe(F.col("b.source"))
                  & (F.col("r.block") == F.col("b.block"))).select("r.*", *known)


def _fillers(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, block, only): single documents that fill what the cut leaves of a target.

    Each round takes the largest document that fits, of those the pass has not taken.
    """
    gaps = plan.filter("rest > 0 and rest < words").select(
        "source", (F.col("rest") - F.coalesce("got", F.lit(0))).alias("gap"))
    state = plan.select("source", "block", "cut", F.col("rest").alias("open"),
                        F.col("words").alias("in_block"))
    free = _by_block(keyed, state).filter(
        (F.col("open") < F.col("in_block")) & (F.col("cut").isNull() | (F.col("key") > F.col("cut")))
        & (F.col("words") > 0)).select("source", "block", "key", "words")
    found = None
    for _ in range(FILLERS):
        g = gaps.alias("g")
        fits = free.alias("f").join(sent(g), F.col("f.source").eqNullSafe(F.col("g.source"))
                                    & (F.col("words") <= F.col("gap"))).groupBy("f.source").agg(
            F.max(F.struct("words", "key", "block")).alias("best"))
        new = stored(fits.select("source", "best.block", F.col("best.key").alias("only"),
                                 F.col("best.words").alias("got")), "fillers")
        gaps = gaps.alias("g").join(sent(new).alias("n"),
                                    F.col("g.source").eqNullSafe(F.col("n.source"))).select(
            "g.source", (F.col("gap") - F.col("got")).alias("gap"))
        free = free.join(sent(new.select("block", "only")),
                         (F.col("key") == F.col("only")) & (free["block"] == new["block"]),
                         "left_anti")
        new = new.select("source", "block", "only")
        found = new if found is None else found.unionByName(new)
    return found


def shard_quotas(plan: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source, rank, shard): the shard of each ticket; rank counts a source's tickets.

    A node sorts its tickets at random and passes the first half to its left
    side, level by level.
    """
    takes = F.col("whole") + F.when(F.col("cut").isNotNull(), 1).otherwise(0)
    tickets = plan.withColumn("takes", takes).filter("takes > 0").select(
        "source", "block", F.explode(F.sequence(F.lit(1), F.col("takes").cast("int"))).alias("turn"))
    rows = tickets.withColumn("node", F.lit(0))
    for level in range(levels):
        node = Window.partitionBy("node")
        drawn = node.orderBy(F.xxhash64("source", "block", "turn", F.lit(level), F.lit(SEED)),
                             "source", "block", "turn")
        half = (F.count("*").over(node) + F.col("node") % 2) / 2
        rows = rows.withColumn("right", (F.row_number().over(drawn) > F.floor(half)).cast("int")) \
            .withColumn("node", F.col("node") * 2 + F.col("right")).drop("right")
    quota = rows.groupBy("source", F.col("node").alias("shard")).agg(F.count("*").alias("quota"))
    ahead = Window.partitionBy("source").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    return quota.withColumn("first", F.coalesce(F.sum("quota").over(ahead), F.lit(0)))


def dealt(plan: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source, block, turn, shard, cut): each take of a block and the shard that draws it."""
    takes = F.col("whole") + F.when(F.col("cut").isNotNull(), 1).otherwise(0)
    turns = plan.withColumn("takes", takes).filter("takes > 0").select(
        "source", "block", "rank", "whole", "cut",
        F.explode(F.sequence(F.lit(1), F.col("takes").cast("int"))).alias("turn"))
    order = Window.partitionBy("source").orderBy("turn", "rank")
    numbered = turns.withColumn("place", F.row_number().over(order) - 1)
    quota = shard_quotas(plan, levels)
    return numbered.alias("t").join(
        quota.alias("q"), F.col("t.source").eqNullSafe(F.col("q.source"))
        & (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("quota"))
    ).select("t.source", "block", "turn", "shard",
             F.when(F.col("turn") > F.col("whole"), F.col("cut")).alias("cut"))


def _block_plan(plan: DataFrame, fillers: DataFrame) -> DataFrame:
    """(source, block, takes): the shard of each take, its cut or single key, in one row a block."""
    singles = fillers.select("source", "block", F.lit(MOST + 1).alias("turn"), F.pmod(
        F.xxhash64("only", F.lit(SEED)), F.lit(1 << LEVELS)).cast("int").alias("shard"),
        F.lit(None).cast("long").alias("cut"), "only")
    every = dealt(plan).withColumn("only", F.lit(None).cast("long")).unionByName(singles)
    return every.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("turn", "shard", "cut", "only"))).alias("takes"))


def _taken(rows: DataFrame, sources: DataFrame, takes: DataFrame) -> DataFrame:
    """The rows with source_size, target, shards (of each take) and taken."""
    out = rows.alias("r").join(sent(sources).alias("s"),
                               F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        "r.*", "s.source_size", "s.target")
    mine = F.filter("takes", lambda t: F.when(t["only"].isNotNull(), t["only"] == F.col("key"))
                    .otherwise(t["cut"].isNull() | (F.col("key") <= t["cut"])))
    out = out.alias("r").join(
        sent(takes).alias("b"), F.col("r.source").eqNullSafe(F.col("b.source"))
        & (F.col("r.block") == F.col("b.block")), "left").select(
        "r.*", F.coalesce(F.transform(mine, lambda t: t["shard"]),
                          F.array().cast("array<int>")).alias("shards"))
    return out.withColumn("taken", F.size("shards") * F.col("size"))


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, the words taken and their shards."""
    rows = stored(sized(docs, blocks_of(docs)), "sized")
    sources, plan, fillers = plan_blocks(rows)
    out = _taken(rows, sources, stored(_block_plan(plan, fillers), "takes"))
    return out.select("doc_id", "size", "source_size", "target", "taken",
                      F.concat_ws(",", F.col("shards").cast("array<string>")).alias("shards"))


def _with_takes(docs: DataFrame) -> DataFrame:
    """(doc, size, source_size, target, taken, key, shards): whole rows beside their part in the mix."""
    blocks = blocks_of(docs)
    rows = stored(sized(docs, blocks), "sized")
    sources, plan, fillers = plan_blocks(rows)
    key = _key(docs["text"], docs["doc_id"])
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                        docs["source"].alias("source"), size(docs["text"]).alias("size"),
                        key.alias("key")).withColumn("block", F.pmod("key", F.lit(blocks)))
    return _taken(whole, sources, stored(_block_plan(plan, fillers), "takes"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix (those with words) with how often and to which shards they go.

    A column of the mix that a document has already is called ``mix_...``.
    """
    own = set(docs.columns)
    names = [c if c not in own else f"mix_{c}" for c in MIX_COLUMNS]
    out = _with_takes(docs).filter("taken > 0").withColumn(
        "shards", F.concat_ws(",", F.col("shards").cast("array<string>")))
    return out.select("doc.*", *[F.col(c).alias(n) for c, n in zip(MIX_COLUMNS, names)])


def write_shards(docs: DataFrame, path: str) -> None:
    """The mix as one folder a shard, each row once per take, in random order within its files."""
    rows = _with_takes(docs).select("doc", "key", F.posexplode("shards").alias("take", "shard"))
    placed = rows.withColumn("place", F.xxhash64("key", "take", "shard", F.lit(SEED)))
    # A shard spreads over several tasks; the place deals its rows out.
    dealt = placed.repartition("shard", F.pmod("place", F.lit(BLOCKS))).sortWithinPartitions(
        "shard", "place")
    dealt.select("shard", "doc").write.partitionBy("shard").parquet(path)
