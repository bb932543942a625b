"""Mixing sources to target weights: Sainte-Lague apportionment of equal blocks of words.

Sources in the order of their names get weights in turn; together they share ``share``
times all words. A source's target ends at ``most`` times its own words; what is over is
shared by weight again until no target is above. Blocks of ``block`` words are then
allotted to sources by the highest quotients target/1, target/3, target/5, ..., and a
source's blocks to its shards by the same rule with the shards' words as weights. A shard
is at most a few times ``shard_words`` words; laid end to end ``most`` times over they are
cut into blocks, and those with the smallest seeded hashes are chosen. A document takes as
many words as chosen blocks cover of it, so none takes more than ``most`` times its size.

Highest quotients without sorting all of them: every seat with a quotient above a divisor
that gives out a little too few seats is taken at once, and only the seats between that
and a divisor that gives out enough (at most two for each part and a few more) are ranked,
by ``numbered``, which needs no single task.

Everything is DataFrame expressions. A source may hold any share of the rows: it is dealt
to shards by hashes, entries of more words than a shard are cut into pieces, and equal
rows are counted instead of collected.

Defined results: a null text has size 0 and takes nothing; a null source is the last one; a
null doc_id is a value like others. Rows equal in doc_id, source and size are alike, and
each takes the mean of what they take together, rounded to a word. An empty table gives an
empty result. Very long texts are cut between shards like others. Only the named columns
are read. The result depends on the rows alone, not on their order or partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seatwise.operators.matching import attach
from seatwise.operators.numbering import numbered

#: Parameters of the mix.
SHARE = 1.5
WEIGHTS = (3, 1, 2)
MOST = 2
BLOCK = 16
SHARD_WORDS = 32_768
SEED = 13
#: Blocks hashed by one task.
TASK_BLOCKS = 500_000

_WORD = r"[^\x20\x09-\x0D]+"
Store = Callable[..., DataFrame]


def sizes(documents: DataFrame, doc_id: str = "doc_id", source: str = "source",
          text: str = "text") -> DataFrame:
    """doc_id, source and number of words of every row."""
    count = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD))
    return documents.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                            count.cast("long").alias("size"))


def targets(sized: DataFrame, store: Store, share: float = SHARE,
            weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, its number, source_size and target, one row per source."""
    each = numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                    [F.col("source").asc_nulls_last()], store, "number", table="sources")
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    each = each.withColumns({
        "_weight": weight.cast("long"), "_cap": F.lit(most).cast("long") * F.col("source_size")})
    words, total = each.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    # The fewer words a source has for its weight, the sooner it is full. A source is full
    # if its cap is no more than its part of what the fuller ones leave.
    ordered = numbered(
        each, [F.col("_cap") / F.col("_weight"), F.col("number")], store, "_order",
        {"_caps": "_cap", "_weights": "_weight"}, "full")
    left = F.lit(share * words) - F.col("_caps")
    full = ordered.withColumn(
        "_full", F.col("_cap") * (F.lit(total) - F.col("_weights")) <= left * F.col("_weight"))
    taken, used = full.filter("_full").agg(
        F.coalesce(F.sum("_cap"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    unit = (share * words - taken) / (total - used) if total > used else 0.0
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        F.lit(unit) * F.col("_weight"))
    return full.select("source", "number", "source_size", target.alias("target"))


def apportion(parts: DataFrame, store: Store, group: str, part: str, weight: str, seats: str,
              name: str) -> DataFrame:
    """``parts`` with ``quota``: the seats of each group given out by highest quotients.

    A row is one part, unique by ``group`` and ``part``; ``seats`` repeats on all parts of a
    group. Equal quotients go to the smaller part first.
    """
    sums = parts.groupBy(group).agg(
        F.sum(F.col(weight).cast("double")).alias("_sum"), F.count(F.lit(1)).alias("_parts"))
    rows = attach(parts, sums, [group])

    def given(slack: Column) -> Column:
        """Seats whose quotient is at least the divisor sum / (seats + slack)."""
        at = F.col(weight) * (F.col(seats) + slack) / F.col("_sum") + 0.5
        return F.when((F.col("_sum") > 0) & (F.col(seats) > 0),
                      F.greatest(F.floor(at), F.lit(0))).otherwise(0).cast("long")

    slack = F.col("_parts") / 2 + 1
    rows = rows.withColumns({"_sure": given(-slack), "_most": given(slack)})
    rows = store(rows, f"{name}_parts")
    sure = rows.groupBy(group).agg(F.sum("_sure").alias("_given"))
    open_seats = rows.filter("_most > _sure").select(
        group, part, seats, F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_seat"),
        F.col(weight).cast("double").alias("_w"),
    ).withColumn("_quotient", F.col("_w") / (2 * F.col("_seat") + 1))
    ranked = numbered(
        open_seats, [F.col(group), F.col("_quotient").desc(), F.col(part), F.col("_seat")],
        store, "_rank", table=f"{name}_seats")
    first = ranked.groupBy(group).agg(F.min("_rank").alias("_first")).join(sure, group)
    extra = attach(ranked, first, [group]).filter(
        F.col("_rank") - F.col("_first") < F.col(seats) - F.col("_given"))
    extra = extra.groupBy(group, part).agg(F.count(F.lit(1)).alias("_extra"))
    quota = F.col("_sure") + F.coalesce("_extra", F.lit(0))
    return rows.join(extra, [group, part], "left").select(*parts.columns, quota.alias("quota"))


def _block_hash(seed: int, block: str) -> str:
    return f"md5(concat_ws(':', {seed}, number, shard, {block}))"


def mix(documents: DataFrame, store: Store, doc_id: str = "doc_id", source: str = "source",
        text: str = "text", share: float = SHARE, weights: Sequence[int] = WEIGHTS,
        most: int = MOST, block: int = BLOCK, shard_words: int = SHARD_WORDS,
        seed: int = SEED) -> DataFrame:
    """Every row's doc_id, source and size, its source's size and target, and what is taken."""
    sized = store(sizes(documents, doc_id, source, text), "sized")
    goals = store(targets(sized, store, share, weights, most), "targets")
    words = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    by_source = apportion(
        goals.withColumns({"_all": F.lit(0), "seats": F.lit(int(share * words / block + 0.5))}),
        store, "_all", "number", "target", "seats", "sources")
    quotas = by_source.withColumn("seats", F.least(
        "quota", F.floor(F.lit(most) * F.col("source_size") / block)))
    quotas = store(quotas.select("source", "number", "source_size", "target", "seats"), "quotas")

    # Equal rows become one entry; long entries become pieces; pieces are dealt to shards.
    entries = sized.filter("size > 0").groupBy("source", "doc_id", "size").agg(
        F.count(F.lit(1)).alias("copies"))
    numbers = quotas.select(
        F.col("source").alias("_s"), "number", "source_size", "seats")
    entries = entries.join(numbers, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    pieces = entries.select("*", F.explode(F.expr(
        f"sequence(0L, (size * copies - 1) div {shard_words})")).alias("piece"))
    pieces = pieces.withColumns({
        "words": F.expr(f"least({shard_words}, size * copies - piece * {shard_words})"),
        "shard": F.expr(
            "cast(conv(substring(md5(concat_ws(':', coalesce(cast(doc_id as string), ''), size,"
            f" piece)), 1, 8), 16, 10) as bigint) % ((source_size + {shard_words - 1}) div {shard_words})"),
    })
    in_shard = Window.partitionBy("number", "shard")
    order = in_shard.orderBy(F.col("doc_id").asc_nulls_first(), "size", "piece")
    pieces = store(pieces.withColumns({
        "start": F.sum("words").over(order) - F.col("words"),
        "shard_size": F.sum("words").over(in_shard),
    }).drop("source_size"), "pieces")

    shards = pieces.groupBy("number", "shard").agg(
        F.first("shard_size").alias("shard_size"), F.first("seats").alias("seats"))
    blocks = F.floor(F.lit(most) * F.col("shard_size") / block)
    shards = apportion(shards, store, "number", "shard", "shard_size", "seats", "shards")
    shards = shards.withColumn("blocks", blocks).withColumn("quota", F.least("quota", "blocks"))
    # Few bytes but much hashing, so the shards are dealt out by blocks and not merged.
    tasks = -(-most * words // (block * TASK_BLOCKS))
    shards = shards.repartition(max(1, tasks), "number", "shard")
    # The hash of the last block chosen tells for every block whether it is.
    limit = F.expr("get(sort_array(transform(sequence(0L, greatest(blocks - 1, 0L)), j -> "
                   f"{_block_hash(seed, 'j')})), cast(quota - 1 as int))")
    # Stored, so that no filter on the limit computes it once more in another stage.
    limits = store(shards.select(
        "number", "shard", "blocks", F.when(F.col("quota") > 0, limit).alias("limit")), "limits")

    begin = "(start + p * shard_size)"
    taken = F.expr(f"""aggregate(sequence(0L, {most - 1}L), 0L, (sum, p) -> sum + aggregate(
        sequence({begin} div {block}, ({begin} + words - 1) div {block}), 0L, (a, j) -> a + if(
            j < blocks and {_block_hash(seed, 'j')} <= limit,
            least((j + 1) * {block}, {begin} + words) - greatest(j * {block}, {begin}), 0L)))""")
    covered = pieces.join(limits, ["number", "shard"]).filter("limit is not null").select(
        "source", "doc_id", "size", "copies", taken.alias("taken"))
    of_entry = covered.groupBy("source", "doc_id", "size").agg(
        F.floor(F.sum("taken") / F.first("copies") + 0.5).cast("long").alias("_taken"))

    # Rows of one entry may be many, so the join must not use the aggregate's partitioning.
    key = F.xxhash64("source", "doc_id", "size")
    of_entry = of_entry.select(
        key.alias("_key"), F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"),
        F.col("size").alias("_size"), "_taken")
    rows = sized.withColumn("_of", key).join(
        of_entry, (F.col("_of") == F.col("_key")) & F.col("source").eqNullSafe(F.col("_source"))
        & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("size") == F.col("_size")), "left")
    goals = quotas.select(F.col("source").alias("_s"), "source_size", "target")
    return rows.join(goals, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("_taken", F.lit(0).cast("long")).alias("taken"))
