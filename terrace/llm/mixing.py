"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target number of words; targets are cut into blocks of equal word
count and the blocks are handed out by highest quotients (votes / 1, 3, 5, ...):

1. over the sources, votes = target words, seats = all blocks of the mix;
2. inside a source over its shards, votes = shard words, seats = the source's blocks.

A shard is a seeded hash class of a source's documents, about the square root of its
document count many, so a source with a third of all rows is ordered by many tasks and the
table of shards stays small. Inside a shard the documents form a tape in seeded order; the
shard's quota takes its blocks from the start of the tape and goes round a second time
where the target exceeds the source. Only (shard, order key, size) rows are shuffled; a
document's share follows from comparing its order key with the shard's cut, so texts stay
in their scan partition.

Defined cases. NULL text: size 0, takes nothing. NULL source: a source of its own, last in
order. NULL doc_id: ordered as the empty id. Equal (doc_id, source) rows: same order key;
at the cut each takes the same part. Empty input: empty result. Extra columns: passed
through by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import packed, staged, word_count

WEIGHTS = (3, 1, 2)  # by source in code-point order, repeating
SHARE = 1.5  # words of the mix / words of all sources
MAX_REPEATS = 2  # a source (and so a document) is taken at most so many times
BLOCK_WORDS = 16
SEED = 20_24


def _key(seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _shard(n_shards):
    """Shard of a document from the last eight hex digits of its order key."""
    return F.conv(F.substring("_key", 25, 8), 16, 10).cast("long") % n_shards


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_repeats=MAX_REPEATS) -> DataFrame:
    """Target words of every source: shares by weight, stopped at ``max_repeats`` x the size.

    ``sizes``: source, _size per document. The excess of stopped sources is shared out
    again by weight until none is above. With sources by cap / weight, the level
    (budget - caps before) / (weights from here) rises while sources are stopped and falls
    after the last of them, so its maximum is the final level. The windows run over one
    row per source.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_docs")
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    t = (
        totals.withColumn("_rank", F.row_number().over(order))
        .withColumn("_weight", F.get(cycle, (F.col("_rank") - 1) % len(weights)))
        .withColumn("_cap", (F.col("source_size") * max_repeats).cast("double"))
        .withColumn("_budget", F.sum("source_size").over(every) * F.lit(float(share)))
    )
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    from_here = F.sum("_weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    t = t.withColumn("_level", (F.col("_budget") - before) / from_here)
    t = t.withColumn("_level", F.max("_level").over(every))
    return t.select(
        "source",
        "source_size",
        F.least("_cap", F.col("_level") * F.col("_weight")).alias("target"),
        "_rank",
        "_docs",
    )


def sainte_lague(parties: DataFrame, group: list[str], votes: str, seats: str, key: str) -> DataFrame:
    """Add ``_seats``: each party's seats among the ``seats`` of its group, by highest quotients.

    Only contested quotients are listed. With quota q = seats * votes / all votes of n
    parties, a party's seats differ from q by at most 1 + 2 n q / seats, so seats below that
    range are given at once and the rest go to the largest quotients votes / (2 k + 1); ties
    go to the smaller ``key``. That is about eight quotients a party, whatever the seats.
    """
    g = Window.partitionBy(*group)
    q = F.col("_quota")
    p = (
        parties.withColumn("_all", F.sum(votes).over(g))
        .withColumn("_n", F.count(F.lit(1)).over(g))
        .withColumn("_quota", F.when(F.col("_all") > 0, F.col(seats) * F.col(votes) / F.col("_all")).otherwise(0.0))
        .withColumn("_slack", F.when(F.col(seats) > 0, 1 + 2 * F.col("_n") * q / F.col(seats)).otherwise(0.0))
        .withColumn("_low", F.greatest(F.lit(0), F.floor(q - F.col("_slack"))).cast("long"))
        .withColumn("_high", F.ceil(q + F.col("_slack")).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(g))
    )
    quotients = p.withColumn("_k", F.explode(F.sequence("_low", "_high"))).withColumn(
        "_quotient", F.col(votes) / (2 * F.col("_k") + 1)
    )
    ranked = quotients.withColumn(
        "_place", F.row_number().over(g.orderBy(F.desc("_quotient"), F.asc_nulls_last(key), "_k"))
    )
    won = F.sum(F.when((F.col("_place") <= F.col("_left")) & (F.col(votes) > 0), 1).otherwise(0))
    keep = [c for c in parties.columns if c not in (*group, key)]
    return (
        ranked.groupBy(*group, key)
        .agg(*(F.first(c).alias(c) for c in keep), (F.first("_low") + won).alias("_seats"))
    )


def mix_cuts(
    sized: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per (source, shard): targets, whole rounds of the tape and the cut in the last.

    ``sized``: source, _size, _key. A document with order key below ``_cut_key`` is taken
    ``_rounds + 1`` times, at the cut ``_cut_words`` words more than ``_rounds`` times, after
    it ``_rounds`` times.
    """
    targets = source_targets(sized, weights, share, max_repeats).withColumn(
        "_blocks", F.floor(F.sum("target").over(Window.partitionBy()) / block_words + 0.5)
    )
    quotas = sainte_lague(targets, [], "target", "_blocks", "_rank").select(
        "source",
        "source_size",
        "target",
        F.ceil(F.sqrt("_docs")).alias("_n_shards"),
        F.col("_seats").alias("_source_blocks"),
    )
    quotas = staged(quotas, "mix-quotas")
    s, q = sized.alias("s"), quotas.alias("q")
    rows = s.join(q, F.col("s.source").eqNullSafe(F.col("q.source"))).select(
        "s.source", "_size", "_key", "source_size", "target", "_n_shards", "_source_blocks",
        _shard(F.col("_n_shards")).alias("_shard"),
    )
    shards = rows.groupBy("source", "_shard").agg(
        F.sum("_size").alias("_tape"),
        *(F.first(c).alias(c) for c in ("source_size", "target", "_n_shards", "_source_blocks")),
    )
    shards = sainte_lague(shards, ["source"], "_tape", "_source_blocks", "_shard")
    words = F.least(F.col("_seats") * block_words, F.col("_tape") * max_repeats)
    shards = shards.select(
        "source", "_shard", "source_size", "target", "_n_shards", "_tape",
        F.when(F.col("_tape") > 0, F.floor(words / F.col("_tape"))).otherwise(0).alias("_rounds"),
        F.when(F.col("_tape") > 0, words % F.col("_tape")).otherwise(0).alias("_rest"),
    )
    shards = staged(shards, "mix-shards")
    r, h = rows.select("source", "_shard", "_key", "_size").alias("r"), shards.alias("h")
    tape = Window.partitionBy("r.source", "r._shard").orderBy("r._key").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        r.join(h, F.col("r.source").eqNullSafe(F.col("h.source")) & (F.col("r._shard") == F.col("h._shard")))
        .select(
            F.col("r.source"), F.col("r._shard"), "_key", "_size", "_rest",
            F.coalesce(F.sum("_size").over(tape), F.lit(0)).alias("_start"),
        )
        .filter((F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_size")))
    )
    cuts = placed.groupBy("source", "_shard").agg(
        F.min("_key").alias("_cut_key"), F.min(F.col("_rest") - F.col("_start")).alias("_cut_words")
    )
    c = cuts.alias("c")
    joined = h.join(
        c, F.col("h.source").eqNullSafe(F.col("c.source")) & (F.col("h._shard") == F.col("c._shard")), "left"
    )
    return joined.select("h.*", "_cut_key", "_cut_words")


def assign(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add source_size, target and taken to ``rows`` (source, _size, _key and any others)."""
    cuts = staged(cuts, "mix-cuts")
    per_source = cuts.groupBy("source").agg(F.first("_n_shards").alias("_n_shards"))
    r, p = rows.alias("r"), per_source.alias("p")
    r = r.join(p, F.col("r.source").eqNullSafe(F.col("p.source"))).select(
        "r.*", _shard(F.col("_n_shards")).alias("_shard")
    ).alias("r")
    c = cuts.alias("c")
    more = (
        F.when(F.col("c._cut_key").isNull() | (F.col("r._key") > F.col("c._cut_key")), 0)
        .when(F.col("r._key") < F.col("c._cut_key"), F.col("r._size"))
        .otherwise(F.least("c._cut_words", "r._size"))
    )
    taken = F.col("c._rounds") * F.col("r._size") + more
    return r.join(
        c, F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r._shard") == F.col("c._shard"))
    ).select("r.*", "c.source_size", "c.target", taken.cast("long").alias("taken"))


def mix_decisions(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``."""
    sized = staged(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("_size")).withColumn("_key", _key(seed)),
        "mix-sizes",
    )
    return assign(sized, mix_cuts(sized, **options)).select(
        "doc_id", "source", F.col("_size").alias("size"), "source_size", "target", "taken"
    )


def mix(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The documents the mix takes, with all their columns and ``mix_words`` taken of each.

    Documents of which nothing is taken are left out. Texts are read a second time
    instead of being shuffled.
    """
    sized = docs.select("source", word_count(F.col("text")).alias("_size"), _key(seed).alias("_key"))
    cuts = mix_cuts(staged(sized, "mix-sizes"), **options)
    rows = packed(
        docs, source=F.col("source"), _size=word_count(F.col("text")), _key=_key(seed)
    )
    taken = assign(rows, cuts).filter(F.col("taken") > 0)
    return taken.select("_row.*", F.col("taken").alias("mix_words"))
