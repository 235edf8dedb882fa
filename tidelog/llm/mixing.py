"""Mixing sources to target weights: exact block quotas split over output shards by a multivariate-hypergeometric tree.

Every source's documents fall into hash blocks. A source's target is met by whole passes over all its blocks plus the
first blocks of a keyed permutation of them; one boundary block is taken document by document and one boundary document
word by word, so the words taken are the target rounded. The draws (a block, once per pass) are dealt to output shards
by a binary tree: each node splits its vector of per-source draw counts by sequential urn draws, which is the
multivariate-hypergeometric law, until a leaf holds the exact quota of each source for one shard. Shards then own
disjoint ranges of each source's permuted draws and are shuffled locally by a keyed order.

Native: DataFrame functions only. Keys are (source, block), so a source with a third of all rows is spread over
all of its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .words import GAP, n_words

#: Three hex digits of a digest name a block.
BLOCK_DIGITS = 3
#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
SHARD_LEVELS = 4
SEED = "mix-1"


def _key(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *parts))


def source_targets(blocks: DataFrame) -> DataFrame:
    """(skey, block_size) -> (skey, source_size, target): 150 % of all sizes shared by weight, at most twice a source's size.

    Sharing an excess again by weight until no source is above its cap is the level at which the capped sources are
    exactly the first ones by size over weight; prefix sums in that order find it in one pass over the sources.
    """
    per = blocks.groupBy("skey").agg(F.sum("block_size").alias("source_size"))
    rank = F.row_number().over(W.orderBy("skey")) - 1
    weight = F.element_at(F.array(*[F.lit(x).cast("long") for x in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("ratio", F.col("source_size") / F.col("w"))
    order, everything = W.orderBy("ratio", "skey"), W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    nothing = F.lit(0).cast("long")
    per = (
        per.withColumn("thrice", 3 * F.sum("source_size").over(everything))
        .withColumn("w_all", F.sum("w").over(everything))
        .withColumn("c_before", F.coalesce(F.sum(2 * F.col("source_size")).over(before), nothing))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), nothing))
        .withColumn(
            "capped",
            F.col("w") * (F.col("thrice") - 2 * F.col("c_before"))
            >= 4 * F.col("source_size") * (F.col("w_all") - F.col("w_before")),
        )
    )
    capped_sum = lambda c: F.coalesce(F.sum(F.when(F.col("capped"), c)).over(everything), nothing)
    per = per.withColumn("c_capped", capped_sum(2 * F.col("source_size"))).withColumn("w_capped", capped_sum(F.col("w")))
    level = (F.col("w") * (F.col("thrice") - 2 * F.col("c_capped"))).cast("double") / (
        2 * (F.col("w_all") - F.col("w_capped"))
    ).cast("double")
    target = F.when(F.col("capped"), (2 * F.col("source_size")).cast("double")).otherwise(level)
    return per.select("skey", "source_size", target.alias("target"))


def _split_left(node: Column, level: int) -> Column:
    """Draw counts of the left child: from each source's draws in turn, each goes left with chance (left places)/(draws to come)."""
    coin = lambda s, i: F.pmod(F.xxhash64(F.lit(SEED), F.lit(level), node, s, i), F.lit(1 << 53)) / F.lit(float(1 << 53))
    total = F.aggregate("quota", F.lit(0).cast("long"), lambda t, x: t + x["draws"])

    def one_source(state: Column, x: Column) -> Column:
        start = F.struct(state["to_come"].alias("to_come"), state["places"].alias("places"), F.lit(0).cast("long").alias("left"))

        def one_draw(s: Column, i: Column) -> Column:
            goes = F.when(coin(x["skey"], i) * s["to_come"] < s["places"], F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
            return F.struct(
                (s["to_come"] - 1).alias("to_come"), (s["places"] - goes).alias("places"), (s["left"] + goes).alias("left")
            )

        draws = F.when(x["draws"] > 0, F.sequence(F.lit(1).cast("long"), x["draws"])).otherwise(F.array().cast("array<bigint>"))
        done = F.aggregate(draws, start, one_draw)
        return F.struct(
            done["to_come"].alias("to_come"),
            done["places"].alias("places"),
            F.concat(state["out"], F.array(done["left"])).alias("out"),
        )

    state = F.struct(total.alias("to_come"), F.floor(total / 2).alias("places"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate("quota", state, one_source)["out"]


def shard_quotas(draws: DataFrame, levels: int = SHARD_LEVELS) -> DataFrame:
    """(skey) per draw -> (shard, skey, draws): the leaves of the splitting tree over 2**levels shards."""
    per = draws.groupBy("skey").agg(F.count(F.lit(1)).alias("draws"))
    tree = per.agg(F.sort_array(F.collect_list(F.struct("skey", "draws"))).alias("quota")).select(
        F.lit(0).cast("long").alias("node"), "quota"
    )
    for level in range(levels):
        tree = tree.withColumn("left", _split_left(F.col("node"), level))
        child = lambda take: F.zip_with("quota", "left", lambda x, n: F.struct(x["skey"].alias("skey"), take(x, n).alias("draws")))
        tree = tree.select(
            F.explode(
                F.array(
                    F.struct((F.col("node") * 2).alias("node"), child(lambda x, n: n).alias("quota")),
                    F.struct((F.col("node") * 2 + 1).alias("node"), child(lambda x, n: x["draws"] - n).alias("quota")),
                )
            ).alias("c")
        ).select("c.node", "c.quota")
    return tree.select(F.col("node").alias("shard"), F.explode("quota").alias("q")).select("shard", "q.skey", "q.draws")


def assign(docs: DataFrame, levels: int = SHARD_LEVELS, text: str = "text", source: str = "source") -> DataFrame:
    """The input's columns plus mix: struct<size, source_size, target, taken, copies: array<struct<copy, words, shard, place>>>.

    Null text has size 0; null source is a source of its own, ranked last. Documents of equal key (doc_id and size)
    are interchangeable, so repeated rows give the same result in any order. An empty table gives an empty table.
    Columns of the caller with any name but mix and _mix_* are left alone. Reruns give the same draws.
    """
    if taken := [c for c in docs.columns if c == "mix" or c.startswith("_mix_")]:
        raise ValueError(f"columns are there already: {taken}")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    skey = F.when(F.col(f"`{source}`").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(f"`{source}`")))
    doc_key = _key(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    sized = docs.select(*kept, skey.alias("_mix_skey"), doc_key.alias("_mix_dkey"), n_words(F.col(f"`{text}`")).alias("_mix_size"))
    own = [F.col(f"_mix_{c}").alias(c) for c in ("skey", "dkey", "size")]
    keyed = sized.select(*own).withColumn("block", F.substring("dkey", 1, BLOCK_DIGITS))

    blocks = keyed.groupBy("skey", "block").agg(F.sum("size").alias("block_size"))
    targets = source_targets(blocks).withColumn("words", F.floor(F.col("target") + 0.5))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(F.lit(0).cast("long"))
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
    permuted = W.partitionBy("skey").orderBy(_key("skey", "block"), "block")
    before = F.coalesce(F.sum("block_size").over(permuted.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    decided = (
        blocks.withColumn("before", before)
        .join(targets, "skey")
        .select(
            "skey",
            "block",
            "source_size",
            "target",
            "whole",
            F.greatest(F.lit(0).cast("long"), F.least(F.col("rest") - F.col("before"), F.col("block_size"))).alias("extra"),
        )
    )

    copies = F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)
    draws = decided.where(copies > 0).select("skey", "block", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))
    by_draw = W.partitionBy("skey").orderBy(_key("skey", "block", F.col("copy").cast("string")), "block", "copy")
    draws = draws.withColumn("draw", F.row_number().over(by_draw).cast("long"))
    quotas = shard_quotas(draws, levels)
    upto = F.sum("draws").over(W.partitionBy("skey").orderBy("shard"))
    owned = (
        quotas.withColumn("upto", upto)
        .where("draws > 0")
        .select("skey", "shard", F.explode(F.expr("sequence(upto - draws + 1, upto)")).alias("draw"))
    )
    dealt = draws.join(owned, ["skey", "draw"]).groupBy("skey", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("copy", "shard"))).alias("shards")
    )
    decided = decided.join(dealt, ["skey", "block"], "left")

    decided = decided.select(*[F.col(c).alias(f"_mix_{c}") for c in decided.columns])
    joined = sized.withColumn("_mix_block", F.substring("_mix_dkey", 1, BLOCK_DIGITS)).join(decided, ["_mix_skey", "_mix_block"])
    whole, extra, size = F.col("_mix_whole"), F.col("_mix_extra"), F.col("_mix_size")
    within = W.partitionBy("_mix_skey", "_mix_block").orderBy("_mix_dkey", "_mix_size")
    so_far = F.coalesce(F.sum(size).over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    joined = joined.withColumn("_mix_partial", F.greatest(F.lit(0).cast("long"), F.least(extra - so_far, size)))
    partial = F.col("_mix_partial")
    copy = lambda n, words: F.struct(
        n.alias("copy"),
        words.alias("words"),
        F.col("_mix_shards")[n].alias("shard"),
        _key("_mix_dkey", n.cast("string"), F.lit("place")).alias("place"),
    )
    nothing = F.array().cast("array<struct<copy:bigint,words:bigint,shard:bigint,place:string>>")
    taken_whole = F.when(
        (whole > 0) & (size > 0), F.transform(F.sequence(F.lit(1).cast("long"), whole), lambda n: copy(n, size))
    ).otherwise(nothing)
    taken_part = F.when(partial > 0, F.array(copy(whole + 1, partial))).otherwise(nothing)
    mix = F.struct(
        size.alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (whole * size + partial).alias("taken"),
        F.concat(taken_whole, taken_part).alias("copies"),
    )
    return joined.select(*kept, mix.alias("mix"))


def mixed_documents(docs: DataFrame, levels: int = SHARD_LEVELS) -> DataFrame:
    """One row per copy the mix takes: row (struct of the input's columns), shard and place.

    Texts are whole, but for the first words of one boundary text a source; there n_chars, if it is a column, is counted anew.
    """
    others = F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text", "source")])
    taken = assign(docs.select("doc_id", "text", "source", others.alias("others")), levels).select("*", F.explode("mix.copies").alias("copy"))
    starts = F.split("text", r"(?<=[ \t-\r])(?=[^ \t-\r])")
    lead = F.when(F.col("text").rlike(f"^{GAP}"), 1).otherwise(0)
    cut = F.col("copy.words") < F.col("mix.size")
    text = F.when(cut, F.array_join(F.slice(starts, 1, (F.col("copy.words") + lead).cast("int")), "")).otherwise(F.col("text"))
    new = {"doc_id": F.col("doc_id"), "source": F.col("source"), "text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("others.n_chars"))
    row = F.struct(*[new.get(c, F.col("others")[c]).alias(c) for c in docs.columns])
    return taken.select(row.alias("row"), F.col("copy.shard").alias("shard"), F.col("copy.place").alias("place"))


def write_shards(docs: DataFrame, path: str, levels: int = SHARD_LEVELS) -> None:
    """Writes the mix as one folder a shard, each in its shuffled order."""
    out = mixed_documents(docs, levels).repartition(1 << levels, "shard").sortWithinPartitions("shard", "place")
    out.select("row.*", F.col("shard").alias("mix_shard")).write.partitionBy("mix_shard").parquet(path)
