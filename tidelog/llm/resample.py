"""Importance resampling towards a target distribution, over bucketed n-gram counts of words.

Texts become a position table: posexplode gives a row for each word, and lead() over a document's rows puts the words
that follow beside it, once for each further word of the longest n-gram. N-grams are hashed into buckets and counted
by group; a bucket's gain is the logarithm of its share in the target over its share in the documents. Documents take
the sum of the gains of their n-grams, joined by bucket, and a Gumbel key for sampling without replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.sources.scratch import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Java pattern of what separates words of lower-cased texts: all ASCII but digits and small letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Longest n-gram, buckets, percentage of eligible documents drawn, words that make one eligible, and seed.
ORDER, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), GAP), "")


def positions(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(row, n_words, bucketable gram): one row for each n-gram of 1 to order words, and one with a null gram for a text without words.

    texts has row, a number that no two of its rows share, and words. Order 1 needs no window and moves nothing.
    """
    rows = texts.select("*", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("pos", "gram")).drop("words")
    if order == 1:
        return rows.drop("pos")
    along = W.partitionBy("row").orderBy("pos")
    following = [F.lead("gram", k).over(along).alias(f"next_{k}") for k in range(1, order)]
    rows = rows.select("*", *following)
    grams, here = [F.col("gram")], F.col("gram")
    for k in range(1, order):
        here = F.concat(here, F.lit(" "), F.col(f"next_{k}"))  # null where the text ends before
        grams.append(here)
    kept = F.filter(F.array(*grams), lambda g: g.isNotNull())
    return rows.select(*[c for c in rows.columns if c not in ("gram", "pos") and not c.startswith("next_")], F.explode_outer(kept).alias("gram"))


def bucket(gram: Column, buckets: int = BUCKETS) -> Column:
    """CRC-32 of the UTF-8 bytes, modulo the number of buckets; null for null."""
    return F.pmod(F.crc32(gram), F.lit(buckets))


def _texts(docs: DataFrame, text: str, carried: list[Column] | None = None) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), words(F.col(f"`{text}`")).alias("words"), *(carried or []))


def counts(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """(bucket, n): how many n-grams of all texts each bucket holds; at most so many rows as there are buckets."""
    grams = positions(_texts(docs, text), order).where("gram is not null")
    return grams.groupBy(bucket(F.col("gram"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): thousandths of the log ratio of smoothed shares, floored, for each bucket that source counts hold."""
    total = lambda c: c.agg(F.sum("n")).first()[0] or 0
    in_source, in_target = float(total(source) + buckets), float(total(target) + buckets)
    both = source.join(F.broadcast(target.withColumnRenamed("n", "t")), "bucket", "left")
    s, t = F.col("n").cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    ratio = ((t + 1.0) * F.lit(in_source)) / ((s + 1.0) * F.lit(in_target))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gain: DataFrame, carried: list[Column], order: int = ORDER, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """Carried columns and n_words, n_features, weight of every row of docs: the sum of gains over its n-grams, 0 without any.

    The gains are a row a bucket, so they are broadcast. A document's words are summed before they are shuffled.
    """
    kept = F.struct(*carried).alias("carried")
    grams = positions(_texts(docs, text, [kept]), order).withColumn("bucket", bucket(F.col("gram"), buckets))
    found = grams.join(F.broadcast(gain), "bucket", "left").groupBy("row").agg(
        F.first("carried").alias("carried"),
        F.first("n_words").alias("n_words"),
        F.count("gram").alias("n_features"),
        F.coalesce(F.sum("gain"), F.lit(0)).cast("long").alias("weight"),
    )
    return found.select("carried.*", F.greatest("n_words", F.lit(0).cast("long")).alias("n_words"), "n_features", "weight")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw that a seed and an id (null: the word null) fix."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Adds rank to (doc_id, n_words, score, ..): 1, 2, 3.. along falling score, then rising doc_id, for the percentage drawn.

    Rows are dealt out by ranges of that order, so a task orders a range and begins where the counts of the ranges before
    end; these counts are one row a partition.
    """
    able = scored.where(F.col("n_words") >= least_words)
    by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    dealt = materialise(able.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = sorted(tuple(r) for r in dealt.groupBy("part").count().collect())
    starts, n = [], 0
    for part, size in sizes:
        starts.append((part, n))
        n += size
    offsets = F.broadcast(scored.sparkSession.createDataFrame(starts, "part int, before long"))
    at = F.col("before") + F.row_number().over(W.partitionBy("part").orderBy(*by))
    able = dealt.join(offsets, "part").withColumn("at", at).drop("part", "before")
    drawn = able.withColumn("rank", F.when(F.col("at") <= percent * n // 100, F.col("at"))).drop("at")
    rest = scored.where(F.coalesce("n_words", F.lit(0)) < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, carried: list[str] = (), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_features, weight, score, rank, and the carried columns as struct `carried`.

    A null or empty text has no words, weight 0 and no rank; a null doc_id is hashed as `null` and ranks behind its ties.
    Rows that repeat are documents of their own. Texts of any length are taken whole. Other columns of docs and target
    are not looked at, whatever their names. Without documents the result is empty; an empty target is a uniform one.
    """
    source = materialise(counts(docs, order, buckets, text), "counts")
    gain = materialise(gains(source, materialise(counts(target, order, buckets), "target"), buckets), "gains")
    kept = [F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias("carried")]
    weighed = weigh(docs, gain, kept, order, buckets, text)
    scored = materialise(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    return ranked(scored, percent, least_words).withColumn("carried", F.col("carried").dropFields("_") if carried else F.col("carried"))
