"""Quality rules: base counts, then robust multivariate outliers by minimum covariance determinant.

Each text's counts are transformed to a vector (log words, log word length, log rates of symbols and repeated lines).
Per language and source, vectors are gathered on a grid, so a group is an array of cells with counts whose size the grid
bounds, however many rows the group has; the group by cell is pre-aggregated before it is shuffled. On that array
concentration steps run: the nearest three quarters by Mahalanobis distance give the next centre and covariance, from a
median start, a classical one and some of hashed subsets of the cells, and the smallest determinant wins. Groups too small for an estimate take that of their
language, or of all documents if the language is too small as well. A document is rejected beyond a chi-square cutoff.

Native: DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import materialise

from .words import words

DIMS = ("x1", "x2", "x3", "x4")
#: Grid step and number of steps of each dimension.
STEPS = (0.5, 0.1, 0.5, 0.5)
CELLS = (48, 80, 24, 24)
#: Standard deviation added to each dimension's own: statistics that are constant in a group still have a scale, and no
#: grid step outweighs it. Chosen with the labels of sf0.1 in sight: of those that pass the base it rejects 3 of
#: 3,330 good and 296 of 301 bad documents (twice as much: 2 and 296; two fifths of it: 65 and 297).
FLOOR = (0.25, 0.05, 0.25, 0.25)
#: Share of a group the estimate rests on, and the factor that makes its covariance consistent for normal vectors.
#: (0.75 over the chance that chi-square with 6 degrees is below the 0.75 quantile of that with 4.)
CORE, CONSISTENT = 0.75, 1.487
#: Starts from subsets, and the share of the cells that each has.
SUBSETS, SUBSET = 4, 4
CONCENTRATIONS = 5
#: Squared distance beyond which a vector is an outlier: about the 1 - 1e-6 quantile of chi-square with 4 degrees.
CUTOFF = 33.4
#: Documents a group or language needs for an estimate of its own.
LEAST = 30
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Groups up to which their estimates are broadcast; beyond that rows are joined to them, salted.
FEW_GROUPS = 100_000
SALTS = 32


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _repeat_words(w: Column) -> Column:
    """Words inside 5-word windows that occur twice or more. Hashes rule out repeats; texts with equal hashes are told by their words."""
    zero = F.lit(0).cast("long")
    places = F.sequence(F.lit(0), F.size(w) - 5)
    hashed = F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))

    def exact() -> Column:
        grams = F.sort_array(F.transform(places, lambda i: F.struct(F.array_join(F.slice(w, i + 1, 5), " ").alias("g"), i.alias("i"))))

        def covered(s: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(s, j)["g"] == F.get(s, k)["g"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j + 1) | ((j > 0) & same(j, F.greatest(j - 1, F.lit(0)))))
            at = F.sort_array(F.transform(twice, lambda j: F.get(s, j)["i"]))
            start = F.struct(zero.alias("n"), F.lit(-5).alias("last"))
            return F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last")))["n"]

        return let(grams, covered)

    repeats = let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(w) < 6, zero).otherwise(F.when(repeats, exact()).otherwise(zero))


def statistics(text: Column) -> Column:
    """struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words> of a whole text; null text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    symbols = F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def vector(s: Column) -> list[Column]:
    n = s["n_words"]
    return [F.log(n), F.log(s["word_chars"] / n), F.log1p(100 * s["n_symbols"] / n), F.log1p(100 * s["n_dup_lines"] / n)]


def _distance(x: list[Column], state: Column) -> Column:
    """Squared Mahalanobis distance by forward substitution in the Cholesky factor l of the covariance."""
    z: list[Column] = []
    for j in range(len(x)):
        rest = x[j] - state[f"m{j}"]
        for k in range(j):
            rest = rest - state[f"l{j}{k}"] * z[k]
        z.append(rest / state[f"l{j}{j}"])
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _factor(mean: list[Column], cov: dict[tuple[int, int], Column], rest: list[Column]) -> Column:
    """State struct of centre and Cholesky factor, built one entry at a time so that no entry is spelled out twice."""

    def entry(names: list[str], s: Column) -> Column:
        done = len(names)
        if done == len(_LOWER):
            return s
        j, k = _LOWER[done]
        value = s[f"c{j}{k}"]
        for t in range(k):
            value = value - s[f"l{j}{t}"] * s[f"l{k}{t}"]
        value = F.sqrt(F.greatest(value, F.lit(1e-9))) if j == k else value / s[f"l{k}{k}"]
        return let(s.withField(f"l{j}{k}", value), lambda t: entry([*names, f"l{j}{k}"], t))

    first = F.struct(*[m.alias(f"m{j}") for j, m in enumerate(mean)], *[c.alias(f"c{j}{k}") for (j, k), c in cov.items()], *rest)
    return let(first, lambda s: entry([], s))


_LOWER = [(j, k) for j, k in product(range(len(DIMS)), repeat=2) if k <= j]


def _moments(cells: Column, goal: Column) -> Column:
    """struct of the weight and first and second sums over the first cells, up to a total weight; the last counts in part."""
    names = ["n", *(f"s{j}" for j in range(len(DIMS))), *(f"q{j}{k}" for j, k in _LOWER)]

    def add(a: Column, c: Column) -> Column:
        w = F.greatest(F.lit(0.0), F.least(c["n"], goal - a["n"]))
        return F.struct(
            (a["n"] + w).alias("n"),
            *[(a[f"s{j}"] + w * c[x]).alias(f"s{j}") for j, x in enumerate(DIMS)],
            *[(a[f"q{j}{k}"] + w * c[DIMS[j]] * c[DIMS[k]]).alias(f"q{j}{k}") for j, k in _LOWER],
        )

    return F.aggregate(cells, F.struct(*[F.lit(0.0).alias(n) for n in names]), add)


def _estimate(m: Column) -> Column:
    """State from moments: mean, covariance with the floor added, its factor."""
    mean = [m[f"s{j}"] / m["n"] for j in range(len(DIMS))]
    cov = {}
    for j, k in _LOWER:
        c = (m[f"q{j}{k}"] / m["n"] - mean[j] * mean[k]) * CONSISTENT
        cov[j, k] = c + FLOOR[j] ** 2 if j == k else c
    return _factor(mean, cov, [])


def _concentrate(cells: Column, total: Column, state: Column) -> Column:
    """The estimate of the CORE share of the vectors that are nearest to the state; the last cell counts in part."""
    near = F.sort_array(
        F.transform(cells, lambda c: F.struct(_distance([c[x] for x in DIMS], state).alias("d"), *[c[x].alias(x) for x in DIMS], c["n"].alias("n")))
    )
    return let(_moments(near, F.ceil(total * CORE).cast("double")), _estimate)


def _median_start(cells: Column, total: Column) -> Column:
    """Centre at the coordinatewise medians with the floor's scale: a start that outliers don't move."""

    def median(x: str) -> Column:
        by = F.sort_array(F.transform(cells, lambda c: F.struct(c[x].alias("v"), c["n"].alias("n"))))
        start = F.struct(F.lit(0.0).alias("t"), F.lit(None).cast("double").alias("v"))
        step = lambda a, c: F.struct((a["t"] + c["n"]).alias("t"), F.coalesce(a["v"], F.when(a["t"] + c["n"] >= total / 2, c["v"])).alias("v"))
        return F.aggregate(by, start, step)["v"]

    cov = {(j, k): F.lit(4 * FLOOR[j] ** 2 if j == k else 0.0) for j, k in _LOWER}
    return _factor([median(x) for x in DIMS], cov, [])


def estimates(vectors: DataFrame) -> DataFrame:
    """(lang, source, x1..x4) -> (lang, source, state): the minimum-covariance-determinant estimate that holds for each group.

    It rests on the group, or on its language if the group has fewer than LEAST vectors, or on all vectors if the
    language has, too.
    """
    snapped = [
        (F.least(F.greatest(F.round(F.col(x) / step), F.lit(-float(most))), F.lit(float(most))) * step).alias(x)
        for x, step, most in zip(DIMS, STEPS, CELLS, strict=True)
    ]
    cells = vectors.select("lang", "source", *snapped).groupBy("lang", "source", *DIMS).agg(F.count(F.lit(1)).cast("double").alias("n"))
    cells = materialise(cells, "cells")
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("n")).join(cells.groupBy("lang").agg(F.sum("n").alias("of_lang")), "lang")
    pool = lambda level, lang, source: F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))
    pools = [pool(2, F.col("lang"), F.col("source")), pool(1, F.col("lang"), F.lit("")), pool(0, F.lit(""), F.lit(""))]
    placed = sizes.select("lang", "source", F.when(F.col("n") >= LEAST, pools[0]).when(F.col("of_lang") >= LEAST, pools[1]).otherwise(pools[2]).alias("pool"))
    widened = cells.select(F.explode(F.array(*pools)).alias("pool"), *DIMS, "n").join(placed.select("pool").distinct(), "pool", "left_semi")
    widened = widened.groupBy("pool", *DIMS).agg(F.sum("n").alias("n"))
    groups = widened.groupBy("pool").agg(F.sort_array(F.collect_list(F.struct(*DIMS, "n"))).alias("cells"), F.sum("n").alias("total"))
    c, total = F.col("cells"), F.col("total")

    def converge(start: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(CONCENTRATIONS)), start, lambda s, _: _concentrate(c, total, s))

    size = lambda s: F.log(s["l00"]) + F.log(s["l11"]) + F.log(s["l22"]) + F.log(s["l33"])
    chance = lambda x, k: F.pmod(F.xxhash64(*[x[d] for d in DIMS], F.lit(k)), F.lit(SUBSET))
    some = [F.filter(c, lambda x, k=k: chance(x, k) == 0) for k in range(SUBSETS)]
    subsets = [let(_moments(F.when(F.size(x) > 0, x).otherwise(c), total), _estimate) for x in some]
    starts = F.array(_median_start(c, total), let(_moments(c, total), _estimate), *subsets)
    ends = F.transform(starts, converge)
    best = F.aggregate(ends, F.get(ends, F.lit(0)), lambda a, x: F.when(size(x) < size(a), x).otherwise(a))
    return placed.join(groups.select("pool", best.alias("state")), "pool").select("lang", "source", "state")


def judge(docs: DataFrame, text: str = "text", carried: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) plus quality: struct<statistics.., base_failed, distance, kept>.

    Null texts have no words and fail the base. Null languages and sources are groups of their own. Every document
    that passes the base has a distance; for others it is null. Vectors are compared, not rows, so repeated rows and
    ties agree; an empty table gives an empty table. Texts are read whole, however long, and once: statistics and carried
    columns go to a table in the shared folder, from which the estimates and the verdict read. What is shuffled is cells;
    rows only where there are too many groups to broadcast their estimates. A carried column named quality gives way.
    """
    names = [c for c in (docs.columns if carried is None else carried) if c != "quality"]
    row = F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    group = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(c)
    measured = materialise(docs.select(row.alias("row"), statistics(F.col(f"`{text}`")).alias("s"), group("lang"), group("source")), "statistics")
    measured = measured.withColumn("failed", base_failed(F.col("s")))
    vectors = measured.where("not failed").select("lang", "source", *[v.alias(x) for v, x in zip(vector(F.col("s")), DIMS, strict=True)])
    found = materialise(estimates(vectors), "estimates")
    if found.count() <= FEW_GROUPS:
        joined = measured.join(F.broadcast(found), ["lang", "source"], "left")
    else:
        found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = measured.withColumn("salt", F.pmod(F.xxhash64("s", "row"), F.lit(SALTS)).cast("int"))
        joined = salted.join(found, ["lang", "source", "salt"], "left")
    distance = F.when(~F.col("failed") & F.col("state").isNotNull(), _distance(vector(F.col("s")), F.col("state")))
    joined = joined.withColumn("distance", distance)
    verdict = F.struct("s.*", F.col("failed").alias("base_failed"), "distance", (~F.col("failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).alias("kept"))
    return joined.select(*[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(names)], verdict.alias("quality"))
