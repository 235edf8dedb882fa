"""The registered queries of the operators, thin digests of their results, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, langid, licenses, mixing, packing, periodic, pivots, quality, repeats, resample, secrets, simhash, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = F.col("license_scan")
    return scanned.select(
        "doc_id",
        F.size(x["identifiers"]).cast("long").alias("n_sentences"),
        F.array_join(x["licenses"], ",").alias("licenses"),
        F.array_join(x["unmatched"], ",").alias("unmatched"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), carried=["doc_id"])
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
    return judged.select("doc_id", *[f"quality.{x}" for x in fields])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.where(F.col("doc_id").isNotNull() & ~out))
    found = langid.identify(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out")])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_log(chat.streamed_log(said.unionByName(own))))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), secrets.network(), [F.col("doc_id")])
    of = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.digest(base), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade(docs, model, [F.col("doc_id")])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.assign(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    words = F.aggregate("mix.copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", words.alias("taken"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", periodic.planted(F.col("text"), F.col("doc_id")))
    found = periodic.periodic_runs(docs, [F.col("doc_id")]).withColumn("top", periodic.strongest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_quality_rules": op2_quality_rules,
        "op3_language_id": op3_language_id,
        "op4_chat_format": op4_chat_format,
        "op5_embedding_near_dedup": op5_embedding_near_dedup,
        "op6_secret_scan": op6_secret_scan,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_packing": op8_packing,
        "op9_toxicity": op9_toxicity,
        "op10_mixing": op10_mixing,
        "op11_suffix_array_dedup": op11_suffix_array_dedup,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_importance_resampling": op13_importance_resampling,
    }


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS dkey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
blocks AS (
  SELECT skey, substr(dkey, 1, 3) AS block, CAST(sum(size) AS BIGINT) AS block_size FROM sized GROUP BY ALL),
sources AS (
  SELECT skey, CAST(sum(block_size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS INT)] AS w
  FROM blocks GROUP BY skey),
running AS (
  SELECT *, 3 * sum(source_size) OVER () AS thrice, sum(w) OVER () AS w_all,
         coalesce(sum(2 * source_size) OVER prior, 0) AS c_before, coalesce(sum(w) OVER prior, 0) AS w_before
  FROM sources
  WINDOW prior AS (ORDER BY CAST(source_size AS DOUBLE) / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (
  SELECT *, w * (thrice - 2 * c_before) >= 4 * source_size * (w_all - w_before) AS capped FROM running),
targets AS (
  SELECT skey, source_size,
         CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST(w * (thrice - 2 * coalesce(sum(2 * source_size) FILTER (capped) OVER (), 0)) AS DOUBLE)
                   / CAST(2 * (w_all - coalesce(sum(w) FILTER (capped) OVER (), 0)) AS DOUBLE) END AS target
  FROM capped),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target + 0.5) / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM targets),
rests AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) - whole * source_size AS rest FROM parts),
decided AS (
  SELECT skey, block, source_size, target, whole, greatest(0, least(rest - coalesce(sum(block_size) OVER (
           PARTITION BY skey ORDER BY md5('mix-1|' || skey || '|' || block), block
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), block_size)) AS extra
  FROM blocks JOIN rests USING (skey))
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(extra - coalesce(sum(size) OVER (
           PARTITION BY skey, block ORDER BY dkey, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), size)) AS BIGINT) AS taken
FROM sized JOIN decided ON sized.skey = decided.skey AND substr(dkey, 1, 3) = decided.block
"""
OP10_SQL = OP10_SQL.replace("PARTITION BY skey, block ORDER BY dkey", "PARTITION BY sized.skey, decided.block ORDER BY dkey")


def _op1_sql() -> str:
    """Sentences by the same splits, known ones from a table; rules fold over a struct of what is left and what was found."""
    known = dict((s, i) for i, s in reversed(licenses.SENTENCES))
    table = ", ".join(f"('{s}', '{i}')" for s, i in known.items())
    plain = "lower(coalesce(text, ''))"
    for pattern, by in licenses.STEPS:
        quoted = lambda x: x.replace("'", "''").replace(licenses.END, "\\x02")
        new = "chr(2) || '\\1'" if by == licenses.END + "\\1" else "chr(2)" if by == licenses.END else "chr(10)" if by == "\n" else f"'{by}'"
        plain = f"regexp_replace({plain}, '{quoted(pattern)}', {new}, 'g')"
    steps = []
    for k, (name, ids) in enumerate(licenses.RULES):
        rule = f";{';;'.join(ids)};"
        steps.append(
            f"r{k} AS (SELECT doc_id, n_sentences, replace(left_over, '{rule}', '|') AS left_over, "
            f"list_concat(found, list_transform(range(CAST((length(left_over) - length(replace(left_over, '{rule}', ''))) / {len(rule)} AS BIGINT)), "
            f"lambda i: '{name}')) AS found FROM {f'r{k - 1}' if k else 'listed'})"
        )
    return rf"""
WITH known(sentence, id) AS (VALUES {table}),
numbered AS (SELECT row_number() OVER () AS n, doc_id, {plain} AS plain FROM documents),
cut AS (SELECT n, generate_subscripts(string_split(plain, chr(2)), 1) AS pos, unnest(string_split(plain, chr(2))) AS sentence FROM numbered),
lined AS (SELECT n, pos, list_filter(list_transform(string_split(sentence, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM cut),
whole AS (SELECT n, pos, 0 AS line, id FROM lined JOIN known ON array_to_string(lines, ' ') = sentence),
pieces AS (
  SELECT n, pos, flatten(list_transform(lines, lambda x: CASE WHEN starts_with(x, '{licenses.TAG}')
         THEN list_transform(regexp_split_to_array(substr(x, {len(licenses.TAG) + 1}), '{licenses.JOINS}'), lambda y: '{licenses.TAG}' || trim(y)) ELSE [x] END)) AS lines
  FROM lined),
parts AS (SELECT n, pos, generate_subscripts(lines, 1) AS line, unnest(lines) AS one FROM pieces),
single AS (SELECT n, pos, line, id FROM parts JOIN known ON one = sentence WHERE NOT EXISTS (SELECT 1 FROM whole WHERE whole.n = parts.n AND whole.pos = parts.pos)),
ids AS (SELECT n, list(id ORDER BY pos, line) AS ids FROM (SELECT * FROM whole UNION ALL SELECT * FROM single) GROUP BY n),
listed AS (
  SELECT doc_id, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_sentences,
         CASE WHEN len(ids) > 0 THEN ';' || array_to_string(ids, ';;') || ';' ELSE '' END AS left_over, []::VARCHAR[] AS found
  FROM numbered LEFT JOIN ids USING (n)),
{", ".join(steps)}
SELECT doc_id, n_sentences, coalesce(array_to_string(found, ','), '') AS licenses,
       coalesce(array_to_string(list_filter(regexp_split_to_array(left_over, '[;|]+'), lambda x: x <> ''), ','), '') AS unmatched
FROM r{len(licenses.RULES) - 1}
"""


OP13_SQL = r"""
WITH steps AS (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
  FROM (SELECT unnest(range(CAST(0 AS BIGINT), 256)) AS i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps),
said AS (
  SELECT row_number() OVER () AS u, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM documents),
wanted AS (
  SELECT unnest(list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS w
  FROM benchmark),
rows AS (SELECT u, unnest(ws) AS w FROM said),
coded AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM rows UNION SELECT w FROM wanted)),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(length(h) / 2 AS BIGINT)),
             lambda i: CAST(16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT))),
           lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM coded, crc),
source AS (SELECT bucket, count(*) AS s FROM rows JOIN hashed USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT sum(s) FROM source) + 10000)::DOUBLE)
           / ((s + 1.0::DOUBLE) * (coalesce((SELECT sum(t) FROM target), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM source LEFT JOIN target USING (bucket)),
weights AS (SELECT u, CAST(sum(gain) AS BIGINT) AS weight FROM rows JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY u),
keyed AS (
  SELECT u, doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT)::DOUBLE AS h
  FROM said LEFT JOIN weights USING (u)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))) AS BIGINT) AS score FROM keyed),
able AS (SELECT u, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN able USING (u)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _op1_sql(), "op10_mixing": OP10_SQL, "op13_importance_resampling": OP13_SQL}
