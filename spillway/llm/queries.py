"""The operators bound to their tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.llm import conversation_trie, decontaminate, embedding_dedup, html_text, language_model, line_dedup, minhash_dedup, mixing, periodic_runs, personal_data, secrets, sharding, toxicity
from spillway.llm.common import Workspace, table

SHARDS = 40


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "op2"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), Workspace(spark, "op3"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"), Workspace(spark, "op4"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), Workspace(spark, "op6"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op7"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.manifest(table(spark, sf_dir, "documents"), SHARDS, Workspace(spark, "op8"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), Workspace(spark, "op10"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"), Workspace(spark, "op11"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), repeat_seed=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    # the longest run; of equal ones the first, then that of the smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return (found.withColumn("longest", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
                    F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
                    F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"), Workspace(spark, "op13"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*personal_data.BASE_KINDS))
    return found.select("doc_id", *map(of, personal_data.BASE_KINDS), F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_secrets": op5_secrets,
    "op6_mix_sources": op6_mix_sources,
    "op7_decontaminate": op7_decontaminate,
    "op8_shards": op8_shards,
    "op9_html_text": op9_html_text,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_personal_data": op13_personal_data,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
        seen AS (SELECT DISTINCT trim(x) AS line, source
                 FROM (SELECT unnest(string_split(text, chr(10))) AS x, source FROM d) WHERE trim(x) <> ''),
        bad AS (SELECT line FROM seen GROUP BY line HAVING count(*) >= {line_dedup.MIN_SITES}),
        cut AS (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF trim(x) <> ''] AS solid,
                       [x FOR x IN string_split(text, chr(10)) IF NOT list_contains(gone, trim(x))] AS kept
                FROM d, (SELECT coalesce(list(line), []) AS gone FROM bad))
        SELECT doc_id, CAST(len(solid) AS BIGINT) AS n_lines,
               CAST(len(solid) - len([x FOR x IN kept IF trim(x) <> '']) AS BIGINT) AS n_removed,
               array_to_string(kept, chr(10)) AS text
        FROM cut""",
}
