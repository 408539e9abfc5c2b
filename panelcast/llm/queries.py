"""Registered queries of the operators for training text, each over its whole tables, and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom_lm, bpe, cdc, chains, gam, langid, lines, merkle, mixing, rules, simhash, substrings, whitening

SPECIAL = {"<|endoftext|>": 50256}


def vocabulary() -> str:
    """Path of the public byte-level vocabulary, as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(n: int = 5):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_line_dedup(spark, sf_dir):
    out = lines.drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_lm_scoring(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", F.coalesce(fold() == 1, F.lit(False)))
    model = bloom_lm.learn(docs.where(~F.col("held_out")))
    out = bloom_lm.score(docs, model, ["doc_id", "held_out"])
    model.destroy()
    return out


def op3_toxicity(spark, sf_dir):
    out = chains.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("unfit", 1 - F.col("quality")),
                          ["unfit", "toxic"], learn_from=fold() != 0)
    return out.select("doc_id", (fold() == 0).alias("held_out"), "p_unfit", F.col("p_toxic").alias("score"), F.col("toxic").alias("predicted"))


def op4_mixing(spark, sf_dir):
    return mixing.mixed(documents(spark, sf_dir).select("doc_id", "source"))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_substring_dedup(spark, sf_dir):
    return substrings.without_repeats(documents(spark, sf_dir).select("doc_id", "text"), with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op7_fingerprints(spark, sf_dir):
    return cdc.compare_with_edits(documents(spark, sf_dir))


def op8_bpe(spark, sf_dir):
    return bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(), SPECIAL).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_quality(spark, sf_dir):
    out = gam.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from=fold() != 0)
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


def op10_quality_rules(spark, sf_dir):
    return rules.apply_rules(documents(spark, sf_dir).select("doc_id", "source", "text")).select(
        "doc_id", *rules.STATS, "base_failed", "host_rate", "kept")


def op11_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return langid.classify(docs, fold() != 0).select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "encoded_size", "rejected")


def op12_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_manifest(spark, sf_dir):
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    more = F.col("n_chars").cast("decimal(20,0)") + F.when(changed, 1).otherwise(0)
    out = merkle.manifest(documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"n_chars": more})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_lm_scoring, op3_toxicity, op4_mixing, op5_simhash, op6_substring_dedup,
                                   op7_fingerprints, op8_bpe, op9_quality, op10_quality_rules, op11_language, op12_whitening,
                                   op13_manifest)}
SQL = {"op1_line_dedup": lines.oracle(), "op4_mixing": mixing.oracle(), "op13_manifest": merkle.ORACLE}
