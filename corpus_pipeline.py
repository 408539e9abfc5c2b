"""Five stages from raw documents to token ids, each written before the next one starts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe, lines, mixing, queries, rules, simhash
from panelcast.sources.staging import write_once


def apart(docs: DataFrame, operator, *results: str) -> DataFrame:
    """Columns of ``docs`` and ``results`` (as ``new__...``) of ``operator``, whose other names cannot clash with them."""
    own = {c: c if c in ("doc_id", "text", "source") else f"own__{c}" for c in docs.columns}
    out = operator(docs.withColumnsRenamed(own))
    return out.select(*[F.col(v).alias(k) for k, v in own.items()], *[F.col(r).alias(f"new__{r}") for r in results])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    return apart(docs, rules.apply_rules, "kept").where("new__kept").drop("new__kept")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs; ``n_chars`` follows the text."""
    out = apart(docs, lines.drop_lines)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, once; a row without an id stays."""
    groups = simhash.near_duplicates(docs)
    stay = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    once = docs.join(stay, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"])
    return once.select(*docs.columns).union(docs.where("doc_id is null"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their files and rows in the order of the mixture."""
    return apart(docs, mixing.mixed, "place").orderBy("new__place").drop("new__place")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the hash of what they decode to and its place in the mixture, ordered by it.

    Files are not read in the order in which they were written, so the places are worked out again;
    they follow from ``doc_id`` and ``source`` alone.
    """
    out = bpe.encode(docs.select("doc_id", "source", "text"), queries.vocabulary(), queries.SPECIAL, with_ids=True).drop("text")
    return mixing.mixed(out).select("doc_id", "source", "units", "block", "slot", "place", "n_tokens", "ids", "ids_sha256",
                                    "decoded_sha256").orderBy("place")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
          ("mixing_sources", mixing_sources), ("bpe_encoding", tokens)]
#: SimHash and BPE have no SQL; the tests run all stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return docs
