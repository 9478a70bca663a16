"""The registered ``opN_<name>`` queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ember.llm.bitsliced import top_k_products
from ember.llm.chat import format_conversations, read_back
from ember.llm.histogram_sort import shard_by_bytes
from ember.llm.id_store import read_documents, write_store
from ember.llm.kmeans_tree import nearest
from ember.llm.langid import fit, identify
from ember.llm.mixing import mix_sources
from ember.llm.packing import pack_documents
from ember.llm.periodic_runs import periodic_runs
from ember.llm.prefix_tokens import count_tokens
from ember.llm.setsketch import near_duplicates
from ember.llm.substring_dedup import substring_dedup
from ember.llm.textkit import WORD_PATTERN
from ember.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def _tokenizer(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_read(spark, sf_dir, "documents"), window=13).drop("kept_text")


def op2_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_products(_read(spark, sf_dir, "embeddings"), k=20)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = fit(docs, docs_per_lang=2000)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_read(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), share=1.5, cap=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op6_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_read(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), limit=4096)


def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_read(spark, sf_dir, "embeddings"), k=20)


# A conversation whose texts hold control strings of the template.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    path = _tokenizer("byte_bpe_50k.json")
    return read_back(format_conversations(turns.unionByName(extra), path), path)


def op9_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_by_bytes(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), length=2048, end_id=1,
                          with_ids=False)


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the documents, told by the id's crc32, repeat a stretch of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(WORD_PATTERN), F.lit(0))
    planted = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"), g.alias("g")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.greatest(F.size("w"), F.lit(1)).cast("long"))
    planted = planted.withColumn("a", F.col("g") % F.col("n")).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    repeated = F.array_join(F.transform("w", lambda _, i: F.get("w", F.when(
        i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int"))), " ")
    return planted.select("doc_id", F.when(F.size("w") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(_read(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    # The first of the runs with the greatest length / period: fractions are compared by products.
    best = F.when(F.size("runs") > 0, F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda a, b: F.when(
        b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    manifest = write_store(docs, _tokenizer("byte_bpe_50k.json"), end_id=0)
    return read_documents(docs.select("doc_id"), manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_read(spark, sf_dir, "embeddings"), components=8)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bit_sliced": op2_bit_sliced,
    "op3_language_id": op3_language_id,
    "op4_mixing": op4_mixing,
    "op5_setsketch": op5_setsketch,
    "op6_prefix_tokens": op6_prefix_tokens,
    "op7_kmeans_tree": op7_kmeans_tree,
    "op8_chat_format": op8_chat_format,
    "op9_histogram_sort": op9_histogram_sort,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_id_store": op12_id_store,
    "op13_whitening": op13_whitening,
}
