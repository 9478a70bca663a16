"""Corpus pipeline over ``documents``: identify, dedup, cut repeats, mix, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
where ``docs`` has the columns of ``documents``, and all but the last return
those columns.  ``run`` writes every stage's result to the shared folder of
``spark.checkpoint.dir`` and reads it back as the next one's input, so a lost
executor costs no more than the stage it was working for.

Defined cases, for every stage: null and empty texts, null labels and
sources, repeated rows, empty tables and extra columns are carried or dropped
as the stage's docstring says; none fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ember.llm.langid import UNDETERMINED, fit, identify
from ember.llm.mixing import mix_sources
from ember.llm.packing import pack_documents
from ember.llm.setsketch import near_duplicates
from ember.llm.staging import staged
from ember.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE, PERCENT = 5, 80
WINDOW = 40                    # words that must repeat before a passage is cut
PORTION = 1000                 # copies of one row written by one task at most
TOKENIZER = "byte_bpe_50k.json"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_key``, a 64-bit hash of the whole row: rows that share an id are told apart, equal rows are one."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in COLUMNS] + [F.col(c).isNull() for c in COLUMNS]
    return docs.select(*COLUMNS, F.xxhash64(*told).alias("row_key"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is identified and fill in missing labels.

    Null texts and texts without a letter are undetermined and go; without any
    labelled row nothing can be learned and nothing is rejected.
    """
    docs = docs.select(COLUMNS)
    model = fit(docs)
    if not model.langs:
        return docs
    return identify(docs, model).filter(F.col("lang_pred") != UNDETERMINED).withColumn(
        "lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every near-duplicate group: that with the smallest id, between equal ids any one, always the same.

    Rows are grouped by their texts alone: rows that share an id but not a text are not linked by it.  Rows with a
    null id stay; rows equal in every column are one document.
    """
    docs = _keyed(docs)
    found = near_duplicates(docs.filter("doc_id IS NOT NULL").select(F.col("row_key").alias("doc_id"), "text"),
                            shingle=SHINGLE, percent=PERCENT)
    linked = found.filter("NOT kept").select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    # A group's smallest key is the only member that is "kept"; the group's ids then name the row that stays.
    members = staged(linked.unionByName(linked.select(F.col("component_id").alias("row_key"), "component_id").distinct())
                     .join(docs.select("row_key", F.col("doc_id").cast("long").alias("doc_id")).distinct(), "row_key"), "groups")
    stays = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_key")).alias("first"))
    copies = members.join(stays, "component_id").filter("row_key <> first.row_key").select("row_key")
    # The anti join leaves the rows dealt by key, so dropping equal rows moves nothing again.
    return docs.join(copies, "row_key", "left_anti").dropDuplicates(["row_key", *COLUMNS]).select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of ``WINDOW`` words that a document with a smaller id holds; a document of which nothing is left goes.

    Texts that lose nothing are kept byte for byte; a cut text is its kept words joined by spaces.  Every row is
    cut on its own, also where rows share an id.
    """
    cut = substring_dedup(docs.select(COLUMNS), window=WINDOW, carry=("text", "lang", "source", "n_chars"))
    some = F.col("n_removed") > 0
    text = F.when(some, F.col("kept_text")).otherwise(F.col("text"))
    return cut.filter(~some | (F.col("n_removed") < F.col("n_words"))).withColumn("text", text).withColumn(
        "n_chars", F.when(some, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat every document as often as the mix takes it (0 to 2 times).

    The mix decides row by row; of rows that are equal in every column as many come out as it takes of them together.
    """
    docs = _keyed(docs)
    taken = mix_sources(docs.select(F.col("row_key").alias("doc_id"), "text", "source")).groupBy(
        F.col("doc_id").alias("row_key")).agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("equal"))
    taken = staged(taken.filter("copies > 0"), "mix-taken")
    rows = docs.join(taken, "row_key")
    alone = rows.filter("equal = 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    # Equal rows meet as one and are repeated in portions, however many there are.
    same = rows.filter("equal > 1").dropDuplicates(["row_key", *COLUMNS]).withColumn("portion", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / PORTION).cast("int")))).repartition("row_key", "portion")
    same = same.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(
        F.lit(PORTION), F.col("copies") - F.col("portion") * PORTION))))
    return alone.select(COLUMNS).unionByName(same.select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in sequences of 2048 ids."""
    import public_tokenizers

    return pack_documents(docs.select(COLUMNS), public_tokenizers.path(TOKENIZER), length=2048, end_id=1, with_ids=False)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("cut_repeats", cut_repeats),
    ("mix", mix),
    ("pack", pack),
]

# SQL cannot express the classifier, the sketches or the tokenizer: tests hold the pipeline to a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
