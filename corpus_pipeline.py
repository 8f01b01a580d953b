"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

Every stage but the last returns the columns of documents. Nulls, repeated rows and empty
tables are treated as the stages' operators state; extra columns pass unchanged whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm import langid, toxicity
from tallygrove.llm._common import crc_mod, fresh, materialise
from tallygrove.llm.line_dedup import drop_boilerplate
from tallygrove.llm.packing import pack_documents
from tallygrove.llm.queries import train_langid, train_toxicity
from tallygrove.llm.simhash import near_dedup


def stage_langid(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go, and those whose score is below what held-out documents of their length have."""
    model = train_langid(docs)
    if model is None:  # nothing to learn from: what has a letter stays
        return docs.where("text rlike '\\\\p{L}'")
    least = langid.calibrate(docs.where(crc_mod(F.col("doc_id"), 4) == 2), model)
    told_as = fresh(docs, "lang_told")
    told = docs.withColumn(told_as, langid.predict_udf(model)("text"))
    return told.where(langid.credible(F.col(f"{told_as}.lang"), F.col(f"{told_as}.score"), F.col("text"), least)).drop(told_as)


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    score = fresh(docs, "score_told")
    told = docs.withColumn(score, toxicity.score_udf(train_toxicity(spark, docs, sf_dir))("text"))
    return told.where(F.col(score) < 0.5).drop(score)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source are cut; n_chars follows the text."""
    return drop_boilerplate(docs, report=None).withColumn("n_chars", F.char_length("text").cast("long"))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each near-duplicate group stays: the first by id, rows without one last, then by row number."""
    row, place = fresh(docs, "row_told"), fresh(docs, "place_told")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    # a table of its own: the numbers must be the same in both uses
    rows = materialise(rows.withColumn(place, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"))), "numbered")
    keep = near_dedup(rows, id_col=place).where("doc_id = component_id").select(F.col("doc_id.row").alias(row))
    return rows.join(keep, row, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed."""
    return pack_documents(docs)


STAGES = [
    ("langid", stage_langid),
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("near_dedup", stage_near_dedup),
    ("packing", stage_packing),
]

#: The stages learn models and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; every stage's result but the last is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
