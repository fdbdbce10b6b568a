"""From raw documents to token ids: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents (COLUMNS), and no others that docs may have. Rows
go or stay each for itself: repeated rows, rows that share an id and rows without an id are told apart as the stages say.
An empty table goes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm._common import table
from placeflow.llm.bpe import encode
from placeflow.llm.decontaminate import remove_contamination
from placeflow.llm.line_dedup import drop_repeated_lines
from placeflow.llm.ngram_join import near_duplicates
from placeflow.llm.queries import toxicity_model
from placeflow.llm.toxicity import drop_toxic
from placeflow.scratch import save

#: Rows of two numbers (some 100 bytes each in memory) that may be sent to all tasks.
GONE = 500_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score reaches the threshold. A null or empty text scores the model's bias, and a row without an id is scored like any other; without labels of both kinds nothing goes. Texts are read whole."""
    return drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that at least five documents share; n_chars follows the text.

    Rows that share an id, and all rows without one, count as one document; a null text is one empty line, and comes out as an empty text.
    """
    kept = drop_repeated_lines(docs, 40, 5, carry=True)
    changed = F.col("n_dropped") > 0
    return kept.select(F.col("row.doc_id"), "text", F.col("row.lang"), F.col("row.source"), F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id.

    A row goes by its id and text: an unlike row that shares the id of one that goes stays, and so do all rows that
    share both with the one that stays. Texts without words have no copies; a row without an id never goes, and stands for no other. What goes
    is sent to the documents if it is at most GONE rows; else both are shuffled.
    """
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    kept = near_duplicates(docs.select("doc_id", "text", text_key.alias("text_key")), 4, 85, carry=("text_key",))
    gone = kept.where("component_id <> doc_id").select("doc_id", "text_key").distinct()
    gone = save(gone, "pipeline-copies")
    if gone.count() <= GONE:
        gone = F.broadcast(gone)
    return docs.withColumn("text_key", text_key).join(gone, ["doc_id", "text_key"], "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that benchmark items contaminate; texts without words, null ones included, never are, and an empty benchmark takes none."""
    return remove_contamination(docs, table(spark, sf_dir, "benchmark"), 13, 20).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of what is left: a row for each row; a null text has no ids."""
    return encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("n-gram jaccard join", near_duplicate), ("benchmark decontamination", decontamination), ("bpe encoding and decoding", tokens)]

#: SQL can't express the learnt scores of the first stage or the merges of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
