"""A training corpus from raw documents: rules, copies, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import curriculum, minmax_dedup, outliers, pii, piece_bpe
from tillhouse.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the limits or the robust distance reject.

    Null and empty texts have no words and are rejected. Rows that repeat, or have a null
    id, language or source, are judged like any other. All columns stay as they are.
    """
    # The document goes along in one column, so that none of its columns is overwritten.
    rows = outliers.text_stats(docs.select("text", "lang", "source", F.struct(*docs.columns).alias("_doc")))
    model = outliers.fit(cut(rows.select("lang", "source", *outliers.STATS), "stage_stats"))
    # Not a filter: that would be pushed below the statistics and work them out again for
    # each mention.
    once = F.when(F.col("kept"), F.array(F.lit(True)))
    return outliers.judge(rows, model).select("_doc", F.explode(once)).select("_doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8.

    Texts without words and rows with a null id stay; rows that repeat an id stay or go together.
    """
    gone = cut(minmax_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id"), "stage_gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data replaced by their kind; `n_chars` follows the text.

    Every row stays; a null text stays null. Other columns stay as they are.
    """
    found = pii.candidates(pii.base_spans(docs.select("text", F.struct(*docs.columns).alias("_doc"))))
    model = pii.fit(cut(found.select("found", "half"), "stage_candidates"))
    clean = pii.select_spans(found, model).select("_doc", pii.redact(F.col("text"), F.col("spans")).alias("_clean"))
    new = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return clean.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order, as often as it takes them."""
    mixed = cut(curriculum.mix_sources(docs).select("doc_id", "positions"), "stage_mix")
    return curriculum.in_order(docs, mixed)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to it again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_bpe.decode(piece_bpe.encode(docs.select("doc_id", "source", "text"), model), model)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("PII", redact_pii),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: No stage but the mix could be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage_" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
