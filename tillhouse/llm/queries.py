"""The registered queries of this package. Each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import curriculum, embedding_dedup, host_reputation, language_id, line_dedup, lm_scoring, minmax_dedup, outliers, periodic_runs, pii, piece_bpe, substring_dedup, whitening
from tillhouse.llm.common import cut, table
from tillhouse.llm.oracle import ORACLE  # noqa: F401  read by the entry module


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """`host, bad` of the pages whose document, the last number of their path, is labelled.

    A page is bad when its document is toxic or of low quality.
    """
    named = pages.select(
        host_reputation.host_of(F.col("url")).alias("host"),
        F.regexp_extract(host_reputation.path_of(F.col("url")), "/([0-9]{1,18})(?:[./]|$)", 1).try_cast("bigint").alias("doc"),
    )
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    outcomes = labels.select(F.col("doc_id").alias("doc"), bad.alias("bad"))
    return named.join(outcomes, "doc").select("host", "bad")


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = host_reputation.judge(pages, page_outcomes(pages, table(spark, sf_dir, "labels")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as good and not toxic."""
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op2_interval_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.remove(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language_id.identify(rows, samples).drop("text")


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = cut(outliers.text_stats(docs).drop("text"), "text_stats")
    judged = outliers.judge(stats, outliers.fit(stats))
    return judged.select("doc_id", *outliers.BASE, "base_failed", "kept", "distance")


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    count = lambda order: F.size(F.filter("base", lambda s: s["order"] == order)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS[:4])],
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"),
    )


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op9_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = piece_bpe.decode(piece_bpe.encode(docs, model).drop("text"), model)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_rows(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    # Bound below the Python step, so that its result is not worked out for each mention.
    found = periodic_runs.find_runs(docs).select("doc_id", "runs", "collapsed", periodic_runs.strongest(F.col("runs")).alias("best"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_cross_entropy_difference": op1_cross_entropy_difference,
    "op2_interval_trees": op2_interval_trees,
    "op3_cross_parsing": op3_cross_parsing,
    "op4_host_reputation": op4_host_reputation,
    "op5_minmax_dedup": op5_minmax_dedup,
    "op6_robust_outliers": op6_robust_outliers,
    "op7_boosted_pii": op7_boosted_pii,
    "op8_curriculum_mix": op8_curriculum_mix,
    "op9_pca_tiles": op9_pca_tiles,
    "op10_piece_bpe": op10_piece_bpe,
    "op11_jacobi_davidson": op11_jacobi_davidson,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}
