"""The registered queries of the training-data operators.

Each takes ``(spark, sf_dir)``, applies its operator with production parameters to whole
tables and returns the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.llm import byte_merges, decontaminate, html_consensus, license_scan, piece_stream, quality_features, toxicity_grammar
from quorum.llm.common import read
from quorum.llm.embedding_graph import near_vectors
from quorum.llm.gnat_codes import compress
from quorum.llm.minhash_forest import near_duplicates
from quorum.llm.ns_clusters import cluster
from quorum.llm.suffix_runs import remove_repeats
from quorum.llm.warc_zip import archived_pages


def op1_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents on 4-word shingles at Jaccard 0.8."""
    return near_duplicates(read(spark, sf_dir, "documents"), k=4, percent=80) \
        .withColumnRenamed("id", "doc_id")


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's record after writing ZIP-packaged archives and reading them by ranges."""
    return archived_pages(spark, read(spark, sf_dir, "pages"))


def op3_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page along its host's winning container paths."""
    return html_consensus.extract(read(spark, sf_dir, "pages")) \
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of each document without 50-byte strings of earlier documents."""
    return remove_repeats(read(spark, sf_dir, "documents"), keep_text=False) \
        .select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document by the clause grammar; fold 0 of 5 is held out."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity_grammar.fit(docs, read(spark, sf_dir, "labels"), toxicity_grammar.held_out("doc", 5, 0))
    return toxicity_grammar.score(docs, model).select(
        F.col("id").alias("doc_id"), toxicity_grammar.held_out("id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors at cosine 0.9 by searches of pruned graphs."""
    return near_vectors(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op7_piece_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document and whether decoding them gives its text back."""
    return piece_stream.encode(read(spark, sf_dir, "documents"), piece_stream.load()) \
        .select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


def op8_quality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document by random Fourier features; fold 1 of 3 is held out."""
    docs = read(spark, sf_dir, "documents")
    model = quality_features.fit(docs, read(spark, sf_dir, "labels"), toxicity_grammar.held_out("doc", 3, 1))
    return quality_features.score(docs, model).select(
        F.col("id").alias("doc_id"), toxicity_grammar.held_out("id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that occur in each document, within their edit budgets."""
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), (F.size("matches") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("matches.item_id")).alias("items"),
        F.array_min("matches.edits").alias("least_edits"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses whose notices each document holds."""
    return license_scan.scan(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.transform("matches", lambda m: m["license"]).alias("licenses"),
        F.transform("matches", lambda m: m["containment"]).alias("containments"),
        F.transform("matches", lambda m: m["start"]).alias("first_words"))


def op11_ns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rounds of 8 centroids over the 64-component vectors, bounds instead of rescans."""
    return cluster(read(spark, sf_dir, "embeddings")).drop("evaluations").withColumnRenamed("id", "vec_id")


def op12_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four bytes per vector: its parts' nearest entries, found by GNAT searches."""
    return compress(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_byte_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document, and the bytes that decoding them gives."""
    vocabulary = byte_merges.load()
    ids = byte_merges.encode(read(spark, sf_dir, "documents"), vocabulary)
    digested = ids.select("id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"))
    return byte_merges.decode(digested, vocabulary, carry=("n_tokens", "ids_sha256")).select(
        F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_forest": op1_minhash_forest,
    "op2_warc_zip": op2_warc_zip,
    "op3_html_consensus": op3_html_consensus,
    "op4_suffix_runs": op4_suffix_runs,
    "op5_toxicity_grammar": op5_toxicity_grammar,
    "op6_embedding_graph": op6_embedding_graph,
    "op7_piece_stream": op7_piece_stream,
    "op8_quality_features": op8_quality_features,
    "op9_decontaminate": op9_decontaminate,
    "op10_license_scan": op10_license_scan,
    "op11_ns_clusters": op11_ns_clusters,
    "op12_gnat_codes": op12_gnat_codes,
    "op13_byte_merges": op13_byte_merges,
}
