"""The operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workdir import work_dir
from . import (
    ann,
    centroids,
    language,
    lines,
    manifest,
    mixture,
    near_duplicates,
    neighbours,
    packing,
    quality,
    secrets,
    shards,
    token_file,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents of the training fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


@query("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    names = secrets.kind_names()
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("secrets", _of_kind(kind))).cast("long").alias(f"n_{names[kind]}")
            for kind in range(3)
        ],
        F.sha2(secrets.spans_text(base, names), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets"), names).alias("spans"),
    )


@query("op3_mixture")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixture.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op4_line_templates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines dropped, and its text without them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_recurring_lines(docs).select("doc_id", "n_lines", "dropped", "is_copy", "text")


@query("op5_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place in it."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        # The ring reads the text only where there is no key.
        F.when(F.col("doc_id").isNull(), F.col("text")).alias("text"),
    )
    return shards.assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_probminhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of copies and near copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates.near_duplicates(docs).select("doc_id", "class_id", "class_rows", "kept")


@query("op7_length_buckets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bucket, batch and padding."""
    packed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "length", "bucket", "boundary", "batch", "place", "padding")


@query("op9_nn_descent")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's number of links and its component."""
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_hnsw")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest others of every fiftieth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query("op8_kneser_ney")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's perplexity under a model of the documents labelled good and not toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    good = table(spark, sf_dir, "labels").filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    # Labels grow with the documents, so their join is a shuffle at any size.
    trusted = docs.join(good.hint("merge"), "doc_id", "left_semi")
    scored = quality.score_quality(docs, trusted, columns=["doc_id", "lang"])
    return scored.select("doc_id", "lang", "n_scored", "perplexity", "adjusted", "threshold", "kept")


#: Id 1 ends a document in the vocabulary of the token files.
END_ID = 1


@query("op11_huffman")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, coded into files and decoded again: where they begin, how many, their checksum."""
    from public_tokenizers import path

    files = work_dir(spark, "token-files")
    tokenizer = token_file.json_of(path("word_bpe_49k.json"))
    token_file.write_ids(table(spark, sf_dir, "documents"), files, tokenizer, END_ID, by_word=True)
    return token_file.read_ids(spark, files)


@query("op12_merkle")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof; those whose key's checksum 7 divides are held against one more character."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    other = manifest.leaf_hash(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"])
    return manifest.merkle_manifest(docs, manifest.leaf_hash(fields), F.when(changed, other))


@query("op13_bisectors")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster, distance and the sums of distances."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))
