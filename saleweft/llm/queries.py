"""The registered queries of this subpackage, and their SQL where SQL can say it.

Each query applies one operator with production parameters to its whole table and
derives the columns it returns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saleweft.session import scratch_path

from .alignment import align_tokenizers
from .common import held_out, settle, small_batches
from .decontam import find_leaks
from .fingerprints import likeness, near_fingerprints, simhash64, with_next
from .licenses import scan_licences
from .neardup import near_duplicate_groups
from .packing import pack_documents
from .quality import fit_quality, score_quality
from .recipes import exact_copies
from .sharding import interleave
from .substring import cut_repeats
from .toxicity import fit_toxicity, score_toxicity
from .warc import page_id_of, read_archive, write_archive
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
  FROM words, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM places GROUP BY gram),
hits AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT p.doc_id, p.i FROM places p JOIN firsts f USING (gram) WHERE f.first_id < p.doc_id),
       LATERAL (SELECT unnest(range(0, 13)) AS k)),
kept AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
  WHERE (doc_id, i) NOT IN (SELECT doc_id, i FROM hits) GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id
"""


@query("op5_substring_dedup", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Words covered by a 13-word window that an earlier document has are removed."""
    cut = cut_repeats(table(spark, folder, "documents"), window=13)
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose 4-word fingerprints differ in 4 bits or fewer, over links."""
    groups = near_duplicate_groups(table(spark, folder, "documents"), shingle=4, radius=4)
    return groups.select("doc_id", _hex("f0").alias("fingerprint"), "component_id")


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity by compression distance."""
    docs = table(spark, folder, "documents")
    model = fit_toxicity(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality by pairwise ranking."""
    docs = table(spark, folder, "documents")
    model = fit_quality(docs, table(spark, folder, "labels"))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op4_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' token pieces in sequences of at most 4096."""
    docs = table(spark, folder, "documents")
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), capacity=4096)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_sharding")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of nearly equal row counts and the same mixture."""
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    return interleave(docs, 8, carry=["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op9_fingerprints")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and their edits; matches of every hundredth document."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "tie", F.xxhash64("text")).withColumn("mark", simhash64(F.col("text")))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.left("text", (F.col("n_chars") - third).cast("int"))
    edited = with_next(docs, ["doc_id", "tie"], ["text", "mark"]).withColumn(
        "edited", F.concat(kept, F.left("next.text", third)))
    marked = settle(edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "mark",
        simhash64(F.col("edited")).alias("edited_mark"), F.col("next.mark").alias("next_mark")), "fingerprints")
    counts = marked.groupBy(F.col("mark").alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"))
    asked = marked.where("doc_id % 100 = 0").select(F.col("mark").alias("fingerprint"))
    found = near_fingerprints(asked, counts, radius=3).join(counts, F.col("found") == F.col("fingerprint"))
    near = settle(found.groupBy(F.col("query").alias("asked")).agg(F.sum("n").alias("n_near")), "near-counts")
    hit = (F.col("doc_id") % 100 == 0) & (F.col("mark") == F.col("asked"))
    return marked.join(near, hit, "left").select(
        "doc_id", "n_chars", "edited_sha256", _hex("mark").alias("fingerprint"),
        _hex("edited_mark").alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next_mark")).alias("near_next"), "n_near")


def _hex(name: str) -> Column:
    return F.lpad(F.lower(F.hex(name)), 16, "0")


@query("op6_license_scan")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    def labels(*columns: str) -> Column:
        named = F.concat(*[F.transform(c, lambda m: m["label"]) for c in columns])
        return F.array_join(F.sort_array(F.array_distinct(named)), ",")

    places = F.transform("phrases", lambda m: m["first"])
    found = scan_licences(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels("phrases").alias("base_labels"), labels("phrases", "notices").alias("labels"),
        F.coalesce(F.array_max(F.transform(F.concat("phrases", "notices"), lambda m: m["share"])), F.lit(0.0)).alias("score"))


@query("op8_warc", """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS kept FROM sized)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND kept <> page_id THEN kept END AS refers_to
FROM marked
""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written to archives and read back."""
    path = scratch_path(spark, "archive")
    write_archive(table(spark, folder, "pages"), path, date="2024-01-01T00:00:00Z")
    read = settle(read_archive(spark, path).select(
        page_id_of(F.col("record_id")).alias("page_id"), "record_type",
        page_id_of(F.col("refers_to")).alias("refers_to"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("problem").isNull(), F.sha1("payload")).otherwise(F.raise_error("problem")).alias("payload_digest"),
        "declared_digest"), "captures")
    # a revisit's payload is that of the capture it refers to, checked against its own digest
    origin = read.where("record_type = 'response'").select(
        F.col("page_id").alias("origin_id"), F.col("payload_bytes").alias("origin_bytes"),
        F.col("payload_digest").alias("origin_digest")).distinct()
    same = (F.col("refers_to") == F.col("origin_id")) & (F.col("declared_digest") == F.col("origin_digest"))
    joined = read.join(origin, same, "left")
    revisit = F.col("record_type") == "revisit"
    return joined.select(
        "page_id", F.when(revisit, F.col("origin_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("origin_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


@query("op7_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that cover most of a benchmark item, with each item they cover."""
    pairs = find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return pairs.select("doc_id", "item_id", "coverage", F.size("tiles").cast("long").alias("n_tiles"),
                        F.array_max(F.transform("tiles", lambda t: t["words"])).cast("long").alias("longest_tile"))


@query("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's byte-level and SentencePiece tokens in groups, and their links over the corpus."""
    return align_tokenizers(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"),
                            tokenizer_path("piece_bpe_32k.model"))


@query("op12_exact_dedup", """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM folded WINDOW same AS (PARTITION BY t)
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    return exact_copies(table(spark, folder, "documents"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding on the 16 leading components, each with unit variance."""
    return whiten(table(spark, folder, "embeddings"), components=16, scale=64, shift=1_000_000)


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    from corpus_pipeline import run

    return run(spark, folder)
