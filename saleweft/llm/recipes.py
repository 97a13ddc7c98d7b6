"""Exact copies through content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own bytes say so: after a fixed pair of byte classes, at the
earliest ``least`` bytes from the last cut and at the latest after ``most``. Equal
texts are cut alike, and texts that share long parts share most chunks. Every chunk
gets an identifier, two seeded hashes of its bytes. The identifiers are verified: all
chunk contents of the table are reduced to the distinct ones, and if two contents share
an identifier, identifiers become longer and are verified anew. From then on a document
is its ordered list of identifiers, some 16 bytes for half a kilobyte of text, and
equality is equality of lists; the text itself moves once, as chunks, of which each
task sends a content only once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import settle

LEAST_BYTES, MOST_BYTES = 256, 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _byte_class(low_bits: int) -> str:
    return "[" + "".join(f"\\x{b:02X}" for b in range(256) if b % 16 == low_bits) + "]"


def chunk_pattern(least: int = LEAST_BYTES, most: int = MOST_BYTES) -> str:
    """A pattern whose successive matches are the chunks of a text of bytes.

    A cut follows a byte with low bits 5 and a byte with low bits 1, whatever the script.
    """
    return f"(?s).{{{least - 2},{most - 2}}}?{_byte_class(5)}{_byte_class(1)}|.{{1,{most}}}"


def folded(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; null as empty.

    Full lower-casing is several times faster than a translation and the same on plain ASCII.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def chunks(text: Column, least: int = LEAST_BYTES, most: int = MOST_BYTES) -> Column:
    """The chunks of a text in order, one character for each byte; an empty text has none."""
    as_bytes = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.regexp_extract_all(as_bytes, F.lit(chunk_pattern(least, most)), F.lit(0))


def identifier(chunk: Column, words: int, bits: int = 64) -> list[Column]:
    """``words`` seeded hashes of a chunk; ``bits`` below 64 keeps that many of each."""
    hashes = [F.xxhash64(F.lit(k), chunk) for k in range(words)]
    return hashes if bits == 64 else [F.shiftrightunsigned(h, 64 - bits) for h in hashes]


def chunk_table(docs: DataFrame, words: int = 2, bits: int = 64, text_col: str = "text",
                least: int = LEAST_BYTES, most: int = MOST_BYTES) -> DataFrame:
    """Each distinct chunk once: ``identifier`` (longs), ``chunk`` and ``uses``, its occurrences.

    Aggregated before the shuffle, so that a passage of very many documents moves once a task.
    """
    each = docs.select(F.explode(chunks(folded(F.col(text_col)), least, most)).alias("chunk"))
    names = [f"__i{k}" for k in range(words)]
    keyed = each.select("chunk", *[c.alias(n) for c, n in zip(identifier(F.col("chunk"), words, bits), names)])
    distinct = keyed.groupBy(*names, "chunk").agg(F.count(F.lit(1)).alias("uses"))
    return distinct.select(F.array(*names).alias("identifier"), "chunk", "uses")


def verified_words(docs: DataFrame, bits: int = 64, text_col: str = "text", least: int = LEAST_BYTES,
                   most: int = MOST_BYTES, start: int = 2) -> int:
    """How many hashes an identifier needs so that no two chunk contents of the table share one."""
    words = start
    while True:
        contents = chunk_table(docs, words, bits, text_col, least, most).groupBy("identifier").count()
        if contents.where("count > 1").isEmpty():
            return words
        words *= 2


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64,
            least: int = LEAST_BYTES, most: int = MOST_BYTES) -> DataFrame:
    """``doc_id``, ``recipe`` (its chunks' verified identifiers in order), ``text_sha256`` of the folded text, ``row``."""
    words = verified_words(docs, bits, text_col, least, most)
    ids = F.transform(chunks(F.col("__text"), least, most), lambda c: F.array(*identifier(c, words, bits)))
    # a step of its own: the text is folded once for both uses
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), folded(F.col(text_col)).alias("__text"))
    return slim.select("doc_id", F.flatten(ids).alias("recipe"), F.sha2("__text", 256).alias("text_sha256"),
                       F.monotonically_increasing_id().alias("row"))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64,
                 least: int = LEAST_BYTES, most: int = MOST_BYTES) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are the same after lower-casing A-Z; a null text is an empty
    one. Of equal texts the row with the largest id stays, a null id being the smallest;
    of rows that share that id, too, exactly one. Other columns are not read. An empty
    table gives an empty table.

    Rows of one recipe are first reduced in slices, about the square root of the row
    count many, and get their group's result back by recipe and slice: no task holds
    more than a slice of the largest group, or one row of each of its slices.
    """
    made = settle(recipes(docs, id_col, text_col, bits, least, most), "recipes")
    slices = max(1, math.isqrt(made.count()))
    sliced = made.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)))
    best = F.max(F.struct("doc_id", "row"))
    part = sliced.groupBy("recipe", "slice").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    part = settle(part, "recipe-slices")
    whole = part.groupBy(F.col("recipe").alias("__recipe")).agg(
        F.max("best").alias("keep"), F.sum("n").alias("group_size"))
    known = part.join(whole, F.col("recipe") == F.col("__recipe")).select(
        F.col("recipe").alias("__recipe"), F.col("slice").alias("__slice"), "keep", "group_size")
    same = (F.col("recipe") == F.col("__recipe")) & (F.col("slice") == F.col("__slice"))
    return sliced.join(known, same).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")
