"""Codes, keys and names."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .nulls import as_column


def make_key(separator: str, *parts: Column | str) -> Column:
    """Composite key; null parts are skipped."""
    return F.concat_ws(separator, *[as_column(p).cast("string") for p in parts])


def strict_key(separator: str, *parts: Column | str) -> Column:
    """Composite key that is null as soon as one part is null."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(as_column(part).cast("string"))
    return F.concat(*pieces)


def clean_code(value: Column | str, width: int | None = None) -> Column:
    """Letters and digits only, empty to null, brought to a width with zeros in front."""
    code = F.nullif(F.regexp_replace(as_column(value), "[^a-zA-Z0-9]", ""), F.lit(""))
    return code if width is None else zero_padded(code, width)


def zero_padded(value: Column | str, width: int) -> Column:
    """Zeros in front up to a width. A longer text stays whole, unlike with ``lpad``."""
    text = as_column(value).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def strip_prefix(value: Column | str, prefix: str) -> Column:
    """Drop a prefix, given as a regular expression, from the start of a text."""
    return F.regexp_replace(as_column(value), f"^(?:{prefix})", "")


def split_part(value: Column | str, separator: str, index: int) -> Column:
    """Part of a text by position from 0; null when there is no such part."""
    return F.get(F.split(as_column(value), re.escape(separator)), F.lit(index))


def standard_name(name: str, keep_brackets: bool = False) -> str:
    """A plain column name: no dots or ``[..]``, words joined by one underscore."""
    if keep_brackets:
        return name.replace(".", "")
    bare = re.sub(r"\[[^\]]*\]", "", name)
    words = re.findall(r"\w+", bare)
    return re.sub("_{2,}", "_", "_".join(words))


def standard_name_column(value: Column | str) -> Column:
    """`standard_name` for names held in a column."""
    bare = F.regexp_replace(as_column(value), r"\[[^\]]*\]", "")
    words = F.trim(F.regexp_replace(bare, r"(?U)[^\w]+", " "))
    return F.regexp_replace(F.replace(words, F.lit(" "), F.lit("_")), "_{2,}", "_")
