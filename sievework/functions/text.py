"""Text normalisation and string building blocks (Column -> Column)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings that stand for "no value" in each kind of delivery.
ORDER_MISSING = ("NULL", "N/A", "-", "")
SALES_MISSING = ("", "-", "N/A")
ROSTER_MISSING = ("", "-", "N/A", "不明")

# Code points Python's str.strip removes and that can survive NFKC.
_BLANKS = "".join(map(chr, (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85,
                            0x1680, 0x2028, 0x2029)))


#: Of these, the ones in ASCII text.
_ASCII_BLANKS = "".join(c for c in _BLANKS if c < "\x80")

# Wide forms with one narrow character each, and text in which NFKC does nothing else: besides them ASCII, kana that no mark
# follows, and ideographs of the main block.
_WIDE = "".join(map(chr, (*range(0xFF01, 0xFF5F), 0x3000, 0xFFE5)))
_NARROW = "".join(map(chr, (*range(0x21, 0x7F), 0x20, 0xA5)))
_ONE_BY_ONE = r"^[\x00-\x7F\u00A5\u3000\u3041-\u3096\u30A1-\u30FA\u30FC\u4E00-\u9FFF\uFF01-\uFF5E\uFFE5]*\z"


@F.arrow_udf(T.StringType())
def _nfkc_values(values: pa.Array) -> pa.Array:
    # Each distinct value of a batch once.  Arrow's own kernel leaves letters and their marks apart.
    distinct = values.dictionary_encode()
    normal = pa.array([unicodedata.normalize("NFKC", v).strip() for v in distinct.dictionary.to_pylist()], pa.string())
    return normal.take(distinct.indices)


# Declared non-deterministic so that Spark computes it once per row.  Otherwise a
# filter on a parsed value is pushed below the parsing, and the whole chain of
# normalising and parsing is evaluated a second time inside the filter.
_nfkc = _nfkc_values.asNondeterministic()


def strip(c: Column) -> Column:
    """Remove every kind of blank at both ends; Spark's trim knows only U+0020."""
    return F.btrim(c, F.lit(_BLANKS))


def nfkc_strip(c: Column) -> Column:
    """Unicode NFKC, then strip.

    ASCII text (as many bytes as characters) is in that form already, and wide forms of it have one
    narrow character each; both stay in the JVM, and the Arrow function sees NULL for them.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    other = _nfkc(F.when(~ascii_only & ~c.rlike(_ONE_BY_ONE), c))
    return F.coalesce(other, F.btrim(F.when(ascii_only, c).otherwise(F.translate(c, _WIDE, _NARROW)), F.lit(_ASCII_BLANKS)))


def missing_to_null(c: Column, tokens: Iterable[str]) -> Column:
    """Spellings of "no value" become NULL; everything else is kept as it is."""
    return F.when(~c.isin(*tokens), c)


def select_once(df: DataFrame, columns: Iterable[Column | str]) -> DataFrame:
    """``df.select(columns)`` whose results later filters and projections use as they are.

    Spark moves a filter below a plain select by copying the selected expressions
    into it; with costly, nested expressions that multiplies the work.  It does not
    move filters below a generator.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def normalise_columns(df: DataFrame, columns: Iterable[str], tokens: Iterable[str] = ()) -> DataFrame:
    """nfkc_strip, then missing_to_null, over the named text columns."""
    wanted = set(columns)
    unknown = wanted - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    tokens = tuple(tokens)
    cleaned = df.select(*[nfkc_strip(F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns])
    if not tokens:
        return cleaned
    return select_once(cleaned, [missing_to_null(F.col(c), tokens).alias(c) if c in wanted else F.col(c)
                                 for c in cleaned.columns])


def zero_pad(c: Column, width: int) -> Column:
    """Pad with zeros on the left, after a sign; longer text is never cut."""
    signed = c.rlike("^[+-]")
    body = F.when(signed, F.expr("''")).otherwise(c)
    padded = F.lpad(body, width, "0")
    with_sign = F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, 1 << 20), width - 1, "0"))
    return F.when(F.char_length(c) >= width, c).when(signed, with_sign).otherwise(padded)


def remove_suffix(c: Column, suffix: str) -> Column:
    """Drop one literal suffix if it is there."""
    return F.when(F.endswith(c, F.lit(suffix)),
                  F.left(c, F.char_length(c) - F.lit(len(suffix)))).otherwise(c)


def remove_prefix(c: Column, prefix: str) -> Column:
    """Drop one literal prefix if it is there."""
    return F.when(F.startswith(c, F.lit(prefix)),
                  F.right(c, F.char_length(c) - F.lit(len(prefix)))).otherwise(c)


def extract_first(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, or NULL where the pattern does not occur."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def split_part(c: Column, separator: str, index: int) -> Column:
    """Part number ``index`` (0-based), or NULL when there are fewer parts."""
    return F.get(F.split(c, re.escape(separator), -1), F.lit(index))


def map_values(c: Column, mapping: Mapping[str, object], unmapped: str = "keep") -> Column:
    """Replace spellings by a small dictionary.

    ``unmapped``: "keep" leaves other values, "null" blanks them, "raise" stops.
    The dictionary is part of the expression and searched from its start; a large one
    belongs in a table: see map_values_by_table.
    """
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    hit = F.try_element_at(F.create_map(*pairs), c)
    if unmapped == "keep":
        return F.coalesce(hit, c)
    if unmapped == "null":
        return hit
    if unmapped == "raise":
        return F.when(c.isNotNull() & hit.isNull(),
                      F.raise_error(F.concat(F.lit("value not in the dictionary: "), c))).otherwise(hit)
    raise ValueError(f"unmapped must be keep, null or raise, not {unmapped!r}")


def map_values_by_table(df: DataFrame, column: str, table: DataFrame, unmapped: str = "keep") -> DataFrame:
    """``map_values`` with a dictionary of any size: ``table`` has ``spelling`` and ``value``, each spelling once.

    Spark broadcasts the table if its measured size allows.  A repeated spelling stops the job.
    """
    if unmapped not in ("keep", "null", "raise"):
        raise ValueError(f"unmapped must be keep, null or raise, not {unmapped!r}")
    once = table.groupBy(F.col("spelling").alias("_spelling")).agg(F.max("value").alias("_value"), F.count(F.lit(1)).alias("_n"))
    single = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated spelling: "), F.col("_spelling")))).otherwise(F.col("_value"))
    joined = df.join(once, F.col(column) == F.col("_spelling"), "left")
    known, c = F.col("_spelling").isNotNull(), F.col(column)
    other = {"keep": c, "null": F.lit(None)}.get(unmapped)
    if other is None:
        other = F.when(c.isNotNull(), F.raise_error(F.concat(F.lit("value not in the dictionary: "), c)))
    mapped = F.when(known, single).otherwise(other).alias(column)
    return joined.select(*[mapped if x == column else F.col(x) for x in df.columns])


def contains_text(c: Column, literal: str) -> Column:
    """Substring test that answers false, not NULL, for a missing value."""
    return F.coalesce(F.contains(c, F.lit(literal)), F.lit(False))


def pseudonym(c: Column, salt: str) -> Column:
    """The same stand-in for the same value in every run."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def content_key(*columns: Column) -> Column:
    """Surrogate key derived from the content; NULL and empty text stay apart."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
