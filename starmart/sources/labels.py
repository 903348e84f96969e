"""Code dictionaries from label text files, parsed by Spark.

The label file lists codes in sections such as::

    /* I94PORT - ...
       value $i94prtl
       'ALC'	=	'ALCAN, AK             '
       ...
    ;

A section starts at its search text and ends at the next ``;``. Every line with
exactly one ``=`` is a pair; blanks, then single quotes, then double quotes are
trimmed from both sides. Lines that do not parse are dropped (``rejects=True``
returns them instead). For ``label_dictionary_pair`` the value must consist of
exactly two comma parts.

The work is a Spark job over any number of files: each file is one row
(``wholetext``), the section is cut with ``instr``/``substr``, lines are
exploded with their position, and pairs are split and trimmed with built-in
string functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.columns import col_of, strip_whitespace

# Line boundaries as Python's ``str.splitlines`` knows them.
LINE_BREAKS = "\\r\\n|[\\n\\r\\u000B\\u000C\\u001C\\u001D\\u001E\\u0085\\u2028\\u2029]"


def read_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: ``(source, text)``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    # ``text()`` sets ``wholetext`` itself, so it must be its argument, not an option.
    return (spark.read.text(paths, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))


def label_section(text: Column | str, tag: str) -> Column:
    """Text from the first ``tag`` up to (not including) the next ``;``; NULL if
    the tag or the closing ``;`` is missing."""
    text = col_of(text)
    start = F.instr(text, tag)
    rest = F.substr(text, F.greatest(start, F.lit(1)), F.length(text))
    end = F.instr(rest, ";")
    return F.when((start > 0) & (end > 0), F.substr(rest, F.lit(1), end - 1))


def _trim_code(c: Column) -> Column:
    return F.btrim(F.btrim(strip_whitespace(c), F.lit("'")), F.lit('"'))


def _trim_value(c: Column) -> Column:
    return strip_whitespace(_trim_code(c))


def parse_pairs(df: DataFrame, text: Column | str, keep: Sequence[str] = (), item_sep: str = LINE_BREAKS,
                kv_sep: str = "=", rejects: bool = False) -> DataFrame:
    """Split ``text`` into items (regex ``item_sep``) and each item at ``kv_sep``.

    Returns ``keep + (item_no, code, value)`` for items with exactly one
    separator; with ``rejects=True`` the other items ``keep + (item_no, item)``.
    """
    items = df.select(*keep, F.posexplode(F.split(col_of(text), item_sep)).alias("item_no", "item"))
    parts = F.split(F.col("item"), _quote(kv_sep), -1)
    if rejects:
        return items.filter(F.size(parts) != 2)
    return (items.filter(F.size(parts) == 2)
            .select(*keep, F.col("item_no").cast("int").alias("item_no"),
                    _trim_code(F.get(parts, 0)).alias("code"),
                    _trim_value(F.get(parts, 1)).alias("value")))


def label_dictionary(texts: DataFrame, tag: str, text_col: str = "text", keep: Sequence[str] = ("source",),
                     rejects: bool = False, required: bool = True) -> DataFrame:
    """``(source, item_no, code, value)`` for the section ``tag`` of every text.

    A text without the section fails the job, as in the original; with
    ``required=False`` it gives no rows.
    """
    section = label_section(text_col, tag)
    if required:
        section = F.coalesce(section, F.raise_error(F.lit(f"label section {tag!r} or its closing ';' is missing"))
                             .cast("string"))
    sections = texts.select(*keep, section.alias("__section"))
    return parse_pairs(sections, "__section", keep=keep, rejects=rejects)


def label_dictionary_pair(texts: DataFrame, tag: str, text_col: str = "text",
                          keep: Sequence[str] = ("source",), sep: str = ",",
                          rejects: bool = False, required: bool = True) -> DataFrame:
    """``(source, item_no, code, value1, value2)``: values with exactly two ``sep`` parts."""
    pairs = label_dictionary(texts, tag, text_col, keep, required=required)
    parts = F.split(F.col("value"), _quote(sep), -1)
    if rejects:
        return pairs.filter(F.size(parts) != 2)
    return (pairs.filter(F.size(parts) == 2)
            .select(*keep, "item_no", "code",
                    strip_whitespace(F.get(parts, 0)).alias("value1"),
                    strip_whitespace(F.get(parts, 1)).alias("value2")))


def _quote(text: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in text)
