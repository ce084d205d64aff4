"""Token and key expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values. The cut points of the delimiter tokeniser: space . ! ? ; [ ] , '
# and the line ends. Tab, colon, double quote, hyphen and ( ) stay in the token.
DELIMITERS = r"[ .!?;\[\],'\r\n\f]+"

# Word characters are the ASCII letters, digits and _. All else, letters beyond
# ASCII included, is a cut point.
NON_WORD = r"\W+"
# Stands for its document in a table of marked words.
MARK = " "
# What Spark writes for a null in the name of a folder.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def tokenize_delims(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row ``(*keep, word)`` per token between delimiters, lower-cased.

    Tokens are lowered after the cut: lower-casing a final sigma looks at the
    letters around it, past a dot or an apostrophe.
    """
    tokens = df.select(*keep, F.explode(F.split(F.col(text), DELIMITERS)).alias("token"))
    return tokens.where(F.col("token") != "").select(*keep, F.lower("token").alias("word"))


def tokenize_words(df: DataFrame, text: str, *keep: str, marked: bool = False) -> DataFrame:
    """One row ``(*keep, word)`` per run of ASCII word characters, lower-cased.

    ``marked`` adds a row with the word ``MARK``, which no text holds, for each row of
    ``df``, so that those without a word, or with a null text, can still be counted.
    """
    words = F.split(F.lower(F.col(text)), NON_WORD)
    if marked:
        words = F.concat(F.array(F.lit(MARK)), F.coalesce(words, F.array().cast("array<string>")))
    return df.select(*keep, F.explode(words).alias("word")).where(F.col("word") != "")


def pack_key(df: DataFrame, sep: str, cols: list[str], name: str = "key") -> DataFrame:
    """Replace ``cols`` by one text column that joins them with ``sep``."""
    rest = [c for c in df.columns if c not in cols]
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias(name), *rest)


def unpack_key(df: DataFrame, key: str, sep: str, names: list[str]) -> DataFrame:
    """Replace the text column ``key`` by its parts, one column per name."""
    parts = F.split(F.col(key), _literal(sep), -1)
    rest = [c for c in df.columns if c != key]
    return df.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)], *rest)


def file_name() -> Column:
    """Base name of the file a row was read from.

    The metadata column holds it percent-encoded with a bare ``+`` left alone,
    which decoding would turn into a space.
    """
    return _decoded(F.col("_metadata.file_name"))


def folder_value() -> Column:
    """The value in the folder ``<name>=<value>`` that a row's file lies in, as Spark writes it for a partition column.

    Spark escapes characters of its own in the folder's name, and the metadata column all that a URI does not hold.
    """
    folder = _decoded(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    value = F.element_at(F.split(folder, "=", 2), -1)
    return F.when(value != NO_VALUE, _decoded(value))


def _decoded(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _literal(sep: str) -> str:
    return "".join("\\" + c if not c.isalnum() and ord(c) < 128 and not c.isspace() else c for c in sep)
