"""Text functions over columns: hashes, ids, term cleaning, escaping, paths, sniffing and dumps."""

from __future__ import annotations

import posixpath
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The marks of a placeholder in catalog text, and the wide space of the scripts.
PLACEHOLDER = r"⟦ADV:\d+⟧"
WIDE_SPACE = "　"


def sha256_text(text: Column | str) -> Column:
    return F.sha2(text, 256)


def stable_id(category: Column, source: Column) -> Column:
    """category:first 12 hex digits of sha256(category NUL source)."""
    return F.concat(category, F.lit(":"), F.substring(F.sha2(F.concat(category, F.char(F.lit(0)), source).cast("binary"), 256), 1, 12))


def clean_term(text: Column) -> Column:
    """Without placeholders; line ends and runs of blanks as one space; blanks and colons trimmed."""
    plain = F.regexp_replace(text, PLACEHOLDER, "")
    plain = F.regexp_replace(plain, r"[\r\n]", " ")
    plain = F.regexp_replace(plain, f"[ \t{WIDE_SPACE}]+", " ")
    return F.regexp_replace(plain, f"^[ \t{WIDE_SPACE}:：]+|[ \t{WIDE_SPACE}:：]+$", "")


def escape_script(text: Column, quote: str) -> Column:
    """A backslash before backslashes, the quote and '<'."""
    return F.regexp_replace(text, f"([\\\\<{quote}])", r"\\$1")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def dirname(path: Column) -> Column:
    """What stands before the last slash; '' where there is none."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def posix_dirname(path: str) -> str:
    """As dirname(3): '.' for a name alone, '/' for one at the root; trailing slashes do not count."""
    kept = path.rstrip("/")
    if not kept:
        return "/" if path else "."
    head = kept.rpartition("/")[0]
    return (head.rstrip("/") or "/") if "/" in kept else "."


def posix_basename(path: str) -> str:
    """As basename(3): '.' for an empty path, '/' for the root."""
    return posixpath.basename(path.rstrip("/")) or ("/" if path else ".")


def replace_suffix(path: str, suffix: str) -> str:
    """path's file name with its last suffix, if any, replaced."""
    base = posixpath.basename(path)
    stem = base.rpartition(".")[0] if "." in base else base
    return f"{stem}.{suffix}"


def dos_path(path: Column) -> Column:
    return F.translate(path, "/", "\\")


def unix_path(path: Column) -> Column:
    return F.translate(path, "\\", "/")


# First bytes of member types.
MAGIC = (("504D0100", "pms"), ("504D0200", "pms"), ("514E5400", "qnt"), ("FFD8FFE0", "jpeg"), ("424D", "bmp"))


def sniff(data: Column) -> Column:
    """'' for no bytes, pms, qnt, jpeg or bmp by the first ones, else null."""
    kind = F.when(F.length(data) == 0, "")
    for digits, name in MAGIC:
        kind = kind.when(F.substring(data, 1, len(digits) // 2) == F.unhex(F.lit(digits)), name)
    return kind


def hex_rows(df: DataFrame, data: str, width: int = 16) -> DataFrame:
    """One row of hex digits for each `width` bytes, with its offset; none for no bytes."""
    last = F.length(data) - 1
    rows = df.where(F.length(data) > 0).withColumn("offset", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(width))))
    return rows.withColumn("hex", F.lower(F.hex(F.substring(data, F.col("offset") + 1, F.lit(width)))))


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """NFKC form; there is no built-in for it."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))
