"""Hash keys and hash diffs of the vault, as JVM-side column expressions.

Recipe (the text that is hashed decides every key, so it is fixed):
  n(c) = nullif(upper(trim(cast(c as string))), '')     -- trim removes spaces only
  g(c) = coalesce(n(c), '^^')
  single key     md5(n(c))                               -- NULL for a NULL or blank value
  composite key  md5(nullif(concat_ws('||', g(c1), ...), sentinel))
  hash diff      md5(concat_ws('||', g(c1), ...))        -- never NULL

The sentinel is '^^' repeated ``sentinel_parts`` times, joined by '||'. It does not always have as
many parts as there are inputs: some keys compare 2 or 3 inputs against a 4-part sentinel, which
then never matches, so those keys are never NULL. Callers pass the part count from the spec.

An md5 is 32 characters that no codec shortens much, and rows of one target hold several. ``text=True`` gives the text
instead, in a column marked as such: equal texts are equal keys, so distinct, grouping and joins can run on them, and
``seal`` puts the md5 in its place where the stored key is needed, after the last shuffle. A text of more than
``TEXT_BYTES`` travels as its md5, behind a byte that tells the two apart. Texts do not sort as their md5 do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the key recipe; keys only equal the reference's when these are identical.
NULL_TOKEN = "^^"
SEPARATOR = "||"

#: texts up to this length travel as they are
TEXT_BYTES = 64
_HASHED = "\u0001"
#: column metadata of a text that is still to be hashed
_LATE = {"hash": "late"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c: str | Column) -> Column:
    """Business-key text: cast to string, trim spaces, upper-case, blank -> NULL."""
    return F.nullif(F.upper(F.trim(_col(c).cast("string"))), F.lit(""))


def _hashed(text: Column, as_text: bool) -> Column:
    if not as_text:
        return F.md5(text)
    short = (F.octet_length(text) <= TEXT_BYTES) & ~F.startswith(text, F.lit(_HASHED))
    return F.when(short, text).otherwise(F.concat(F.lit(_HASHED), F.md5(text)))


def late_columns(df: DataFrame) -> list[str]:
    """Columns that hold texts still to be hashed."""
    return [f.name for f in df.schema.fields if f.metadata.get("hash") == "late"]


def seal(df: DataFrame, only: list[str] | None = None) -> DataFrame:
    """``df`` with the md5 in place of the texts of ``only``, or of all columns that hold them."""
    late = [c for c in late_columns(df) if only is None or c in only]
    if not late:
        return df
    md5 = lambda c: F.when(F.startswith(c, F.lit(_HASHED)), F.substring(c, 2, 32)).otherwise(F.md5(c))
    return df.select(*[md5(F.col(c)).alias(c, metadata={}) if c in late else F.col(c) for c in df.columns])


def mark(c: Column, name: str) -> Column:
    """``c`` named and marked as a text still to be hashed."""
    return c.alias(name, metadata=_LATE)


def hash_key(c: str | Column, text: bool = False) -> Column:
    """md5 of one normalised business key; NULL when the key is NULL or blank."""
    return _hashed(norm_text(c), text)


def _joined(cols: list[str | Column] | tuple) -> Column:
    return F.concat_ws(SEPARATOR, *[F.coalesce(norm_text(c), F.lit(NULL_TOKEN)) for c in cols])


def sentinel(parts: int) -> str:
    return SEPARATOR.join([NULL_TOKEN] * parts)


def hash_composite(cols: list[str | Column] | tuple, sentinel_parts: int, text: bool = False) -> Column:
    """md5 of several normalised parts; NULL only when the joined text equals the sentinel."""
    return _hashed(F.nullif(_joined(cols), F.lit(sentinel(sentinel_parts))), text)


def hash_diff(cols: list[str | Column] | tuple, text: bool = False) -> Column:
    """md5 of the joined normalised payload; never NULL."""
    return _hashed(_joined(cols), text)
