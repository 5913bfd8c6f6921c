"""Text and code columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline import fixed


def row_key(columns: Sequence[str], length: int = fixed.ROW_KEY_LENGTH) -> Column:
    """First characters of the SHA-256 over the columns' text, joined by ``_``.

    NULL columns are skipped, so drop rows with NULL keys first. The key itself
    is never NULL; saying so lets Spark leave out the hash where only its
    presence matters, as in counts and in NULL checks before joins.
    """
    joined = F.concat_ws("_", *[F.col(c).cast("string") for c in columns])
    return F.coalesce(F.substring(F.sha2(joined, 256), 1, length), F.lit(""))


def blank_to(value: Column, default: object) -> Column:
    """The default for NULL, empty or blank text; other text as it is, trimmed."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))


def lenient_int(value: Column, default: int = 0, kind: str = "bigint") -> Column:
    """Whole part of a number in any spelling; the default where there is none.

    Plain whole numbers are taken as they are, all digits of them; other spellings go through double.
    """
    whole = value.try_cast("bigint")
    return F.coalesce(F.coalesce(whole, value.try_cast("double").try_cast("bigint")).try_cast(kind), F.lit(default).cast(kind))


def known_code(value: Column, allowed: Sequence[int]) -> Column:
    """The code when it is in the list, otherwise NULL; blank text is no code."""
    code = value.try_cast("int")
    return F.when(code.isin(list(allowed)), code)
