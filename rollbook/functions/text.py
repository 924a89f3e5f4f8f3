"""Text helpers built from JVM-side expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literals a CSV reader of the feed treats as missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c: Column | str, tokens: Sequence[str] = NA_TOKENS) -> Column:
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def fit_text(c: Column | str, limit: int) -> Column:
    """Drop trailing blanks beyond ``limit``, as storing into VARCHAR does."""
    c = _col(c)
    return F.when(
        (F.length(c) > limit) & (F.length(F.rtrim(c)) <= limit), F.substring(c, 1, limit)
    ).otherwise(c)


def derive_email(
    first: Column | str,
    last: Column | str,
    domain: str,
    suffix: Column | str | None = None,
) -> Column:
    """``first.last<suffix>@domain`` in lower case, blanks removed from the last name."""
    local = F.concat_ws(".", F.lower(_col(first)), F.replace(F.lower(_col(last)), F.lit(" "), F.lit("")))
    parts = [local] if suffix is None else [local, _col(suffix).cast("string")]
    return F.concat(*parts, F.lit("@" + domain))
