"""Comparison keys for names."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremora import fixed

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# Text of ASCII and the Turkish letters is already in NFKC form once lower-cased.
_NEEDS_NFKC = r"[^\x00-\x7FçÇğĞıİöÖşŞüÜâÂîÎûÛ]"


@F.pandas_udf(T.StringType())
def _lower_nfkc(text: pd.Series) -> pd.Series:
    return text.str.lower().str.normalize("NFKC")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_SPACE, "")


def lowered(text: Column, nfkc: bool = True) -> Column:
    """Lower case, in NFKC form.

    Spark has no normaliser. Only text with letters outside the usual set is handed to the Arrow
    function; all other rows pass it a null and stay with the native expression.
    """
    if not nfkc:
        return F.lower(text)
    foreign = F.when(text.rlike(_NEEDS_NFKC), text)
    return F.coalesce(_lower_nfkc(foreign), F.lower(text))


def fold(lower_text: Column) -> Column:
    """Turkish letters to ASCII, every run of anything else to one space."""
    plain = F.translate(lower_text, fixed.FOLD_FROM, fixed.FOLD_TO)
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def normalize(text: Column, nfkc: bool = True) -> Column:
    return fold(lowered(F.coalesce(text, F.lit("")), nfkc))


def contains_any(key: Column, words) -> Column:
    # the words are plain [a-z ] text, so one alternation finds them as substrings
    return key.rlike("|".join(words))


def access_type(name_key: Column, category: Column) -> Column:
    return (
        F.when(contains_any(name_key, fixed.MILITARY_WORDS), "military")
        .when(contains_any(name_key, fixed.PRIVATE_OR_SPECIAL_WORDS), "special_or_private")
        .when(category.isin(*fixed.FACILITY_TYPE_SCORES), "civilian_or_unknown")
        .otherwise("unknown")
    )
