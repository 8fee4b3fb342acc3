"""Text normalization (TXT1-TXT6) as column expressions; only non-ASCII values reach Python, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ADDRESS_WORDS, LEGAL_SUFFIXES


#: Runs of what is neither letter nor digit; \w holds the underscore too.
_OTHER = re.compile(r"[\W_]+")


def fold(value: str) -> str:
    """One value: compatibility form, case folded, ampersands spelled out, letters and digits kept, single spaces."""
    folded = unicodedata.normalize("NFKC", value.strip()).casefold().replace("&", " and ")
    return _OTHER.sub(" ", folded).strip(" ")


def _fold_all(values: pd.Series) -> pd.Series:
    return values.map(fold, na_action="ignore")


def normalize(value: Column) -> Column:
    """TXT1-TXT3, TXT6.  Null becomes ''.  ASCII stays in generated code; the rest goes to an Arrow UDF, which gets null for ASCII rows."""
    v = F.coalesce(value.cast("string"), F.lit(""))
    plain = v.rlike(r"\A[\x00-\x7F]*\z")
    native = F.trim(F.regexp_replace(F.replace(F.lower(v), F.lit("&"), F.lit(" and ")), "[^0-9a-z]+", " "))
    return F.coalesce(F.pandas_udf(_fold_all, "string")(F.when(~plain, v)), native)


def name_core(normalized: Column) -> Column:
    """TXT4: without words of the legal form, wherever they stand; the whole name where nothing else is left."""
    core = F.array_join(F.filter(F.split(normalized, " "), lambda w: ~w.isin(*LEGAL_SUFFIXES)), " ")
    return F.when(core == "", normalized).otherwise(core)


def short_address(normalized: Column) -> Column:
    """TXT5: each word in its short form."""
    known = F.create_map(*[F.lit(x) for pair in ADDRESS_WORDS.items() for x in pair])
    return F.array_join(F.transform(F.split(normalized, " "), lambda w: F.coalesce(F.try_element_at(known, w), w)), " ")


def tokens(value: Column) -> Column:
    """SCL3: parts between single spaces, empty ones included."""
    return F.split(value, " ")
