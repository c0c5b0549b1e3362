"""Column expressions on malware-family and product names."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from feedmark import model as m
from feedmark.functions.values import strip


def _unicode_folder():
    """UDF for the names that plain ASCII rules cannot fold.

    Built as a closure, so that it travels to the executors by value and they need not have this
    package installed.
    """
    not_canon = re.compile("[^a-z0-9]")

    def fold(names: pd.Series) -> pd.Series:
        return names.map(
            lambda name: not_canon.sub("", unicodedata.normalize("NFKD", name).lower()),
            na_action="ignore",
        )

    return F.pandas_udf(fold, T.StringType())


_fold_unicode = _unicode_folder()


def canon(name: Column) -> Column:
    """Name reduced to lower-case ASCII letters and digits after NFKD; '' for NULL or ''.

    Matching later demands equal canons and nothing looser. Spark has no NFKD, so names with
    other than ASCII characters go through one Arrow UDF (all others reach it as NULL). Call it
    on name dimensions, never per observation.
    """
    ascii_only = name.rlike(r"^[\x00-\x7F]*$")
    folded = F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    return F.coalesce(
        F.when(ascii_only, folded), _fold_unicode(F.when(~ascii_only, name)), F.lit("")
    )


def split_aliases(aliases: Column) -> Column:
    """Trimmed, non-empty fragments of a comma-separated string; empty array for NULL."""
    fragments = F.transform(F.split(aliases, ","), strip)
    return F.coalesce(F.filter(fragments, lambda f: f != ""), F.array().cast("array<string>"))


def family_id(malware: Column) -> Column:
    """Identity of the attributed family, NULL when the feed attributed none."""
    bare = strip(malware)
    return F.when((bare != "") & ~F.lower(bare).isin(*m.NO_FAMILY_LABELS), bare)


def malpedia_name(identifier: Column) -> Column:
    """Family part of a dotted identifier: after the first dot, or all of it if that is empty."""
    after = F.regexp_extract(identifier, r"(?s)^[^.]*\.(.*)$", 1)
    return F.when(after == "", identifier).otherwise(after)
