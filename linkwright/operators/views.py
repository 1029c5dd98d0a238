"""Normalised views and retrieval keys of raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.functions import text as T

DIALECTS = ("train", "test", "query")


def normalized_views(raw: DataFrame, compose: bool = True) -> DataFrame:
    """raw with eleven views of name and address added, through NFKC unless compose is false."""
    name, address = F.col("business_name"), F.col("business_address")
    if compose:  # each once, in one Python step
        raw = raw.withColumns({"_name": T.nfkc(T.text(name)), "_address": T.nfkc(T.text(address))})
        name, address = F.col("_name"), F.col("_address")
    out = raw.withColumns(
        {
            "name_clean": T.normalize_text(name),
            "name_compact": T.normalize_compact(name),
            "address_clean": T.normalize_text(address),
            "address_compact": T.normalize_compact(address),
            "numbers": T.extract_numbers(address),
        }
    )
    later = {"postal_code": T.postal_of(F.col("numbers"), F.col("country")), "name_no_legal": T.remove_legal_suffixes(F.col("name_clean"))}
    out = out.withColumns(later)
    return out.withColumns(
        {
            "name_sorted": T.sort_tokens(F.col("name_no_legal")),
            "name_compact_core": T.normalize_compact(F.col("name_no_legal")),
            "combined_text": F.concat_ws(" ", "name_clean", "address_clean"),
        }
    ).drop("_name", "_address")


def keyed_views(raw: DataFrame, dialect: str = "train", compose: bool = True) -> DataFrame:
    """normalized_views with the address anchor, name token and address token of one dialect.

    Both sides of a join must use the same dialect.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    v = normalized_views(raw, compose)
    name = F.col("name_no_legal" if dialect == "query" else "name_clean")
    return v.withColumns(
        {
            "addr_anchor": T.addr_anchor(F.col("address_clean"), F.col("numbers"), dialect),
            "tok1": T.tok1(name, dialect),
            "addr_tok1": T.addr_tok1(F.col("address_clean"), dialect),
        }
    )


def first_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    best = rows.groupBy(key).agg(F.min(order).alias(order))
    return rows.join(best, [key, order], "left_semi")
