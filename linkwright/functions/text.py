"""Text normalisation as Column expressions; nulls count as empty text.

Word characters are Unicode letters, digits and the underscore.  Everything is native
but nfkc() and strip_accents(), for which Spark has no function: these are Arrow UDFs
that see only the values with characters beyond ASCII.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from linkwright import vocab

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x1c-\x1f\x{85}\p{Z}]"


def _rare(value: Column, fn: Column) -> Column:
    """fn where it is not null, else the plain value: UDF rows are only those beyond ASCII."""
    return F.coalesce(fn, value)


def _beyond_ascii(value: Column) -> Column:
    return F.when(value.rlike(r"[^\x00-\x7F]"), value)


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


@F.pandas_udf(StringType())
def _strip_accents(values: pd.Series) -> pd.Series:
    def strip(v: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn")

    return values.map(strip, na_action="ignore")


def nfkc(value: Column) -> Column:
    return _rare(value, _nfkc(_beyond_ascii(value)))


def strip_accents(value: Column) -> Column:
    value = text(value)
    return _rare(value, _strip_accents(_beyond_ascii(value)))


def text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    return F.regexp_replace(value, f"^{SPACE}+|{SPACE}+$", "")


def unicode_clean(value: Column, compose: bool = False) -> Column:
    """Trimmed text; with compose also in NFKC, which needs Python."""
    return strip(nfkc(text(value)) if compose else text(value))


def strip_domains(value: Column) -> Column:
    return F.regexp_replace(value, rf"(?i)\.({'|'.join(vocab.DOMAIN_ENDINGS)})(?!{WORD})", "")


def normalize_text(value: Column, compose: bool = False) -> Column:
    out = strip_domains(F.lower(unicode_clean(value, compose)))
    out = F.regexp_replace(F.replace(out, F.lit("&"), F.lit(" and ")), rf"[^\p{{L}}\p{{N}}_\s\x1c-\x1f\x{{85}}\p{{Z}}]", " ")
    return F.trim(F.regexp_replace(out, f"{SPACE}+", " "))


def normalize_compact(value: Column, compose: bool = False) -> Column:
    return F.regexp_replace(strip_domains(F.lower(unicode_clean(value, compose))), r"[^\p{L}\p{N}_]", "")


def tokens(value: Column) -> Column:
    return F.filter(F.split(value, " "), lambda t: t != "")


def words(value: Column) -> Column:
    """Maximal runs of word characters."""
    return F.regexp_extract_all(value, F.lit(f"{WORD}+"), F.lit(0))


def remove_legal_suffixes(value: Column) -> Column:
    """Without the tokens of LEGAL_SUFFIXES, anywhere; unchanged if nothing would be left."""
    left = F.filter(tokens(value), lambda t: ~t.isin(*vocab.LEGAL_SUFFIXES))
    return F.when(F.size(left) == 0, value).otherwise(F.array_join(left, " "))


def sort_tokens(value: Column) -> Column:
    return F.array_join(F.array_sort(tokens(value)), " ")


def extract_numbers(value: Column, compose: bool = False) -> Column:
    """The words that are all digits, in order, repeats kept."""
    return F.filter(words(unicode_clean(value, compose)), lambda w: w.rlike(r"^\p{Nd}+$"))


def postal_code(address: Column, country: Column, compose: bool = False) -> Column:
    """The last all-digit word of the country's form; other countries try India's, then five digits."""
    return postal_of(extract_numbers(address, compose), country)


def postal_of(numbers: Column, country: Column) -> Column:
    """postal_code of the all-digit words of an address."""
    five = F.try_element_at(F.filter(numbers, lambda w: F.length(w) == 5), F.lit(-1))
    six = F.try_element_at(F.filter(numbers, lambda w: w.rlike(r"^[1-9]\p{Nd}{5}$")), F.lit(-1))
    kind = F.upper(strip(text(country)))
    found = F.when(kind.isin("US", "FRANCE"), five).when(kind == "INDIA", six).otherwise(F.coalesce(six, five))
    return F.coalesce(found, F.lit(""))


def leet(value: Column) -> Column:
    return F.translate(text(value), vocab.LEET_FROM, vocab.LEET_TO)


def clean_extra_legal(value: Column) -> Column:
    """Empty for a text that is only a legal form, else its ASCII letters and digits."""
    out = F.regexp_replace(text(value), r"(?i)\b(pc|p\.c\.|pllc|p\.l\.l\.c\.|corp|llc|inc|ltd)\b", "")
    return F.regexp_replace(out, "[^a-zA-Z0-9]", "")


def _first(items: Column, keep) -> Column:
    return F.coalesce(F.try_element_at(F.filter(items, keep), F.lit(1)), F.lit(""))


def _letters(address: Column, least: int) -> Column:
    """Words of ASCII letters only, of a least length, in lower case."""
    return F.transform(F.filter(words(address), lambda w: w.rlike(f"^[a-zA-Z]{{{least},}}$")), F.lower)


def addr_anchor(address: Column, numbers: Column, dialect: str = "train") -> Column:
    """A house number and a street word.

    train: first number, underscore, first longer word that is no stop word;
    test: the first number followed by a word, with a space;
    query: first number, underscore, first word of three letters.
    """
    if dialect == "test":
        found = F.regexp_extract(F.lower(address), rf"(?<!{WORD})(\p{{Nd}}+)\s+([a-z]{{3,}})(?!{WORD})", 0)
        return F.regexp_replace(found, r"\s+", " ")
    number = F.coalesce(F.try_element_at(numbers, F.lit(1)), F.lit(""))
    word = addr_tok1(address, dialect)
    return F.when((number != "") & (word != ""), F.concat_ws("_", number, word)).otherwise("")


def addr_tok1(address: Column, dialect: str = "train") -> Column:
    if dialect == "test":
        runs = F.regexp_extract_all(F.lower(address), F.lit("[a-z]{4,}"), F.lit(0))
        return F.coalesce(
            F.try_element_at(F.filter(runs, lambda w: ~w.isin(*vocab.TEST_ADDRESS_STOPS)), F.lit(1)),
            F.try_element_at(runs, F.lit(1)),
            F.lit(""),
        )
    if dialect == "query":
        return _first(tokens(address), lambda w: w.rlike(r"^\p{L}{3,}$"))
    return _first(_letters(address, 4), lambda w: ~w.isin(*vocab.TRAIN_ADDRESS_STOPS))


def tok1(name: Column, dialect: str = "train") -> Column:
    """The first telling word of a name; for dialect query give the name without legal forms."""
    if dialect == "test":
        runs = F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]{4,}"), F.lit(0))
        telling = F.filter(runs, lambda w: ~w.isin(*vocab.GENERIC_NAME_TOKENS) & ~w.rlike("^[0-9]+$"))
        return F.coalesce(F.try_element_at(telling, F.lit(1)), F.try_element_at(runs, F.lit(1)), F.lit(""))
    if dialect == "query":
        return _first(tokens(name), lambda w: w.rlike(r"^\p{L}{3,}$"))
    return _first(tokens(name), lambda w: (F.length(w) >= 3) & ~w.isin(*vocab.TRAIN_NAME_STOPS))


def parse_ids(value: Column) -> Column:
    """A comma list as an array: trimmed, without empties, repeats after the first dropped."""
    parts = F.transform(F.split(text(value), ","), strip)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def format_ids(ids: Column, ordered: bool = True) -> Column:
    """A comma list without repeats; sorted, or in the given order."""
    ids = F.array_distinct(F.coalesce(ids, F.array().cast("array<string>")))
    return F.array_join(F.array_sort(ids) if ordered else ids, ",")
