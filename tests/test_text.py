import unicodedata

import pytest
from pyspark.sql import functions as F

from linkwright.functions import text as T


def one(spark, fn, *values):
    cols = [F.col(f"c{i}") for i in range(len(values))]
    rows = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return rows.select(fn(*cols).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "fn,args,expected",
    [
        (T.normalize_text, ("  Maure & Williams, Inc. - 100% Quality!  ",), "maure and williams inc 100 quality"),
        (T.normalize_text, ("A&B",), "a and b"),
        (T.normalize_text, ("shop.com online",), "shop online"),
        (T.normalize_text, (None,), ""),
        (T.normalize_text, ("snake_case  x",), "snake_case x"),
        (T.normalize_compact, ("Maure-Williams, LLC",), "maurewilliamsllc"),
        (T.normalize_compact, ("A&B",), "ab"),
        (T.remove_legal_suffixes, ("apple inc",), "apple"),
        (T.remove_legal_suffixes, ("tata consultancy services limited",), "tata consultancy"),
        (T.remove_legal_suffixes, ("raj investments llp",), "raj investments"),
        (T.remove_legal_suffixes, ("inc",), "inc"),
        (T.sort_tokens, ("williams maure colombier",), "colombier maure williams"),
        (T.postal_code, ("85 Wayne Avenue, Ticonderoga, NY 12883-1234", "US"), "12883"),
        (T.postal_code, ("6(29), C.I.T. Colony, Mylapore, Chennai, Tamil Nadu 600004", "India"), "600004"),
        (T.postal_code, ("10 Rue de la Paix, 75002 Paris", "France"), "75002"),
        (T.postal_code, ("110001 and 12345", "USA"), "110001"),
        (T.postal_code, (None, None), ""),
        (T.extract_numbers, ("6(29), C.I.T. Colony, Plot 102, Floor 3",), ["6", "29", "102", "3"]),
        (T.leet, ("gl0b4l 3$",), "global es"),
        (T.clean_extra_legal, ("llc",), ""),
        (T.clean_extra_legal, ("acme_1é",), "acme1"),
        (T.parse_ids, (" S2-1, S3-2,,S2-1 ",), ["S2-1", "S3-2"]),
        (T.parse_ids, (None,), []),
        (T.strip_accents, ("Café Ångström",), "Cafe Angstrom"),
    ],
)
def test_cases(spark, fn, args, expected):
    assert one(spark, fn, *args) == expected


def test_nfkc_only_where_asked(spark):
    text = "ﬁne Ｃｏ １２"
    assert one(spark, lambda c: T.unicode_clean(c, True), text) == unicodedata.normalize("NFKC", text)
    assert one(spark, T.unicode_clean, text) == text


@pytest.mark.parametrize("dialect,anchor,word", [("train", "12_newton", "newton"), ("test", "12 old", "newton"), ("query", "12_old", "old")])
def test_key_dialects(spark, dialect, anchor, word):
    rows = spark.createDataFrame([("12 old newton road",)], "a string")
    got = rows.select(
        T.addr_anchor(F.col("a"), T.extract_numbers(F.col("a")), dialect).alias("x"), T.addr_tok1(F.col("a"), dialect).alias("y")
    ).first()
    assert tuple(got) == (anchor, word)


def test_format_ids(spark):
    rows = spark.createDataFrame([(["b", "a", "b"],), (None,)], "ids array<string>")
    got = rows.select(T.format_ids(F.col("ids")), T.format_ids(F.col("ids"), ordered=False)).collect()
    assert [tuple(r) for r in got] == [("a,b", "b,a"), ("", "")]
