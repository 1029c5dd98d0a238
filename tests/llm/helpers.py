"""Small tables with awkward rows, and plain versions of the operators."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


#: nulls, empty and blank texts, repeated rows and ids, ties, a long text
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (5, "One two three"),
    (5, "One two three"),
    (6, "one two"),
    (6, words(80)),
    (7, words(80)),
    (None, words(80)),
    (8, words(80) + " tail"),
    (9, "x " * 3000),
    (10, "é漢 ß z " + words(60, 20)),
    (11, words(20_000, 500)),
]
