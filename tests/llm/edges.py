"""Tables of awkward rows for the training-data operators."""

from __future__ import annotations

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000

#: doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id string, _kept int, _label int, "
          "label string, node long, _score double, size int, a int, b int, _n int, block int, score string, _lines int")

ROWS = [
    (1, "One line of text\nand another line of text", "en", "s1", 42),
    (1, "One line of text\nand another line of text", "en", "s1", 42),
    (2, "one line of text  \nsomething else entirely here", "en", None, 1),
    (3, None, "en", "s1", None),
    (4, "", None, "s2", 0),
    (5, "   \n \t ", "de", "s2", 7),
    (6, LONG, "en", "s2", len(LONG)),
    (7, LONG + " omega", "en", "é", len(LONG)),
    (8, "café \U0001f600 naïve 中文 text with signs", "fr", "s1", 3),
    (None, "a row that has no id at all", "es", "s1", 3),
    (None, None, None, None, None),
    (9, "idiot " * 50, "en", "s3", 1),
    (10, "x", "en", "s3", 1),
    (11, "x", "en", "s3", 1),
]


def docs(spark, rows=ROWS):
    more = ("id", 1, 1, "label", 5, 0.5, 7, 1, 2, 3, 4, "high", 9)
    return spark.createDataFrame([r + more for r in rows], SCHEMA)


def labels(spark, rows=((1, 1, 0), (2, 1, 0), (9, 0, 1), (9, 0, 1), (6, None, None), (None, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
