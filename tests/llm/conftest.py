import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: texts every text operator must take: null, empty, blanks, no letters,
#: repeated, accented, astral, control characters, very long
EDGE_TEXTS = [None, "", " \n\t", "12 34", "same text here", "same text here", "Größe naïve ÉCOLE 漢字 😀",
              "a\x00b\x0bc\r\nd", "word " * 30_000, "x" * 100_000, "\n" * 50]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0, langs=None):
    rows = [(first + i, t, (langs or ["en"] * len(texts))[i], "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)
