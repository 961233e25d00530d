"""Inputs shared by the tests of this folder; the session comes from the conftest above it."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus():
    import pandas as pd

    return pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]]


SCHEMA = "doc_id long, text string, lang string, _row int, d int"
#: nulls, empties, blanks, ties, repeated rows and columns whose names operators use inside
MESSY = [(1, None, "en", 1, 1), (2, "", None, 2, 2), (3, " \t \n\x0b", "en", 3, 3), (4, "a", "de", 4, 4),
         (4, "a", "de", 4, 4), (None, "null id, same words as others here", None, None, None),
         (5, "Ünïcödé ﬁ ▁ 漢字  two  spaces  nbsp　wide\r\nline  ", "fr", 5, 5),
         (6, "<s> </s> <unk> <0x0A> <|endoftext|> <|startoftext|>x 's't", "en", 6, 6),
         (7, "a" * 5000 + " " * 700 + "é" * 900 + "\n" * 50 + "1" * 300, "es", 7, 7),
         (8, "word " * 30000, "en", 8, 8)]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(MESSY, SCHEMA)
