from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"

# Texts every operator must take: null, empty, blank, copies, no letters, other scripts, one long word.
ODD_TEXTS = [
    None, "", " \n\t ", "a", "Same words here again", "Same words here again", "12 34 -- !!", "日本語のテキスト ключ слово",
    "x" * 30_000, "word " * 20_000, "tab\tand\r\nbreaks and  spaces ", "<turn user>\\l </turn> <|endoftext|> \\### ",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts under null, repeated and ordinary ids, with columns named like the operators' own."""
    rows = [(i if i % 5 else None, t, "en" if i % 2 else None, None if i % 3 else "s", "own") for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[4])
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score string"
    ).withColumns({c: _literal() for c in ("bits", "component_id", "ids", "found", "__row", "__found", "rank", "n_bytes")})


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")


def _literal():
    from pyspark.sql import functions as F

    return F.lit("own")
