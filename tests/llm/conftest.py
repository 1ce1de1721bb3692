import os

import pytest

SF = "/root/testdata/sf0.001"

#: Rows of documents with everything that may go wrong, plus columns whose names clash with those
#: that operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, n int, "
          "node string, size string, part string, key string, start string, row string, features string")


def docs_frame(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, 1, "x", "y", "z", "k", "s", "r", "f") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_rows():
    long = " ".join(f"word{i % 997} of the {i % 13}" for i in range(30_000))
    return [(1, "The quick brown fox jumps over the lazy dog and runs away from the old farm.", "en", "a"),
            (2, None, "en", "a"), (3, "", None, None), (4, "   \n\t ", "de", "b"), (5, "!!! ??? 123 ...", "de", None),
            (6, long, "en", "c"), (7, "Émile a vu l'été — ñandú ß 日本語 \U0001F600", "fr", "b"),
            (8, "The quick brown fox jumps over the lazy dog and runs away from the old farm.", "en", "a"),
            (8, "The quick brown fox jumps over the lazy dog and runs away from the old farm.", "en", "a"),
            (9, "one", "en", "a"), (None, "a row without an id", "en", "a"), (10, "x\u0000y <|im_end|> z", None, "c")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return docs_frame(spark, odd_rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return docs_frame(spark, [])


@pytest.fixture(scope="session", autouse=True)
def import_path():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
