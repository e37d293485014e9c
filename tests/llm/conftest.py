import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(20_000))
#: NULLs, blanks, one word, ties, repeats, a very long text, clashing extra columns.
ROWS = [(1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, " \t\n", None, "b"), (6, "word", "en", "c"), (7, "12345 !!", "de", "c"),
        (8, LONG, "en", "d"), (9, LONG + " tail", "en", "d"), (None, "der hund und die katze", "de", None),
        (10, "der hund und die katze im haus", "de", "b"), (11, "das haus und der hund mit der katze", "de", "b"),
        (12, "a dog and a cat in the house", "en", "b"), (13, "x " * 50, None, "a")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size int, kept string"


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, 7, "extra") for r in ROWS], SCHEMA)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from shoal.session import build_session
    s = build_session("local[4]", app="llm-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-test-"))
    return s
