import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [ROOT, HERE]
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the Python workers

SMALL = "/root/testdata/sf0.001"
LINE = "the same passage of words stands in many of these documents and is longer than a hundred bytes for sure, it is. "


def odd_rows():
    """Nulls, empty and very long texts, ties, repeats, other scripts."""
    text = " ".join(f"word{i % 977} and{i % 31}" for i in range(300))
    return [(10_000, None, "en", None, 0), (10_001, "", "en", "zz", 0), (10_002, " \n\t ", None, "zz", 3), (10_003, "one", "en", "zz", 3),
            (10_004, "One", "en", "zz", 3), (10_005, "two words", "en", "zz", 9), (10_006, text, "en", "big", len(text)),
            (10_007, text, "en", "big", len(text)), (10_008, text.replace("word5 ", "wörd "), "en", "big", None),
            (10_009, LINE + text[:500], "en", "big", 0), (10_010, text[500:1200] + "\n" + LINE, "en", "a", 0),
            (10_011, "x" * 5000, "en", "a", 0), (10_012, "héé " * 900, "fr", "a", 0),
            (10_013, " ".join(f"w{i * i % 7919}x{i}" for i in range(30_000)), "en", "a", 0),
            (10_014, "中文 字符 テスト。\n" * 40, "zh", "a", 0), (10_015, "a b\x1cc d  e \n f", "en", "a", 0)]


COLS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest documents table, odd rows, and extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    from tidemark.llm.common import cut
    d = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    d = d.unionByName(spark.createDataFrame(odd_rows(), COLS))
    return cut(d.select("*", *[F.lit("clash").alias(c) for c in ("uid", "rep", "node", "size", "n_words", "before", "own", "kept", "pid", "TEXT2")]), "test-docs")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLS)


@pytest.fixture(scope="session")
def repeated(spark):
    """Rows that repeat an id, with equal and other text, and null ids."""
    t = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
    return spark.createDataFrame([(1, t, "en", "s", 1), (1, t, "en", "s", 1), (1, "other " + t[:90], "en", "s", 1), (None, t, "en", "s", 1),
                                  (None, None, None, None, None), (2, t + " tail", "en", None, 1)], COLS)
