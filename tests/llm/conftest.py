import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF01 = "/root/testdata/sf0.01"

# Texts that are null, empty, without words, very long, repeated, beyond ASCII.
ODD_TEXTS = [None, "", " \n\t ", "!!! ---", "the the the the the the", "Ünïcode  ñandú 漢字 é́  x y", "a" * 40_000,
             "word " * 30_000, "one two three four five six seven", "one two three four five six seven", "<|endoftext|> x", "\u0085  z",
             "under the MIT License. CC-BY-NC under the mit license"]


@pytest.fixture(scope="session")
def spark():
    from blogweave.session import build_session, configure
    s = configure(build_session("local[8]", shuffle_partitions=8, app_name="blogweave-llm-tests"))
    yield s


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts, repeated rows, a null id, and extra columns with clashing names."""
    rows = [(i, t, "en", "src0", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[8], rows[8], (None, "null id here", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


def crc_of(ids):
    import zlib

    import numpy as np
    return zlib.crc32(np.array(ids, "<u4").tobytes())
