import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import CLASHES, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    extra = "".join(f", `{c}` string" for c in CLASHES)
    rows = [(i, t, "en", s, None if t is None else len(t), *["clash"] * len(CLASHES)) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long{extra}").repartition(3)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
