from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import EXTRA, tricky_texts  # noqa: E402


@pytest.fixture(scope="session")
def tricky():
    return tricky_texts()


@pytest.fixture(scope="session")
def documents(spark, tricky):
    schema = "doc_id bigint, source string, text string, lang string, n_chars bigint, " + ", ".join(
        f"`{c}` string" for c in EXTRA
    )
    rows = [(i, s, t, None, len(t or ""), *EXTRA) for i, s, t in tricky]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
