"""The entry without the training-data operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
CODE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
assert "dedupe_global" in entry.queries() and len(entry.oracle_sql()) > 50
assert not any(name.startswith("op") and name[2].isdigit() for name in entry.queries())
"""


def imported_without(missing: str) -> int:
    return subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT).returncode


def test_entry_without_the_training_data_operators():
    assert imported_without("corpus_pipeline") == 0
    assert imported_without("addrloom.llm") == 0


def test_other_missing_modules_are_not_hidden():
    assert imported_without("pyarrow") != 0
