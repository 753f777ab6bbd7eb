"""The other queries register without the optional folders and packages."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("absent", [("tidegate.llm", "corpus_pipeline"), ("public_tokenizers",), ("zstandard",)])
def test_entry_point_without(absent):
    code = f"""
import sys
for name in {absent!r}:
    sys.modules[name] = None  # importing it now fails
import __spark_entry__ as entry
names = entry.queries()
assert len(names) > 150 and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(entry.oracle_sql()) <= set(names)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
