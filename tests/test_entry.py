"""The driver's entry module, with and without the text operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
WITHOUT = """
import sys
for name in ("tallywright.llm", "corpus_pipeline"):
    sys.modules[name] = None
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert "fct_orders" in q and not [n for n in q if n.startswith("op") and n[2:3].isdigit()] and "pipeline" not in q
assert set(o) == set(q)
"""
BROKEN = """
import sys, types
sys.modules["corpus_pipeline"] = types.ModuleType("corpus_pipeline")
import tallywright
class Finder:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("no tokenizers", name="tokenizers")
del sys.modules["corpus_pipeline"]
sys.meta_path.insert(0, Finder())
import __spark_entry__ as e
try:
    e.queries()
except ModuleNotFoundError as error:
    assert error.name == "tokenizers"
else:
    raise AssertionError("a missing requirement was swallowed")
"""


def test_entry_works_without_the_text_modules():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True)


def test_entry_does_not_hide_other_missing_modules():
    subprocess.run([sys.executable, "-c", BROKEN], cwd=ROOT, check=True)
