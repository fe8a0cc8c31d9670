"""The driver's contract, with and without the training-data operators."""

import subprocess
import sys

from .conftest import ROOT

BLOCKED = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("spectrail.llm", "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, ROOT)
import __spark_entry__ as e
names = set(e.queries())
assert "similarity_71" in names and not any(n[:2] == "op" and n[2].isdigit() for n in names), names
assert set(e.oracle_sql()) <= names
"""


def test_without_the_subpackage():
    subprocess.run([sys.executable, "-c", BLOCKED.replace("ROOT", repr(ROOT))], check=True, timeout=120)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[0] == "pair_id"
