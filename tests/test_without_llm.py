"""The core does not need the optional subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("rowloom.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
names = set(e.queries())
assert names and not any(n.startswith("p1_") or n.startswith("p9_") for n in names)
assert {"p3_found", "p4_found"} <= names and set(e.oracle_sql()) <= names
"""


def test_import_without_the_subpackage():
    subprocess.run([sys.executable, "-c", BLOCK], cwd=ROOT, check=True, timeout=120)


def test_foreign_import_errors_are_raised():
    block = BLOCK.replace('name.startswith("rowloom.llm")', 'name == "pandas"').split("import __spark_entry__")[0]
    done = subprocess.run([sys.executable, "-c", block + "import __spark_entry__"], cwd=ROOT, capture_output=True, timeout=120)
    assert done.returncode


def test_nothing_outside_imports_it():
    for folder, _, files in os.walk(os.path.join(ROOT, "rowloom")):
        if os.sep + "llm" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(folder, f), encoding="utf-8").read()
                assert "rowloom.llm" not in text, f
