import importlib
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_every_sql_has_a_query():
    e = importlib.import_module("__spark_entry__")
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_stands_without_the_text_subpackage():
    code = "import sys; sys.modules['pagegrain.llm'] = None; import __spark_entry__ as e; assert 'p2_found' in e.queries() and 'p4_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_nothing_outside_imports_it():
    for p in (REPO / "pagegrain").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm import" not in p.read_text() and "import llm" not in p.read_text(), p
