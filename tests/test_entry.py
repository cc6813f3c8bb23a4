import importlib.util
import sys
from pathlib import Path

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"


def loaded(name):
    spec = importlib.util.spec_from_file_location(name, ENTRY)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry_works_without_the_optional_subpackage(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("fieldtally.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # makes its import fail
    monkeypatch.setitem(sys.modules, "fieldtally.llm", None)
    entry = loaded("entry_without")
    assert entry.queries().keys() == entry.oracle_sql().keys()
    assert entry.FLAGSHIP in entry.queries() and "pipeline" not in entry.queries()
