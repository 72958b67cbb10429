import importlib
import sys

import __spark_entry__ as entry
from archivolt.plans import catalogue


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_without_the_text_problems(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("archivolt.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "archivolt.llm", None)
    plain = importlib.reload(entry)
    assert set(plain.queries()) == set(catalogue.queries())
    monkeypatch.undo()
    importlib.reload(entry)
