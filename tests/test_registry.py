"""The registry of queries with parts of it missing."""

import sys

import __spark_entry__ as entry


def _without(monkeypatch, *names):
    for name in list(sys.modules):
        if name.startswith(("sparkmart.llm", "corpus_pipeline")):
            monkeypatch.delitem(sys.modules, name)
    for name in names:
        monkeypatch.setitem(sys.modules, name, None)  # importing it raises ImportError


def test_core_queries_stand_without_a_library_of_the_corpus_queries(monkeypatch, recwarn):
    _without(monkeypatch, "public_tokenizers")
    assert "v00_error_code_counts" in entry.queries() and "v00_error_code_counts" in entry.oracle_sql()
    assert not [q for q in entry.queries() if q.startswith("op")]


def test_core_queries_stand_without_the_corpus_queries(monkeypatch):
    _without(monkeypatch, "corpus_pipeline", "sparkmart.llm")
    assert "m07_fact_student_module_presentation_week" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
