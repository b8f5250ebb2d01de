"""The README's coverage list names every registered query."""

import os

import __spark_entry__ as E
from tickerpulse.plans import catalog


def test_readme_lists_every_query():
    readme = open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "README.md")).read()
    missing = [n for n in E.queries() if f"`{n}`" not in readme]
    assert not missing, missing


def test_every_core_query_has_an_oracle():
    assert set(catalog.queries()) <= set(E.oracle_sql())
