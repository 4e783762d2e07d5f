"""The coverage table names every registered operator query."""
import os
import re

from ledgerline.plans.queries import QUERIES
from ledgerline.plans.registry import MODELS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_coverage_lists_every_operator_query():
    text = open(os.path.join(ROOT, "COVERAGE.md")).read()
    named = set(re.findall(r"`([a-z_0-9]+)`", text))
    operators = set(QUERIES) - set(MODELS)
    assert operators - named == set()
