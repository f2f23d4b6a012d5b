import os
import sys

import pytest

ROOT = os.path.abspath(os.path.join(os.path.dirname(__file__), "..", ".."))
# The tasks' own Python processes import the package as well.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from ``(doc_id, text)`` rows, with columns that clash with what operators return."""
    def run(rows, parts=3):
        full = [(i, t, "en", "src", None if t is None else len(t), "x", 7, "k", True) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", component_id string, n_tokens long, spans string, kept boolean").repartition(parts)
    return run
