"""The registered queries with and without the document operators beside the library."""
import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

PROBE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
print(len(entry.queries()), "pipeline" in entry.queries(), any(n.startswith("op") for n in entry.queries()),
      "mom_changes" in entry.oracle_sql(), sorted(set(entry.oracle_sql()) - set(entry.queries())))
"""


def _probe(folder):
    run = subprocess.run([sys.executable, "-c", PROBE, str(folder)], cwd=folder, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout.strip()


@pytest.mark.parametrize("gone", [("setbook/llm",), ("setbook/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_the_document_operators(tmp_path, gone):
    copied = tmp_path / "repo"
    left_out = shutil.ignore_patterns("__pycache__", "llm") if "setbook/llm" in gone else shutil.ignore_patterns("__pycache__")
    shutil.copytree(f"{ROOT}/setbook", copied / "setbook", ignore=left_out)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in gone and os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", copied / name)
    n, pipeline, documents, marts, orphans = _probe(copied).split(" ", 4)
    there = "setbook/llm" not in gone and os.path.isdir(f"{ROOT}/setbook/llm")
    assert int(n) > 90 and marts == "True" and orphans == "[]"
    assert pipeline == "False" and documents == str(there)
