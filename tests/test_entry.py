"""The entry works where the corpus subpackage has been taken away."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "strandwise"), tmp_path / "strandwise", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'sort_markdup' in q and set(q) == set(e.oracle_sql()) and not any(n.startswith('op') or n == 'pipeline' for n in q if n != 'output_name' and n != 'orientation')"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})


def test_nothing_else_imports_the_corpus_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "strandwise")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "llm" not in f.read()
