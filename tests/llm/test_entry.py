"""The training-data queries are left out where their folder is gone, and only there."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]


def queries_of(folder, change, path=None):
    """Number of training-data queries of a changed copy, or None where its import fails; `path` goes before its own."""
    shutil.copytree(REPO / "eventmart", folder / "eventmart", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(REPO / name, folder)
    change(folder)
    code = "import __spark_entry__ as e; print(len(e.EXTRA_QUERIES))"
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | ({"PYTHONPATH": path} if path else {})
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, env=clean)
    return int(done.stdout.split()[-1]) if done.returncode == 0 else None


def empty_folder(folder):
    shutil.rmtree(folder / "eventmart/llm")
    (folder / "eventmart/llm").mkdir()


def pipeline_line(line):
    return lambda folder: (folder / "corpus_pipeline.py").write_text(line + "\n" + (REPO / "corpus_pipeline.py").read_text())


@pytest.mark.parametrize("change, want", [
    (lambda folder: None, 14), (lambda folder: shutil.rmtree(folder / "eventmart/llm"), 0), (empty_folder, 0),
    (lambda folder: (folder / "corpus_pipeline.py").unlink(), 0),
    (pipeline_line("from eventmart.llm import mixng"), None), (pipeline_line("from os import no_such_name"), None),
    (pipeline_line("import no_such_module"), None), (pipeline_line("raise ImportError('native library')"), None),
    (pipeline_line("raise ModuleNotFoundError('native library')"), None)])
def test_queries_are_left_out_only_without_their_folder(tmp_path, change, want):
    assert queries_of(tmp_path, change) == want


def test_another_copy_on_the_path_does_not_count(tmp_path):
    """The pipeline of the repository is on the path, that of the copy is deleted."""
    path = os.pathsep.join([str(tmp_path), str(REPO)])
    assert queries_of(tmp_path, lambda folder: (folder / "corpus_pipeline.py").unlink(), path) == 0
