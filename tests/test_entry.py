"""The library without its optional subpackage, in a copy of the tree."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
PROGRAM = """
import __spark_entry__ as e
assert not any(n.startswith("op") or n == "pipeline" for n in e.queries()), sorted(e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
print(len(e.queries()))
"""


def _copy(to: Path, without: tuple[str, ...]) -> Path:
    def left_out(folder, names):
        inside = Path(folder).relative_to(ROOT)
        return [n for n in names if n.startswith((".git", "__pycache__")) or str(inside / n) in without]

    shutil.copytree(ROOT, to, ignore=left_out)
    return to


@pytest.mark.parametrize(
    "without", [("tidemark/llm", "tests/llm"), ("tidemark/llm", "tests/llm", "corpus_pipeline.py")]
)
def test_the_rest_imports_without_the_optional_folders(tmp_path, without):
    tree = _copy(tmp_path / "tree", without)
    run = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tree, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) >= 50


def test_an_error_inside_the_subpackage_is_not_hidden(tmp_path):
    tree = _copy(tmp_path / "tree", ("tests/llm",))
    package = tree / "tidemark" / "llm"
    package.mkdir(exist_ok=True)
    (package / "__init__.py").write_text("")
    (package / "queries.py").write_text("import a_module_that_is_not_there\n")
    run = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tree, capture_output=True, text=True, timeout=120
    )
    assert run.returncode != 0 and "a_module_that_is_not_there" in run.stderr
