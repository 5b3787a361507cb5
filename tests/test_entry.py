"""The driver's entry point works whether or not the optional parts are there."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = (
    "import __spark_entry__ as e; names = sorted(e.queries()); "
    "print(len(names), sum(n.startswith('op') for n in names), 'pipeline' in names, "
    "set(e.oracle_sql()) <= set(names))"
)


def imported(folder: Path, code: str = SHOW) -> subprocess.CompletedProcess:
    # the copy alone, whatever path the tests themselves were started with
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-B", "-c", code]
    return subprocess.run(command, cwd=folder, env=env, capture_output=True, text=True, timeout=120)


def copied(folder: Path, *without: str) -> Path:
    def ignore(directory: str, names: list[str]) -> list[str]:
        place = Path(directory).relative_to(ROOT)
        hidden = [n for n in names if n in (".git", "__pycache__", "tests")]
        return hidden + [n for n in names if str(place / n) in without]

    shutil.copytree(ROOT, folder / "copy", ignore=ignore)
    return folder / "copy"


@pytest.mark.parametrize(
    "without", [("requestmill/llm", "corpus_pipeline.py"), ("requestmill/llm",)]
)
def test_without_the_optional_parts(tmp_path, without):
    bare = imported(copied(tmp_path, *without))
    assert bare.returncode == 0, bare.stderr
    count, operators, pipeline, known = bare.stdout.split()
    assert int(count) > 80 and (operators, pipeline, known) == ("0", "False", "True")


def test_without_the_pipeline_alone(tmp_path):
    bare = imported(copied(tmp_path, "corpus_pipeline.py"))
    assert bare.returncode == 0, bare.stderr
    there = (ROOT / "requestmill/llm").exists()
    assert bare.stdout.split()[2] == "False" and (bare.stdout.split()[1] != "0") == there


def test_nothing_else_imports_them():
    for path in [*ROOT.glob("requestmill/**/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "requestmill.llm" not in path.read_text(), path


def test_other_import_errors_are_raised(tmp_path):
    folder = copied(tmp_path)
    if not (folder / "corpus_pipeline.py").exists():
        return
    (folder / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    assert "a_module_that_is_not_there" in imported(folder).stderr
