"""The driver contract holds with and without the corpus part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"


def _copy(target: Path, leave: set[str]) -> Path:
    for name in ["__spark_entry__.py", "corpus_pipeline.py", "curbline"]:
        if name in leave:
            continue
        source = ROOT / name
        if source.is_dir():
            skip = lambda folder, names: [n for n in names if n == "__pycache__" or f"{Path(folder).name}/{n}" in leave]
            shutil.copytree(source, target / name, ignore=skip)
        else:
            shutil.copy(source, target / name)
    return target


@pytest.mark.parametrize("leave", [{"curbline/llm"}, {"curbline/llm", "corpus_pipeline.py"}])
def test_contract_without_the_corpus_part(tmp_path, leave):
    tree = _copy(tmp_path, leave)
    run = subprocess.run([sys.executable, "-B", "-c", CODE], cwd=tree, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    count, pipeline, covered = run.stdout.split()
    assert int(count) > 100 and pipeline == "False" and covered == "True"


def test_a_missing_module_of_the_corpus_part_is_a_fault(tmp_path):
    if not (ROOT / "curbline/llm/common.py").exists():
        pytest.skip("the corpus part is not installed")
    tree = _copy(tmp_path, {"llm/common.py"})
    run = subprocess.run([sys.executable, "-B", "-c", CODE], cwd=tree, capture_output=True, text=True, timeout=120)
    assert run.returncode != 0 and "common" in run.stderr
