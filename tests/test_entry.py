"""The contract file without the folder of training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(q.startswith('op') for q in e.queries()))"


def _listed(folder: str) -> list[int]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return list(map(int, done.stdout.split()))


def test_other_queries_stay_without_the_folder(tmp_path):
    from market_lens.plans import CHECKS, QUERIES

    for kept in ("", "left"):  # the folder is gone, or left empty
        copy = tmp_path / f"repo{kept}"
        copy.mkdir()
        shutil.copy(f"{ROOT}/__spark_entry__.py", copy)
        shutil.copytree(f"{ROOT}/market_lens", copy / "market_lens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        if kept:
            (copy / "market_lens" / "llm").mkdir()
        assert _listed(str(copy)) == [len(QUERIES), len(CHECKS), 0]


def test_an_error_inside_the_folder_is_not_hidden(tmp_path):
    copy = tmp_path / "repo"
    copy.mkdir()
    shutil.copy(f"{ROOT}/__spark_entry__.py", copy)
    shutil.copytree(f"{ROOT}/market_lens", copy / "market_lens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (copy / "market_lens" / "llm").mkdir()
    (copy / "market_lens" / "llm" / "queries.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode and "no_such_module" in done.stderr
