"""The library without the training-data package: entry, queries and tests still load."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import __spark_entry__ as e
names = set(e.queries())
assert set(e.oracle_sql()) <= names
print(len(names), sorted(n for n in names if n == "pipeline" or n[:2] == "op" and n[2].isdigit()))
"""


def copy_without(tmp_path, *gone):
    skip = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse")
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: skip(d, names) | {n for n in names if os.path.relpath(os.path.join(d, n), ROOT) in gone})
    return copy


def run(copy, *args):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, *args], cwd=copy, env=env, capture_output=True, text=True, timeout=300)


def test_rest_loads_without_the_package_and_the_pipeline(tmp_path):
    copy = copy_without(tmp_path, "voltide/llm", "tests/llm", "corpus_pipeline.py")
    got = run(copy, "-c", PROBE)
    assert got.returncode == 0, got.stderr
    assert got.stdout.split(" ", 1)[1].strip() == "[]"


def test_rest_loads_without_the_package_alone(tmp_path):
    copy = copy_without(tmp_path, "voltide/llm", "tests/llm")
    got = run(copy, "-c", PROBE)
    assert got.returncode == 0, got.stderr
    assert got.stdout.split(" ", 1)[1].strip() == "[]"


def test_all_test_modules_can_be_collected(tmp_path):
    copy = copy_without(tmp_path, "voltide/llm", "tests/llm")
    got = run(copy, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert got.returncode == 0, got.stdout[-2000:]
