import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

HERE = os.path.dirname(os.path.abspath(entry.__file__))


def test_queries_and_sql_belong_together():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"sub_07_sdc_pair", "run_01_full_evaluation"} <= set(entry.oracle_sql())


def test_copy_without_the_training_data_folders(tmp_path):
    """The other queries stay as they are when both folders and the pipeline are deleted."""
    at = tmp_path / "copy"
    shutil.copytree(HERE, at, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op')])"
    out = subprocess.run([sys.executable, "-c", code], cwd=at, env=os.environ | {"PYTHONPATH": str(at)}, capture_output=True, text=True, check=True).stdout
    n = sum(not q.startswith("op") and q != "pipeline" for q in entry.queries())
    assert out.split(maxsplit=2)[0] == str(n) and out.strip().endswith("[]")


def test_broken_import_within_the_training_data_package_is_an_error(tmp_path):
    at = tmp_path / "copy"
    shutil.copytree(HERE, at, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    if not (at / "roadsift/llm").is_dir():
        return
    (at / "roadsift/llm/registry.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=at, env=os.environ | {"PYTHONPATH": str(at)}, capture_output=True, text=True)
    assert done.returncode and "no_such_module" in done.stderr


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
