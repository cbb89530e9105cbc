"""The entry module stands whether or not the training-data operators are there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"


def entry_of(folder):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def copied(to, without):
    skip = shutil.ignore_patterns("__pycache__", *without)
    shutil.copytree(os.path.join(ROOT, "tillroll"), to / "tillroll", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), to / name)
    return to


def test_core_queries_stand_without_the_training_part(tmp_path):
    for number, without in enumerate((["llm"], ["llm", "corpus_pipeline.py"])):
        count, pipeline, known = entry_of(copied(tmp_path / str(number), without))
        assert int(count) >= 60 and pipeline == "False" and known == "True"
