"""The driver's contract, with and without the text subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAYS = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), sum(k.startswith('op') for k in q))"


def run(folder):
    return subprocess.run([sys.executable, "-c", SAYS], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_catalogue_stands_without_the_text_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "strandplan"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    n, text = map(int, run(tmp_path))
    assert n > 130 and text == 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["sro", "median_d3", "max_d3", "pct_auto"] and df.count() == 25
