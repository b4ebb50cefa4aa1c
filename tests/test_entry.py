"""The driver contract holds with and without the optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(at: Path) -> list[str]:
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(*sorted(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=at, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def copied(to: Path, *without: str) -> Path:
    skip = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, to, ignore=skip)
    for w in without:
        (shutil.rmtree if (to / w).is_dir() else Path.unlink)(to / w)
    return to


def test_imports_without_the_corpus_folders(tmp_path):
    if not (ROOT / "quillfold" / "llm").exists():
        found = names(ROOT)
    else:
        assert {"op1_lm_score", "pipeline"} <= set(names(ROOT))
        found = names(copied(tmp_path / "no-folders", "quillfold/llm", "tests/llm"))
        assert names(copied(tmp_path / "no-part", "quillfold/llm", "tests/llm", "corpus_pipeline.py")) == found
        assert set(found) <= set(names(ROOT))
    assert len(found) > 150 and not any(n.startswith("op1_") or n == "pipeline" for n in found)


def test_entry_gives_rows(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["document_id", "request_id", "state", "readiness", "attention"] and df.count() > 0
