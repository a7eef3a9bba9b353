"""The repository without the corpus subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_llm(tmp_path):
    (tmp_path / "methlake").mkdir()
    for name in os.listdir(f"{ROOT}/methlake"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/methlake/{name}", tmp_path / "methlake" / name)
    os.symlink(f"{ROOT}/jobs", tmp_path / "jobs")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'qc_table' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    env = os.environ | {"PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    (tmp_path / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, check=True)


def test_nothing_outside_imports_llm():
    for top in ("methlake", "jobs"):
        for folder, _, names in os.walk(f"{ROOT}/{top}"):
            if "/llm" not in folder:
                for n in names:
                    if n.endswith(".py"):
                        text = open(f"{folder}/{n}").read()
                        assert "methlake.llm" not in text and "corpus_pipeline" not in text
