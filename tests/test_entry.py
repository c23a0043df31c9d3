"""The entry point with and without the training-data subpackage."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("gone", ["tarnworks.llm", "tokenizers"])
def test_imports_without_llm(gone):
    code = f"""
        import sys
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" and {gone!r} != "tokenizers" or name.startswith({gone!r}):
                    raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert e.queries() and not any(k.startswith("op") or k == "pipeline" for k in e.queries())
        assert e.oracle_sql()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=REPO, check=True, timeout=120)
