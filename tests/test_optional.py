"""The library and its entry point work without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDE = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "tidecast.llm") or name.startswith("tidecast.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
sys.path.insert(0, %r)
import __spark_entry__ as e
q = e.queries()
assert q and "pipeline" not in q and not any(k.startswith("op1_") for k in q)
assert set(e.oracle_sql()) <= set(q)
""" % ROOT


def test_entry_without_the_subpackage():
    subprocess.run([sys.executable, "-c", HIDE], check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "tidecast")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for f in files:
            if f.endswith(".py"):
                assert "llm" not in open(os.path.join(folder, f)).read(), f


def test_all_test_modules_are_collected_with_and_without_the_optional_part():
    here = os.path.join(ROOT, "tests")
    for more in ([], ["--ignore", os.path.join(here, "llm")]):
        out = subprocess.run([sys.executable, "-m", "pytest", here, "--collect-only", "-q", "-p", "no:cacheprovider", *more],
                             capture_output=True, text=True, timeout=240, cwd=ROOT)
        assert out.returncode == 0, out.stdout[-2000:]
        for module in ("test_models", "test_oracle", "test_plans", "test_properties", "test_streaming"):
            assert f"{module}.py" in out.stdout
