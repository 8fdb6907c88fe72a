"""The driver's entry points work with and without the corpus operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_corpus_operators():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['jobsift.llm'] = None\n"
            "import __spark_entry__ as e; names = set(e.queries()); assert 'screen_listings' in names and len(names) >= 46\n"
            "assert not any(n.startswith('op') for n in names) and set(e.oracle_sql()) <= names")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_other_import_errors_are_not_swallowed(tmp_path):
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); sys.path.append({ROOT!r})\nimport __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode and "a_module_that_is_not_there" in done.stderr
