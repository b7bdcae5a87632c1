"""The driver's entry, with and without the llm subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["file", "clip", "start", "end", "text"]


def test_entry_without_llm():
    code = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['quillwave.llm'] = None; import __spark_entry__ as e; assert 'cue_clips' in e.queries() and 'pipeline' not in e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
