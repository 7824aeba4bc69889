"""The driver imports __spark_entry__.py from its own working directory with
its own session: Python-worker queries must still find their code."""
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location('entry', {os.path.join(REPO, '__spark_entry__.py')!r})
e = importlib.util.module_from_spec(spec); spec.loader.exec_module(e)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')
         .config('spark.ui.showConsoleProgress', 'false').getOrCreate())
assert e.entry(spark).count() == 1
q = e.queries()
for n in ('translate_documents_distributed', 'injected_document_function'):
    print(n, q[n](spark, '/root/testdata/sf0.001').count())
spark.stop()
"""


def test_python_worker_queries_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="paperlane-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "translate_documents_distributed 200" in out.stdout
    assert "injected_document_function 200" in out.stdout
