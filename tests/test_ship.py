"""The package reaches workers that cannot import it from their own path."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_import_the_shipped_package(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.python.worker.reuse", "false").getOrCreate())
        from quarry.session import ship_package
        ship_package(s)
        def where(_):
            sys.path[:] = [p for p in sys.path if p != {ROOT!r}]
            import quarry
            yield quarry.__file__
        print("FOUND", s.sparkContext.parallelize([0], 1).mapPartitions(where).first())
        s.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=300)
    found = [x for x in out.stdout.splitlines() if x.startswith("FOUND")]
    assert found and "quarry.zip" in found[0], out.stdout + out.stderr
