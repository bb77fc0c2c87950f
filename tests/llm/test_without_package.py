"""Every registered corpus query runs where the executors' Python cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import corpus_pipeline
from cadenza.llm import queries
from cadenza.session import local_session

def tried(_):
    try:
        import cadenza
    except ModuleNotFoundError:
        return [0]
    return [1]

spark = local_session("bare", cpus=4, memory="3g")
spark.conf.set("spark.sql.shuffle.partitions", "4")
assert sum(spark.sparkContext.parallelize(range(4), 4).mapPartitions(tried).collect()) == 0
wanted = dict(queries.QUERIES, pipeline=corpus_pipeline.run)
for name, query in wanted.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_queries_run_without_the_package_on_executors(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = {line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")}
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(ran) >= 14 and "pipeline" in ran
