"""Kernels travel to the workers whole: executors have no copy of the package, and none of it on their path."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN = """
import sys
sys.path.insert(0, {root!r})
from quillspark.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=4, extra={{"spark.sql.warehouse.dir": {here!r} + "/wh", "spark.driver.memory": "2g"}})
spark.sparkContext.setCheckpointDir({here!r} + "/ckpt")
from quillspark.llm.queries import REGISTRY
for name, (query, _) in REGISTRY.items():
    if name.split("_")[0] in {names!r}:
        print(name, query(spark, {data!r}).count())
"""


def test_queries_from_a_foreign_folder(tmp_path):
    sys.path.insert(0, os.path.dirname(__file__))
    import data
    import test_new_operators as new
    path = data.write(tmp_path, labels=[(i, int(i % 5 == 0)) for i in range(40)])
    new.write_conversations(tmp_path, new.awkward_conversations()[:60])
    names = ("op6", "op7", "op11", "op12", "op13")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = RUN.format(root=ROOT, here=str(tmp_path), data=path, names=names)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stdout + done.stderr[-1500:]
    assert len([line for line in done.stdout.splitlines() if line.startswith("op")]) == len(names)
