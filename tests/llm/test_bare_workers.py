"""Queries in a session whose workers find nothing of the repository on their path."""

import os
import subprocess
import sys

SCRIPT = """
import os, sys, tempfile
sys.path.insert(0, sys.argv[1])
from annomill.session import local_session
from pyspark.sql import functions as F

spark = local_session(4, "bare", **{"spark.checkpoint.dir": sys.argv[3]})
spark.sparkContext.setLogLevel("ERROR")

def found(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        here = importlib.util.find_spec("annomill") is not None
        yield pa.RecordBatch.from_arrays([pa.array([here] * batch.num_rows)], names=["here"])

assert [r.here for r in spark.range(1).mapInArrow(found, "here boolean").collect()] == [False]
from annomill.llm.queries import QUERIES
for name in sys.argv[4:]:
    print(name, QUERIES[name](spark, sys.argv[2]).count())
from annomill.sources.prompts import read_prompts
path = sys.argv[3] + "/p.csv"
spark.createDataFrame([("1", "a\\n\\"b\\"")], "custom_id string, prompt string").write.option("header", True).option("escape", '"').csv(path)
assert [tuple(r) for r in read_prompts(spark, path, "csv", multiline="parallel").collect()] == [("1", "a\\n\\"b\\"")]
"""

NAMES = ["op2_probminhash", "op4_lyndon_suffixes", "op5_doubling_substrings", "op7_cost_packing", "op9_toxicity_chain",
         "op11_fm_variants", "op12_table_centroids"]


def test_workers_need_no_path(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "script.py"
    script.write_text(SCRIPT)
    clean = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), root, "/root/testdata/sf0.001", str(tmp_path / "shared"), *NAMES],
                          cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == NAMES
