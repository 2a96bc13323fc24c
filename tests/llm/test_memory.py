"""What the pipeline's Python workers keep of an executor's memory."""
import subprocess
import sys
from pathlib import Path

import pytest

# The function that a stage gives to Spark is caught and run alone, in a process of its own.
HEAD = """
import os, random, re, sys, threading, time
os.environ["OMP_NUM_THREADS"] = "1"
import numpy as np, pandas as pd
from unittest.mock import MagicMock
from shardloom.llm import packing, quality

def mb():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", file.read()))) / 1024

draw = random.Random(5)
words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(20_000)]
def batch(seed):
    draw.seed(seed)
    return [" ".join(draw.choices(words, k=650)) for _ in range(1000)]
top = [0.0]
def watch():
    while True:
        top[0] = max(top[0], mb())
        time.sleep(0.02)
"""
PACK = """
held, docs = [], MagicMock()
packing.texts = lambda docs: docs
packing.F = MagicMock()
docs.mapInPandas = lambda run, shape: held.append(run) or docs
packing.pieces(docs, most=150_000)
list(held[0](iter([pd.DataFrame({"doc_id": [1], "text": ["a b"]})])))
before = mb()
for frame in held[0](pd.DataFrame({"doc_id": range(1000), "text": batch(i)}) for i in range(3)):
    pass
print(mb() - before)
"""
SCORE = """
held, docs = [], MagicMock()
quality.modest_batches = lambda spark: None
quality.F = MagicMock()
quality.F.pandas_udf = lambda kind: lambda run: held.append(run) or MagicMock()
n = quality.FEATURES
model = quality.Model(np.zeros(n), np.ones(n), {k: np.zeros(s, np.float32) for k, s in {
    "w": (n, 24), "b": 24, "v": (24, 12), "u": (24, 12), "a": 12, "c": 24, "d": ()}.items()})
docs.sparkSession.sparkContext.broadcast = lambda model: MagicMock(value=model)
quality.scores(docs, model)
column = pd.Series(batch(0))
held[0](column[:2])
before = mb()
threading.Thread(target=watch, daemon=True).start()
assert len(held[0](column)) == 1000
print(top[0] - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
@pytest.mark.parametrize("body, most", [(PACK, 20), (SCORE, 60)])
def test_a_worker_keeps_little(body, most):
    root = Path(__file__).parents[2]
    done = subprocess.run([sys.executable, "-c", HEAD + body], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < most, done.stdout
