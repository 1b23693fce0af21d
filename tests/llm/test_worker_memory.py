"""A worker outlives its stage: what the packing's encoder keeps and frees there counts beside
the executor's JVM in every later stage."""

import subprocess
import sys

import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("tokenizers")

IDLE = """
import re
import pyarrow as pa
from scriptorium.llm import packing
from scriptorium.llm.registry import tokenizer_path

def held():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", f.read()))) / 1024

run = packing._encode(tokenizer_path("byte_bpe_50k.json"), 2048)
batch = lambda k: pa.record_batch([pa.array(range(40)), pa.array([" ".join(f"w{k}x{i}y{j}" for j in range(5000)) for i in range(40)])], names=["doc_id", "text"])
assert sum(x.num_rows for x in run(iter([batch(0).slice(0, 1)])))
before, pieces = held(), 0
for k in range(1, 4):
    pieces += sum(x.num_rows for x in run(iter([batch(k)])))
assert pieces >= 120
print(held() - before)
"""


def test_an_idle_worker_keeps_little():
    """600,000 distinct words: their ids, and nothing of what it took to find them."""
    done = subprocess.run([sys.executable, "-c", IDLE], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 110, done.stdout
