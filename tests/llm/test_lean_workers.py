"""What a Python worker keeps once its task has ended."""

import os
import subprocess
import sys

import pytest

CODE = """
import re
import pyarrow as pa
import pandas
from weftline.llm import ngram_join
from weftline.llm.common import lean

def held():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024

def batches(n):
    texts = [" ".join(f"w{(i * 31 + k * k) % 5003}" for k in range(250)) for i in range(n)]
    yield pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": texts})

for run in (ngram_join._frequent(5), ngram_join._sets(5)):
    sum(b.num_rows for b in lean(run)(batches(10)))
before = held()
for run in (ngram_join._frequent(5), ngram_join._sets(5)):
    sum(b.num_rows for b in lean(run)(batches(6000)))
print(held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory cannot be read here")
def test_worker_keeps_little_after_a_task():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    got = subprocess.run([sys.executable, "-c", CODE], cwd=root, capture_output=True, text=True, check=True)
    assert int(got.stdout) < 30, got.stdout  # MB
