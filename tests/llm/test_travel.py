import subprocess
import sys
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle

from answerloom.llm import arrowtext, bpe, decontamination, jaccard, quality, repair, toxicity, whitening


def test_functions_travel_to_workers_without_this_package(folder):
    """What tasks run is pickled by value: a process that cannot import the package loads it."""
    functions = [
        *(f for f in vars(arrowtext).values() if callable(f) and getattr(f, "__module__", "") == arrowtext.__name__),
        jaccard.pivot_rows, jaccard.bounded, jaccard.compared, jaccard.possible(80), jaccard.joined_region(80), jaccard.cell_rows(2, 80, 5), jaccard.set_rows(5),
        jaccard.sketch_rows(5), jaccard.size_rows(5), repair.span_rows(pa.int64()), repair.sorted_pass(pa.int64(), True), decontamination.item_pieces(10, 100),
        decontamination.scanned(0, None, True), decontamination.merged_spans, whitening.column_sums, whitening.matrices, toxicity.evidence, bpe.Encoder, quality.vote,
    ]
    Path(f"{folder}/functions").write_bytes(cloudpickle.dumps(functions))
    code = f"import importlib.util, pickle; assert importlib.util.find_spec('answerloom') is None; print(len(pickle.load(open('{folder}/functions', 'rb'))))"
    said = subprocess.run([sys.executable, "-c", code], cwd=folder, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=100)
    assert said.stdout.strip() == str(len(functions)), said.stderr
