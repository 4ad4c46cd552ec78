"""What passes leave in the Python processes that run them."""

import subprocess
import sys

from strider.llm import common, pieces, quality_classifier

HELD = '''
import re, sys
import numpy as np, pyarrow as pa
from strider.llm import common, quality_classifier as q

def mb():
    return sum(map(int, re.findall(r"Private_Dirty:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

caught = []
class Texts:  # stands for a frame: hands over the pass
    def select(self, *_): return self
    def mapInArrow(self, run, *_): caught.append(run); raise StopIteration

try:
    q.word_vectors(Texts())
except StopIteration:
    pass
rng = np.random.default_rng(1)
def batches():
    for _ in range(12):
        yield pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{x}" for x in rng.integers(0, 150_000, 3_000)) for _ in range(60)])], ["text"])
list(zip(range(1), caught[0](iter([pa.RecordBatch.from_arrays([pa.array(["a b"])], ["text"])]))))
before = mb()
n = sum(b.num_rows for b in caught[0](batches()))
print(n, mb() - before, common._POWERS)
'''


def test_word_sums_leave_no_memory_in_their_process():
    run = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, timeout=120, check=True)
    n, left, _ = run.stdout.split(" ", 2)
    assert int(n) >= 150_000
    assert float(left) < 12, run.stdout


def test_a_codec_stays_until_another_operator_works():
    class Sent:
        value = pieces.read_model(pieces.model_path())

    own = pieces.codec("a", Sent)
    list(common.lean(lambda it: it, "pieces")(iter([1])))
    assert pieces.codec("a", Sent) is own
    assert list(common.lean(lambda it: it)(iter([1, 2]))) == [1, 2]
    assert "pieces" not in common.KEPT
    assert common._POWERS == {"n": 0}


def test_a_kept_text_goes_to_python_once(spark, tmp_path):
    texts = [("good words stand here " * 9 + str(i) if i % 2 else f"$$ ## {i} 00 @@", i) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for t, i in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for _, i in texts], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    both = quality_classifier.score(docs, model, keep=("doc_id", "text"))
    assert "__text" not in both._jdf.queryExecution().analyzed().toString()
    one = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    assert {r["doc_id"]: (r["text"], r["score"]) for r in both.collect()} == {i: (t, one[i]) for t, i in texts}
