"""Executors have no copy of the library: its tasks must carry all they use."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import os, sys
sys.path.insert(0, sys.argv[1])          # of the driver only: workers are started without it
from paygrid.session import build_session
from paygrid.llm import alignment, content, decontaminate, jaccard_join, negatives, substring_dedup, suffix_dedup
import public_tokenizers as P

spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": sys.argv[2] + "/shared", "spark.sql.warehouse.dir": sys.argv[2] + "/warehouse"})

def visible(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("paygrid") is not None] * len(batch))], ["v"])

assert [r.v for r in spark.range(1).mapInArrow(visible, "v boolean").collect()] == [False]
long = " ".join(f"w{i}" for i in range(60))
docs = spark.createDataFrame([(1, long), (2, long), (3, long + " x"), (None, "a b c")], "doc_id long, text string")
assert len(substring_dedup.remove_repeats(docs).collect()) == 4
assert len(suffix_dedup.remove_repeats(docs).collect()) == 4
assert sorted(r.n_links for r in jaccard_join.links(docs).collect()) == [0, 2, 2, 2]
assert len(decontaminate.scan(docs, spark.createDataFrame([(1, long)], "item_id long, text string")).collect()) == 4
assert len(alignment.align(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).collect()) == 4
pages = spark.createDataFrame([(1, "u", "<article><p>some text here</p></article>")], "page_id long, url string, html string")
assert [r.text for r in content.extract(pages, content.learn(pages)).collect()] == ["some text here"]
vectors = spark.createDataFrame([(i, [float(i % 7), 1.0], i % 2) for i in range(300)], "vec_id long, embedding array<float>, label int")
assert negatives.mine(negatives.clean(vectors)).count() > 0
print("done")
"""


def test_tasks_carry_what_they_use(tmp_path):
    script = tmp_path / "driver.py"
    script.write_text(textwrap.dedent(SCRIPT))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), REPO, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and done.stdout.strip().endswith("done"), done.stderr[-3000:]
