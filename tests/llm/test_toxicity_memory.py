"""What the toxicity model costs the driver: it travels without its tables, and a pass holds little besides the sums."""

import pickle
import tracemalloc

import numpy as np

from pagewright.llm import toxicity
from pagewright.llm.arrowtext import ALNUM, hash_words

import pyarrow as pa


def _train(spark):
    rows = [(k % 2, f"word{k % 7} bad{k % 3} thing" if k % 3 else f"good{k % 5} day word{k % 7}", int(k % 3 > 0), k % 5 == 0, "en") for k in range(60)]
    return spark.createDataFrame(rows, "part long, text string, toxic int, held boolean, lang string").coalesce(2)


def test_the_model_travels_without_its_tables(spark):
    docs = spark.createDataFrame([(k, f"word{k % 7} bad{k % 3}" if k % 3 else f"good{k % 5} day", "en") for k in range(400)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(400)], "doc_id long, toxic int")
    model = toxicity.trained(docs, labels)
    words = hash_words(pa.array(["word1 bad2", "good4 day", None, ""]), ALNUM, heads=True)
    before = len(pickle.dumps(model))
    here = model.score(words)
    assert len(pickle.dumps(model)) == before  # the tables are made where texts are scored
    tables = sum(t.nbytes for kind in model.tables for t in kind)
    assert tables == 3 * model.embeddings.nbytes
    assert np.array_equal(pickle.loads(pickle.dumps(model)).score(words), here)


def test_a_pass_holds_little_on_the_driver(spark):
    rows = 1 << 17
    places = [np.arange(toxicity.WORD_ROWS, dtype=np.int32) % rows, np.arange(toxicity.HEAD_ROWS, dtype=np.int32)]
    params = toxicity._new(rows, 3)
    was, size, train = params["E"].copy(), params["E"].nbytes, _train(spark)
    tracemalloc.start()
    try:
        got = toxicity._epoch(train, places, params, 0, (1.0, 1.0))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    changed = np.flatnonzero((got["E"] != was).any(1))
    assert 0 < len(changed) < 100 and not got["E"][0].any()  # rows of words in the texts only
    assert set(got) == set(params) and most < 3 * size
