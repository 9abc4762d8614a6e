"""BPE decodes whole batches, and a Python worker keeps its encoder from task to task."""

import pyarrow as pa

from stratalake.llm import bpe
from stratalake.llm.queries import vocabulary


def test_batch_of_ids_is_joined_at_once():
    tokens = pa.array(["a", None, "c", "d e"])
    ids = pa.array([[7], [0, None, 3, -1, 9], None, [], [2], [1]], pa.list_(pa.int32()))
    assert bpe.joined_tokens(ids, tokens).to_pylist() == ["", "a d e", None, "", "c", ""]
    assert bpe.joined_tokens(ids[1:4], tokens).to_pylist() == ["a d e", None, ""]
    assert bpe.joined_tokens(ids[:0], tokens).to_pylist() == []


def test_tasks_of_a_worker_share_one_encoder(spark):
    words = vocabulary("word_bpe_49k.json")
    assert bpe.word_bpe(words) is bpe.word_bpe(words) and bpe.token_names(words) is bpe.token_names(words)
    df = spark.createDataFrame([(i, f"plain words {i % 3} of a text" if i % 5 else None) for i in range(40)], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(df.repartition(8), words), words).collect()
    alone = bpe.WordBpe(words)
    assert all(r.ids == (alone.encode(f"plain words {r.doc_id % 3} of a text") if r.doc_id % 5 else []) for r in rows)
    names = bpe.token_names(words).to_pylist()
    assert all(r.decoded == " ".join(names[i] for i in r.ids) for r in rows)
