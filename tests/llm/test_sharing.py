"""What operators share with all tasks is taken back when the next one begins, and comes again where it is still needed."""

import numpy as np
import public_tokenizers
import pytest

from fundtide.llm import packing, queries, textops


def test_shared_values_are_taken_back_and_come_again(llm_spark):
    handle = textops.shared(llm_spark, np.arange(5))
    rows = llm_spark.range(4).rdd.map(lambda r: int(handle.value.sum()) + r[0])
    assert rows.collect() == [10, 11, 12, 13]
    queries.prepare(llm_spark)
    assert not textops._handed_out
    assert rows.collect() == [10, 11, 12, 13]


@pytest.mark.parametrize("turn", range(2))
def test_a_result_that_was_not_written_survives_the_next_operator(llm_spark, documents, turn):
    packed = packing.pack_documents(documents.filter("doc_id < 20"), public_tokenizers.path("byte_bpe_50k.json"))
    queries.prepare(llm_spark)
    assert packed.select("doc_id").distinct().count() == 20
    for name, value in queries.ALLOCATION.items():
        assert llm_spark.sparkContext.environment[name] == value


def test_a_worker_keeps_the_encoder_for_its_own_kind_only():
    import pyarrow as pa

    from fundtide.llm import tokenizing

    path = public_tokenizers.path("byte_bpe_50k.json")
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", "c"])], ["text"])
    first = tokenizing.encoder(path)
    assert [b.num_rows for b in textops.chunks([batch], kind=tokenizing.KIND)] == [2] and tokenizing.encoder(path) is first
    assert [b.num_rows for b in textops.chunks([batch])] == [2] and tokenizing.encoder(path) is not first


def test_batches_of_long_texts_have_few_rows(llm_spark):
    import pyarrow as pa

    queries.prepare(llm_spark)

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    texts = llm_spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) AS text")
    found = [r["n"] for r in texts.mapInArrow(rows, "n bigint").collect()]
    assert sum(found) == 40 and max(found) <= 10
