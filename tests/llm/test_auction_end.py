import pytest

from lexmesh.llm.matching import auction


def test_auction_without_end_is_an_error(spark):
    rivals = spark.createDataFrame([(f"l{i}", f"r{j}", 1.0) for i in range(4) for j in range(4)], "l string, r string, w double")
    with pytest.raises(RuntimeError):
        auction(rivals, max_rounds=2)
    assert auction(rivals).count() == 4
