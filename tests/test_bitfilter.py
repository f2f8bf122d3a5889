import numpy as np

from pagegrain.functions import bitfilter


def test_no_key_is_lost_and_few_others_pass(spark):
    bits = bitfilter.build(spark.range(0, 200_000, 2, 5), "id")
    assert bitfilter.probe(bits, np.arange(0, 200_000, 2).astype(np.uint64)).all()
    assert bitfilter.probe(bits, np.arange(1, 200_000, 2).astype(np.uint64)).mean() < 0.01
    assert not bitfilter.probe(bitfilter.build(spark.range(0), "id"), np.arange(50).astype(np.uint64)).any()


def test_size_follows_the_count_within_bounds():
    assert [bitfilter.bits_for(n) for n in (0, 1, 1 << 16, (1 << 16) + 1, 10**8, 10**12)] == [1 << 20, 1 << 20, 1 << 20, 1 << 21, 1 << 29, 1 << 29]
