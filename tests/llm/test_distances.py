import numpy as np
import pytest

from tests.llm.test_texts import components_of
from textfeat.llm import simhash


@pytest.mark.parametrize("distance", [1, 3, 5, 8])
def test_links_hold_for_any_distance(spark, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    # Bits spread over the word, so that no wide block agrees.
    spread = [base ^ np.uint64(sum(1 << (64 * i // n + int(rng.integers(0, 64 // n))) for i in range(n))) for n in (distance, distance + 1)]
    codes = np.unique(np.concatenate([base, *spread]))
    label = components_of(codes, distance)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    stars = {r.u: r.v for r in simhash.stars(simhash.links(df, distance=distance)).collect()}
    found = [stars.get(int(c), int(c)) for c in codes.view(np.int64)]
    assert len({(a, b) for a, b in zip(found, label)}) == len(set(found)) == len(set(label.tolist()))


def test_a_distance_beyond_the_word_raises(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), distance=64)
