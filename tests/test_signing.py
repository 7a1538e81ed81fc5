"""MinHash signatures against plain arithmetic."""

import numpy as np
import pandas as pd

from codequarry.functions import hashing


def test_signatures_are_the_least_remainders():
    rng = np.random.default_rng(1)
    p = hashing.PRIME
    rows = [np.array([0, p - 1, p - 1, 1]), None, np.array([], np.int64), rng.integers(0, p, 3 * hashing._BLOCK + 5), np.array([p - 1])]
    a, b = hashing.permutations()
    want = [None if r is None or not len(r) else [min((x * int(h) + y) % p for h in r) for x, y in zip(a, b)] for r in rows]
    got = hashing.signatures_of(pd.Series(rows))
    assert [None if g is None else g.tolist() for g in got] == want


def test_a_block_of_hashes_fits_a_cores_cache():
    assert hashing._BLOCK * hashing.NUM_PERM * 8 <= 1 << 20
