"""Places of least hashes do not depend on how a long text is cut into blocks."""

import numpy as np
import pytest

from tidemark.llm.dedup import ANCHOR, LENGTH, PLACE_BITS, anchor_places

WIDTH = LENGTH - ANCHOR + 1


@pytest.mark.parametrize("n", [WIDTH - 1, WIDTH, WIDTH + 1, 700, 5000])
def test_blocks(n):
    rng = np.random.default_rng(n)
    hashes = rng.integers(0, 40, n).astype(np.uint64) << np.uint64(PLACE_BITS)
    expected = [i + int(np.argmin(hashes[i : i + WIDTH])) for i in range(n - WIDTH + 1)]
    for block in (1, 7, WIDTH, 1000, 1 << 24):
        assert anchor_places(hashes, block).tolist() == expected


def test_past_the_bits_of_a_place():
    """A text of more windows than places in a block: windows past the end of the bits find
    what the same windows find on their own."""
    n, tail = (1 << PLACE_BITS) + 3000, 2000
    hashes = np.zeros(n, dtype=np.uint64)
    hashes[-tail:] = np.random.default_rng(1).integers(0, 1 << 62, tail).astype(np.uint64)
    whole, alone = anchor_places(hashes), anchor_places(hashes[-tail:])
    assert (whole[-len(alone) :] == alone + n - tail).all()


def test_too_long_a_block():
    with pytest.raises(ValueError):
        anchor_places(np.zeros(500, np.uint64), 1 << PLACE_BITS)
