"""The last comparison of large regions: few blocks, and all links between two of them."""

import numpy as np
import pytest

from furrow.llm import jaccard_join as J


def test_copies_sent_stay_few(spark):
    """A region of 24,000 documents was dealt in 94 blocks, and every document sent to all blocks of the other side."""
    rows = spark.createDataFrame([(300, 120_000), (2_000, 800_000), (24_000, 9_600_000), (100, 9_000_000)], "docs long, total long")
    assert [r[0] for r in rows.select(J._last_blocks()).collect()] == [2, 8, 12, 5]


@pytest.mark.parametrize("dense", [0, 1 / 64, 2])
@pytest.mark.parametrize("listed", [40, 2_000_000])
def test_all_links_of_two_blocks(monkeypatch, dense, listed):
    monkeypatch.setattr(J, "DENSE", dense)
    monkeypatch.setattr(J, "LISTED", listed)
    monkeypatch.setattr(J, "TILE", 16)
    monkeypatch.setattr(J, "COLUMNS", 32)
    rng = np.random.default_rng(3)

    def copies(k: int, base: np.ndarray) -> list[np.ndarray]:
        kept = [base[rng.random(len(base)) > rng.random() * 0.3] for _ in range(k)]
        return [np.unique(np.append(x, rng.integers(0, 1 << (60 if i % 2 else 12), len(base) - len(x)))) for i, x in enumerate(kept)]

    long, short = (rng.integers(0, 1 << 60, size) for size in (120, 9))
    own, guests = copies(40, long) + copies(5, short), copies(30, long) + copies(9, short)
    guests += own[:2] + [np.array([5])]
    labels, guest_labels = np.arange(len(own)) % 30, np.arange(len(guests)) % 35 + 7
    want = {(int(y), int(x)) for a, x in zip(own, labels, strict=True) for b, y in zip(guests, guest_labels, strict=True) if x != y and J._near(a, b, 75)}
    assert want and J.rectangle_links(own, guests, labels, guest_labels) == want
