"""Links of tiny sets whose registers collide."""

import numpy as np

from statuta.llm import near_duplicates


def colliding():
    """Texts of 7 and 8 words (4 and 5 shingles of four words, likeness 4/5) that the fine sketch rules out."""
    rng = np.random.default_rng(3)
    while True:
        words = [[f"t{x}" for x in rng.integers(0, 1 << 30, 8)] for _ in range(5000)]
        short, long = (near_duplicates.shingle_sets([" ".join(w[:n]) for w in words], 4) for n in (7, 8))
        a, b = (np.array([np.frombuffer(near_duplicates.compressed(x, near_duplicates.FINE), np.uint8) for x in part]) for part in (short, long))
        bad = np.flatnonzero(near_duplicates.estimates(a, b) < 0.8 - near_duplicates.MARGIN)
        for i in bad:
            # They must share a band, or no bucket brings them together.
            if set(bands(short[i])) & set(bands(long[i])):
                return " ".join(words[i][:7]), " ".join(words[i])


def bands(found):
    return near_duplicates.band_keys(found).tolist()


def test_tiny_link_is_kept(spark):
    one, two = colliding()
    docs = spark.createDataFrame([(1, one), (2, two), (3, "some other text that is long enough")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(docs, 4, 80).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
