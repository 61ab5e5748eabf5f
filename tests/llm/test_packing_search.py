"""The local search ends only where no exchange is left, on groups of production size too."""

import itertools

import numpy as np

from waferlens.llm import packing


def _squares(bins, lengths):
    return sum(sum(lengths[i] for i in b) ** 2 for b in bins)


def test_large_group_of_loose_lengths():
    lengths = np.random.default_rng(1).integers(600, 761, 20_000).tolist()
    start = packing.best_fit_decreasing(lengths, 2048)
    out = packing.pack_lengths(lengths, 2048)
    assert sorted(i for b in out for i in b) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in b) for b in out) <= 2048
    # Stopping after 4,000 looks left all 7,422 bins.
    assert len(start) == 7422 and len(out) <= 6850 and _squares(out, lengths) > _squares(start, lengths)


def test_no_exchange_is_left():
    rng = np.random.default_rng(3)
    for n, low, high in ((30, 15, 40), (40, 17, 30), (25, 5, 50)) * 5:
        lengths = rng.integers(low, high + 1, n).tolist()
        out = packing.local_search([[i] for i in range(n)], lengths, 64)
        assert sorted(i for b in out for i in b) == list(range(n))
        if len(out) == -(-sum(lengths) // 64):
            continue

        def parts(b, least):
            return [c for k in range(least, 3) for c in itertools.combinations(b, k)]

        for s, k in itertools.permutations(out, 2):
            fs, fk = sum(lengths[i] for i in s), sum(lengths[i] for i in k)
            for give, take in itertools.product(parts(s, 1), parts(k, 0)):
                g = sum(lengths[i] for i in give) - sum(lengths[i] for i in take)
                assert not (fk >= fs and 0 < g <= 64 - fk), (s, k, give, take)


def test_search_empties_bins_of_the_first_pass():
    """Log-normal lengths, and lengths that best fit packs badly: the search does the work, near the bound."""
    rng = np.random.default_rng(7)
    for lengths in (np.clip(rng.lognormal(6.4, 0.8, 20_000), 1, 2047).astype(int).tolist(), rng.choice([1025, 700, 680, 345, 340], 6_000).tolist()):
        made = {}
        start = packing.first_pass(lengths, 2048)
        out = packing.pack_lengths(lengths, 2048, made)
        least = -(-sum(lengths) // 2048)
        assert sorted(i for b in out for i in b) == list(range(len(lengths)))
        assert max(sum(lengths[i] for i in b) for b in out) <= 2048
        assert made["moves"] > 0 and made["exchanges"] > 0 and made["emptied"] == len(start) - len(out) > 0
        assert len(out) <= max(1.005 * least, len(packing.best_fit_decreasing(lengths, 2048)))


def test_rows_tell_how_the_search_went(docs):
    rows = packing.pack_documents(docs).filter("group_least is not null").collect()
    assert {(r.group_bins, r.group_start >= r.group_bins >= r.group_least) for r in rows} == {(len({r.sequence_id for r in rows}), True)}
