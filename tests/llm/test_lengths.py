"""Sequence lengths are encoded tokens."""

from collections import Counter

import cases
from retail_stream.llm import token_counts
from retail_stream.llm.queries import op7_packing


def test_packing_query_takes_encoded_lengths(spark):
    encoding = token_counts._encoding(token_counts.RANKS)
    expected = {d: len(encoding.encode_ordinary(t or "")) + 1 for d, t, *_ in cases.documents()}
    bins, found = Counter(), Counter()
    for r in op7_packing(spark, cases.SMALL).collect():
        found[r.doc_id] += r.n_tokens
        bins[r.shard, r.bin, r.capacity] += r.n_tokens
    assert found == expected
    assert all(used <= capacity for (_, _, capacity), used in bins.items())
