"""The FM-index: order of suffixes, search, and what they cost."""

import numpy as np
import pandas as pd

from cartledger.llm import fm_index, substring_dedup


def test_suffix_order_in_few_sorts(monkeypatch):
    """Copied contexts stay tied over many symbols; each sort must lengthen the compared prefix as far as 63 bits allow."""
    rng = np.random.default_rng(3)
    one = rng.integers(1, 900, 88)
    texts = [one, one, rng.integers(1, 3, 88), one[20:], np.zeros(0, np.int64), np.full(300, 7)]
    symbols = np.concatenate([np.append(t, 0) for t in texts]).astype(np.int64)
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    order = fm_index._suffix_order(symbols)
    heads = [tuple(symbols[p : p + fm_index.DEPTH]) for p in order.tolist()]
    assert sorted(order.tolist()) == list(range(len(symbols)))
    assert heads == sorted(heads)
    assert len(sorts) <= 4


def test_suffix_order_of_little():
    assert fm_index._suffix_order(np.zeros(0, np.int64)).tolist() == []
    assert fm_index._suffix_order(np.zeros(1, np.int64)).tolist() == [0]
    assert fm_index._suffix_order(np.array([5, 0])).tolist() == [1, 0]


def near_copies(families=40, copies=6):
    """Contexts by family of near copies, among them runs of one word and a context within another."""
    rng = np.random.default_rng(7)
    texts, anchors = [], []
    for family in range(families):
        base = rng.integers(1, 2000 if family % 4 else 3, 88).astype(np.uint64)
        for copy in range(copies):
            words = base.copy()
            words[rng.integers(0, 88, copy % 4)] = rng.integers(5000, 9000, copy % 4).astype(np.uint64)
            texts.append(words)
            anchors.append(family)
    words = [t.tobytes() for t in texts]
    n = len(texts)
    return texts, pd.DataFrame({"context": np.arange(n), "anchor": anchors, "first_doc": rng.integers(0, 60, n), "left": 38, "words": words})


def test_shard_in_few_steps(monkeypatch):
    """Windows found are those of brute force, and few steps go through the wavelet matrix: an occurrence or two are read on
    in the text, and a failed search tells where the next one ends."""
    texts, shard = near_copies()
    steps, extend = [], fm_index.FMIndex.extend
    monkeypatch.setattr(fm_index.FMIndex, "extend", lambda self, s, lo, hi: steps.append(len(s)) or extend(self, s, lo, hi))
    got = dict(substring_dedup.repeats_in_shard(shard).itertuples(index=False))
    starts = {}
    for words, doc in zip(texts, shard["first_doc"], strict=True):
        for i in range(88 - 49):
            key = words[i : i + 50].tobytes()
            starts[key] = min(doc, starts.get(key, doc))
    first = shard.groupby("anchor")["first_doc"].transform("min")
    want = {
        c: mask
        for c, (words, doc) in enumerate(zip(texts, shard["first_doc"], strict=True))
        if first[c] < doc and (mask := sum(1 << i for i in range(39) if starts[words[i : i + 50].tobytes()] < doc))
    }
    assert got == want and any(m != (1 << 39) - 1 for m in want.values())
    assert sum(steps) < 40 * len(texts)
    monkeypatch.setattr(fm_index, "FEW", 0)
    assert dict(substring_dedup.repeats_in_shard(shard).itertuples(index=False)) == want
