"""Extendible-hash dedup, phrase mining and periodic runs against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cartledger.llm import collocations, exact_dedup, periodic

COLUMNS = "doc_id long, text string, lang string, hash long, page long, n long, runs string, ids string"
rng = np.random.default_rng(5)


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in rows], COLUMNS).repartition(parts)


LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(200_000))  # over one slice of 1 MiB
TEXTS = [None, "", " ", "one", "ONE", "One ", "Ünder É", "ünder É", "la la la la la la", "a b a b a b a b. a b, a b", LONG, LONG.upper()]
ROWS = [(i, t, ["en", "de", None, "und"][i % 4]) for i, t in enumerate(TEXTS * 2)]
ROWS += [(5, "one", "en"), (5, "one", "en"), (None, "ONE", "fr"), (None, "alone", None), (None, "alone", None), (None, None, None)]


def copies(rows):
    """doc_id, keep_id, size, kept, digest; of equal rows with the kept id one is kept."""
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(low(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        left = [top]
        for i in ids:
            out.append((i, top, len(ids), i in left, hashlib.sha256(text.encode()).hexdigest()))
            left = [x for x in left if x != i] if i == top else left
    return out


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_duplicates(spark):
    docs = frame(spark, ROWS)
    assert collected(exact_dedup.exact_duplicates(docs)) == sorted(copies(ROWS), key=repr)
    assert exact_dedup.exact_duplicates(docs.limit(0)).isEmpty()


def test_hot_text_is_shared_by_owners(spark):
    """A third of all rows are one text; with tiny buckets its entries go to several owners and still form one class."""
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 150}", "en") for i in range(900)]
    docs = frame(spark, rows, 24)
    index = exact_dedup.build(docs, capacity=900)
    assert index.parted and index.owners > 12
    assert collected(exact_dedup.exact_duplicates(docs, capacity=900)) == sorted(copies(rows), key=repr)


def test_colliding_keys_are_told_apart(spark, monkeypatch):
    """Every text has the same key: the chain compares bytes, in one owner or in several."""
    rows = [(i, f"t{i % 7}", "en") for i in range(100)]
    docs = frame(spark, rows, 8)
    entries = docs.select("doc_id", "text").mapInArrow(exact_dedup._entries, exact_dedup.ENTRIES)
    for capacity, owners in ((1 << 20, 1), (1000, 2)):
        index = exact_dedup.build(docs, capacity)
        forced = entries.withColumn("hash", entries["hash"] * 0)
        cells = spark.createDataFrame([(0, 0, 0, owners, 0)], "cell long, depth int, bucket long, parts int, base int")
        index = exact_dedup.Index(exact_dedup.cut_lineage(forced), cells, owners, owners > 1)
        classes = {}
        for r in exact_dedup.chained(index).collect():
            classes.setdefault((r["hash"], r["link"]), set()).update(i % 7 for i in r["ids"])
        assert sorted(map(tuple, classes.values())) == [(i,) for i in range(7)]


def test_directory_splits_only_overfull_buckets():
    filled = np.zeros(16, np.int64)
    filled[[0, 1]] = 60
    filled[8] = 100
    depth = exact_dedup.directory(filled, 100)
    assert depth.tolist() == [4, 4, 3, 3, 2, 2, 2, 2] + [1] * 8
    assert exact_dedup.directory(np.zeros(16, np.int64), 1).tolist() == [0] * 16


def mined(rows, longest=3, least=10, reported=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out, most = {}, Counter()
    for (lang, q), b in candidates.items():
        for k in range(2, len(q)):
            for i in range(len(q) - k + 1):
                most[lang, q[i : i + k]] = max(b, most[lang, q[i : i + k]])
    for (lang, p), a in candidates.items():
        if most[lang, p] and 100 * most[lang, p] >= 50 * a:
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]]))
    return [
        (lang, i + 1, p.decode(), a, l, r, n[lang], -s)
        for lang, found in out.items() for i, (s, _, p, a, l, r) in enumerate(sorted(found)[:reported])
    ]


@pytest.mark.parametrize("longest,reported", [(3, 2000), (4, 7), (2, 3)])
def test_collocations(spark, monkeypatch, longest, reported):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 4000)
    words = ["new", "york", "New", "the", "É", "a.b", "x,", "end.\n", "z\x0bz", "z!"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60))), ["en", None, "und", "fr"][i % 4]) for i in range(120)]
    rows += [(500 + i, "hot pair here. hot pair", "en") for i in range(60)] + ROWS[:2] + [(9, LONG, "long"), (None, None, None)]
    docs = frame(spark, rows, 5)
    got = collected(collocations.collocations(docs, longest, reported=reported))
    assert got == sorted(mined(rows, longest, reported=reported), key=repr)
    assert collocations.collocations(docs.limit(0)).isEmpty()


def runs_of(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in found.items())


def digests(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = runs_of(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs(spark):
    def made(i):
        w = rng.integers(0, 1 + i % 4, rng.integers(0, 50)).astype(str).tolist()
        at = int(rng.integers(0, len(w) + 1))
        return " ".join(w[:at] + rng.integers(0, 3, 1 + i % 6).astype(str).tolist() * int(rng.integers(1, 9)) + w[at:])

    rows = [(i, made(i), "en") for i in range(400)] + ROWS[:10] + [(None, "b " * 40, "en"), (3, "ab ab \x0bab\tab ab\nab", "x"), (7, "b " * 3000, "x")]
    docs = frame(spark, rows)
    want = [digests(*r[:2]) for r in rows]
    assert sum(w[1] > 0 for w in want) > 100 and max(w[1] for w in want) > 1
    assert collected(periodic.run_digests(docs)) == sorted(want, key=repr)
    assert periodic.run_digests(docs.limit(0)).isEmpty()


def test_runs_of_a_long_text(spark):
    """A text of more than one slice, with a long loop inside."""
    text = " ".join([f"u{i}" for i in range(150_000)] + ["x y z"] * 5000 + ["end"])
    got = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got["runs"]] == [(150_000, 15_000, 3)]
    assert got["collapsed"] == " ".join([f"u{i}" for i in range(150_000)] + ["x y z end"])


def test_a_repeated_sample_id_sends_one_row(spark, monkeypatch):
    """One id on many rows, toxic and in two languages: what reaches the driver is one row for each sampled id."""
    from cartledger.llm import language, toxicity

    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"plain words number {i} here", "en" if i % 2 else "de") for i in ids]
    rows += [(ids[0], f"bad words {k}", "en" if k % 2 else "de") for k in range(2000)]
    docs = frame(spark, rows, 8)
    labels = spark.createDataFrame([(i, 1, int(i == ids[0])) for i in ids], "doc_id long, quality int, toxic int")
    sent, whole = [], type(docs).toLocalIterator

    def counted(self, *a):
        found = list(whole(self, *a))
        sent.append(len(found))
        return iter(found)

    monkeypatch.setattr(type(docs), "toLocalIterator", counted)
    toxicity.train(docs, labels)
    language.train(docs)
    assert len(sent) == 2 and sent[0] == len(ids) and sent[1] <= language.SAMPLE_PIECES * len(ids)
