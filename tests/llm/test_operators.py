"""Operators against brute force, round trips and edge cases."""

import hashlib
import io
import re
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from cartledger.llm import (
    decontamination,
    language,
    mixing,
    near_dedup,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
    warc,
)
from cartledger.llm.fm_index import FMIndex

COLUMNS = "doc_id long, text string, lang string, source string, n_words string, kept string, of string, node long"
rng = np.random.default_rng(1)
VOCABULARY = [f"w{i}" for i in range(400)] + ["é", "Ünder", "ß."]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


def edited(text, every):
    return " ".join("new" + str(i) if i % every == 7 else w for i, w in enumerate(text.split()))


BASE, PASSAGE = prose(200, 1), prose(70, 2)
TEXTS = [
    None, "", " \t\n", "one", "Two words", BASE, BASE, BASE.upper(), edited(BASE, 90), edited(BASE, 60),
    prose(60, 3) + " " + PASSAGE + " " + prose(20, 4), prose(9, 5) + " " + PASSAGE, PASSAGE,
    "la " * 300, "la " * 120 + "x", "$$ a " * 80, "same line\nsame line\n\n" + prose(55, 6), prose(3000, 7), prose(49, 8),
    prose(50, 9), "b\x0bc d\u00a0e", prose(100, 10) + " " + prose(3000, 7),
]


def rows():
    made = [(i * 3, t, ["en", "de", None][i % 3], ["s1", None, "s2"][i % 3], "x", "y", "z", 1) for i, t in enumerate(TEXTS)]
    return made + [made[5], (None, BASE, "en", "s1", "", "", "", 2), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quality_counts(docs, none):
    want = []
    for doc_id, text, *_ in rows():
        w = words(text)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        want.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed))
    got = quality.quality_rules(docs)
    assert collected(got.drop("kept")) == sorted(want, key=repr)
    assert got.where("kept and base_failed").isEmpty()
    assert quality.quality_rules(none).isEmpty()


def test_quality_limits_adapt(spark):
    plain = [(i, prose(80, i), "en", "a") for i in range(150)]
    noisy = [(1000 + i, " ".join(w + "#" * (i % 3) for w in prose(80, i).split()), "en", "b") for i in range(150)]
    odd = [(5000, "$$ " * 40 + prose(60, 3), "en", "a")]
    got = quality.quality_rules(spark.createDataFrame(plain + noisy + odd, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in got.where("not kept").collect()} == {5000}


def brute_groups(table):
    sets = []
    for doc_id, text in table:
        w = words(low(text))
        sets.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = group[i], group[j]
                group = [min(x, y) if g in (x, y) else g for g in group]
    least = {}
    for (doc_id, _), g in zip(sets, group, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return [(d, len(s), least.get(g) if s else d, d == (least.get(g) if s else d)) for (d, s), g in zip(sets, group, strict=True)]


def test_near_duplicates(docs, none):
    assert collected(near_dedup.near_duplicates(docs)) == sorted(brute_groups([r[:2] for r in rows()]), key=repr)
    assert near_dedup.near_duplicates(none).isEmpty()


def test_near_duplicates_compare_rows_of_null_ids(spark):
    """Near copies whose ids are all null are linked, and bridge documents with ids."""
    base = prose(200, 91)
    changed = lambda text, first: " ".join(f"new{i}" if i % 50 == first else w for i, w in enumerate(text.split()))
    bridge = changed(base, 10)
    far = changed(bridge, 35)
    table = [(1, base), (None, bridge), (2, far), (None, prose(80, 92)), (None, edited(prose(80, 92), 60)), (3, PASSAGE), (None, edited(PASSAGE, 60))]
    want = brute_groups(table)
    assert want[2][2] == 1 and brute_groups([table[0], table[2]])[1][2] == 2
    got = near_dedup.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"))
    assert collected(got) == sorted(want, key=repr)
    assert near_dedup.survivors(spark.createDataFrame(table, "doc_id long, text string")).count() == 3


def test_near_duplicates_of_one_template(spark):
    """Many copies with edits of their own: links near the threshold, found without all pairs."""
    words_ = prose(120, 77).split()
    table = []
    for i in range(150):
        r = np.random.default_rng(i)
        table.append((i, " ".join(f"e{i}x{k}" if r.random() < 0.025 else w for k, w in enumerate(words_))))
    got = near_dedup.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"))
    assert collected(got) == sorted(brute_groups(table), key=repr)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in near_dedup.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def plain_weights(tokens, exponent):
    raised = [(t / sum(tokens)) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raised) for r in raised]


def plain_repeats(tokens, exponent):
    ratio = [w / t if t else 0.0 for w, t in zip(plain_weights(tokens, exponent), tokens, strict=True)]
    return [r / min(x for x in ratio if x) if r else 1.0 for r in ratio]


def plain_entropy(weights):
    return -sum(w * np.log(w) for w in weights if w)


def plain_exponent(tokens, evenness, most):
    """By halving, once for the entropy and once for the repeats."""
    some = [t for t in tokens if t]
    if len(some) < 2:
        return 1.0
    found = []
    for fits, grows in (
        (lambda a: plain_entropy(plain_weights(some, a)) >= evenness * np.log(len(some)), False),
        (lambda a: max(plain_repeats(some, a)) <= most, True),
    ):
        lo, hi = 0.0, 1.0
        for _ in range(50):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if fits(mid) == grows else (mid, hi)
        found.append((1.0 if not grows and fits(1.0) else 0.0 if grows and fits(0.0) else lo))
    return max(found)


@pytest.mark.parametrize("tokens, evenness, most", [
    ([1000, 100, 10, 1], 0.8, 1e9), ([1000, 100, 10, 1], 1.0, 2.0), ([7, 7, 7], 0.95, 2.0), ([5, 0], 0.95, 2.0), ([0, 0], 0.95, 2.0),
    ([10**12, 3, 10**6, 0, 50], 0.95, 4.0), ([900, 800, 1000], 0.5, 2.0), ([100, 10], 0.95, 1.0),
])
def test_mixing_plan_is_that_of_plain_halving(spark, tokens, evenness, most):
    df = spark.createDataFrame([(f"s{i}" if i else None, t) for i, t in enumerate(tokens)], "source string, tokens long")
    got = {r.of: (r.weight, r.repeats) for r in mixing.source_plan(df, evenness, most).collect()}
    a = plain_exponent(tokens, evenness, most)
    if any(tokens):
        want = list(zip(plain_weights(tokens, a), plain_repeats(tokens, a), strict=True))
    else:
        want = [(0.0, 1.0)] * len(tokens)
    for i, pair in enumerate(want):
        assert got[f"s{i}" if i else None] == pytest.approx(pair, rel=1e-6)


def test_mixture_against_plain_python(spark, docs):
    """Blocks and turns by hashes that Spark tells; budget, order and keys in plain Python."""
    spark.createDataFrame([(None, p, b, s) for p in range(4) for b in range(mixing.BLOCKS) for s in ("s1", "s2", None)], "x int, p int, b int, s string").createOrReplaceTempView("turns")
    turns = {(r.s, r.p, r.b): r.t for r in spark.sql(f"SELECT s, p, b, xxhash64({mixing.SEED}, s, p, b) AS t FROM turns").collect()}
    hashed = docs.selectExpr("doc_id", "text", "source", f"pmod(xxhash64({mixing.SEED}, doc_id, text), {mixing.BLOCKS}) AS block",
                             *[f"pmod(xxhash64({mixing.SEED + 1}, doc_id, {p}), {1 << 30}) / {1 << 30} AS u{p}" for p in range(4)]).collect()
    sizes = Counter()
    for r in hashed:
        sizes[r.source, r.block] += len(words(r.text))
    sources = sorted({s for s, _ in sizes}, key=repr)
    totals = [sum(n for (s, _), n in sizes.items() if s == x) for x in sources]
    repeats = dict(zip(sources, plain_repeats(totals, plain_exponent(totals, 0.99, 3.0)), strict=True))
    keys = {}
    for source, total in zip(sources, totals, strict=True):
        for p in range(max(1, int(np.ceil(repeats[source])))):
            line = sorted((turns[source, p, b], b) for s, b in sizes if s == source)
            seen = 0
            for i, (_, b) in enumerate(line):
                left = repeats[source] - p
                if left >= 1 or seen + sizes[source, b] / 2 < left * total:
                    keys.setdefault((source, b), []).append((p, i / len(line), 1 / len(line)))
                seen += sizes[source, b]
    want = []
    for r in hashed:
        for p, place, width in keys.get((r.source, r.block), ()):
            want.append((r.doc_id, r.source, len(words(r.text)), p, r.block, round((p + place + r[f"u{p}"] * width) / repeats[r.source], 6)))
    got = [(r.doc_id, r.source, r.n_tokens, r.mix_pass, r.mix_block, round(r.mix_key, 6)) for r in mixing.mixture(docs, 0.99, 3.0).collect()]
    assert max(repeats.values()) > 1.5 and sorted(got, key=repr) == sorted(want, key=repr)


def test_mixing_bisects_and_realises(spark, docs, none):
    table = [(i, prose(30, i), "big" if i % 10 else "small") for i in range(3000)]
    got = mixing.mixture(spark.createDataFrame(table, "doc_id long, text string, source string"), 0.9, 3.0)
    seen = {r.source: (r.n, r.d) for r in got.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).collect()}
    a = plain_exponent([2700 * 30, 300 * 30], 0.9, 3.0)
    repeats = plain_repeats([2700 * 30, 300 * 30], a)[1]
    assert seen["big"] == (2700, 2700) and seen["small"][1] == 300 and abs(seen["small"][0] / 300 - repeats) < 0.03
    out = mixing.mixed(docs)
    assert set(docs.columns) < set(out.columns)
    assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in rows()}
    assert mixing.mixture(none).isEmpty()


def test_warc_round_trip(spark):
    pages = [(1, "http://a/é\n", "<p>x</p>", 9), (2, None, "<p>x</p>", 9), (3, "u", None, 9), (4, "", "", 9), (2, None, "<p>x</p>", 9), (None, "n", "q", 9), (5, "long", "y" * 3_000_000, 9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, refers_to int")
    b32 = lambda t: warc.digest((t or "").encode())
    first = {"<p>x</p>": 1, "": 3, "q": None, "y" * 3_000_000: 5}
    want = [(p, len((h or "").encode()), b32(h), "response" if p == first[h or ""] else "revisit", None if p == first[h or ""] else first[h or ""]) for p, _, h, _ in pages]
    assert collected(warc.round_trip(df)) == sorted(want, key=repr)
    assert warc.round_trip(df.limit(0)).isEmpty()


def test_warc_rejects_what_does_not_fit():
    sink = io.BytesIO()
    a = warc.Archive(sink, b"")
    good = warc.record(7, "http://x", b"abc", None, False)
    a.add(good)
    raw = sink.getvalue()
    assert [body for _, body in warc.read_archive(io.BytesIO(raw), 5)] == [b"abc"]
    size = struct.unpack("<II", raw[:8])[1]
    encode = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size])).compress
    for bad in (good.replace(b"Length: 3", b"Length: 4"), good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"WARC/9"), good[:-2], good.replace(b"response", b""), good.replace(b"WARC-Date", b"Date"), good.replace(b"<urn:page:7>", b"seven")):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(io.BytesIO(raw[: 8 + size] + encode(bad))))
    for cut in (raw[:-3], raw + b"junk", raw[8:]):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(io.BytesIO(cut)))


def foreign(kind, block, *more, version="1.0", date="2019-03-04T05:06:07Z"):
    lines = [f"WARC/{version}", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:7b2b1c1e-0000-4000-8000-00000000000a>", f"WARC-Date: {date}", *more]
    return "\r\n".join([*lines, f"content-length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def test_warc_reads_archives_of_other_writers(spark, tmp_path):
    body = b"5\r\nhello\r\n0\r\n\r\n"
    message = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body
    sha, hexed = warc.digest(b"hello"), hashlib.sha256(b"k: v").hexdigest()
    records = [
        foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <urn:x:1>", "WARC-Concurrent-To: <urn:x:2>"),
        foreign("response", message, "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha}", "WARC-Target-URI: http://a/", version="1.1", date="2019-03-04T05:06:07.123456Z"),
        foreign("response", message, "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{warc.digest(body)}"),
        foreign("response", b"no digest", version="1.1"),
        foreign("metadata", b"k: v", f"WARC-Block-Digest: sha256:{hexed}", "X-Long: one", "  two", "WARC-Payload-Digest: blake3:unknown"),
        foreign("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Profile: http://p", "WARC-Refers-To: <urn:uuid:1>", f"WARC-Payload-Digest: sha1:{sha}"),
        foreign("continuation", b"part", "WARC-Segment-Number: 2", f"WARC-Payload-Digest: sha1:{sha}"),
        foreign("novel", b""),
    ]
    words = b"".join(records)
    plain, skip = zstandard.ZstdCompressor().compress, struct.pack("<II", 0x184D2A51, 3) + b"abc"
    known = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)).compress
    packed = plain(words)
    archives = {
        "none": b"".join(plain(r) for r in records),
        "skips": skip + b"".join(plain(r) + skip for r in records),
        "raw": struct.pack("<II", 0x184D2A5D, len(words)) + words + b"".join(map(known, records)),
        "packed": struct.pack("<II", 0x184D2A5D, len(packed)) + packed + b"".join(map(known, records)),
    }
    for name, raw in archives.items():
        for chunk in (3, 1 << 16):
            got = list(warc.read_archive(io.BytesIO(raw), chunk))
            assert [h.first("warc-type") for h, _ in got] == ["warcinfo", "request", "response", "response", "response", "metadata", "revisit", "continuation", "novel"]
        assert got[1][0]["warc-concurrent-to"] == ["<urn:x:1>", "<urn:x:2>"] and got[5][0]["x-long"] == ["one two"]
        assert [b for _, b in got[:2]] == [b"software: x\r\n", b"GET / HTTP/1.1\r\n\r\n"]
        (tmp_path / name).write_bytes(raw)
    listed = spark.createDataFrame([(n, 9 if n == "raw" else None) for n in archives], "archive string, records long")
    rows = warc.read_archives(listed, str(tmp_path)).collect()
    assert len(rows) == 36 and {r.page_id for r in rows} == {None} and sum(r.url == "http://a/" for r in rows) == 4
    for bad in (
        foreign("metadata", b"k: w", f"WARC-Block-Digest: sha256:{hexed}"), foreign("response", message, "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{warc.digest(b'x')}"),
        foreign("revisit", b""), foreign("response", b"", date="yesterday"), foreign("response", b"", "no colon"), foreign("response", b"", "WARC-Date: 2019-03-04T05:06:07Z"),
    ):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(io.BytesIO(plain(bad))))
    for cut in (archives["raw"][:6], archives["raw"][:40], archives["none"][:-3], archives["none"] + b"junk"):
        with pytest.raises(warc.BadArchive):
            list(warc.read_archive(io.BytesIO(cut)))


def test_warc_trains_its_dictionary():
    """Records that share much are smaller with a trained dictionary than without; too few keep their beginning."""
    made = [warc.record(i, f"http://h/{i}", ("<html><body>" + prose(60, i) + "</body></html>").encode(), None, False, "2020-01-01T00:00:00Z") for i in range(400)]
    words = warc.trained(made)
    assert words[:4] == b"\x37\xa4\x30\xec" and len(words) <= warc.DICTIONARY_BYTES
    sizes = []
    for dictionary in (words, b""):
        sink = io.BytesIO()
        archive = warc.Archive(sink, dictionary)
        for raw in made:
            archive.add(raw)
        assert [b for _, b in warc.read_archive(io.BytesIO(sink.getvalue()))] == [warc.parse(r)[1] for r in made]
        sizes.append(archive.size)
    assert sizes[0] < 0.8 * sizes[1]
    assert warc.trained([b"one record only"]) == b"one record only" and warc.trained([]) == b""


def test_toxicity_learns_a_pair(spark, docs):
    table, labels = [], []
    for i in range(900):
        r = np.random.default_rng(i)
        kind = i % 4  # insult, group, both, neither: only both is toxic
        extra = [["oaf"], ["folk"], ["oaf", "folk"], []][kind]
        body = list(r.choice(VOCABULARY, 30)) + extra
        table.append((i, " ".join(r.permutation(body))))
        labels.append((i, int(kind == 2)))
    df, known = spark.createDataFrame(table, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(df, known).join(known, "doc_id").where("held_out")
    assert got.where("(score >= 0.5) = (toxic = 1)").count() >= 0.97 * got.count()
    edge = toxicity.toxicity(docs, known)
    assert edge.count() == len(rows()) and edge.where("score is null or score < 0 or score > 1 or held_out is null").isEmpty()
    assert {r.score for r in toxicity.toxicity(docs, known.limit(0)).collect()} == {0.0}


def test_fm_index_finds_what_is_there():
    text = np.array([int(x) for x in "1212312012341230"])
    index = FMIndex(text, np.array([3] * 8 + [5] * 8, np.int32))
    query = np.array([2, 3, 1, 2, 3, 4])
    got = index.reach(query, np.array([0, 0, 2, 2]), np.array([4, 6, 6, 6]), np.array([9, 9, 9, 5]))
    # 2312 stands in owner 3; 231234 nowhere (1234 does, 31234 not); 1234 only in owner 5
    assert got.tolist() == [-1, 1, 1, 5]


def brute_removed(table, window):
    first, out = {}, []
    for d, t in table:
        w = words(t)
        for i in range(len(w) - window + 1):
            if d is not None:
                first[tuple(w[i : i + window])] = min(d, first.get(tuple(w[i : i + window]), d))
    for d, t in table:
        w = words(t)
        gone = {i + j for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i : i + window])] < d for j in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [2000, 2])
def test_substring_dedup(docs, none, monkeypatch, most):
    """``most`` contexts of an anchor in a shard: the index for all, or whole windows for frequent ones."""
    monkeypatch.setattr(substring_dedup, "ANCHOR_CONTEXTS", most)
    assert collected(substring_dedup.substring_dedup(docs)) == brute_removed([r[:2] for r in rows()], 50)
    assert substring_dedup.substring_dedup(none).isEmpty()


def test_decontamination(spark, docs, none):
    items = [(1, BASE), (2, "TWO words!"), (3, None), (4, "?"), (5, " ".join(PASSAGE.split()[20:31])), (10, PASSAGE), (11, "e-la la")]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    grams = {}
    for item, text in items:
        w = re.findall(pattern, low(text))
        for i in range(max(1, len(w) - 9)) if w else []:
            grams.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    want = []
    for doc_id, text, *_ in rows():
        w, hit, found = re.findall(pattern, low(text)), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if own := grams.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= own
        want.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert collected(decontamination.decontaminated(docs, bench)) == sorted(want, key=repr)
    assert decontamination.decontaminated(docs, bench.limit(0)).where("contaminated").isEmpty()
    assert decontamination.decontaminated(none, bench).isEmpty()


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "http://com", "https://WWW.Example.com/en/x?q", "http://a.example.com/en/", "http://example.com/e", "http://badexample.com/en/",
            "http://x.net/es/", "http://x.net/ES/", "http://net/fr/#f", "http://y.net?/fr/", "http://x.com#/en/", "a://b.example.com/en//c://z.net/es/"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string")
    want = []
    for i, u in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (low(m[1]), m[2]) if m else ("", "")
        fits = [(r, v) for r, v in url_filter.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        want += [(i, host, path, rule, verdict)] * 2
    got = url_filter.judged(df, url_filter.build(url_filter.given_rules(spark)))
    assert collected(got) == sorted(want, key=repr)
    assert url_filter.judged(df.limit(0), []).isEmpty()


def test_url_filter_routes_probes(spark, monkeypatch):
    """Many rules in several segments, long URLs, and a host with rules of many lengths, against a plain search."""
    monkeypatch.setattr(url_filter, "SEGMENT_RULES", 100)
    r = np.random.default_rng(5)
    hosts = [f"h{i}.site{i % 50}.org" for i in range(200)] + ["big.net", "ünï.de"]
    rules = {f"{h}/{'x' * int(r.integers(0, 4))}": ["allow", "block"][int(r.integers(2))] for h in hosts}
    rules |= {f"big.net/{'y' * n}/": "block" for n in range(60)}
    urls = [f"http://{a}{h}/{p}" for h in hosts for a in ("", "www.") for p in ("", "xx", "xxx/y", "y/")] + ["http://big.net/" + "y" * 59 + "/" + "z" * 2_000_000, "http://h1.site1.org.", "http://..big.net/y/"]
    given = spark.createDataFrame([*rules.items(), ("big.net", "block"), ("big.net/y/", "allow"), (None, "block")], "rule string, verdict string")
    want = []
    for i, u in enumerate(urls):
        host, path = url_filter.host_and_path(u)
        fits = [x for x in rules if (lambda h, p: (host == h or host.endswith("." + h)) and path.startswith("/" + p))(*x.split("/", 1))]
        rule = max(fits, key=len, default=None)
        want.append((i, host, path, rule, rules.get(rule, "allow")))
    segments = url_filter.build(given)
    assert len(segments) > 3
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert collected(url_filter.judged(df, segments)) == sorted(want, key=repr)


def test_url_filter_confirms_strings(tmp_path):
    """Equal digests of different strings: the stored string decides."""
    texts = [b"block\tx/", b"allow\ty/"]
    for kind, data in (("keys", np.array([5, 5], np.uint64).tobytes()), ("ends", np.array([0, 8, 16]).tobytes()), ("text", b"".join(texts))):
        (tmp_path / f"s.{kind}").write_bytes(data)
    found = url_filter.Segment(str(tmp_path), "s").find(["y/", "z/", "x/"], np.array([5, 5, 5], np.uint64))
    assert found == {0: "allow", 2: "block"}


def test_languages(spark, docs, none):
    kinds = {"aa": "kala moka tuli", "bb": "strich pfand schum", "cc": "eaux ouille prêt"}
    table = [(i, " ".join(np.random.default_rng(i).choice(text.split(), 12)) + f" {i}", name) for i, (name, text) in enumerate(list(kinds.items()) * 80)]
    table += [(900, None, "aa"), (901, "12 34 !", "aa"), (902, "", None), (903, "kala tuli " * 2000, None)]
    got = {r.doc_id: r for r in language.languages(spark.createDataFrame(table, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == name for i, _, name in table[:240])
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"] and 0 <= got[903].score <= 1
    assert language.languages(docs).count() == len(rows())
    assert language.languages(none).isEmpty()
    assert {r.lang_pred for r in language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_sharding(spark, docs, none):
    table = [(i, f"text {i // 4 if i < 400 else i}") for i in range(600)]
    got = sharding.sharded(spark.createDataFrame(table, "doc_id long, text string")).toPandas()
    counts = got.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert len(counts) == 24 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    split = got.groupby("text_crc32")["shard"].nunique()
    assert (split > 1).sum() <= 20  # of 100 groups, two thirds of all rows
    out = sharding.sharded(docs)
    assert out.count() == len(rows()) and out.where("shard is null or slot is null or size < 8").isEmpty()
    assert sharding.sharded(none).isEmpty()


def test_sharding_of_many_equal_rows(spark):
    """A third of the rows are equal: numbering deals them to several tasks, and slots stay gapless."""
    df = spark.createDataFrame([(5, "same") if i % 3 == 0 else (i, f"t{i}") for i in range(6000)], "doc_id long, text string")
    part = sharding.numbered(df, "n", None, "doc_id", "text").where("text = 'same'").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in part) < 1500 and sum(r["count"] for r in part) == 2000
    got = sharding.sharded(df).toPandas().groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert len(got) == 24 and set(got["count"]) == {250} and set(got["max"]) == {249} and set(got["nunique"]) == {250}


def test_decontamination_of_greek_capitals_without_blanks(spark):
    """A capital sigma ends every word; lower case would depend on what follows."""
    letters = "ΑΒΓΔΕΖΗΘΙΚΛΜ"
    item = [f"ΟΔ{a}Σ" for a in letters]
    texts = spark.createDataFrame([(1, ".".join(["ΑΒΓ", *item, "ΑΒΓ"])), (2, "'".join(item)), (3, ":".join(item[:9]))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, "ΩΣ")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in decontamination.decontaminated(texts, items).collect()}
    assert got == {1: (12, True), 2: (12, True), 3: (0, False)}
