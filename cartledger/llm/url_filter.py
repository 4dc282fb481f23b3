"""URL rules in a sorted array of 64-bit digests that executors map into memory.

A rule is a host and the beginning of a path. The index of a rule set is three files in the shared
folder for each segment: sorted xxhash64 keys, offsets, and the strings in the same order. A segment holds a
range of the keys, so a probe is searched in one segment only. Besides the rules, the index holds for each host
of a rule the lengths that its rules' paths have. A URL is asked for at every suffix of its host
(whole labels), and then at the prefixes of its path of the lengths found there; all keys of a batch are
searched by vectorised binary search, and a hit counts only if the stored string is the one asked for.

The longest rule that fits decides; rules that fit and are equally long are the same. A URL that no rule
fits is allowed. Nulls and texts without ``://`` have an empty host and path. URLs of any length are judged
whole. Repeated rows return each; empty tables give empty results. Columns other than page_id and url are not read.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartledger.session import cut_lineage, work_dir

from .warc import _opened

#: Fixed rules of the registered query: host and path, verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Rules that one segment of the index holds, about.
SEGMENT_RULES = 1_000_000
DEFAULT = "allow"

_SPLIT = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_UPPER = {code: code + 32 for code in range(65, 91)}


def host_and_path(url: str | None) -> tuple[str, str]:
    m = _SPLIT.search(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def _keys(texts: list[str]) -> np.ndarray:
    """Spark's ``xxhash64`` of each text, unsigned."""
    return np.array([xxhash.xxh64_intdigest(t.encode(), seed=42) for t in texts], np.uint64)


def build(rules: DataFrame) -> list[dict]:
    """Index files of ``rules`` (rule, verdict); returns the segments, about one for SEGMENT_RULES entries.

    Of a rule given twice, block wins. A rule without a slash fits no URL.
    """
    spark = rules.sparkSession
    folder = os.path.join(work_dir(spark), f"urls-{uuid.uuid4().hex}")
    one = cut_lineage(rules.where("contains(rule, '/')").groupBy("rule").agg(F.max("verdict").alias("verdict")))
    host = F.substring_index("rule", "/", 1)
    lengths = one.groupBy(host.alias("rule")).agg(
        F.array_join(F.sort_array(F.collect_set(F.length("rule") - F.length(host))), ",").alias("verdict")
    )
    entries = cut_lineage(one.unionByName(lengths))
    segments = max(1, -(-entries.count() // SEGMENT_RULES))

    def write(part: pd.DataFrame) -> pd.DataFrame:
        at, path = _opened(folder)
        at.create_dir(path, recursive=True)
        name, texts = uuid.uuid4().hex, [f"{v}\t{r}".encode() for v, r in zip(part["verdict"], part["rule"], strict=True)]
        keys = _keys(part["rule"].tolist())
        order = np.argsort(keys, kind="stable")
        texts = [texts[i] for i in order]
        ends = np.cumsum([0] + [len(x) for x in texts]).astype(np.int64)
        for kind, data in (("keys", keys[order].tobytes()), ("ends", ends.tobytes()), ("text", b"".join(texts))):
            with at.open_output_stream(f"{path}/{name}.{kind}") as sink:
                sink.write(data)
        return pd.DataFrame({"segment": [part["segment"].iloc[0]], "name": [name]})

    upper = F.shiftrightunsigned(F.xxhash64("rule"), 32)
    made = entries.withColumn("segment", F.shiftright(upper * F.lit(segments).cast("long"), 32))
    made = cut_lineage(made.groupBy("segment").applyInPandas(write, "segment long, name string"))
    return [{"folder": folder, "name": r["name"], "segment": r["segment"], "segments": segments} for r in made.collect()]


class Segment:
    """One sorted array, mapped from the shared folder or from a copy of this worker."""

    def __init__(self, folder: str, name: str):
        at, path = _opened(folder)
        self.keys, self.ends, self.text = (self._mapped(at, f"{path}/{name}.{kind}", dtype)
                                           for kind, dtype in (("keys", np.uint64), ("ends", np.int64), ("text", np.uint8)))

    @staticmethod
    def _mapped(at, path: str, dtype) -> np.ndarray:
        if at.type_name != "local":
            copy = tempfile.NamedTemporaryFile(delete=False)
            with at.open_input_stream(path) as source, copy:
                while piece := source.read(1 << 22):
                    copy.write(piece)
            path = copy.name
        found = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        if at.type_name != "local":
            os.unlink(path)  # the mapping holds the copy until this worker ends
        return found

    def find(self, asked: list[str], keys: np.ndarray) -> dict[int, str]:
        """Place in ``asked`` -> verdict, of those that are stored."""
        lo = np.searchsorted(self.keys, keys, side="left")
        found = {}
        near = np.flatnonzero(lo < len(self.keys))
        for i in near[self.keys[lo[near]] == keys[near]].tolist():
            j, wanted = int(lo[i]), asked[i].encode()
            while j < len(self.keys) and self.keys[j] == keys[i]:  # equal digests stand side by side
                verdict, _, rule = self.text[self.ends[j] : self.ends[j + 1]].tobytes().partition(b"\t")
                if rule == wanted:
                    found[i] = verdict.decode()
                    break
                j += 1
        return found


def _suffixes(host: str) -> list[str]:
    labels = host.split(".") if host else []
    return [".".join(labels[i:]) for i in range(len(labels))]


class Index:
    """All segments; each is mapped when a probe first falls into it."""

    def __init__(self, segments: list[dict]):
        self.names = {s["segment"]: s for s in segments}
        self.count = segments[0]["segments"] if segments else 1
        self.opened: dict[int, Segment] = {}

    def find(self, asked: list[str]) -> dict[str, str]:
        """What is stored for each text of ``asked`` that the index has."""
        found: dict[str, str] = {}
        keys = _keys(asked)
        owner = ((keys >> np.uint64(32)) * np.uint64(self.count)) >> np.uint64(32)
        for s in np.unique(owner).tolist():
            if s not in self.names:
                continue
            if s not in self.opened:
                self.opened[s] = Segment(self.names[s]["folder"], self.names[s]["name"])
            at = np.flatnonzero(owner == s)
            own = [asked[i] for i in at.tolist()]
            found.update({own[i]: told for i, told in self.opened[s].find(own, keys[at]).items()})
        return found


def judged(urls: DataFrame, segments: list[dict]) -> DataFrame:
    """page_id, host, path, rule and verdict of every URL."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(segments)
        for batch in batches:
            split = [host_and_path(u) for u in batch.column("url").to_pylist()]
            hosts = {h: _suffixes(h) for h in {h for h, _ in split}}
            lengths = {s: [int(n) for n in told.split(",")] for s, told in index.find(sorted({s for own in hosts.values() for s in own})).items()}
            asked = [[s + path[:n] for s in hosts[host] for n in lengths.get(s, ()) if n <= len(path)] for host, path in split]
            known = index.find(sorted({x for own in asked for x in own}))
            rules = [max((x for x in own if x in known), key=len, default=None) for own in asked]
            verdicts = [DEFAULT if r is None else known[r] for r in rules]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()),
                 pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return urls.select("page_id", "url").mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")


def given_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "rule string, verdict string")
