"""URL filters over a sorted digest array.

A list of entries (host, path prefix, verdict) is kept as one file: the sorted 64-bit xxhash digests of the entries'
strings, offsets, and the strings themselves.  Tasks map the file into memory, so the workers of a machine share its
pages and none is read before it is probed.  A batch of URLs is probed at once: the digests of all candidate strings go
through one vectorised binary search, and what is found is confirmed against the stored full strings, so a digest
collision changes nothing.

An entry fits a URL if the URL's host is the entry's host or a subdomain of it and the URL's path starts with the
entry's path; the candidates of a URL are its host's suffixes at label bounds times the prefixes of its path that have
the length of some entry's path.  The longest entry that fits decides.

Defined cases: a null URL or one without ``://`` has an empty host and path, which no rule fits; its verdict is the
default.  Repeated entries count once; of entries that differ in the verdict only, a block wins.  Empty lists and
empty tables are allowed.  Columns other than the id and the URL are not read.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from podium.llm.shared import ship

MAX_ENTRIES = 20_000_000
SEPARATOR = "\n"  # neither part of an entry can hold it


class DigestArray:
    """The file's view in one process: three arrays over mapped memory."""

    def __init__(self, path: str):
        head = np.fromfile(path, "<u8", 2)
        n, size = int(head[0]), int(head[1])
        at = 16
        self.keys = np.memmap(path, "<u8", "r", at, (n,)) if n else np.empty(0, "<u8")
        self.ends = np.memmap(path, "<u8", "r", at + 8 * n, (n + 1,))
        self.text = np.memmap(path, "u1", "r", at + 16 * n + 8, (size,)) if size else np.empty(0, "u1")

    @staticmethod
    def save(strings: Iterable[str], path: str) -> int:
        raw = sorted({(xxhash.xxh64_intdigest(b), b) for b in (s.encode() for s in strings)})
        ends = np.cumsum([0, *(len(b) for _, b in raw)]).astype("<u8")
        with open(path, "wb") as f:
            f.write(np.array([len(raw), int(ends[-1])], "<u8").tobytes())
            f.write(np.array([k for k, _ in raw], "<u8").tobytes())
            f.write(ends.tobytes())
            f.writelines(b for _, b in raw)
        return len(raw)

    def contains(self, probes: list[bytes]) -> np.ndarray:
        """For each probe whether the array holds exactly this string."""
        digests = np.fromiter((xxhash.xxh64_intdigest(b) for b in probes), "<u8", len(probes))
        low = np.searchsorted(self.keys, digests, "left")
        high = np.searchsorted(self.keys, digests, "right")
        found = np.zeros(len(probes), bool)
        for i in np.flatnonzero(high > low):  # runs longer than one are digest collisions
            found[i] = any(self.text[int(self.ends[j]):int(self.ends[j + 1])].tobytes() == probes[i]
                           for j in range(low[i], high[i]))
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty for null and for a URL without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _suffixes(host: str) -> list[str]:
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))] if host else []


class Matcher:
    """The longest entry that fits, for a list of (host, path) at a time."""

    def __init__(self, array: DigestArray, lengths: tuple[int, ...]):
        self.array, self.lengths = array, lengths

    def longest(self, urls: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        probes, owner = [], []
        for i, (host, path) in enumerate(urls):
            heads = [path[:n] for n in self.lengths if n <= len(path)]
            for suffix in _suffixes(host):
                probes += [f"{suffix}{SEPARATOR}{head}".encode() for head in heads]
                owner += [i] * len(heads)
        best: list[tuple[str, str] | None] = [None] * len(urls)
        for k in np.flatnonzero(self.array.contains(probes)) if probes else ():
            host, path = probes[k].decode().split(SEPARATOR)
            old = best[owner[k]]
            if old is None or (len(host) + len(path), path) > (len(old[0]) + len(old[1]), old[1]):
                best[owner[k]] = (host, path)
        return best


def publish(spark: SparkSession, entries: Iterable[tuple[str, str]]) -> tuple[str, tuple[int, ...]]:
    """Write the array and hand it to the executors through Spark's own file distribution, which also serves executors
    that join later.  Returns the file's name and the lengths of the entries' paths."""
    entries = list(entries)
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"{len(entries)} entries; an array holds {MAX_ENTRIES} at most")
    name = f"digests-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(), name)
    DigestArray.save((f"{h}{SEPARATOR}{p}" for h, p in entries), path)
    spark.sparkContext.addFile(path)
    return name, tuple(sorted({len(p) for _, p in entries}))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], blocklist: Iterable[tuple[str, str]],
               id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row ``host, path, rule, verdict`` and ``listed`` (the entry of the blocklist that fits, or null).

    ``rules`` are (host, path, verdict) and decide first.  Where none fits, the URL is blocked if the blocklist has an
    entry for it and gets the default otherwise."""
    spark = pages.sparkSession
    ship(spark)
    verdicts: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        if verdicts.setdefault((host, path), verdict) != verdict:
            verdicts[host, path] = "block"
    rule_file, listed_file = publish(spark, verdicts), publish(spark, blocklist)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_rule, by_list = (Matcher(DigestArray(SparkFiles.get(name)), lengths) for name, lengths in (rule_file, listed_file))
        for rows in batches:
            urls = [split_url(u) for u in rows["url"]]
            rule, listed = by_rule.longest(urls), by_list.longest(urls)
            yield pd.DataFrame({
                "id": rows["id"], "host": [h for h, _ in urls], "path": [p for _, p in urls],
                "rule": [r and "".join(r) for r in rule],
                "verdict": [verdicts[r] if r else "block" if m else default for r, m in zip(rule, listed)],
                "listed": [m and "".join(m) for m in listed]})

    kind = pages.schema[id_col].dataType.simpleString()
    return (pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"))
            .mapInPandas(judge, f"id {kind}, host string, path string, rule string, verdict string, listed string")
            .withColumnRenamed("id", id_col))
