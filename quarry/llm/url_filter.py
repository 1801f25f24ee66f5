"""URL filter: sort-merge range join of urls with host and path rules.

A url's key is its host with the labels reversed and a dot after each
(``www.example.com`` -> ``com.example.www.``). A rule's host is a prefix of the
keys of that host and all its subdomains, so a rule is an interval of keys.
Urls are range-partitioned and sorted by (key, path, id); each task sweeps its
sorted urls once against the sorted rules, keeping a stack of the host
intervals that are open (each nested in the one below). Of the open rules
whose path starts the url's path, the longest wins.

A host with a third of all pages is split: the range key ends with path and id.
Rules are applied in blocks of at most ``block_rules`` rules, one narrow sweep a
block over the same sorted partitions, so what a task holds is bounded however
long the rule list is.

Defined results: a null url or one without ``://`` has empty host and path;
no rule fits it, nor any url that no rule covers: rule null and the default
verdict. Ties of length go to the longer host. Of repeated equal rules the
first counts. Rows that repeat are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower

BLOCK_RULES = 100_000


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The production rules.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_key(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split("."))) if host else ""


class Sweep:
    """The open host intervals at the current position of one sorted sweep."""

    def __init__(self, rules: Sequence[Rule]):
        by_host: dict[str, dict[str, Rule]] = {}
        for r in rules:
            by_host.setdefault(reversed_key(r.host), {}).setdefault(r.path, r)
        self.hosts = sorted(by_host.items())
        self.next = 0
        self.stack: list[tuple[str, dict[str, Rule], list[int]]] = []

    def at(self, key: str) -> None:
        """Moves the sweep to ``key``, which is not before the last one."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()
        while self.next < len(self.hosts) and self.hosts[self.next][0] <= key:
            start, paths = self.hosts[self.next]
            self.next += 1
            if key.startswith(start):  # else its interval ended before this key
                self.stack.append((start, paths, sorted({len(p) for p in paths})))

    def best(self, path: str) -> Rule | None:
        found = None
        for start, paths, sizes in self.stack:
            for n in sizes:
                if n <= len(path) and (r := paths.get(path[:n])) is not None:
                    if found is None or (len(r.text), len(r.host)) >= (len(found.text), len(found.host)):
                        found = r
        return found


def _sweeper(rules: Sequence[Rule]):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Sweep(rules)
        for b in batches:
            names = b.schema.names
            old_rule, old_verdict = b.column("rule").to_pylist(), b.column("verdict").to_pylist()
            old_host = b.column("_rule_host").to_pylist()
            for i, (key, path) in enumerate(zip(b.column("_key").to_pylist(), b.column("path").to_pylist())):
                state.at(key)
                r = state.best(path)
                if r is not None and (old_rule[i] is None or
                                      (len(r.text), len(r.host)) > (len(old_rule[i]), old_host[i])):
                    old_rule[i], old_verdict[i], old_host[i] = r.text, r.verdict, len(r.host)
            new = {"rule": pa.array(old_rule, pa.string()), "verdict": pa.array(old_verdict, pa.string()),
                   "_rule_host": pa.array(old_host, pa.int32())}
            yield pa.RecordBatch.from_arrays([new.get(n, b.column(n)) for n in names], schema=b.schema)
    return sweep


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, default: str = "allow", id_col: str = "page_id",
                url_col: str = "url", block_rules: int = BLOCK_RULES) -> DataFrame:
    """page_id, url, host, path, rule, verdict for each row of ``pages``."""
    host, path = host_path(pages[url_col])
    labels = F.reverse(F.split("host", r"\."))
    keyed = (pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), host.alias("host"),
                          path.alias("path"))
             .withColumn("_key", F.when(F.col("host") == "", F.lit(""))
                         .otherwise(F.concat(F.array_join(labels, "."), F.lit("."))))
             .withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
             .withColumn("_rule_host", F.lit(0)))
    order = ["_key", "path", "page_id"]
    swept = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    rules = [r for r in rules if r.host]
    for at in range(0, len(rules), block_rules):
        swept = swept.mapInArrow(_sweeper(rules[at:at + block_rules]), swept.schema)
    return swept.select("page_id", "url", "host", "path", "rule", "verdict")
