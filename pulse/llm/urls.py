"""URL filters by a sort-merge range join of reversed hosts.

A host's labels, reversed and each ended by a dot, make its key. A rule fits its host and all
subdomains, so it covers the interval of keys that start with its own, and the intervals nest or
are disjoint. Urls and rules, both sorted by key, are swept together: a stack holds the rules whose
intervals are open at the current key; rules that ended are popped. Each host on the stack keeps
its rules by path, and of those that the url's path starts with, the longest over host and path
decides; of equally long ones that with the longer host.

Rules are held in every task as long as there are at most `max_rules`; a larger set is dealt into
slices of about half that, each slice sweeps the distinct hosts and paths, and the best of the
slices is joined back.

Defined results: host and path of a null url, or one without `://`, are empty; no rule fits an empty
host, which gets the default verdict; of rules with one host and path, block wins; a rule with a
null part never fits; repeated urls are judged each by itself; no rules give the default verdict.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import cut, lower_ascii

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MAX_RULES = 100_000
NONE = (None, None, None)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class RuleIndex:
    """Rules by host key, sorted; each host's paths with their lengths, longest first."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        by_key: dict[str, dict[str, tuple[str, str, int]]] = {}
        for host, path, verdict in rules:
            by_key.setdefault(host_key(host), {})[path] = (host + path, verdict, len(host))
        self.keys = sorted(by_key)
        self.paths = [by_key[key] for key in self.keys]
        self.lengths = [sorted({len(p) for p in paths}, reverse=True) for paths in self.paths]

    def best(self, stack: list[int], path: str) -> tuple:
        """The longest rule of the open hosts that the path starts with, longest host first."""
        found: tuple = NONE
        for at in reversed(stack):
            for length in self.lengths[at]:
                rule = self.paths[at].get(path[:length]) if length <= len(path) else None
                if rule:
                    if found[0] is None or len(rule[0]) > len(found[0]):
                        found = rule
                    break
        return found

    def sweep(self, hosts: list[str], paths: list[str]) -> list[tuple]:
        """The deciding rule, its verdict and the length of its host, for every url."""
        results = [NONE] * len(hosts)
        keys = [host_key(host) for host in hosts]
        stack: list[int] = []
        coming = 0
        for at in sorted(range(len(keys)), key=keys.__getitem__):
            key = keys[at]
            while stack and not key.startswith(self.keys[stack[-1]]):
                stack.pop()
            while coming < len(self.keys) and self.keys[coming] <= key:
                if key.startswith(self.keys[coming]):
                    stack.append(coming)
                coming += 1
            if stack and hosts[at]:
                results[at] = self.best(stack, paths[at])
        return results


def decide(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds `_best`, the deciding rule and its verdict, from host and path."""
    shared = urls.sparkSession.sparkContext.broadcast(RuleIndex(rules))

    @F.arrow_udf("struct<rule: string, verdict: string, host_length: int>")
    def best(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = shared.value.sweep(hosts.to_pylist(), paths.to_pylist())
        kinds = {"rule": pa.string(), "verdict": pa.string(), "host_length": pa.int32()}
        columns = [
            pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds.values())
        ]
        return pa.StructArray.from_arrays(columns, list(kinds))

    return urls.withColumn("_best", best("host", "path"))


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """Adds host, path, rule and verdict. `rules` has host, path and verdict (allow or block)."""
    parsed = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    clean = (
        rules.where("host is not null and path is not null and verdict is not null")
        .groupBy(lower_ascii(F.col("host")).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    count = clean.count()
    if count <= max_rules:
        judged = decide(parsed, [tuple(row) for row in clean.collect()])
    else:
        slices = math.ceil(2 * count / max_rules)
        dealt = cut(clean.withColumn("slice", F.pmod(F.xxhash64("host", "path"), F.lit(slices))))
        places = cut(parsed.select("host", "path").distinct())
        rank = F.struct(F.length("_best.rule"), F.col("_best.host_length"))
        union = None
        for part in range(slices):
            few = [tuple(r) for r in dealt.where(F.col("slice") == part).drop("slice").collect()]
            found = cut(decide(places, few).where("_best.rule is not null"))
            union = found if union is None else union.union(found)
        best = union.groupBy("host", "path").agg(F.max_by("_best", rank).alias("_best"))
        judged = parsed.join(best, ["host", "path"], "left")
    return judged.withColumns(
        {
            "rule": F.col("_best.rule"),
            "verdict": F.coalesce(F.col("_best.verdict"), F.lit(default)),
        }
    ).drop("_best")
