"""URL filters: allow and block entries in one trie over reversed host labels and path segments.

The trie is broadcast after its rules were counted and measured; a longer list is judged by
a join on host suffixes instead. Neither way shuffles pages on their host, so a host that
holds a third of the table costs no more than others.
"""

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii

# A rule costs about 1 KB in the trie of a Python worker.
TRIE_RULES = 200_000
TRIE_BYTES = 32_000_000


@dataclass(frozen=True)
class UrlRule:
    """`target` is a host, then a path that starts with a slash: `example.net/en/`."""

    target: str
    verdict: str

    @property
    def host(self) -> str:
        return self.target.partition("/")[0]

    @property
    def path(self) -> str:
        return self.target[len(self.host) :]


RULES = (
    UrlRule("net/", "block"),
    UrlRule("example.net/en/", "allow"),
    UrlRule("example.com/de/", "block"),
    UrlRule("org/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a url without `://`."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    known = url.isNotNull() & (at > 0)
    host = F.when(known, lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")
    path = F.when(known, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


class Trie:
    """Host labels from the last to the first, then whole path segments.

    A node keeps `tails`: (rest of the path, target, verdict) of the rules whose last, partial
    segment ends there. The longest target that fits wins; of equals, block.
    """

    def __init__(self, rules: Iterable[UrlRule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node.setdefault("." + label, {})
            *segments, tail = rule.path.split("/")
            for segment in segments:
                node = node.setdefault("/" + segment, {})
            node.setdefault("tails", []).append((tail, rule.target, rule.verdict))

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple = (-1, False, None, None)
        node = self.root
        labels = host.split(".")[::-1]
        for depth in range(len(labels) + 1):
            best = max(best, self._along(node, path), key=lambda found: found[:2])
            if depth == len(labels) or (node := node.get("." + labels[depth])) is None:
                break
        return best[2], best[3]

    @staticmethod
    def _along(node: dict, path: str) -> tuple:
        best: tuple = (-1, False, None, None)
        begin = 0
        while True:
            for tail, target, verdict in node.get("tails", ()):
                found = (len(target), verdict == "block", target, verdict)
                if path.startswith(tail, begin) and found[:2] > best[:2]:
                    best = found
            end = path.find("/", begin)
            if end < 0 or (node := node.get("/" + path[begin:end])) is None:
                return best
            begin = end + 1


def _by_trie(sites: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    trie = sites.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, rule_verdict string")
    def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for host, path in parts:
            found = [trie.value.match(h, p) for h, p in zip(host, path, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "rule_verdict"])

    return sites.withColumn("found", look_up("host", "path")).select("*", "found.*").drop("found")


def _by_join(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """For lists beyond the trie: a row per host suffix and whole-segment path prefix, joined on both.

    A rule's last, partial segment is compared after the join.
    """
    labels = F.split("host", r"\.")
    segments = F.split("path", "/")
    # A position of its own for each row, so that equal rows stay apart.
    numbered = sites.withColumn("row", F.monotonically_increasing_id())
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 1 << 20), "."))
    keys = numbered.withColumn("rule_host", F.explode(F.array_append(suffixes, F.lit("")))).withColumn(
        "rule_dir",
        F.explode(F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda i: F.array_join(F.slice(segments, 1, i), "/"))),
    )
    hits = keys.dropDuplicates(["row", "rule_host", "rule_dir"]).join(rules, ["rule_host", "rule_dir"])
    fits = hits.filter(F.startswith("path", F.col("rule_path")))
    best = fits.groupBy("row").agg(
        F.max(F.struct(F.length("target"), F.col("rule_verdict") == "block", "target", "rule_verdict")).alias("best")
    )
    joined = numbered.join(best, "row", "left")
    return joined.select(*sites.columns, F.col("best.target").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))


def judge(
    pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, otherwise: str = "allow", trie_rules: int = TRIE_RULES
) -> DataFrame:
    """`page_id, host, path, rule, verdict` of every page.

    A rule fits its host and all subdomains where the path starts with the rule's path; the
    longest fitting target decides, `otherwise` where none fits. A null or unreadable url has
    an empty host and path. Repeated rows are judged one by one, other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    sites = pages.select("page_id", host.alias("host"), path.alias("path"))
    if len(rules) <= trie_rules and sum(len(rule.target) for rule in rules) <= TRIE_BYTES:
        found = _by_trie(sites, rules)
    else:
        rows = [(r.target, r.verdict, r.host, r.path, re.sub(r"/?[^/]*$", "", r.path)) for r in rules]
        table = "target string, rule_verdict string, rule_host string, rule_path string, rule_dir string"
        found = _by_join(sites, sites.sparkSession.createDataFrame(rows, table))
    return found.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(otherwise)).alias("verdict"))
