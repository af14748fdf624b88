"""URL filters: a trie over reversed host labels, then path segments.

A rule is a host and a path. It fits its host and all sub-domains, for paths that begin with the
rule's path. The trie is walked once per url, from the top-level label down; at each host node
with rules the url's path is walked along the rule paths' segments. The deepest hit wins: more
host labels first, then the longer path, so an allow entry may open a part of a blocked site and
the reverse; of two rules with the same host and path, block wins.

The trie is broadcast while the rules are at most ``TRIE_RULES``; a larger list is joined on the
keys that the trie would branch on.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and gets
the default verdict; so does an empty one. Repeated rows are judged each; further columns are not
read; an empty table gives an empty one. A rule list may be empty.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import small_batches

#: Rules that fit in a broadcast trie: some hundred bytes each.
TRIE_RULES = 100_000


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one. Later ones belong to path or query."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)", 1), F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*(/[^?#]*)", 1)


class Trie:
    """Nodes are dicts by label. Under the key None a host node keeps the trie of its paths; under
    "" + leading part of a segment a path node keeps the rules that end within a segment."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})
            if ends.get(last, ("", "allow"))[1] == "allow":
                ends[last] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        node, best = self.root, (None, None)
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._along(node[None], segments) or best
        return best

    @staticmethod
    def _along(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            hits = [last for last in node.get(None, ()) if segment.startswith(last)]
            if hits:
                best = node[None][max(hits, key=len)]
            node = node.get(segment)
            if node is None:
                break
        return best


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url", trie_rules: int = TRIE_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has the string columns ``host, path, verdict`` (allow or block).
    """
    rules = rules.select("host", "path", "verdict").dropna()
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                         path_of(url).alias("path"))
    few = rules.limit(trie_rules + 1).collect()
    found = _by_trie(parts, few) if len(few) <= trie_rules else _by_join(parts, rules)
    return found.select("page_id", "host", "path", "hit.rule",
                        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def _by_trie(parts: DataFrame, rules: list) -> DataFrame:
    small_batches(parts.sparkSession, 10_000)
    shared = parts.sparkSession.sparkContext.broadcast([tuple(r) for r in rules])

    @F.pandas_udf("rule string, verdict string")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = Trie(shared.value)
        for host, path in batches:
            yield pd.DataFrame([trie.find(h, p) for h, p in zip(host, path)],
                               columns=["rule", "verdict"], dtype=object)

    return parts.withColumn("hit", look_up("host", "path"))


def _by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """The trie's branches as keys: (host suffix, whole path segments), an equi-join.

    A url has as many keys as labels times segments; a key with many rules that end within its
    segment is narrowed by that segment's beginning.
    """
    whole = F.regexp_extract("path", r"(?s)^(.*/)?", 1)
    best = F.struct(F.size(F.split("r_host", r"\.")).alias("labels"),
                    F.length("r_path").alias("length"),
                    F.when(F.col("r_verdict") == "block", 1).otherwise(0).alias("block"),
                    F.concat("r_host", "r_path").alias("rule"),
                    F.col("r_verdict").alias("verdict"))
    keyed = rules.select(F.col("host").alias("suffix"), whole.alias("trunk"),
                         F.col("host").alias("r_host"), F.col("path").alias("r_path"),
                         F.col("verdict").alias("r_verdict")).distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    places = parts.select("host", "path").distinct()
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(
        F.slice(labels, k, F.size(labels)), "."))
    trunks = F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda k: F.when(
        k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(segments, F.lit(1), k), "/"),
                                              F.lit("/"))))
    hits = (places.select("host", "path", F.explode(suffixes).alias("suffix"), trunks.alias("ts"))
            .select("host", "path", "suffix", F.explode("ts").alias("trunk"))
            .join(keyed, ["suffix", "trunk"])
            .where(F.startswith("path", "r_path"))
            .groupBy("host", "path").agg(F.max(best).alias("hit")))
    return parts.join(hits, ["host", "path"], "left")
