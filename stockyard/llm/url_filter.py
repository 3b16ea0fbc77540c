"""Block and allow rules over URLs, found in a trie of reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


# Fixed values.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

# The trie goes to every executor; above this size of its rules the query is refused, not degraded.
MOST_RULE_BYTES = 64 * 2**20


def build(rules: Iterable[Rule]) -> dict:
    """A node is {label: node}; under the key None it has the trie of its host's paths.

    In a path's trie the keys are whole segments; a node keeps under None the rules that end in it, as
    (beginning of the next segment, rule, verdict), the longest first. Of rules that are the same but
    for their verdict, blocking wins.
    """
    root: dict = {}
    for rule in sorted(set(rules), key=lambda r: (r.verdict == "block", r)):
        node = root
        for label in reversed(rule.host.lower().split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *whole, rest = rule.path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = [e for e in node.get(None, []) if e[0] != rest]
        ends.append((rest, rule.host.lower() + rule.path, rule.verdict))
        node[None] = sorted(ends, key=lambda e: -len(e[0]))
    return root


def _longest(paths: dict, segments: list[str]) -> tuple[str, str] | None:
    """The longest rule of one host that begins the path."""
    node, best = paths, None
    for segment in segments:
        best = next(((rule, verdict) for rest, rule, verdict in node.get(None, ()) if segment.startswith(rest)), best)
        node = node.get(segment)
        if node is None:
            break
    return best


def find(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits: more host labels come first, then the longer path."""
    node, found, segments = root, None, path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if None in node:
            found = _longest(node[None], segments) or found
    return found


def judged(
    df: DataFrame,
    rules: Iterable[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """One row per page: host, path, the rule that decides, and its verdict.

    A null URL, or one without `://`, has an empty host and path; no rule fits those. Where no rule
    fits, the verdict is `otherwise`. Rows stay as they are, repeated ones and null identifiers too;
    other columns are ignored.
    """
    rules = tuple(rules)
    if sum(len(r.host) + len(r.path) for r in rules) > MOST_RULE_BYTES:
        raise ValueError("the rules exceed what a broadcast may hold")
    trie = df.sparkSession.sparkContext.broadcast(build(rules))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in batches:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            found = [find(root, h, p) or (None, otherwise) for h, p in zip(hosts, paths, strict=True)]
            rule, verdict = zip(*found, strict=True) if found else ((), ())
            columns = [batch["page_id"], batch["host"], batch["path"], pa.array(rule, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"]
            )

    at = F.instr(F.col("url"), "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    bare = df.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    split = bare.withColumn("rest", F.regexp_extract(rest, r"(?s)^[^?#]*", 0)).select(
        "page_id",
        F.translate(
            F.substring_index("rest", "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        ).alias("host"),
        F.regexp_extract("rest", r"(?s)/.*$", 0).alias("path"),
    )
    kind = dict(split.dtypes)["page_id"]
    return split.mapInArrow(search, f"page_id {kind}, host string, path string, rule string, verdict string")
