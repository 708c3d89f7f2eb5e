"""URL filter: a broadcast trie over reversed host labels, then path segments."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules are broadcast whole; a longer list is refused rather than sent.
MAX_RULES = 1_000_000
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without a ``://``."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_ASCII_LOWER), found[2]) if found else ("", "")


class UrlTrie:
    """Longest match between allow and block entries.

    A rule fits its host and every subdomain, if the path starts with the rule's
    path (as a string).  The longer host wins, then the longer path; if the same
    entry is listed as both, block wins.
    """

    def __init__(self, rules: list[tuple[str, str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            node = self.root
            for label in reversed(host.translate(_ASCII_LOWER).split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *whole, last = path.split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {}).setdefault(len(last), {})
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (host.translate(_ASCII_LOWER) + path, verdict)

    @staticmethod
    def _longest_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            for length in sorted(node.get("ends", ()), reverse=True):
                if hit := node["ends"][length].get(segment[:length]):
                    best = hit
                    break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits, or None."""
        best, node, segments = None, self.root, path.split("/")
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._longest_path(node["paths"], segments) or best
        return best


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url",
               default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    One output row per input row, repeated rows included.  A null URL, or one
    without ``://``, has an empty host and path; no rule fits it, and like any
    URL that no rule fits it has a null rule and the verdict ``default``.  An
    input column of one of those four names is replaced.  An empty table gives
    an empty result.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            rows = []
            for u in urls:
                host, path = split_url(u)
                rule, verdict = trie.value.match(host, path) or (None, default)
                rows.append((host, path, rule, verdict))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    own = {"host", "path", "rule", "verdict"}
    kept = [c for c in pages.columns if c not in own]
    named = pages.select(*(F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(kept)), judged(F.col(url)).alias("judged"))
    return named.select(*(F.col(f"d{i}").alias(c) for i, c in enumerate(kept)),
                        *(F.col(f"judged.{c}").alias(c) for c in ("host", "path", "rule", "verdict")))
