"""URL filter: pattern rules found through their rarest literal token.

Every rule is a regular expression over host and path with the literal tokens
that any match must contain.  How often each rule token occurs in the URLs is
counted in Spark; a rule is filed under its rarest one.  A URL's own tokens then fetch
the few rules that can match, and only those run their expression.

Site rules (host and path prefix) decide by the longest match; without one the
word rules give the verdict, and a URL that matches nothing is allowed.

The rules are an argument, held by the driver and sent to the tasks; URLs are
read in place, without a shuffle.  A null URL, or one without ://, has an empty
host and path; repeated rows each get their result; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_REST = re.compile(r"([^/?#]*)([^?#]*)")
#: Tokens of a URL: what stands between these characters.
_SEPARATORS = r"[./_\-]+"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str  # over host + path
    tokens: tuple[str, ...]  # each is a token of every URL that matches
    site: bool = True


def site_rule(verdict: str, rule: str) -> Rule:
    """Rule for a host, its subdomains and a path prefix, like `example.org/es/`."""
    host, slash, path = rule.partition("/")
    path = slash + path
    # the last piece of the prefix may be the start of a longer token
    whole = re.split(_SEPARATORS, path)[:-1]
    tokens = tuple(t for t in [*re.split(_SEPARATORS, host), *(t.translate(_TO_LOWER) for t in whole)] if t)
    return Rule(rule, verdict, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tokens)


def word_rule(verdict: str, *words: str) -> Rule:
    """Rule for URLs that hold these words one after the other."""
    gap = r"[./_\-]+"
    return Rule("-".join(words), verdict, rf"(?s:(?:.*{gap})?){gap.join(map(re.escape, words))}(?:{gap}(?s:.*))?$", tuple(words), site=False)


#: Word rules of the method itself.
WORD_RULES = (
    word_rule("block", "spam"), word_rule("block", "cheap", "pills"), word_rule("block", "casino"), word_rule("block", "viagra"),
    word_rule("block", "porn"), word_rule("block", "xxx"), word_rule("block", "malware"), word_rule("block", "phishing"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path."""
    _, mark, rest = (url or "").partition("://")
    m = _REST.match(rest)
    return m[1].translate(_TO_LOWER), m[2]


def _tokens(host: str, path: str) -> set[str]:
    return set(re.split(_SEPARATORS, f"{host}/{path.translate(_TO_LOWER)}"))


def token_counts(pages: DataFrame, rules, url_col: str = "url") -> dict[str, int]:
    """URLs that hold each of the rules' tokens (one row per token comes back)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    rest = F.regexp_extract(F.translate(col(url_col).cast("string"), _UPPER, _LOWER), r"(?s)://([^?#]*)", 1)
    tokens = pages.select(F.explode(F.array_distinct(F.split(rest, _SEPARATORS))).alias("token"))
    # the rules are an argument of this call, so their tokens are as bounded as it is
    known = F.broadcast(pages.sparkSession.createDataFrame([(t,) for t in wanted], "known string"))
    found = tokens.join(known, F.col("token") == F.col("known")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return {r["token"]: r["n"] for r in found.collect()}


def index_rules(rules, counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without any under the empty one."""
    index: dict[str, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(r)
    return index


def judge(pages: DataFrame, rules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: `page_id`, `host`, `path`, `rule` (longest site rule, or null)
    and `verdict`."""
    rules = list(rules)
    index = index_rules(rules, token_counts(pages, rules, url_col))
    schema = T.StructType([field(pages, id_col, "page_id")] + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")])

    def run(batches):
        compiled: dict[str, re.Pattern] = {}  # on first use: most rules meet no URL of a task

        def fits(r: Rule, text: str) -> bool:
            if r.pattern not in compiled:
                compiled[r.pattern] = re.compile(r.pattern)
            return compiled[r.pattern].match(text) is not None

        always = index.get("", [])
        for b in batches:
            out = []
            for url in b.column(1).to_pylist():
                host, path = split_url(url)
                fit = [r for t in _tokens(host, path) & index.keys() - {""} for r in index[t] if fits(r, host + path)]
                fit += [r for r in always if fits(r, host + path)]
                sites = [r for r in fit if r.site]
                best = max(sites, key=lambda r: (len(r.name), r.name), default=None)
                verdict = best.verdict if best else "block" if any(r.verdict == "block" for r in fit) else "allow"
                out.append((host, path, best.name if best else None, verdict))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.string()) for c in columns]], names=schema.names)

    return pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url")).mapInArrow(run, schema)
