"""URL filter rules, looked up by their rarest literal token.

Tokens are runs of ASCII letters and digits. A rule that fits a URL holds each of its whole literal tokens, so
it is filed under the one that the fewest URLs of the table hold. A URL's tokens fetch the rules filed under
them, and only those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules are a list that every task holds; more than this many is refused.
MAX_RULES = 1_000_000
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is searched in host + path, the host in lower case. ``name`` is what is reported; the rule with the
    longest name wins, then the one with the longest host, then the first. ``tokens`` are whole tokens of every fit."""

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    host: str = ""


def host_rule(action: str, host: str, path: str) -> UrlRule:
    """Fits ``host`` and all its subdomains where the URL's path starts with ``path``."""
    host = _lower(host)
    # The last token of the path may go on in the URL unless something ends it.
    whole = re.sub(r"[A-Za-z0-9]+$", "", path)
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path) or "(?![^/])"}"
    return UrlRule(host + path, action, pattern, tuple(_TOKEN.findall(_lower(host + whole))), host)


def word_rule(action: str, word: str) -> UrlRule:
    """Fits hosts that hold ``word`` as a whole token."""
    return UrlRule("", action, rf"^(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?![a-z0-9])", (word,))


#: Words of link farms and shops in host names: what a URL without a rule is judged by.
SPAM_WORDS = ("casino", "pills", "poker", "porn", "spam", "viagra", "xxx")
SPAM_RULES = tuple(word_rule("block", w) for w in SPAM_WORDS)


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return _lower(host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """Of how many rows each of ``tokens`` is a token; a row per rule token at most reaches the driver."""
    spark = urls.sparkSession
    named = spark.createDataFrame([(t,) for t in sorted(set(tokens))], "token string")
    held = F.array_distinct(F.split(F.translate("url", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+"))
    found = urls.select(F.explode(held).alias("token")).join(named, "token").groupBy("token").count()
    return {r["token"]: r["count"] for r in found.collect()}


def _filed(rules: Sequence[UrlRule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Places of rules by rarest token; those without a whole token."""
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            always.append(i)
    return index, always


def _judge(rules: Sequence[UrlRule], otherwise: Sequence[UrlRule], counts: dict[str, int], default: str):
    every = [*rules, *otherwise]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, always = _filed(every, counts)
        compiled: dict[int, re.Pattern] = {}

        def fits(i: int, url: str) -> bool:
            if i not in compiled:
                compiled[i] = re.compile(every[i].pattern)
            return compiled[i].search(url) is not None

        for batch in batches:
            out = []
            for url in batch.column("url").to_pylist():
                host, path = host_and_path(url)
                whole = host + path
                asked = {i for t in set(_TOKEN.findall(_lower(whole))) for i in index.get(t, ())}
                found = [i for i in (*asked, *always) if fits(i, whole)]
                named = [i for i in found if i < len(rules)]
                best = max(named, key=lambda i: (len(every[i].name), len(every[i].host), -i), default=None)
                least = min(found, default=None)
                verdict = every[best].action if best is not None else default if least is None else every[least].action
                out.append((host, path, None if best is None else every[best].name, verdict, len(asked) + len(always)))
            columns = list(zip(*out)) or [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.string()] * 4 + [pa.int32()])]
            yield pa.record_batch([*(batch.column(c) for c in batch.schema.names), *arrays], [*batch.schema.names, "host", "path", "rule", "verdict", "n_candidates"])

    return run


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule], otherwise: Sequence[UrlRule] = SPAM_RULES, default: str = "allow",
    key: str = "page_id", url: str = "url",
) -> DataFrame:
    """key, host, path, rule, verdict and n_candidates (rules whose expression ran) for each row of ``pages``.

    The longest of ``rules`` that fits decides; without one, the first fit of ``otherwise``; without any, ``default``.
    One pass counts the rules' tokens over all URLs (a partial count per task), the second judges each URL where it is
    read: nothing but counts is shuffled.

    A null url or one without ``://`` has empty host and path and meets only rules without tokens. Rows without key, repeated rows and
    ties are judged alike; other columns are ignored; no rows give no rows.
    """
    if len(rules) + len(otherwise) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    urls = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("url"))
    counts = token_counts(urls, [t for r in (*rules, *otherwise) for t in r.tokens])
    kind = dict(urls.dtypes)["_key"]
    schema = f"_key {kind}, url string, host string, path string, rule string, verdict string, n_candidates int"
    done = urls.mapInArrow(_judge(tuple(rules), tuple(otherwise), counts, default), schema)
    return done.select(F.col("_key").alias(key), "host", "path", "rule", "verdict", "n_candidates")
