"""URL filters: host and path rules, then a logistic regression on hashed
character n-grams of host and path.

Rules come first: a rule ``host/path`` fits its host and all subdomains where
the url's path starts with the rule's; the longest fitting rule decides.  Urls
that no rule fits get the classifier's verdict.  It is trained on the driver
from a small table of labelled urls (a parameter, bounded by ``MAX_LABELLED``)
and applied in Arrow batches; nothing is shuffled.

Defined results: a null url, or one without ``://``, has empty host and path
and is judged by the classifier's bias; an empty path fits no rule; repeated
rows get equal results; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

MAX_LABELLED = 50_000
DIGITS = re.compile("[0-9]+")
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# --- fixed values: words of hosts to block and to allow, words that go with either, paths
BLOCK_TOPICS = (
    "ad", "ads", "adserver", "banner", "tracker", "tracking", "pixel", "popup", "clicks", "casino", "poker", "slots", "jackpot", "lottery", "betting", "bet", "gambling",
    "porn", "xxx", "sex", "adult", "cams", "escort", "pill", "viagra", "pharma", "replica", "payday", "crypto", "phish", "malware", "crack", "keygen", "warez", "torrent", "spam",
)
ALLOW_TOPICS = (
    "news", "weather", "library", "museum", "university", "school", "garden", "recipes", "cooking", "history", "science", "physics", "music", "travel", "sports", "health",
    "forum", "books", "city", "photos", "code", "maps", "radio", "theatre", "film", "bank", "family", "nature", "river", "mountain", "journal", "letters", "poems", "language", "research",
)
BLOCK_PARTNERS = ("free", "best", "cheap", "hot", "win", "bonus", "instant", "secret")
ALLOW_PARTNERS = ("local", "daily", "open", "our", "new", "little", "public", "north")
SYLLABLES = ("ba", "cor", "den", "fal", "gri", "hol", "ken", "lin", "mar", "nor", "pel", "ros", "san", "tor", "vel", "wen", "ton", "ley", "ster", "ing", "the", "er", "an", "ment", "tion", "al", "st", "ent")
PATHS = ("/", "/en/7", "/index.html", "/a/b", "/de/list", "/fr/2024/page", "/es/item/3", "/view?id=1")
# -----------------------------------------------------------------------------


def seed_urls() -> tuple[tuple[str, int], ...]:
    """Labelled host-and-path samples; 1 is block.  Every topic stands alone and
    beside words that go with its label, in front and behind; separators,
    subdomains and paths are dealt alike to both labels.  Names without a topic
    (two or three syllables) are allowed."""
    out = []
    for label, topics, partners in ((1, BLOCK_TOPICS, BLOCK_PARTNERS), (0, ALLOW_TOPICS, ALLOW_PARTNERS)):
        for i, topic in enumerate(topics):
            one, two = partners[i % len(partners)], partners[(i + 3) % len(partners)]
            hosts = (topic, f"{one}-{topic}", f"{topic}-{two}", f"{topic}{one}", f"www.{topic}s", f"m.{two}{topic}")
            out += [(f"{host}.example{PATHS[(6 * i + k) % len(PATHS)]}", label) for k, host in enumerate(hosts)]
    n = len(SYLLABLES)
    for i in range(12 * n):
        a, b, c = SYLLABLES[i % n], SYLLABLES[(i + 1 + i // n) % n], SYLLABLES[(7 * i + 3) % n]
        name = (a + b, a + b + c, f"{a}{b}-{c}{a}", f"www.{b}{c}")[i % 4]
        out.append((f"{name}.example{PATHS[i % len(PATHS)]}", 0))
    return tuple(out)


SEED_URLS = seed_urls()


@dataclass(frozen=True)
class UrlSpec:
    log2_buckets: int = 15
    orders: tuple[int, ...] = (3, 4, 5)
    l2: float = 0.1
    steps: int = 1500
    rate: float = 0.5


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        test = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        fits.append(F.when(test, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def features(host: str, path: str, spec: UrlSpec) -> list[int]:
    """Distinct buckets of the n-grams of host and path, kept apart; a run of
    digits counts as one digit, whatever the number."""
    host, path = DIGITS.sub("0", host), DIGITS.sub("0", path)
    out = set()
    for tag, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in spec.orders:
            for i in range(len(s) - n + 1):
                out.add(zlib.crc32(f"{tag}{s[i:i + n]}".encode()) & ((1 << spec.log2_buckets) - 1))
    return sorted(out)


def _logit(weights: np.ndarray, buckets: list[int]) -> float:
    return float(weights[buckets].sum() / np.sqrt(max(1, len(buckets))) + weights[-1])


def train(labelled: Sequence[tuple[str, int]], spec: UrlSpec = UrlSpec()) -> np.ndarray:
    """Weights by bucket, the bias last.  ``labelled``: (host/path, 1 for block)."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"the labelled table is fitted on the driver: at most {MAX_LABELLED} rows")
    rows, cols, vals = [], [], []
    for k, (u, _) in enumerate(labelled):
        host, _, path = u.partition("/")
        b = features(host, "/" + path, spec)
        rows += [k] * len(b)
        cols += b
        vals += [1 / np.sqrt(max(1, len(b)))] * len(b)
    r, c, v = np.array(rows, int), np.array(cols, int), np.array(vals)
    y = np.array([x for _, x in labelled], float)
    w = np.zeros((1 << spec.log2_buckets) + 1)
    for _ in range(spec.steps if len(y) else 0):
        z = np.bincount(r, v * w[c], len(y)) + w[-1]
        e = (1 / (1 + np.exp(-z)) - y) / len(y)
        g = np.bincount(c, v * e[r], len(w))
        g[-1] = e.sum()
        g[:-1] += spec.l2 / len(y) * w[:-1]
        w -= spec.rate * len(y) ** 0.5 * g
    return w.astype(np.float32)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: Sequence[tuple[str, int]] = SEED_URLS, spec: UrlSpec = UrlSpec()) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score."""
    weights = train(labelled, spec)

    ship()

    @F.pandas_udf("double")
    def score(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([1 / (1 + np.exp(-_logit(weights, features(h, p, spec)))) for h, p in zip(host, path)], dtype="float64")

    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = parts.withColumns({"r": rule_for(F.col("host"), F.col("path"), rules), "block_score": score("host", "path")})
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "block_score")
