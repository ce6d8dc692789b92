"""URL filter: allow and block rules, and a classifier for what no rule decides.

The classifier is a logistic regression on hashed character n-grams of host and path,
fitted here on a small labelled table of URLs. Weights have a fixed size, so they travel
with the task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower

#: Size of the hashed feature space, and lengths of the n-grams.
BUCKETS, GRAMS = 1 << 16, (3, 4, 5)
THRESHOLD = 0.5

#: The labelled URL table. 1 is to be blocked.
LABELLED = [
    *((f"https://{host}/{path}", 1) for host in (
        "casino-win.example.net", "www.casino.example.com", "blog.casino-win.example.net", "best-casino.example.org",
        "cheap-pills.example.net", "www.cheap-pills.example.com", "pills-online.example.com", "cheap-meds.example.org",
        "spam-farm.example.org", "www.spam-farm.example.org", "m.spam.example.com", "link-farm.example.net",
        "adult-x.example.com", "m.adult-x.example.com", "adult-cams.example.net", "xxx-adult.example.org",
        "free-bets.example.net", "www.free-bets.example.net", "free-money.example.com", "bets-win.example.org",
        "ads-track.example.com", "m.ads-track.example.com", "track-ads.example.net", "popup-ads.example.org")
      for path in ("en/680", "de/12", "fr/99.html", "es/3105/")),
    *((f"https://{host}/{path}", 0) for host in (
        "tionsh.example.net", "blog.tionble.example.com", "m.tiontion.example.com", "blog.ththth.example.org",
        "m.thther.example.org", "ththon.example.com", "www.ththes.example.net", "www.therst.example.com",
        "news.example.org", "blog.news.example.net", "m.library.example.com", "www.science.example.org",
        "garden.example.net", "m.history.example.org", "blog.recipes.example.com", "www.weather.example.net",
        "museum.example.org", "docs.python.example.com", "blog.thering.example.org", "ththan.example.net")
      for path in ("en/680", "de/12", "fr/99.html", "es/3105/")),
]

#: Rules (host and path) with what they decide.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

_PARTS = r"(?s)://([^/?#]*)([^?#]*)"


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matching_rule(host, path, rules: list[tuple[str, str]]):
    """Struct (rule, action) of the longest rule for the host or a parent domain, else null.

    Rules are looked up by host in a literal map, one look-up for each parent domain, so
    any number of rules that fits a plan costs the same.
    """
    by_host: dict[str, list] = {}
    for rule, action in rules:
        domain, _, rest = rule.partition("/")
        by_host.setdefault(domain.lower(), []).append((f"/{rest}", rule, action))
    entries = [x for domain, found in by_host.items() for x in (F.lit(domain), F.array(*[
        F.struct(F.lit(p).alias("path"), F.lit(len(r)).alias("n"), F.lit(r).alias("rule"), F.lit(a).alias("action"))
        for p, r, a in found]))]
    if not entries:
        return F.lit(None).cast("struct<rule:string,action:string>")
    known, labels = F.create_map(*entries), F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = F.flatten(F.filter(F.transform(parents, lambda h: F.element_at(known, h)), lambda x: x.isNotNull()))
    fits = F.transform(F.filter(found, lambda r: path.startswith(r["path"])),
                       lambda r: F.struct(r["n"], r["rule"], r["action"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["action"].alias("action")))


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct n-grams of host and path; both are marked, so equal grams stay apart."""
    found = set()
    for mark, text in ((b"h", f"^{host}$".encode()), (b"p", f"^{path}$".encode())):
        for n in GRAMS:
            found.update(mark + text[i:i + n] for i in range(len(text) - n + 1))
    return np.unique(np.array([zlib.crc32(g) % BUCKETS for g in found], np.int64))


def train(labelled: Iterable[tuple[str, int]], steps: int = 400, rate: float = 2.0, ridge: float = 1e-3) -> np.ndarray:
    """Weights by gradient descent; the last one is the bias. Features of a URL are scaled to unit length."""
    rows = [(m[1].lower(), m[2], y) for url, y in labelled if (m := re.search(_PARTS, url or ""))]
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    found = [features(h, p) for h, p, _ in rows]
    used, column = np.unique(np.concatenate(found), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    value = 1 / np.sqrt(np.array([max(1, len(f)) for f in found], float))[row]
    y, w, bias = np.array([y for *_, y in rows], float), np.zeros(len(used)), 0.0
    for _ in range(steps):
        z = np.bincount(row, value * w[column], len(rows)) + bias
        gap = 1 / (1 + np.exp(-z)) - y
        w -= rate * (np.bincount(column, value * gap[row], len(used)) / len(rows) * 10 + ridge * w)
        bias -= rate * gap.mean()
    weights[used], weights[-1] = w, bias
    return weights


def score(host: str, path: str, weights: np.ndarray) -> float:
    found = features(host, path)
    z = weights[-1] + (weights[found].sum() / np.sqrt(len(found)) if len(found) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labelled: Iterable[tuple[str, int]] = LABELLED,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict, score) for every row: the rule's verdict, else the model's.

    A null URL or one without ``://`` has an empty host and path, fits no rule and gets
    the model's verdict on them. Rows and repeated rows are judged one by one, so no key is
    ever gathered; an empty table gives an empty one; further columns are ignored.
    """
    weights = train(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(h, p, weights) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "score"])

    kind = dict(pages.select(id_col).dtypes)[id_col]
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    scored = rows.mapInArrow(run, f"id {kind}, host string, path string, score double")
    ruled = scored.withColumn("_r", matching_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("_r.action"), F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow"))
    return ruled.select(F.col("id").alias(id_col), "host", "path", F.col("_r.rule").alias("rule"),
                        verdict.alias("verdict"), "score")
