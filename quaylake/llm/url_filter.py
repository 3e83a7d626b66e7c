"""Operator 10: URL filter - rules first, else logistic regression on hashed n-grams.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case;
the path goes on up to `?`, `#` or the end.  A null url or one without `://` has an empty host
and path.  A rule holds for its host and all subdomains when the url's path starts with the
rule's; of several, the longest decides.  All other urls get the verdict of a logistic
regression on hashed character n-grams of host and path, trained from a small labelled table.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import ascii_lower

DIMENSION = 1 << 14
_SIZES = (3, 4, 5)

#: Labelled urls (1: block) that the default model learns from.
LABELLED = (
    ("http://www.casino-win.example/slots", 1), ("https://casino-royal.example/en/12", 1),
    ("http://best-casino-bonus.example/?a=1", 1), ("https://win-casino.example/fr/", 1),
    ("http://free-bets.example/today", 1), ("https://m.free-bets.example/de/7", 1),
    ("http://sports-bets-free.example/odds", 1), ("https://bets-online.example/en/9", 1),
    ("http://cheap-pills.example/buy", 1), ("https://www.cheap-pills.example/es/4", 1),
    ("http://pills-cheap-online.example/shop", 1), ("https://buy-pills.example/en/", 1),
    ("http://ads-track.example/pixel", 1), ("https://ads-track.example/en/88.html", 1),
    ("http://track-ads.example/click", 1), ("https://adserver-track.example/c?id=4", 1),
    ("http://spam-farm.example/a", 1), ("https://spam-farm.example/en/31/", 1),
    ("http://link-farm-spam.example/b", 1), ("https://spam-links.example/fr/2", 1),
    ("http://lottery-win.example/prize", 1), ("https://win-prize-now.example/en/5", 1),
    ("http://poker-bonus.example/play", 1), ("https://payday-loan-fast.example/de/", 1),
    ("http://xxx-adult.example/v", 1), ("https://free-porn-tube.example/en/1", 1),
    ("http://malware-download.example/x.exe", 1), ("https://phish-login.example/bank", 1),
    ("http://cheap-replica-watch.example/", 1), ("https://free-crypto-win.example/en/3", 1),
    ("http://www.theatre.example/en/12", 0), ("https://blog.garden.example/fr/345", 0),
    ("https://thering.example/en/7.html", 0), ("http://www.river.example/de/28/", 0),
    ("https://m.library.example/es/61", 0), ("http://blog.winter.example/en/900", 0),
    ("https://news.herald.example/en/2024/04", 0), ("http://docs.python.example/3/library", 0),
    ("https://www.university.example/research", 0), ("http://thorn.example/fr/10#top", 0),
    ("https://museum.example/collection/5", 0), ("http://www.recipes.example/bread", 0),
    ("https://blog.tiontion.example/en/81", 0), ("http://ththand.example/de/99", 0),
    ("https://m.therere.example/es/7.html", 0), ("http://www.anderin.example/fr/46/", 0),
    ("https://weather.example/city/berlin", 0), ("http://history.example/rome", 0),
    ("https://www.windows-repair.example/en/", 0), ("http://farmers-market.example/food", 0),
    ("https://trackandfield.example/en/2", 0), ("http://freedom-press.example/de/3", 0),
    ("https://city-council.example/minutes", 0), ("http://www.maths.example/algebra/1", 0),
    ("https://blog.ingenthe.example/en/5", 0), ("http://sheren.example/es/17", 0),
    ("https://music-school.example/piano", 0), ("http://www.erthen.example/fr/60", 0),
    ("https://forum.cycling.example/t/88", 0), ("http://m.ndthe.example/en/77", 0),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null where none fits.

    Rules are (verdict, host, path)."""
    rule = verdict = None
    for what, at, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, at + start) if rule is None else rule.when(fits, at + start)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all urls in a row, and for each the number of its url."""
    texts = [b"\x01" + h.encode() + b"\x02" + p.encode() + b"\x03" for h, p in zip(hosts, paths)]
    data = np.frombuffer(b"".join(texts) + b"\0" * max(_SIZES), np.uint8).astype(np.uint32)
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))   # bytes up to the end
    grams, owners = [], []
    for size in _SIZES:
        hashed = np.full(len(owner), size, np.uint32)
        for at in range(size):
            hashed = (hashed ^ data[at:at + len(owner)]) * np.uint32(0x01000193)
        hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x9E3779B1)
        inside = left >= size
        grams.append((hashed >> np.uint32(32 - 14))[inside])
        owners.append(owner[inside])
    return np.concatenate(grams), np.concatenate(owners)


def _sums(weights: np.ndarray, grams: np.ndarray, owners: np.ndarray, urls: int) -> np.ndarray:
    """For each url the weights of its n-grams, over the root of their number."""
    number = np.maximum(np.bincount(owners, minlength=urls), 1)
    return np.bincount(owners, weights[grams], urls) / np.sqrt(number)


def fit(labelled: list[tuple[str, str, int]], rounds: int = 400, step: float = 0.5,
        penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept from (host, path, 0/1) by gradient descent from zero."""
    weights, bias = np.zeros(DIMENSION), 0.0
    if not labelled:
        return weights, -1.0
    grams, owners = _features([h for h, _, _ in labelled], [p for _, p, _ in labelled])
    wanted = np.array([y for _, _, y in labelled], float)
    share = 1 / np.sqrt(np.maximum(np.bincount(owners, minlength=len(wanted)), 1))
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(_sums(weights, grams, owners, len(wanted)) + bias))) - wanted
        weights -= step * (np.bincount(grams, (error * share)[owners], DIMENSION) / len(wanted)
                           + penalty * weights) * 10
        bias -= step * error.mean()
    return weights, bias


def judge(df: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", labelled: Iterable[tuple[str, int]] = LABELLED,
          threshold: float = 0.5) -> DataFrame:
    """Per url: host, path, rule, verdict, and the model's probability to block.

    The labelled table is small by contract; it is parsed by the same Spark expressions."""
    table = df.sparkSession.createDataFrame(list(labelled), "url string, y int")
    known = table.select(host_of(F.col("url")), path_of(F.col("url")), "y").collect()
    weights, bias = fit(sorted((h, p, y) for h, p, y in known))

    @F.pandas_udf("double")
    def block_probability(host: pd.Series, path: pd.Series) -> pd.Series:
        if not len(host):
            return pd.Series([], dtype=float)
        grams, owners = _features(host.tolist(), path.tolist())
        return pd.Series(1 / (1 + np.exp(-(_sums(weights, grams, owners, len(host)) + bias))))

    pages = df.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                      path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                          block_probability("host", "path").alias("block_probability"))
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("block_probability") >= threshold, "block")
                   .otherwise("allow")).alias("verdict"), "block_probability")
