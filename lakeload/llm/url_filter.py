"""URL filters: host and path rules, and a weighted vocabulary found with Aho-Corasick.

Rules are plain column expressions. The vocabulary runs in an Arrow-batched function, one automaton per
Python worker; the table is never shuffled.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import LOWER, UPPER, ascii_lower

# Terms that alone reject a URL.
STRICT_TERMS = ("adult", "casino", "cialis", "escort", "hentai", "porn", "spam", "viagra", "warez", "xxx")
# Terms that reject a URL when several different ones occur, with their weights.
SOFT_TERMS = {
    "ads": 1.0, "bet": 1.0, "bets": 1.0, "betting": 1.0, "cheap": 1.0, "crack": 1.0, "dating": 1.0, "discount": 0.5,
    "farm": 0.5, "free": 0.5, "gamble": 1.0, "keygen": 1.5, "loan": 0.5, "loans": 0.5, "lottery": 1.0, "nude": 1.5,
    "pills": 1.0, "poker": 1.0, "replica": 1.0, "sexy": 1.5, "slots": 1.0, "torrent": 1.0, "track": 0.5,
    "tracker": 0.5, "win": 0.5}


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for a host with all its subdomains, below a path."""
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...], value: str) -> Column:
    """Attribute ``value`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


@functools.cache
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in terms:
        found.add_word(term, term)
    found.make_automaton()
    return found


def _edge(text: str, at: int) -> bool:
    return not (0 <= at < len(text) and text[at].isascii() and text[at].isalnum())


def bounded_terms(text: str, terms: tuple[str, ...]) -> set[str]:
    """Distinct terms in ``text`` with no ASCII letter or digit on either side."""
    if not terms:
        return set()
    return {term for end, term in _automaton(terms).iter(text)
            if _edge(text, end + 1) and _edge(text, end - len(term))}


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = (), strict: tuple[str, ...] = STRICT_TERMS,
                soft: dict[str, float] = SOFT_TERMS, min_soft: int = 2, url: str = "url") -> DataFrame:
    """All pages with ``host, path, rule, n_strict, n_soft, soft_weight, verdict``.

    ``verdict`` is the longest fitting rule's; without one it is ``block`` for at least one strict term or
    ``min_soft`` different soft terms, else ``allow``. A null URL, or one without ``://``, has an empty host and path,
    fits no rule, and its text (none when null) still goes through the vocabulary. Repeated rows stay, no
    rows give no rows.
    """
    lower = str.maketrans(UPPER, LOWER)
    terms = tuple(sorted({*strict, *soft}))
    hard, weights = frozenset(strict), dict(soft)

    @F.pandas_udf("n_strict long, n_soft long, soft_weight double")
    def vocabulary(urls: pd.Series) -> pd.DataFrame:
        found = [bounded_terms(u.translate(lower), terms) if u else () for u in urls]
        gentle = [[t for t in hit if t in weights] for hit in found]
        return pd.DataFrame({"n_strict": [sum(t in hard for t in hit) for hit in found],
                             "n_soft": [len(hit) for hit in gentle],
                             "soft_weight": [float(sum(sorted(weights[t] for t in hit))) for hit in gentle]})

    address = F.col(f"`{url}`")
    parts = {"host": url_host(address), "path": url_path(address)}
    out = pages.withColumns({**parts, "rule": rule_of(parts["host"], parts["path"], rules, "name"),
                             "verdict": rule_of(parts["host"], parts["path"], rules, "verdict"),
                             "n_strict": vocabulary(address)})
    hits = F.col("n_strict")
    bad = (hits["n_strict"] >= 1) | (hits["n_soft"] >= min_soft)
    return out.withColumns({
        "verdict": F.coalesce("verdict", F.when(bad, "block").otherwise("allow")),
        "n_strict": hits["n_strict"], "n_soft": hits["n_soft"], "soft_weight": hits["soft_weight"]})
