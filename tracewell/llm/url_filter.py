"""URL filter: site rules first, then a weighted vocabulary counted with Aho-Corasick.

One pass of an automaton over the lower-cased URL finds every vocabulary term; a hit counts only where the
characters beside it are no ASCII letters or digits.  One strict term rejects a URL, and so do `soft_needed`
different soft terms.  A site rule that fits takes precedence over the vocabulary.

Defined cases: a null URL, or one without `://`, has an empty host and an empty path, fits no rule and is judged by
the vocabulary over its whole string (null: no hit, so `allow`).  Rows are judged one by one: repeated rows give
repeated results, an empty table gives none, other columns are ignored.  Of rules that fit, the one with the
longest text wins; equal rules with different verdicts are refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import ascii_lower, read
from tracewell.llm.registry import query


@dataclass(frozen=True)
class Rule:
    """`site` is a host, a `/` and the beginning of a path; it holds for the host and all hosts below it."""

    site: str
    verdict: str

    @property
    def host(self) -> str:
        return self.site.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.site.partition("/")[2]


@dataclass(frozen=True)
class Vocabulary:
    """One hit of a strict term rejects; `soft_needed` different soft terms do."""

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    soft_needed: int = 2


SITE_RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)

UNWANTED = Vocabulary(
    strict=(
        "casino", "casinos", "porn", "porno", "xxx", "viagra", "cialis", "escort", "escorts", "malware", "phishing",
        "spam", "warez", "keygen", "ads-track", "adserver", "clickbait",
    ),
    soft=(
        "adult", "bet", "bets", "betting", "bonus", "cheap", "cams", "dating", "deal", "deals", "discount", "farm", "free",
        "gambling", "hot", "jackpot", "loan", "loans", "lottery", "nude", "payday", "pharmacy", "pill", "pills", "poker",
        "prize", "sex", "sexy", "slots", "torrent", "track", "win", "winner", "x",
    ),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = SITE_RULES,
    vocabulary: Vocabulary = UNWANTED,
    url: str = "url",
    key: Sequence[str] = ("page_id",),
) -> DataFrame:
    """key columns, host, path, rule (null if none fits), strict_hits, soft_terms, verdict."""
    table: dict[str, list[Rule]] = {}
    for rule in sorted(set(rules), key=lambda r: -len(r.site)):
        if any(r.site == rule.site for r in table.get(rule.host, ())):
            raise ValueError(f"two verdicts for {rule.site}")
        table.setdefault(rule.host, []).append(rule)
    verdicts = {r.site: r.verdict for r in rules}

    @F.pandas_udf("rule string, strict_hits long, soft_terms long, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(vocabulary)
        for urls, hosts, paths in batches:
            out = []
            for text, host, path in zip(urls, hosts, paths, strict=True):
                strict, soft = _hits(automaton, text or "")
                rule = _fitting(table, host, path)
                refused = strict > 0 or soft >= vocabulary.soft_needed
                out.append((rule, strict, soft, verdicts[rule] if rule else "block" if refused else "allow"))
            yield pd.DataFrame(out, columns=["rule", "strict_hits", "soft_terms", "verdict"])

    text = F.col(url)
    slim = pages.select(*key, ascii_lower(text).alias("_lower"), host_of(text).alias("host"), path_of(text).alias("path"))
    return slim.withColumn("_j", judge("_lower", "host", "path")).select(*key, "host", "path", "_j.*")


def _automaton(vocabulary: Vocabulary):
    import ahocorasick

    found = ahocorasick.Automaton()
    for strict, terms in ((False, vocabulary.soft), (True, vocabulary.strict)):
        for term in terms:
            found.add_word(term, (strict, term))
    if len(found):
        found.make_automaton()
    return found


def _plain(c: str) -> bool:
    return c.isascii() and c.isalnum()


def _hits(automaton, text: str) -> tuple[int, int]:
    """How many strict hits stand alone in the text, and how many different soft terms do."""
    strict, soft = 0, set()
    if not len(automaton):
        return 0, 0
    for end, (is_strict, term) in automaton.iter(text):
        start = end - len(term)
        if (start >= 0 and _plain(text[start])) or (end + 1 < len(text) and _plain(text[end + 1])):
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def _fitting(table: dict[str, list[Rule]], host: str, path: str) -> str | None:
    """The longest rule for the host or a host above it whose path begins this path."""
    best, rest = None, host
    while rest:
        for rule in table.get(rest, ()):
            if path.startswith(rule.path):
                if best is None or len(rule.site) > len(best):
                    best = rule.site
                break
        rest = rest.partition(".")[2]
    return best


def _sql() -> str:
    def alone(term: str) -> str:
        return f"regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"

    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.site}'"
        for r in sorted(SITE_RULES, key=lambda r: -len(r.site))
    )
    strict = " OR ".join(alone(t) for t in UNWANTED.strict)
    soft = " + ".join(f"CAST({alone(t)} AS INT)" for t in UNWANTED.soft)
    blocked = ", ".join(f"'{r.site}'" for r in SITE_RULES if r.verdict == "block")
    return f"""WITH p AS (SELECT page_id, coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS u,
          coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
          coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        r AS (SELECT *, CASE {fits} END AS rule, ({strict}) AS strict, {soft} AS soft FROM p)
        SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN CASE WHEN rule IN ({blocked}) THEN 'block' ELSE 'allow' END
          WHEN strict OR soft >= {UNWANTED.soft_needed} THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@query("op10_url_filter", _sql())
def op10_url_filter(spark, folder):
    return judge_urls(read(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")
