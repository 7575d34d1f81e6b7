"""URL filter: host rules first, then a weighted vocabulary found by Aho-Corasick.

One pass of the automaton over the whole url (A-Z lower-cased) finds every
vocabulary term; a place counts only if no letter or digit touches it.  A url is
rejected for one strict term, or when the weights of its distinct soft terms
reach `limit`.  The vocabulary and the rules are parameters, so what each task
holds is as large as the caller's lists, whatever the size of the table.

Cases: a NULL url has empty host and path, no rule and no hits (allow); a url
without `://` has empty host and path, so no rule fits, but its terms count;
repeated rows are judged alike; other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.shared import LOWER, UPPER, lower_ascii

_FOLD = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case; soft terms carry weights."""

    strict: tuple[str, ...] = (
        "adult", "casino", "cheap-pills", "escorts", "link-farm", "malware", "payday-loans",
        "phishing", "porn", "spam-farm", "viagra", "warez", "xxx",
    )
    soft: tuple[tuple[str, float], ...] = (
        ("ads", 1.0), ("bet", 1.0), ("bets", 1.0), ("bonus", 1.0), ("cheap", 1.0),
        ("click", 0.5), ("download", 0.5), ("farm", 0.5), ("free", 1.0), ("jackpot", 1.5),
        ("loans", 1.0), ("offer", 0.5), ("pills", 1.5), ("poker", 1.5), ("promo", 1.0),
        ("sex", 1.5), ("spam", 1.5), ("torrent", 1.5), ("track", 1.0), ("tracker", 1.0),
        ("win", 1.0),
    )
    limit: float = 2.0


@dataclass(frozen=True)
class UrlRules:
    """(host, path, verdict); a rule covers its host, all subdomains, paths below."""

    rules: tuple[tuple[str, str, str], ...] = (
        ("net", "/", "block"),
        ("example.net", "/en/", "allow"),
        ("example.com", "/de/", "block"),
        ("org", "/fr/", "allow"),
    )
    vocabulary: Vocabulary = field(default_factory=Vocabulary)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path as the rules see them; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def match_rule(host: Column, path: Column, rules: UrlRules) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else NULL."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Shorter rules first: each longer one overrides what stands so far.
    for rule_host, rule_path, says in sorted(rules.rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(
            path, F.lit(rule_path)
        )
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def build_automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term, weight in vocabulary.soft:
        automaton.add_word(term, (term, weight))
    for term in vocabulary.strict:
        automaton.add_word(term, (term, None))
    automaton.make_automaton()
    return automaton


def _touches(url: str, at: int) -> bool:
    return 0 <= at < len(url) and (url[at].isdigit() or url[at].isalpha()) and url[at].isascii()


def count_terms(url: str | None, automaton: ahocorasick.Automaton) -> tuple[int, int, float]:
    """Distinct strict terms, distinct soft terms, weight of the latter."""
    if not url:
        return 0, 0, 0.0
    folded, strict, soft = url.translate(_FOLD), set(), {}
    for end, (term, weight) in automaton.iter(folded):
        if _touches(folded, end + 1) or _touches(folded, end - len(term)):
            continue
        if weight is None:
            strict.add(term)
        else:
            soft[term] = weight
    return len(strict), len(soft), float(sum(soft.values()))


def filter_urls(pages: DataFrame, rules: UrlRules | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the hits found."""
    rules = rules or UrlRules()
    vocabulary = rules.vocabulary
    host, path = split_url(F.col("url"))
    rule, says = match_rule(F.col("host"), F.col("path"), rules)
    judged = (
        pages.select("page_id", "url")
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": rule, "verdict": says})
    )
    id_type = pages.schema["page_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton(vocabulary)
        for batch in batches:
            hits = [count_terms(u, automaton) for u in batch["url"].to_pylist()]
            verdicts = [
                says or ("block" if strict or weight >= vocabulary.limit else "allow")
                for says, (strict, _, weight) in zip(batch["verdict"].to_pylist(), hits)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in ("page_id", "host", "path", "rule")]
                + [
                    pa.array(verdicts, pa.string()),
                    pa.array([h[0] for h in hits], pa.int64()),
                    pa.array([h[1] for h in hits], pa.int64()),
                    pa.array([h[2] for h in hits], pa.float64()),
                ],
                names=["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight"],
            )

    return judged.mapInArrow(
        judge,
        f"page_id {id_type}, host string, path string, rule string, verdict string, "
        "n_strict bigint, n_soft bigint, soft_weight double",
    )


def oracle(rules: UrlRules | None = None) -> str:
    """The same judgement as SQL."""
    rules = rules or UrlRules()
    vocabulary = rules.vocabulary

    def hit(term: str) -> str:
        return f"regexp_matches(folded, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"

    fits = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p, _ in sorted(rules.rules, key=lambda r: (-len(r[0] + r[1]), r))
    ]
    says = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in rules.rules)
    strict = " + ".join(f"CAST({hit(t)} AS BIGINT)" for t in vocabulary.strict)
    soft = " + ".join(f"CAST({hit(t)} AS BIGINT)" for t, _ in vocabulary.soft)
    weight = " + ".join(f"{w}::DOUBLE * CAST({hit(t)} AS BIGINT)" for t, w in vocabulary.soft)
    return f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS folded,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, folded, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT *, CASE {' '.join(fits)} END AS rule, {strict} AS n_strict, {soft} AS n_soft, {weight} AS soft_weight
  FROM parts)
SELECT page_id, host, path, rule,
       CASE rule {says} ELSE CASE WHEN n_strict > 0 OR soft_weight >= {vocabulary.limit} THEN 'block' ELSE 'allow' END
       END AS verdict, n_strict, n_soft, soft_weight
FROM ruled"""
