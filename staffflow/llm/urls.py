"""URL filter: host rules, and a weighted vocabulary of strict and soft terms.

An Aho-Corasick automaton finds all terms of the vocabulary in one pass over a url. A hit counts
where no letter A-Z or digit stands on either side. One strict term rejects a url, and so do
several distinct soft ones. A rule that fits the url decides before the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.llm.common import LOWER, UPPER, bytes_of, map_batches


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case; ``soft_needed`` distinct soft terms weigh as much as a strict one."""

    strict: tuple[str, ...] = ("adult", "casino", "escorts", "malware", "phishing", "porn", "spam", "viagra", "xxx")
    soft: tuple[str, ...] = (
        "ads", "bet", "bets", "bonus", "cheap", "click", "dating", "deals", "farm", "free", "gambling", "loans",
        "lottery", "pills", "poker", "prize", "slots", "track", "win", "winner",
    )
    soft_needed: int = 2


#: (verdict, host, path): longest host and path first counts.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://``: up to ``/``, ``?`` or ``#`` in lower case, and from there to ``?`` or ``#``."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule for the host or a domain above it; null without one."""
    text = verdict = F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text, verdict = F.when(fits, name + start).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def term_hits(pages: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``pages`` (page_id, url) with n_strict and n_soft, the distinct terms of each kind in the url."""
    terms = [(t, True) for t in vocabulary.strict] + [(t, False) for t in vocabulary.soft]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, strict in terms:
            automaton.add_word(term, (term, strict))
        automaton.make_automaton()
        inside = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        for batch in batches:
            found = ([], [])
            for url in bytes_of(batch, "url"):
                text = url.lower().decode()
                hits: set[tuple[str, bool]] = set()
                for end, (term, strict) in automaton.iter(text):
                    start = end - len(term) + 1
                    if (start == 0 or text[start - 1] not in inside) and (end + 1 == len(text) or text[end + 1] not in inside):
                        hits.add((term, strict))
                found[0].append(sum(s for _, s in hits)), found[1].append(sum(not s for _, s in hits))
            counts = [pa.array(x, pa.int64()) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), *counts], ["page_id", "url", "n_strict", "n_soft"]
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(pages.select("page_id", "url"), step, f"page_id {kind}, url string, n_strict long, n_soft long")


def filter_urls(pages: DataFrame, vocabulary: Vocabulary = Vocabulary(), rules=RULES) -> DataFrame:
    """Verdict on every url: page_id, host, path, rule, verdict, n_strict, n_soft; one row per input row.

    A null url, or one without ``://``, has an empty host and path, so no rule fits it; its
    verdict is the vocabulary's, over whatever text there is. A url of any length is read whole, of
    rules of one length the first listed counts. Rows that repeat are judged each, an empty table
    gives no rows, further columns are ignored.
    """
    hits = term_hits(pages, vocabulary)
    host, path = host_and_path(F.col("url"))
    parts = hits.select("page_id", host.alias("host"), path.alias("path"), "n_strict", "n_soft")
    rule, given = fitting_rule(F.col("host"), F.col("path"), rules)
    rejected = (F.col("n_strict") >= 1) | (F.col("n_soft") >= vocabulary.soft_needed)
    verdict = F.coalesce(given, F.when(rejected, "block").otherwise("allow"))
    return parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "n_strict", "n_soft")


def _sql() -> str:
    words = Vocabulary()
    hit = "CAST(regexp_matches(u, '(^|[^a-z0-9]){}($|[^a-z0-9])') AS BIGINT)"
    strict, soft = (" + ".join(hit.format(t) for t in terms) for terms in (words.strict, words.soft))
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = "(host = '{1}' OR suffix(host, '.{1}')) AND starts_with(path, '{2}')"
    rule = " ".join(f"WHEN {fits.format(*r)} THEN '{r[1]}{r[2]}'" for r in ordered)
    given = " ".join(f"WHEN {fits.format(*r)} THEN '{r[0]}'" for r in ordered)
    return f"""
WITH low AS (
  SELECT page_id, url, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
hits AS (SELECT *, {strict} AS n_strict, {soft} AS n_soft FROM low)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {given} WHEN n_strict >= 1 OR n_soft >= {words.soft_needed} THEN 'block' ELSE 'allow' END AS verdict,
  n_strict, n_soft FROM hits
"""


URL_SQL = _sql()
