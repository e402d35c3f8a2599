"""URLs judged by host rules and by a weighted vocabulary."""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: (action, host and path): the longest that fits decides.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
#: One of these anywhere rejects.
STRICT = (
    "adult", "betting", "casino", "escort", "malware", "phishing", "porn", "roulette", "sex", "spam",
    "viagra", "warez", "xxx",
)
#: So many different ones of these reject.
SOFT = (
    "ad", "ads", "affiliate", "bet", "bets", "bonus", "cheap", "click", "coupon", "crack", "deal",
    "deals", "discount", "download", "farm", "free", "hot", "jackpot", "keygen", "loan", "offer",
    "pharma", "pill", "pills", "popup", "prize", "promo", "sale", "slots", "torrent", "track",
    "tracker", "win", "winner",
)
SOFT_LIMIT = 2
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def parts(url: str | None) -> tuple[str, str]:
    """Host, A-Z in lower case, and path; both empty without a scheme."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def rule_index(rules) -> dict[str, list[tuple[str, str, str]]]:
    """By host: path, action and the rule itself."""
    index: dict[str, list[tuple[str, str, str]]] = {}
    for action, rule in rules:
        host, slash, path = rule.partition("/")
        index.setdefault(host, []).append((slash + path, action, rule))
    return index


def fitting_rule(index, host: str, path: str) -> tuple[str, str] | None:
    """Rule and action of the longest rule for the host or a domain above it."""
    found = []
    while host:
        found += [(len(r), r, a) for p, a, r in index.get(host, ()) if path.startswith(p)]
        host = host.partition(".")[2]
    return max(found)[1:] if found else None


def vocabulary(strict, soft) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            automaton.add_word(term, (kind, term))
    automaton.make_automaton()
    return automaton


def hits(automaton, address: str) -> tuple[set[str], set[str]]:
    """Different strict and soft terms that stand between characters other than a-z and 0-9."""
    found = {"strict": set(), "soft": set()}
    inner = "abcdefghijklmnopqrstuvwxyz0123456789"
    for last, (kind, term) in automaton.iter(address):
        before, after = last - len(term), last + 1
        if (before < 0 or address[before] not in inner) and (
            after >= len(address) or address[after] not in inner
        ):
            found[kind].add(term)
    return found["strict"], found["soft"]


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT,
    soft=SOFT, soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Per row: id, host, path, rule, n_strict, n_soft, verdict ("allow" or "block").

    A rule decides if one fits: host equal or a subdomain, path beginning with the rule's, the
    longest rule first. Else the url blocks with one strict or ``soft_limit`` different soft terms
    in host and path. A null or empty url, or one without "://", has empty host and path, no rule
    and is allowed. Rows are independent: repeated rows and null ids get their own result, other
    columns are not read.
    """
    schema = pages.select(id_col).schema
    fields = ", ".join(f"{c} string" for c in ("host", "path", "rule", "verdict"))
    kinds = f"`{id_col}` {schema[0].dataType.simpleString()}, {fields}, n_strict int, n_soft int"

    def judged(batches):
        index, automaton = rule_index(rules), vocabulary(strict, soft)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = parts(url)
                rule = fitting_rule(index, host, path)
                hard, mild = hits(automaton, host + path.translate(_LOWER))
                block = bool(hard) or len(mild) >= soft_limit
                out.append((
                    host, path, rule and rule[0], rule[1] if rule else "block" if block else "allow",
                    len(hard), len(mild),
                ))
            columns = list(zip(*out)) if out else [()] * 6
            types = [pa.string()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, types)],
                [id_col, "host", "path", "rule", "verdict", "n_strict", "n_soft"],
            )

    return pages.select(id_col, url_col).mapInArrow(judged, kinds)
