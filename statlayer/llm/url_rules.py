"""URL filter: rules indexed by their rarest literal token; only fetched candidates run their regex.

Two kinds of rule share the index. *Site rules* (``allow org/``, ``block example.org/en/1``) name a host
with a path prefix; they fit the host and every subdomain, and the longest fitting one decides.
*Pattern rules* are regular expressions over the lower-cased address; any hit blocks an address that no
site rule decides. Everything is DataFrame expressions: no Python runs on the executors.

Defined results: null url or one without ``://`` -> empty host and path and no site rule; pattern rules
still see such an address, null counts as empty (``allow``); repeated rows are judged each for itself; an empty table gives an empty result. Very
long addresses are judged whole. Of site rules of one length that fit, the greatest by text decides, of pattern rules that
hit the least is named. Only the id and url columns are read, so further columns cannot clash.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower

RULES_AT_ONCE = 20_000     # an index is a literal of the plan; a longer list of rules makes several


@dataclass(frozen=True)
class Rule:
    """``text``: how the rule is written; ``regex`` runs over host + path (site) or the whole address."""
    text: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    site: bool


def site_rule(action: str, text: str) -> Rule:
    """``host/path-prefix``: the host with all subdomains, addresses whose path starts with the prefix."""
    host, slash, path = text.partition("/")
    prefix = slash + path
    whole = re.findall(r"[a-z0-9]+", host)
    # a path token is whole only if the prefix goes on after it; the last one may be cut short
    whole += re.findall(r"[a-z0-9]+(?=[^a-z0-9])", prefix.lower())
    return Rule(text, action, rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(prefix)}", tuple(dict.fromkeys(whole)), True)


def pattern_rule(regex: str, *tokens: str) -> Rule:
    """A blocking regular expression over the lower-cased address; ``tokens`` are literals every hit holds whole."""
    return Rule(regex, "block", regex, tokens, False)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_])", r"\\\1", text)


# Rules of the contract, longest fitting wins: fixed values.
SITE_RULES = (
    site_rule("allow", "org/"),
    site_rule("block", "example.org/es/"),
    site_rule("block", "example.org/en/1"),
    site_rule("allow", "com/fr/"),
    site_rule("block", "com/de/"),
)
# What decides where no site rule fits: link farms, pill shops, gambling, tracking and login pages.
PATTERN_RULES = (
    pattern_rule(r"(^|[^a-z0-9])spam-farm[^a-z0-9]", "spam", "farm"),
    pattern_rule(r"(^|[^a-z0-9])link-farm[^a-z0-9]", "link", "farm"),
    pattern_rule(r"(^|[^a-z0-9])cheap-pills[^a-z0-9]", "cheap", "pills"),
    pattern_rule(r"(^|[^a-z0-9])(casino|poker)-(bonus|online)[^a-z0-9]"),
    pattern_rule(r"(^|[^a-z0-9])online-casino[^a-z0-9]", "online", "casino"),
    pattern_rule(r"://[^/?#]*[^a-z0-9]adult[^a-z0-9]", "adult"),
    pattern_rule(r"/wp-login\.php([?#]|$)", "wp", "login", "php"),
    pattern_rule(r"[?&]sessionid=", "sessionid"),
)


def tokens_of(address: Column) -> Column:
    """Distinct lower-case alphanumeric tokens of an address."""
    return F.array_distinct(F.filter(F.split(ascii_lower(address), "[^a-z0-9]+"), lambda t: t != ""))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for text without ``://``."""
    text = F.coalesce(url, F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(text, shape, 1)), F.regexp_extract(text, shape, 2)


def token_frequencies(pages: DataFrame, url_col: str, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many addresses hold each token that some rule could be indexed by (one row a token at most)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    held = F.array_intersect(tokens_of(F.coalesce(F.col(url_col), F.lit(""))), F.array(*map(F.lit, wanted)))
    rows = pages.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in rows}


def rule_index(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rarest token -> numbers of the rules under it; rules without a literal stand under ''."""
    index: dict[str, list[int]] = {}
    for n, rule in enumerate(rules):
        key = min(rule.tokens, key=lambda t: (counts.get(t, 0), t)) if rule.tokens else ""
        index.setdefault(key, []).append(n)
    return index


def with_hits(base: DataFrame, rules: tuple[Rule, ...], index: dict[str, list[int]], name: str) -> DataFrame:
    """The frame with best<name> (size, rule and verdict of the deciding site rule) and pattern<name>, by some rules."""
    always = index.pop("", [])
    fetch = F.create_map(*[x for k, v in sorted(index.items()) for x in (F.lit(k), F.array(*map(F.lit, v)))]) \
        if index else F.expr("map('', array(0))")
    col = {k: F.array(*[F.lit(getattr(r, k)) for r in rules]) if rules else F.array(F.lit(kind)) for k, kind in
           (("text", ""), ("action", ""), ("regex", ""), ("site", True))}
    none = F.expr("cast(array() as array<int>)")
    fetched = F.flatten(F.transform(tokens_of(F.col("address")),
                                    lambda t: F.coalesce(F.try_element_at(fetch, t), none)))
    candidates = F.concat(fetched, F.array(*map(F.lit, always)) if always else none)

    def runs(n: Column) -> Column:
        subject = F.when(F.get(col["site"], n), F.concat("host", "path")).otherwise(F.col("address"))
        return F.rlike(subject, F.get(col["regex"], n))

    hits = base.withColumn("hits", F.filter(candidates, runs))
    return hits.select(
        *base.columns,
        F.array_max(F.transform(F.filter("hits", lambda n: F.get(col["site"], n)),
                                lambda n: F.struct(F.length(F.get(col["text"], n)).alias("size"),
                                                   F.get(col["text"], n).alias("rule"),
                                                   F.get(col["action"], n).alias("verdict")))).alias(f"best{name}"),
        F.array_min(F.transform(F.filter("hits", lambda n: ~F.get(col["site"], n)),
                                lambda n: F.get(col["text"], n))).alias(f"pattern{name}"))


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 rules: tuple[Rule, ...] = SITE_RULES + PATTERN_RULES) -> DataFrame:
    """id, host, path, rule (the deciding site rule or null), verdict, pattern (the pattern rule that hit)."""
    counts = token_frequencies(pages, url_col, rules)
    host, path = split_url(F.col(url_col))
    weighed = pages.select(F.col(id_col).alias("id_"), host.alias("host"), path.alias("path"),
                           ascii_lower(F.coalesce(F.col(url_col), F.lit(""))).alias("address"))
    sets = [rules[i:i + RULES_AT_ONCE] for i in range(0, len(rules), RULES_AT_ONCE)] or [()]
    for k, part in enumerate(sets):
        weighed = with_hits(weighed, part, rule_index(part, counts), str(k))
    best, pattern = ([F.col(f"{n}{k}") for k in range(len(sets))] for n in ("best", "pattern"))
    weighed = weighed.withColumns({"best": F.greatest(*best) if len(sets) > 1 else best[0], "pattern": F.least(*pattern) if len(sets) > 1 else pattern[0]})
    return weighed.select(
        F.col("id_").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "pattern")
