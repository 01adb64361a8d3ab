"""URL filtering by rules that are found through their rarest literal token.

A rule is a regular expression, a verdict and the literal tokens that every URL it fits must hold.
Token counts over all URLs tell which of them is rarest; the rule is filed under that token. A URL's
tokens fetch its candidate rules and only those expressions run.

Tokens are runs of a-z and 0-9 in the lower-cased URL. A rule's token has a certain border on either side in whatever the
rule fits, so it is a token of the URL too: the index misses no rule. Rules come from hosts and paths, from words, from
expressions, or from lines of a filter list (``parse_rules``); exceptions of a list win over its blocks.

Few rules become a constant look-up inside one map over the URLs, with no shuffle; a list
longer than ``MAX_INLINE`` is joined on the token instead. Both give the same rows.

Defined cases: a null URL, or one without ``://``, has empty host and path and fits no host rule; a
URL that is repeated is judged alike each time; a rule without tokens is tried on every URL. URLs may be of any length.
Columns of the input named host, path, rule or verdict are replaced, all others kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"[a-z0-9]+"
MADE = ["host", "path", "rule", "verdict"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_INLINE = 500
ANY = ""


@dataclass(frozen=True)
class Rule:
    """``place`` rules fit host + path and are ranked by length; others fit the whole URL."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    place: bool = False


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/])", r"\\\1", text)


def _whole_tokens(text: str, border_before: bool, border_after: bool) -> list[str]:
    """Tokens of a literal text that no neighbour can make longer."""
    found = list(re.finditer(TOKEN, text))
    return [
        m[0] for m in found
        if (m.start() > 0 or border_before) and (m.end() < len(text) or border_after)
    ]


def place_rule(verdict: str, place: str) -> Rule:
    """``host/path``: the host with all subdomains, and paths that start with the given one."""
    host = place.partition("/")[0].lower()
    pattern = r"^(?:[^/]*\.)?" + _quoted(host) + _quoted(place[len(host):])
    whole = _whole_tokens(place.lower(), True, False)
    return Rule(place, verdict, pattern, tuple(whole), True)


def word_rule(verdict: str, word: str) -> Rule:
    """A word that stands alone in the host."""
    pattern = r"^[^:/?#]*://(?:[^/?#]*[^a-z0-9/?#])?" + _quoted(word) + r"(?:$|[^a-z0-9])"
    return Rule(f"word:{word}", verdict, pattern, (word,))


def pattern_rule(verdict: str, pattern: str) -> Rule:
    """An expression over the lower-cased URL; its tokens are those of texts that every match holds."""
    tokens: list[str] = []
    try:
        parts = list(_parser.parse(pattern))
    except re.error:
        parts = []
    run, before = "", False
    for kind, value in [*parts, (None, None)]:
        if kind is _parser.LITERAL:
            run += chr(value)
            continue
        at_end = kind is _parser.AT and value is _parser.AT_END_STRING
        tokens += _whole_tokens(run, before, at_end)
        run, before = "", kind is _parser.AT and value in (_parser.AT_BEGINNING, _parser.AT_BEGINNING_STRING)
    return Rule(f"/{pattern}/", verdict, pattern, tuple(dict.fromkeys(tokens)))


#: How marks of a filter list read as expressions over the lower-cased URL.
SEPARATOR = r"(?:[^a-z0-9_.%\-]|$)"
ANY_HOST = r"^[^:/?#]*:/*(?:[^/?#]*\.)?"


def list_rule(line: str) -> Rule | None:
    """A line of a filter list: ``||host^``, ``|begin``, ``end|``, ``*``, ``/expression/``, ``@@`` for exceptions.

    None for comments, rules about elements of a page, rules with options, which ask for more than a URL, and
    expressions that are none.
    """
    text = line.strip()
    if not text or text[0] in "![" or "##" in text or "#@#" in text or "#?#" in text:
        return None
    verdict, body = ("allow", text[2:]) if text.startswith("@@") else ("block", text)
    if len(body) > 2 and body[0] == body[-1] == "/":
        try:
            re.compile(body[1:-1])
        except re.error:
            return None
        rule = pattern_rule(verdict, body[1:-1])
        return Rule(text, verdict, rule.pattern, rule.tokens)
    if "$" in body or not body.strip("|*^"):
        return None
    body = body.lower()
    begin = "||" if body.startswith("||") else "|" if body.startswith("|") else ""
    body = body[len(begin) :]
    end = body.endswith("|")
    body = body.removesuffix("|")
    pattern = {"||": ANY_HOST, "|": "^", "": ""}[begin]
    tokens: list[str] = []
    parts = re.split(r"([*^])", body)
    for i, part in enumerate(parts):
        if part in ("*", "^"):
            pattern += {"*": ".*", "^": SEPARATOR}[part]
            continue
        pattern += _quoted(part)
        before = parts[i - 1] == "^" if i else bool(begin)
        after = parts[i + 1] == "^" if i + 1 < len(parts) else end
        tokens += _whole_tokens(part, before, after)
    return Rule(text, verdict, pattern + ("$" if end else ""), tuple(dict.fromkeys(tokens)))


def parse_rules(lines: Iterable[str]) -> list[Rule]:
    """The rules of a filter list that can be decided by a URL alone."""
    return [rule for rule in map(list_rule, lines) if rule]


#: Words in host names that mark spam; URLs that no rule fits are allowed.
SPAM_WORDS = ("spam", "casino", "porn", "xxx", "viagra", "warez", "phishing", "malware")
DEFAULT_RULES = [word_rule("block", w) for w in SPAM_WORDS]


def host_of(url: Column) -> Column:
    after = F.length(F.substring_index(url, "://", 1)) + 4
    found = F.regexp_extract(F.substr(url, after), r"^[^/?#]*", 0)
    return F.when(F.contains(url, F.lit("://")), F.translate(found, UPPER, LOWER)).otherwise(
        F.lit("")
    )


def path_of(url: Column) -> Column:
    start = F.length(F.substring_index(url, "://", 1)) + 4 + F.length(host_of(url))
    found = F.regexp_extract(F.substr(url, start), r"^[^?#]*", 0)
    return F.when(F.contains(url, F.lit("://")), found).otherwise(F.lit(""))


def _tokens(url: Column) -> Column:
    found = F.regexp_extract_all(F.lower(url), F.lit(TOKEN), F.lit(0))
    return F.array_append(F.array_distinct(F.coalesce(found, F.array().cast("array<string>"))), ANY)


def rarest_tokens(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> dict[str, list[Rule]]:
    """Rules by the token they are filed under: the one that fewest URLs of the table hold."""
    wanted = sorted({t for r in rules for t in r.tokens})
    counts = {}
    if wanted:
        held = urls.select(F.explode(F.array_intersect(
            _tokens(F.col(url)), F.array(*[F.lit(t) for t in wanted]))).alias("token"))
        rows = held.groupBy("token").agg(F.count("*").alias("n")).collect()  # a row per rule token
        counts = {r["token"]: r["n"] for r in rows}
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=ANY)
        index.setdefault(key, []).append(rule)
    return index


def _judged(fitting: Column) -> tuple[Column, Column]:
    """The place rule that wins, and the verdict, from the rules that fit."""
    best = F.array_max(F.filter(fitting, lambda r: r["place"]))
    other = lambda verdict: F.exists(fitting, lambda r: ~r["place"] & (r["verdict"] == verdict))
    method = F.when(other("block") & ~other("allow"), F.lit("block")).otherwise(F.lit("allow"))
    return best["name"], F.coalesce(best["verdict"], method)


def _rule_column(rule: Rule) -> Column:
    return F.struct(
        F.lit(len(rule.name)).alias("size"), F.lit(rule.name).alias("name"),
        F.lit(rule.verdict).alias("verdict"), F.lit(rule.pattern).alias("pattern"),
        F.lit(rule.place).alias("place"),
    )


RULE = "struct<size: int, name: string, verdict: string, pattern: string, place: boolean>"


def judge(
    urls: DataFrame, rules: Sequence[Rule], url: str = "url", max_inline: int = MAX_INLINE
) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict``."""
    index = rarest_tokens(urls, rules, url)
    kept = [c for c in urls.columns if c not in MADE]
    at = F.col(url)
    host, path = host_of(at), path_of(at)
    fits = lambda r: F.rlike(
        F.when(r["place"], F.concat(host, path)).otherwise(F.lower(at)), r["pattern"]
    )
    none = F.array().cast(f"array<{RULE}>")
    if len(rules) <= max_inline:
        filed = F.create_map(*[
            x for t, found in index.items()
            for x in (F.lit(t), F.array(*[_rule_column(r) for r in found]))
        ]) if index else F.create_map().cast(f"map<string, array<{RULE}>>")
        held = F.array_intersect(_tokens(at), F.map_keys(filed))
        candidates = F.flatten(F.transform(held, lambda t: filed[t]))
        fitting = F.coalesce(F.filter(candidates, fits), none)
        rule, verdict = _judged(fitting)
        return urls.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"),
                           rule.alias("rule"), verdict.alias("verdict"))
    spark = urls.sparkSession
    table = spark.createDataFrame(
        [(t, (len(r.name), r.name, r.verdict, r.pattern, r.place))
         for t, found in index.items() for r in found],
        f"_acct_token string, _acct_rule {RULE}",
    )
    distinct = urls.select(url).where(at.isNotNull()).distinct()
    fitting = (
        distinct.select(url, F.explode(_tokens(at)).alias("_acct_token"))
        .join(table, "_acct_token")
        .where(fits(F.col("_acct_rule")))
        .groupBy(url)
        .agg(F.collect_set("_acct_rule").alias("_acct_fit"))  # rules that fit one URL
        .withColumnRenamed(url, "_acct_url")
    )
    joined = urls.select(*[F.col(f"`{c}`") for c in kept]).join(fitting, at == F.col("_acct_url"), "left")
    rule, verdict = _judged(F.coalesce("_acct_fit", none))
    return joined.select(
        *[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"),
        rule.alias("rule"), verdict.alias("verdict"),
    )
