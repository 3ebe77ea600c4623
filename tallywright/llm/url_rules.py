"""URL rules found by their rarest literal token.

Each rule is a regular expression with the tokens any matching URL must contain. Spark counts how many URLs have
each of these tokens, and a rule is indexed under its rarest one. A URL looks up its own tokens and runs only
the expressions found there, so most URLs run none. Rules come as a table, written by hand (``rule_table``) or read from
lines in filter-list form (``filter_rules``). An index of at most ``INDEX_BYTES`` goes to every task; a larger one is
joined with the URLs' tokens, in lists of at most about ``TOGETHER`` rules, where tokens that many URLs have are split off.

Host rules come first: of those that fit, the longest decides, a block before an allow of the same length.
Without one, an exception that matches allows, else a pattern rule that matches blocks, else the URL is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no host rule, and is blocked
only by a pattern that an empty address matches. A rule that is listed twice counts once. A null or empty line, a comment (``!``) and a
section title (``[``) are no rules. Other columns pass through; one of the same name as a result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm.common import by_weight, free, stored

_TOKEN = "[a-z0-9]+"
#: size of an index that is sent to every task, rules of one list beyond it, and expressions that a task keeps
INDEX_BYTES, TOGETHER, KEPT_PATTERNS = 32 << 20, 64, 50_000
_CASES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LOWER = str.maketrans(*_CASES)
_COLUMNS = ["name", "action", "pattern", "tokens", "exact"]
_RULE = "name string, action string, pattern string, tokens array<string>, exact boolean"


@dataclass(frozen=True)
class Rule:
    """``name`` is shown; ``pattern`` is searched in host and path; ``tokens`` occur in whatever it matches."""

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    exact: bool


def host_rule(action: str, host: str, path: str = "/") -> Rule:
    """Fits the host and its subdomains, below a path."""
    whole = re.findall(_TOKEN, host.lower()) + re.findall(_TOKEN + "(?=[^a-z0-9])", path.lower())
    return Rule(host + path, action, rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(whole), True)


def word_rule(word: str) -> Rule:
    """Blocks a word that stands alone in host or path, in any case."""
    return Rule(word, "block", rf"(?i)(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])", (word,), False)


#: the host rules of the query
HOST_RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)
#: words of addresses that hold no prose
WORD_RULES = tuple(map(word_rule, ("casino", "poker", "porn", "xxx", "viagra", "warez", "torrent", "escort")))


def _parts(url):
    """Host in lower case and path of a URL."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(after, r"\A[^/?#]*", 0), *_CASES)
    return F.struct(host.alias("host"), F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1).alias("path"))


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as a table."""
    return spark.createDataFrame([astuple(r) for r in rules], _RULE)


def filter_rule(line: str | None) -> Rule | None:
    """A rule in filter-list form, without options; none for a comment.

    ``||`` before a host stands for it and its subdomains, ``|`` for the start or end of host and path, ``*`` for
    anything, ``^`` for a separator or the end, ``@@`` in front makes an exception. A-Z match in any case.
    """
    name = (line or "").strip()
    if not name or name[0] in "![":
        return None
    action, body = ("allow", name[2:]) if name.startswith("@@") else ("block", name)
    host, start, end = body.startswith("||"), body.startswith("|"), body.endswith("|")
    body = body[2 if host else start :].removesuffix("|")
    parts = {"*": r"[\s\S]*", "^": r"(?:[^A-Za-z0-9_.%-]|\Z)"}
    pattern = "".join(parts.get(c) or re.escape(c) for c in body)
    front = r"\A(?:[^/]*\.)?" if host else r"\A" if start else ""
    # a token is whole where something other than a letter, a digit or a wildcard stands on either side
    edged = ("/" if start else "*") + body.translate(_LOWER) + ("/" if end else "*")
    tokens = re.findall("(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", edged)
    return Rule(name, action, f"(?ia){front}{pattern}" + r"\Z" * end, tuple(dict.fromkeys(tokens)), False)


def filter_rules(lines: DataFrame, line: str = "value") -> DataFrame:
    """The rules in a table of lines in filter-list form, as ``spark.read.text`` gives them."""

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rules = filter(None, map(filter_rule, batch["line"]))
            yield pd.DataFrame([(*astuple(r)[:3], list(r.tokens), r.exact) for r in rules], columns=_COLUMNS)

    return lines.select(F.col(line).cast("string").alias("line")).mapInPandas(parsed, _RULE)


def _tokens(address: str) -> set[str]:
    """Tokens of an address, by A-Z alone and by all letters that have a lower case; the empty one stands for rules without."""
    found = {"", *re.findall(_TOKEN, address.translate(_LOWER))}
    return found if address.isascii() else found.union(re.findall(_TOKEN, address.lower()))


def _bytes(rules: DataFrame) -> int:
    size = F.length("name") + F.length("pattern") + F.length(F.array_join("tokens", " ")) + 100
    return rules.agg(F.sum(size)).first()[0] or 0


def _placed(urls: DataFrame, rules: DataFrame, few: bool) -> DataFrame:
    """The rules with their rarest token (empty without one), and the number of URLs that have it. ``few`` rules are broadcast."""
    address = F.lower(F.concat("host", "path"))
    tokens = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(address, F.lit(_TOKEN), F.lit(0)))).alias("token"))
    needed = rules.select(F.explode("tokens").alias("token")).distinct()
    if few:
        counts = tokens.join(F.broadcast(needed), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    else:  # counted before the shuffle, so that a token of most URLs is a few rows
        counts = tokens.groupBy("token").agg(F.count("*").alias("urls")).join(needed, "token", "left_semi")
    each = rules.withColumn("token", F.explode_outer("tokens")).join(counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), F.coalesce("token", F.lit("")).alias("token")))
    placed = each.groupBy("name", "action", "pattern", "exact").agg(rarest.alias("rarest"), F.first("tokens").alias("tokens"))
    return placed.select(*_COLUMNS, "rarest.token", "rarest.urls")


def _by_token(placed: DataFrame) -> dict[str, list[Rule]]:
    index: dict[str, list[Rule]] = {}
    for row in placed.collect():
        index.setdefault(row["token"], []).append(Rule(*(row[c] for c in _COLUMNS)))
    return index


def _index(urls: DataFrame, rules: Iterable[Rule]) -> dict[str, list[Rule]]:
    """Rules under their rarest token; those without one under the empty token."""
    return _by_token(_placed(urls, rule_table(urls.sparkSession, rules), True))


@lru_cache(KEPT_PATTERNS)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def _deciding(rules: Iterable[Rule], address: str) -> tuple[Rule | None, Rule | None]:
    """Of the rules that fit an address: the host rule and the pattern rule that come first."""
    fits = [r for r in rules if _compiled(r.pattern).search(address)]
    host = min((r for r in fits if r.exact), key=lambda r: (-len(r.name), r.action != "block", r.name), default=None)
    return host, min((r for r in fits if not r.exact), key=lambda r: (r.action != "allow", r.name), default=None)


def _sent(parted: DataFrame, at: str, says: str, placed: DataFrame) -> DataFrame:
    """Rule, pattern and verdict from an index that every task has."""
    shared = parted.sparkSession.sparkContext.broadcast(_by_token(placed))

    @F.pandas_udf("rule string, pattern string, verdict string")
    def decide(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        index, found = shared.value, []
        for address in hosts + paths:
            host, other = _deciding((r for t in _tokens(address) & index.keys() for r in index[t]), address)
            other = None if host else other
            decides = host or other
            found.append((host and host.name, other and other.name, decides.action if decides else "allow"))
        return pd.DataFrame(found, columns=["rule", "pattern", "verdict"])

    return parted.withColumn(says, decide(f"{at}.host", f"{at}.path"))


def _joined(parted: DataFrame, at: str, says: str, placed: DataFrame) -> DataFrame:
    """Rule, pattern and verdict from an index of any size, by joins on the tokens."""
    (row,) = free(parted, "row")
    rows = stored(parted.withColumn(row, F.monotonically_increasing_id()), "urls")
    each_token = F.pandas_udf(lambda hosts, paths: (hosts + paths).map(lambda a: sorted(_tokens(a))), "array<string>")
    # the tokens that rules stand under, and in how many lists: long ones are dealt out by a hash of the rule
    placed = stored(placed, "placed-rules")
    sizes = stored(placed.groupBy("token").agg(F.max("urls").alias("urls"), F.ceil(F.count("*") / TOGETHER).alias("lists")), "rule-tokens")
    dealt = placed.drop("urls").join(sizes, "token").withColumn("list", F.pmod(F.xxhash64("name", "pattern"), F.col("lists")))
    rule = F.struct("name", "action", "pattern", "exact")
    key = F.concat_ws(" ", "token", "list").alias("key")
    lists = stored(dealt.groupBy(key).agg(F.collect_list(rule).alias("rules")), "rule-lists")
    asked = rows.select(F.col(row).alias("row"), f"{at}.host", f"{at}.path")
    asked = asked.withColumn("token", F.explode(each_token("host", "path")))
    # the empty token is one of every URL
    n = rows.count()
    weights = stored(sizes.withColumn("urls", F.when(F.col("token") == "", n).otherwise(F.col("urls"))), "rule-token-weights")
    asked = stored(asked, "url-tokens")
    asked = by_weight(asked, weights, "token", "urls", asked.count())
    asked = stored(asked.withColumn("list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lists") - 1))).select("row", "host", "path", key), "asked")
    weighed = stored(lists.join(asked.groupBy("key").agg(F.count("*").alias("n")), "key"), "asked-lists")
    met = by_weight(asked, weighed, "key", "n", asked.count())

    @F.pandas_udf("host_rule string, host_action string, other string, other_action string")
    def decide(hosts: pd.Series, paths: pd.Series, rules: pd.Series) -> pd.DataFrame:
        found = []
        for address, listed in zip(hosts + paths, rules):
            host, other = _deciding((Rule(r["name"], r["action"], r["pattern"], (), r["exact"]) for r in listed), address)
            found.append((host and host.name, host and host.action, other and other.name, other and other.action))
        return pd.DataFrame(found, columns=["host_rule", "host_action", "other", "other_action"])

    fits = met.select("row", decide("host", "path", "rules").alias("d")).select("row", "d.*")
    by_host = F.struct(
        (-F.length("host_rule")).alias("longest"), (F.col("host_action") != "block").alias("late"),
        F.col("host_rule").alias("rule"), F.col("host_action").alias("verdict"),
    )
    by_other = F.struct((F.col("other_action") != "allow").alias("late"), F.col("other").alias("rule"), F.col("other_action").alias("verdict"))
    first = fits.groupBy("row").agg(
        F.min(F.when(F.col("host_rule").isNotNull(), by_host)).alias("h"), F.min(F.when(F.col("other").isNotNull(), by_other)).alias("o")
    )
    decided = first.select(F.col("row").alias(row), F.struct(
        F.col("h.rule").alias("rule"), F.when(F.col("h").isNull(), F.col("o.rule")).alias("pattern"),
        F.coalesce("h.verdict", "o.verdict", F.lit("allow")).alias("verdict"),
    ).alias(says))
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("pattern"), F.lit("allow").alias("verdict"))
    return rows.join(decided, row, "left").withColumn(says, F.coalesce(F.col(says), none)).drop(row)


def judge(pages: DataFrame, rules: DataFrame | None = None, url: str = "url", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Adds host, path, rule (null if no host rule fits), pattern (null if no pattern rule was needed), verdict.

    ``rules`` is a table as ``rule_table`` and ``filter_rules`` give it; by default the rules of this module.
    """
    rules = rule_table(pages.sparkSession, (*HOST_RULES, *WORD_RULES)) if rules is None else stored(rules, "rules")
    at, says = free(pages, "at", "says")
    parted = pages.withColumn(at, _parts(F.coalesce(F.col(url), F.lit(""))))
    few = _bytes(rules) <= index_bytes
    placed = _placed(parted.select(f"{at}.host", f"{at}.path"), rules, few)
    judged = (_sent if few else _joined)(parted, at, says, placed)
    return judged.withColumns({
        **{k: F.col(f"{at}.{k}") for k in ("host", "path")},
        **{k: F.col(f"{says}.{k}") for k in ("rule", "pattern", "verdict")},
    }).drop(at, says)
