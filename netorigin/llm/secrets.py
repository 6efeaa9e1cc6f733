"""Secret scan through a trigram inverted index.

From each rule's regular expression a Boolean query of trigrams is derived that every match must satisfy.  The postings
(trigram, text key) hold the trigrams that some rule asks for; a rule's clauses are intersected by counting the postings
of a key.  Candidates meet the texts again in one join and the regular expressions settle them, so a wrong candidate does no
harm.  A rule without mandatory trigrams is tried on every text.
"""

from __future__ import annotations

import re._constants as k
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import let, text_or_empty

LITERALS = 16  # more alternatives than this stop being spelled out


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern and, where only long matches count, the least characters of a group."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: From BEGIN through the next END, with no other five hyphens between; without END, the header lines and base64 lines that follow
#: (line ends may be written out as \n, or be spaces where runs are long).  Repeats are possessive: Java then needs no stack for them.
PRIVATE_KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
               r"|(?:[\x20\x09-\x0D]*+(?:Proc-Type|Content-Domain|DEK-Info):[^\n]*+\n)*+"
               r"(?:(?:[\x20\x09-\x0D]|\\[nr])*+[A-Za-z0-9+/]{16,}+=*+"
               r"|\x20*+(?:\r?\n|\\r\\n|\\n)[\x20\t]*+[A-Za-z0-9+/]++=*+(?=[\x20\t]*+(?:\r?\n|\\[nr]|(?![\s\S]))))*+)")

#: The kinds as they are listed; the first three are the base.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("private_key", PRIVATE_KEY),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9a-zA-Z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}"),
]
BASE = ["assign", "access", "hex"]


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Clauses of lower-case trigrams: a match contains all trigrams of one clause at least.  An empty clause always holds."""
    def need(text: str) -> frozenset[str]:
        return frozenset(text[i:i + 3].lower() for i in range(len(text) - 2))

    def both(a, b):
        got = {x | y for x, y in product(a, b)}
        return frozenset(x for x in got if not any(y < x for y in got))

    def seal(texts):  # the literal seen so far must occur
        return frozenset(need(t) for t in texts)

    anything = frozenset([frozenset()])

    def walk(items):
        """(clauses, texts): what must hold besides, and all texts the items can match if those are few, else None."""
        clauses, texts, complete = anything, [""], True
        for op, arg in items:
            own_clauses, own = one(op, arg)
            clauses = both(clauses, own_clauses)
            if own is not None and len(own) * len(texts) <= LITERALS:
                texts = [a + b for a in texts for b in own]
            else:
                clauses, complete = both(clauses, seal(texts)), False
                texts = own if own is not None and len(own) <= LITERALS else [""]
        return (clauses, texts) if complete else (both(clauses, seal(texts)), None)

    def one(op, arg):
        if op is k.LITERAL:
            return anything, [chr(arg)]
        if op is k.IN:
            if all(o is k.LITERAL for o, _ in arg):
                return anything, [chr(c) for _, c in arg]
            return anything, None
        if op is k.SUBPATTERN:
            return walk(arg[3])
        if op is k.BRANCH:
            parts = [walk(x) for x in arg[1]]
            if all(t is not None for _, t in parts) and all(c == anything for c, _ in parts):
                return anything, [t for _, ts in parts for t in ts]
            return frozenset(c for cs, ts in parts for c in both(cs, seal(ts) if ts is not None else anything)), None
        if op in (k.MAX_REPEAT, k.MIN_REPEAT):
            low, high, inner = arg
            clauses, texts = walk(inner)
            if (low, high) == (0, 1) and texts is not None:
                return anything, ["", *texts]
            if low == high and texts is not None and len(texts) == 1:
                return clauses, [texts[0] * low]
            if low and texts is not None:
                return both(clauses, seal(texts)), None
            return (clauses if low else anything), None
        return anything, None

    clauses, texts = walk(list(parser.parse(pattern)))
    return both(clauses, seal(texts)) if texts is not None else clauses


def matches(text: Column, rule: Rule) -> Column:
    """Array of (at, kind, till, order) of the rule's leftmost non-overlapping matches, in code points.

    Cutting the text at the matches gives the lengths between them, so places need no position function.
    """
    order = F.lit(RULES.index(rule) if rule in RULES else len(RULES))
    whole = F.lit(rule.pattern)
    none = F.array().cast("array<struct<at:int,order:int,till:int,kind:string>>")

    def spans(found: Column) -> Column:
        gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g))
        sized = F.transform(found, lambda m: F.length(m))
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))

        def step(g, s):
            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, lambda acc, i: F.struct(
                (acc["at"] + g[i] + s[i]).alias("at"),
                F.when(long_enough(found[i]), F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + g[i]).alias("at"), order.alias("order"), (acc["at"] + g[i] + s[i]).alias("till"),
                    F.lit(rule.kind).alias("kind"))))).otherwise(acc["out"]).alias("out")), lambda acc: acc["out"])

        return let(gaps, lambda g: let(sized, lambda s: step(g, s)))

    def long_enough(m: Column) -> Column:
        return F.length(F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m) >= rule.least

    found = F.regexp_extract_all(text, whole, F.lit(0))
    return let(found, lambda f: F.when(~F.exists(f, long_enough), none).otherwise(spans(f)))


def candidates(docs: DataFrame, key: Column, text: Column, rules: list[Rule] = RULES) -> DataFrame:
    """(key, kinds): per text key the kinds whose trigram query holds; kinds without a query are not listed."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {kind: q for kind, q in queries.items() if frozenset() not in q}
    clauses = [(kind, n, sorted(c)) for kind, q in asked.items() for n, c in enumerate(sorted(map(sorted, q)))]
    wanted = sorted({t for _, _, c in clauses for t in c})
    low = F.lower(text)
    postings = (docs.select(key.alias("key"), F.explode(let(low, lambda x: F.filter(
        F.lit(wanted), lambda t: F.contains(x, t)))).alias("trigram")))
    table = docs.sparkSession.createDataFrame(
        [(t, kind, n, len(c)) for kind, n, c in clauses for t in c], "trigram string, kind string, clause int, size int")
    return (postings.join(F.broadcast(table), "trigram")  # one row per rule trigram: fixed by the rules
            .groupBy("key", "kind", "clause", "size").agg(F.count_distinct("trigram").alias("n"))
            .filter("n = size").groupBy("key").agg(F.collect_set("kind").alias("kinds")))


def scan(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """All columns of `docs` and `spans`: array of (at, order, till, kind) by place, then rule.

    A null text is empty.  Repeated rows keep their number: candidates are keyed by the text, not the id.  A column
    named `spans` gives way.
    """
    t = text_or_empty(F.col("_d." + text))
    key = F.struct(F.xxhash64(t).alias("a"), F.length(t).alias("b"))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "spans"]).alias("_d"))
    found = candidates(rows, key, t, rules)
    always = [r.kind for r in rules if frozenset() in trigram_query(r.pattern)]
    joined = rows.withColumn("key", key).join(found, "key", "left")
    none = F.array().cast("array<struct<at:int,order:int,till:int,kind:string>>")
    per_rule = [matches(t, r) if r.kind in always else F.when(F.array_contains("kinds", r.kind), matches(t, r)).otherwise(none)
                for r in rules]
    return joined.select("_d.*", F.array_sort(F.concat(*per_rule)).alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"], s["till"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every found span replaced by `mark`; overlapping spans become one mark, other texts stay as they are."""
    d = scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text")), "text")
    def add(acc, s):
        last = F.get(acc, F.size(acc) - 1)
        longer = F.struct(last["at"].alias("at"), F.greatest(last["till"], s["till"]).alias("till"))
        return F.when(F.exists(acc, lambda x: x["till"] >= s["at"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(
            F.concat(acc, F.array(F.struct(s["at"].alias("at"), s["till"].alias("till")))))

    merged = F.aggregate("spans", F.array().cast("array<struct<at:int,till:int>>"), add)
    t = F.col("text")
    cut = let(merged, lambda m: F.concat(
        F.array_join(F.transform(m, lambda s, i: F.concat(t.substr(
            F.coalesce(F.get(m, i - 1)["till"], F.lit(0)) + 1, s["at"] - F.coalesce(F.get(m, i - 1)["till"], F.lit(0))), F.lit(mark))), ""),
        t.substr(F.get(m, F.size(m) - 1)["till"] + 1, F.length(t))))
    clean = F.when(F.size("spans") > 0, cut).otherwise(t)
    return d.select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
