"""URL filter: host and path rules first, then association rules mined by FP-growth.

The urls that a rule decides are the labelled ones.  Their tokens and the verdict are transactions; FP-growth finds the token
combinations that go with a verdict, pruned by support and confidence.  A mined rule is filed under its rarest token;
a url meets the rules of its tokens and keeps those whose tokens it has all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import text_or_empty
from netorigin.operators.lineage import cut

SUPPORT, CONFIDENCE = 0.01, 0.8
BROADCAST_RULES = 20_000  # mined rules are broadcast up to this count, and joined by shuffle above it
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    site: str  # host, slash, path prefix

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.site.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


#: Fixed values.
RULES = [Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = text_or_empty(url)
    return (F.translate(F.regexp_extract(u, shape, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(u, shape, 2))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(site, verdict) of the longest rule that fits, else null."""
    site = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.site)):
        site, verdict = F.when(r.fits(host, path), F.lit(r.site)).otherwise(site), F.when(r.fits(host, path), F.lit(r.verdict)).otherwise(verdict)
    return site, verdict


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host labels and their parts, path parts without digits-only ones."""
    h = F.transform(F.split(host, r"[.-]+"), lambda x: F.concat(F.lit("h:"), x))
    p = F.transform(F.filter(F.split(path, r"[/._-]+"), lambda x: ~x.rlike("^[0-9]*$")), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(h, p))


def token_counts(labelled: DataFrame) -> DataFrame:
    """(token, n, most, together): urls with the token, those of its commonest verdict, and a key that is equal for tokens that always occur together."""
    row = F.xxhash64(F.array_sort("tokens"), "verdict")
    seen = labelled.select(F.explode("tokens").alias("token"), "verdict", row.alias("a"), F.xxhash64(F.lit(7), row).alias("b"))
    wide = "decimal(38,0)"
    per = seen.groupBy("token", "verdict").agg(F.count("*").alias("k"), F.sum(F.col("a").cast(wide)).alias("a"), F.sum(F.col("b").cast(wide)).alias("b"))
    return per.groupBy("token").agg(F.sum("k").alias("n"), F.max("k").alias("most"), F.sum("a").alias("a"), F.sum("b").alias("b")).select(
        "token", "n", "most", F.struct("n", "a", "b").alias("together"))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Rules (tokens, verdict, confidence, support, rare) from (tokens, verdict) rows, and (token, rep): the token that stands for those that always occur with it.

    A rule of several tokens is pruned when a rule with one of them has the same verdict and no less confidence.  So a token that goes with one verdict only is in no
    such rule, and of tokens that always occur together one is enough: only the representatives of tokens with both verdicts go to FP-growth.  A long path
    that many urls share is thus one item or none.  Rules of one token are counted for every token.
    """
    total = labelled.count()
    least = max(1, math.ceil(support * total))
    counts = cut(token_counts(labelled).filter(F.col("n") >= least))
    reps = counts.filter("most < n").groupBy("together").agg(F.min("token").alias("rep"), F.collect_list("token").alias("ts")).select(F.explode("ts").alias("token"), "rep")
    reps = cut(reps)
    per = (labelled.select(F.explode("tokens").alias("token"), "verdict").groupBy("token", "verdict").agg(F.count("*").alias("k")).join(counts.select("token", "n"), "token")
           .filter((F.col("k") >= least) & (F.col("k") / F.col("n") >= confidence)))
    one = cut(per.select(F.array("token").alias("tokens"), "verdict", (F.col("k") / F.col("n")).alias("confidence"), (F.col("k") / total).alias("support"), F.col("token").alias("rare")))
    if reps.isEmpty():
        return one, reps
    items = (labelled.withColumn("_r", F.monotonically_increasing_id()).select("_r", "verdict", F.explode("tokens").alias("token")).join(reps, "token")
             .groupBy("_r", "verdict").agg(F.collect_set("rep").alias("reps")).select(F.concat("reps", F.array(F.concat(F.lit("="), "verdict"))).alias("items")))
    # supports are shares of all labelled urls; those without such a token hold no itemset
    items = cut(items)
    kept = items.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / kept), minConfidence=confidence).fit(items)
    rules = (model.associationRules.filter((F.size("antecedent") > 1) & F.col("consequent")[0].startswith("="))
             .select(F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], 2, 1_000).alias("verdict"), "confidence", (F.col("support") * kept / total).alias("support")))
    by_one = one.select(F.col("rare").alias("t"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    longer = rules.withColumn("token", F.explode("tokens"))
    several = (longer.join(by_one, (longer.token == by_one.t) & (longer.verdict == by_one.v) & (by_one.c >= longer.confidence), "left")
               .join(counts.select("token", "n"), "token").groupBy("tokens", "verdict", "confidence", "support")
               .agg(F.count("t").alias("covered"), F.min_by("token", F.struct("n", "token")).alias("rare")))
    return one.unionByName(several.filter("covered = 0").drop("covered")), reps


def judge(pages: DataFrame, page: str = "page_id", url: str = "url", rules: list[Rule] = RULES,
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule for every row.

    A null url, or one without `://`, has empty host and path.  Urls that neither a rule nor a mined rule decides are
    allowed, as are all of them when no url is labelled.  Of several mined rules the most confident decides, then the
    better supported, the longer, the first by text.  A token stands for all that always occur with it where the rules fit.
    """
    host, path = host_and_path(F.col("url"))
    d = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url")).withColumns({"host": host, "path": path})
    site, verdict = rule_of(F.col("host"), F.col("path"), rules)
    d = d.withColumns({"rule": site, "ruled": verdict, "tokens": tokens(F.col("host"), F.col("path"))})
    labelled = d.filter("ruled is not null").select("tokens", F.col("ruled").alias("verdict"))
    out = ["page_id", "host", "path", "rule"]
    if labelled.isEmpty():
        return d.select(*out, F.coalesce("ruled", F.lit(DEFAULT)).alias("verdict"), F.lit(None).cast("string").alias("mined_rule"))
    mined, reps = mine(labelled, support, confidence)
    mined = cut(mined)
    if mined.count() <= BROADCAST_RULES:
        mined = F.broadcast(mined)
    asked = d.filter("ruled is null").select("host", "path", "tokens").distinct()  # each distinct url once
    stand = (asked.select("host", "path", F.explode("tokens").alias("token")).join(reps, "token").groupBy("host", "path").agg(F.collect_set("rep").alias("reps")))
    asked = asked.join(stand, ["host", "path"], "left").select("host", "path", F.array_distinct(F.concat("tokens", F.coalesce("reps", F.array().cast("array<string>")))).alias("tokens"))
    best = (asked.withColumn("token", F.explode("tokens"))
            .join(mined.withColumnsRenamed({"tokens": "want", "verdict": "says", "rare": "token"}), "token")
            .filter(F.size(F.array_except("want", "tokens")) == 0).groupBy("host", "path")
            .agg(F.min_by(F.struct("says", "want"), F.struct(-F.col("confidence"), -F.col("support"), -F.size("want"), F.col("want"), F.col("says"))).alias("best")))
    return d.join(best, ["host", "path"], "left").select(
        *out, F.coalesce("ruled", "best.says", F.lit(DEFAULT)).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.array_join("best.want", " ")).alias("mined_rule"))
