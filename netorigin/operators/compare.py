"""Address-weighted comparison of two origin tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.functions.addr import length_bucket
from netorigin.functions.space import V4
from netorigin.operators.backbone import top_per_class
from netorigin.operators.joins import adjacent_in_paths, lpm_distinct
from netorigin.operators.ranges import sweep


def align(a: DataFrame, b: DataFrame, space=V4) -> DataFrame:
    """Elementary segments of two tables(range_start, range_end, asn) with both ASNs
    and the start of the A row they lie in."""
    A = a.select("range_start", "range_end", F.col("asn").alias("a_asn"), F.col("range_start").alias("a_start"))
    B = b.select("range_start", "range_end", F.col("asn").alias("b_asn"))
    return sweep(space, {"a": A, "b": B}, {"a": ["a_asn", "a_start"], "b": ["b_asn"]})


def classify_segments(segments: DataFrame, decisions: DataFrame, candidates: DataFrame, links: DataFrame,
                      space=V4) -> DataFrame:
    """Add `class`: same | only_a | only_b | moas | below_floor | adjacent | unrelated.

    decisions(net, len, reason) holds kept and dropped prefixes of B, candidates
    (net, len, asn) their vote-getters in long form.  A's ASN is looked for among
    the candidates of the most specific kept prefix at the segment, then among
    those of the most specific dropped one: two equi-joins on (prefix, asn), so
    no candidate list is ever gathered.
    """
    seg = segments.withColumn("differ", F.col("in_a") & F.col("in_b") & (F.col("a_asn") != F.col("b_asn")))
    at = seg.filter("differ").select(F.col("range_start").alias("ip")).distinct()
    cand = candidates.select("net", "len", F.col("asn").alias("a_asn"), F.lit(True).alias("voted"))

    def voted(decided: DataFrame, name: str) -> DataFrame:
        pfx = lpm_distinct(at, decided.select("net", "len"), space, [])
        return pfx.select(F.col("ip").alias("range_start"), F.col("net").alias(f"{name}_net"), F.col("len").cast("int").alias(f"{name}_len"))

    kept = voted(decisions.filter("reason is null"), "kept")
    drop = voted(decisions.filter("reason is not null"), "drop")
    s = seg.join(kept, "range_start", "left").join(drop, "range_start", "left")
    for name in ("kept", "drop"):
        c = cand.withColumnsRenamed({"net": f"{name}_net", "len": f"{name}_len", "voted": f"{name}_vote"})
        s = s.join(c, [f"{name}_net", f"{name}_len", "a_asn"], "left")
    s = adjacent_in_paths(s, links)
    cls = (
        F.when(F.col("in_a") & ~F.col("in_b"), "only_a").when(~F.col("in_a") & F.col("in_b"), "only_b")
        .when(~F.col("differ"), "same").when(F.col("kept_vote"), "moas").when(F.col("drop_vote"), "below_floor")
        .when(F.col("adjacent"), "adjacent").otherwise("unrelated"))
    return s.select("range_start", "range_end", "in_a", "in_b", "a_asn", "b_asn", "a_start",
                    F.col("kept_len").alias("b_len"), cls.alias("class"))


def simple_class(segments: DataFrame) -> DataFrame:
    """Class without prefix decisions: same | differ | only_a | only_b."""
    return segments.withColumn(
        "class", F.when(F.col("in_a") & ~F.col("in_b"), "only_a").when(~F.col("in_a"), "only_b")
        .when(F.col("a_asn") == F.col("b_asn"), "same").otherwise("differ"))


def _size(space):
    return space.size(F.col("range_start"), F.col("range_end"))


def class_totals(classified: DataFrame, space=V4) -> DataFrame:
    return classified.groupBy("class").agg(F.count("*").alias("segments"), F.sum(_size(space)).alias("addresses"))


def agreement(classified: DataFrame, space=V4) -> DataFrame:
    """Covered space of A, B, both, and the three ratios, four decimals."""
    total = lambda cond: F.coalesce(F.sum(F.when(cond, _size(space))), F.lit(0).cast("bigint"))
    a, b = F.col("in_a"), F.col("in_b")
    t = classified.agg(total(a).alias("a_covered"), total(b).alias("b_covered"), total(a & b).alias("both_covered"),
                       total(a & b & (F.col("a_asn") == F.col("b_asn"))).alias("same"))
    share = lambda x, y: F.when(F.col(y) > 0, F.round(F.col(x) / F.col(y), 4)).otherwise(F.lit(0.0))
    return t.select("a_covered", "b_covered", "both_covered", share("same", "both_covered").alias("agreement"),
                    share("both_covered", "a_covered").alias("b_covers_of_a"),
                    share("both_covered", "b_covered").alias("a_covers_of_b"))


def only_a_split(classified: DataFrame, b: DataFrame, space=V4) -> DataFrame:
    """Only-in-A segments by what B knows: the A row is partly routed, its ASN is
    elsewhere in B, or absent from B."""
    touched = classified.filter("in_a").groupBy("a_start").agg(F.max("in_b").alias("touched"))
    origins = b.select(F.col("asn").alias("a_asn")).distinct().withColumn("known", F.lit(True))
    o = classified.filter("in_a and not in_b").join(touched, "a_start").join(origins, "a_asn", "left")
    kind = F.when(F.col("touched"), "partly_routed").when(F.col("known"), "asn_elsewhere").otherwise("asn_absent")
    return o.groupBy(kind.alias("kind")).agg(F.count("*").alias("segments"), F.sum(_size(space)).alias("addresses"))


def only_a_by_size(classified: DataFrame, space=V4) -> DataFrame:
    return classified.filter("in_a and not in_b").groupBy(
        length_bucket(F.col("range_start"), F.col("range_end"), space).alias("bucket")).agg(F.count("*").alias("n"))


def differ_by_length(classified: DataFrame, space=V4) -> DataFrame:
    """Disagreeing addresses by the length of B's prefix there."""
    return classified.filter("in_a and in_b and a_asn <> b_asn").groupBy("b_len").agg(F.sum(_size(space)).alias("addresses"))


def largest(classified: DataFrame, n: int = 40, space=V4) -> DataFrame:
    """The n largest segments per class, except agreement."""
    d = classified.filter("class <> 'same'").withColumn("size", _size(space))
    return top_per_class(d, "class", "size", n, "range_start")
