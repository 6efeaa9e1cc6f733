"""Range-set algebra over inclusive [range_start, range_end] rows.

All operators share one idea: turn ranges into boundary events, aggregate the
events by position, and scan the positions (see scan.py).  The work is linear
in the number of distinct boundaries; no operator compares ranges pairwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.operators.scan import BUCKET, scan


SPAN = 65_536


def explode_span(df: DataFrame, lo: Column, hi: Column, name: str) -> DataFrame:
    """One row per whole number in [lo, hi]; nothing when hi < lo.

    Two steps of at most 65,536 numbers each, so that a row with a huge span never
    becomes one huge array.
    """
    d = df.withColumns({"_from": lo, "_to": hi}).filter("_to >= _from")
    d = d.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_to") - F.col("_from")) / SPAN))))
    first = F.col("_from") + F.col("_part") * SPAN
    return d.withColumn(name, F.explode(F.sequence(first, F.least(F.col("_to"), first + SPAN - 1)))).drop("_from", "_to", "_part")


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def boundary_events(df: DataFrame, space, layer: str, payload: list[str], keys: tuple[str, ...]) -> DataFrame:
    """+1 where a range of `layer` starts (with its payload), -1 just after it ends."""
    def event(pos: Column, delta: int, opens: bool) -> Column:
        at_start = lambda c: c if opens else F.when(F.lit(False), c)
        return F.struct(
            pos.alias("pos"), F.lit(delta).cast("bigint").alias(f"d_{layer}"),
            *([at_start(F.lit(True)).alias(f"s_{layer}")] if payload else []),
            *[at_start(F.col(c)).alias(f"p_{layer}_{c}") for c in payload])

    rows = df.select(*keys, F.explode(F.array(
        event(F.col("range_start"), 1, True), event(space.succ(F.col("range_end")), -1, False))).alias("e"))
    return rows.select(*keys, "e.*").filter(F.col("pos").isNotNull())


def _event_table(space, layers: dict[str, DataFrame], payload: dict[str, list[str]],
                 keys: tuple[str, ...]) -> DataFrame:
    """One row per position.  A keyed layer starts at most once per position, so the
    maximum of each payload column is its value; columns are aggregated one by one
    (not as a struct) to stay in a hash aggregate."""
    parts = [boundary_events(df, space, l, payload.get(l, []), keys) for l, df in layers.items()]
    ev = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    zero = F.lit(0).cast("bigint")
    g = ev.groupBy(*keys, "pos").agg(
        *[F.coalesce(F.sum(f"d_{l}"), zero).alias(f"d_{l}") for l in layers],
        *[F.max(f"s_{l}").alias(f"s_{l}") for l in payload],
        *[F.max(f"p_{l}_{c}").alias(f"p_{l}_{c}") for l in payload for c in payload[l]])
    return g.select(
        *keys, "pos", *[f"d_{l}" for l in layers],
        *[F.when(F.col(f"s_{l}"), F.struct(*[F.col(f"p_{l}_{c}").alias(c) for c in payload[l]])).alias(f"p_{l}") for l in payload])


def sweep(space, layers: dict[str, DataFrame], payload: dict[str, list[str]] | None = None,
          keys: tuple[str, ...] = ()) -> DataFrame:
    """Elementary segments of several range layers laid over each other.

    One row per maximal stretch between two neighbouring boundaries in which at
    least one layer is on: keys, range_start, range_end, in_<layer> booleans and
    the payload columns of each layer listed in `payload` (null where that layer
    is off).  A layer with a payload must hold disjoint ranges.
    """
    payload = payload or {}
    s = scan(
        _event_table(space, layers, payload, keys), space, keys=keys, nexts=True,
        sums=tuple(f"d_{l}" for l in layers), lasts=tuple(f"p_{l}" for l in payload),
    )
    on = {l: F.col(f"run_d_{l}") > 0 for l in layers}
    return s.filter(_any(list(on.values()))).select(
        *keys,
        F.col("pos").alias("range_start"),
        F.coalesce(space.pred(F.col("next_pos")), space.max()).alias("range_end"),
        *[c.alias(f"in_{l}") for l, c in on.items()],
        *[F.when(on[l], F.col(f"last_p_{l}")[c]).alias(c) for l in payload for c in payload[l]],
    )


def merge_ranges(df: DataFrame, space, keys: tuple[str, ...] = ()) -> DataFrame:
    """Union of overlapping and adjacent ranges, per key."""
    keys = tuple(keys)
    ev = _event_table(space, {"a": df}, {}, keys).filter("d_a <> 0")
    depth = scan(ev, space, keys=keys, sums=("d_a",), keep_bucket=True)
    # Outer edges only: depth leaves zero, or falls back to it.
    edges = depth.filter("run_d_a = 0 or run_d_a = d_a").select(*keys, "pos", BUCKET, (F.col("run_d_a") > 0).alias("opens"))
    return scan(edges, space, keys=keys, nexts=True).filter("opens").select(
        *keys,
        F.col("pos").alias("range_start"),
        F.coalesce(space.pred(F.col("next_pos")), space.max()).alias("range_end"),
    )


def intersect_ranges(a: DataFrame, b: DataFrame, space) -> DataFrame:
    """Pieces common to two disjoint sets; touching pieces stay apart."""
    return sweep(space, {"a": a, "b": b}).filter("in_a and in_b").select("range_start", "range_end")


def subtract_ranges(a: DataFrame, b: DataFrame, space, payload: list[str] | None = None) -> DataFrame:
    """What is left of the disjoint set `a` outside `b`; rows of `a` are never bridged."""
    p = {"a": payload} if payload else {}
    return sweep(space, {"a": a, "b": b}, p).filter("in_a and not in_b").select(
        "range_start", "range_end", *(payload or []))


def complement(cover: DataFrame, space) -> DataFrame:
    """Disjoint stretches of the whole address space that `cover` leaves free: the
    space itself is the second layer."""
    half = F.lit(-(1 << 63))
    lowest = F.lit(0).cast("bigint") if space.version == 4 else F.struct(half.alias("hi"), half.alias("lo"))
    whole = cover.sparkSession.range(1).select(lowest.alias("range_start"), space.max().alias("range_end"))
    return merge_ranges(sweep(space, {"a": whole, "b": cover}).filter("in_a and not in_b"), space)


def range_join(left: DataFrame, right: DataFrame, space) -> DataFrame:
    """Every (left, right) pair of overlapping ranges; `right` must be disjoint.

    `left` keeps its range_start/range_end and columns, the matching row of
    `right` comes back as r_<column>.  Right rows get their rank along the
    address line.  A left range overlaps exactly the ranks between two running
    counts (right ranges ended before its start, right ranges started by its
    end), so the pairs come from an equi-join on the rank and their number is
    the size of the answer.
    """
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    r = right.select(
        F.explode(F.array(
            F.struct(F.col("range_start").alias("pos"), one.alias("started"), zero.alias("ended")),
            F.struct(space.succ(F.col("range_end")).alias("pos"), zero.alias("started"), one.alias("ended")),
        )).alias("e")).select("e.*").filter("pos is not null")
    q = left.select(F.explode(F.array("range_start", "range_end")).alias("pos")).select(
        "pos", zero.alias("started"), zero.alias("ended"))
    counts = scan(
        r.unionByName(q).groupBy("pos").agg(F.sum("started").alias("started"), F.sum("ended").alias("ended")),
        space, sums=("started", "ended"))
    # `pos` is unique in counts, so neither join multiplies rows.
    lo = counts.select(F.col("pos").alias("_lo_pos"), F.col("run_ended").alias("_lo"))
    hi = counts.select(F.col("pos").alias("_hi_pos"), F.col("run_started").alias("_hi"))
    ranked = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).join(
        hi.withColumnsRenamed({"_hi_pos": "_p", "_hi": "_rank"}), F.col("r_range_start") == F.col("_p")).drop("_p")
    found = left.join(lo, F.col("range_start") == F.col("_lo_pos")).join(hi, F.col("range_end") == F.col("_hi_pos"))
    pairs = explode_span(found, F.col("_lo") + 1, F.col("_hi"), "_rank").select(*left.columns, "_rank")
    return pairs.join(ranked, "_rank").drop("_rank")


def gaps(candidates: DataFrame, cover: DataFrame, space) -> DataFrame:
    """Parts of each candidate range that `cover` leaves free, clipped to it."""
    free = complement(cover, space)
    hit = range_join(candidates, free, space)
    rest = [c for c in candidates.columns if c not in ("range_start", "range_end")]
    return hit.select(
        F.greatest("range_start", "r_range_start").alias("range_start"),
        F.least("range_end", "r_range_end").alias("range_end"), *rest)


def union_size(df: DataFrame, space, keys: tuple[str, ...]) -> DataFrame:
    """Addresses covered per key, overlaps and copies counted once."""
    m = merge_ranges(df, space, keys)
    return m.groupBy(*keys).agg(F.sum(space.size(F.col("range_start"), F.col("range_end"))).alias("addresses"))


def _by_start(df: DataFrame, tie: str | None, rest: list[str]) -> DataFrame:
    """One row per start: the longest range wins, then the lowest `tie` column."""
    rank = F.struct("range_end", *([(-F.col(tie)).alias("t")] if tie else []))
    return df.groupBy(F.col("range_start").alias("pos")).agg(
        F.max_by(F.struct("range_end", *rest), rank).alias("w"), F.count("*").alias("n")
    ).select("pos", "w.*", "n")


def sanitize_steps(df: DataFrame, space, tie: str | None = None) -> DataFrame:
    """What the overlap sanitizer does with each distinct start.

    Rows are taken in order (start, end descending, tie ascending).  A row inside
    the space seen so far is dropped, a row that sticks out is clipped.
    action: keep | clip | drop; `copies` further rows with the same start are
    contained in this one and dropped as well.
    """
    rest = [c for c in df.columns if c not in ("range_start", "range_end")]
    s = scan(_by_start(df, tie, rest), space, maxes=("range_end",))
    top = F.col("top_range_end")
    return s.select(
        F.when(top.isNull() | (F.col("pos") > top), F.col("pos")).otherwise(space.succ(top)).alias("range_start"),
        "range_end", *rest,
        F.when(top.isNull() | (F.col("pos") > top), F.lit("keep"))
        .when(F.col("range_end") > top, F.lit("clip")).otherwise(F.lit("drop")).alias("action"),
        (F.col("n") - 1).alias("copies"),
    )


def sanitize(df: DataFrame, space, tie: str | None = None) -> DataFrame:
    return sanitize_steps(df, space, tie).filter("action <> 'drop'").drop("action", "copies")


def sanitize_counts(df: DataFrame, space, tie: str | None = None, limit: int = 1000) -> DataFrame:
    """Number of repairs and whether it passes the limit (1000 by default)."""
    s = sanitize_steps(df, space, tie)
    fixed = F.coalesce(F.sum(F.when(F.col("action") == "keep", 0).otherwise(1) + F.col("copies")), F.lit(0)).cast("bigint")
    return s.agg(
        fixed.alias("repairs"),
        F.count_if(F.col("action") == "clip").alias("clipped"),
        F.coalesce(F.sum(F.when(F.col("action") == "drop", 1).otherwise(0) + F.col("copies")), F.lit(0)).cast("bigint").alias("dropped"),
        (fixed <= limit).alias("ok"),
    )


def structure_violations(df: DataFrame, space) -> DataFrame:
    """Counts of rows that break a layer's form: inverted, out of bound, overlapping."""
    inverted = F.col("range_end") < F.col("range_start")
    bad = df.agg(
        F.count_if(inverted).alias("inverted"),
        F.count_if((F.col("range_end") > space.max())
                   | (F.col("range_start") < 0 if space.version == 4 else F.lit(False))).alias("out_of_bound"),
    )
    s = scan(_by_start(df.filter(~inverted).select("range_start", "range_end"), None, []), space, maxes=("range_end",))
    over = s.agg(F.coalesce(F.sum(
        (F.col("n") - 1) + F.when(F.col("top_range_end") >= F.col("pos"), 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n"))
    return bad.select(F.explode(F.array(
        F.struct(F.lit("inverted").alias("violation"), F.col("inverted").alias("n")),
        F.struct(F.lit("out_of_bound").alias("violation"), F.col("out_of_bound").alias("n")),
    )).alias("v")).select("v.*").unionByName(over.select(F.lit("overlap").alias("violation"), "n"))


def coalesce_equal(df: DataFrame, space, payload: list[str]) -> DataFrame:
    """Join neighbouring disjoint rows whose whole payload is equal (null-safe)
    and which touch; a gap or any differing payload field keeps them apart."""
    d = df.select(F.col("range_start").alias("pos"), F.struct("range_end", F.struct(*payload).alias("pl")).alias("row"))
    s = scan(d, space, prevs=("row",), keep_bucket=True)
    joined = (F.col("prev_row").isNotNull()
              & F.coalesce(space.succ(F.col("prev_row.range_end")) == F.col("pos"), F.lit(False))
              & F.col("prev_row.pl").eqNullSafe(F.col("row.pl")))
    s = s.select("pos", "row", BUCKET, F.when(joined, 0).otherwise(1).cast("bigint").alias("head"))
    return (
        scan(s, space, sums=("head",)).groupBy("run_head")
        .agg(F.min("pos").alias("range_start"), F.max("row.range_end").alias("range_end"), F.first("row.pl").alias("pl"))
        .select("range_start", "range_end", "pl.*")
    )


def overlay_share(base: DataFrame, overlay: DataFrame, space) -> DataFrame:
    """Percent of each ASN's space inside the overlay, one decimal."""
    size = space.size(F.col("range_start"), F.col("range_end"))
    seg = sweep(space, {"base": base, "o": overlay}, {"base": ["asn"]}).filter("in_base")
    return seg.groupBy("asn").agg(
        F.sum(size).alias("addresses"),
        F.coalesce(F.sum(F.when(F.col("in_o"), size)), F.lit(0).cast("bigint")).alias("inside"),
    ).withColumn("pct", F.round(F.col("inside") / F.col("addresses") * 100, 1))


def bucket_pieces(df: DataFrame, shift: int = 16) -> DataFrame:
    """Split IPv4 ranges at block bounds (2^shift addresses), one row per block.

    For disjoint ranges the pieces outnumber the ranges by at most the number of
    blocks.  Kept for storage layouts; joins here use ranks instead.
    """
    rest = [c for c in df.columns if c not in ("range_start", "range_end")]
    block = F.lit(1 << shift).cast("bigint")
    d = explode_span(df, F.shiftright("range_start", shift), F.shiftright("range_end", shift), "bucket")
    return d.select(
        "bucket",
        F.greatest(F.col("range_start"), F.col("bucket") * block).alias("range_start"),
        F.least(F.col("range_end"), (F.col("bucket") + 1) * block - 1).alias("range_end"), *rest)
