"""The whole program: raw layers -> checked, stamped, projected and classified intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from netorigin.functions.space import V4
from netorigin.operators.compilation import asn_flags, gap_fill, missing_listed, stamp
from netorigin.operators.lineage import cut
from netorigin.operators.project import intervals
from netorigin.operators.ranges import merge_ranges, sanitize


def build_intervals(raw_base: DataFrame, raw_vpn: DataFrame, raw_dc: DataFrame, meta: DataFrame, lists: DataFrame,
                    corrections: DataFrame, names: DataFrame, candidates: DataFrame | None = None, space=V4,
                    elsewhere: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Sanitize the base, merge the overlays, stamp flags, fill gaps, project, classify.

    `elsewhere` holds the bases of other address families: an ASN that originates
    something there is not missing.  Lineage is cut after each stage that later scans read more than once.
    """
    flags = cut(asn_flags(meta, lists, corrections))
    base = cut(stamp(sanitize(raw_base, space, "asn"), flags))
    if candidates is not None:
        base = cut(gap_fill(base, missing_listed(lists, base, *elsewhere), candidates, flags, space))
    vpn, dc = cut(merge_ranges(raw_vpn, space)), cut(merge_ranges(raw_dc, space))
    return intervals(base, vpn, dc, names, space)
