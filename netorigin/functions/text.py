"""String, date, array and JSON rules as column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netorigin.functions import vocab


def parse_asn(text: Column) -> Column:
    digits = F.regexp_extract(F.trim(text), r"^(?:[Aa][Ss])?(\d+)$", 1)
    n = F.when(digits != "", digits).try_cast("decimal(38,0)")
    return F.when(n.between(1, vocab.ASN_MAX), n.cast("bigint"))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Unicode NFC, the one text rule Spark has no function for."""
    return s.map(lambda v: v if v is None else unicodedata.normalize("NFC", v))


def squeeze(text: Column) -> Column:
    """Control characters to blanks, runs of blanks to one, trimmed, empty to null."""
    t = F.regexp_replace(text, r"\p{Cc}", " ")
    return F.nullif(F.btrim(F.regexp_replace(t, " {2,}", " "), F.lit(" ")), F.lit(""))


def clean_label(text: Column, normalize: bool = True) -> Column:
    # Pure ASCII is already NFC: such rows go to Python as nulls.
    base = F.coalesce(nfc(F.when(~text.rlike(r"^\p{ASCII}*$"), text)), text) if normalize else text
    return squeeze(base)


def url_host(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def restricted_host(host: Column) -> Column:
    return F.coalesce(
        host.rlike("(^|[.])(" + "|".join(re.escape(h) for h in vocab.RESTRICTED_HOSTS) + ")$"), F.lit(False))


def restricted_url(url: Column) -> Column:
    return restricted_host(url_host(url))


def registrable_domain(url: Column) -> Column:
    """Last two labels of the host, three under a generic second level; null without a host."""
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    labels = F.split(host, r"\.")
    n = F.size(labels)
    generic = (n >= 3) & F.try_element_at(labels, F.lit(-2)).isin(vocab.GENERIC_SECOND_LEVEL)
    take = F.when(generic, F.lit(3)).otherwise(F.least(n, F.lit(2)))
    return F.when(host.isNotNull(), F.array_join(F.slice(labels, F.greatest(n - take, F.lit(0)) + 1, take), "."))


def clean_name(text: Column) -> Column:
    """Draft name without self-references to an ASN and empty parentheses."""
    t = F.regexp_replace(text, r"\p{Cc}", " ")
    for pattern, to in (
        (" # ", " "),
        (r"\s*[—–-]\s*AS\d+\b", ""),
        (r"\s*/\s*AS\d+\b", ""),
        (r"\bAS\d+\s*(,|/)\s*", ""),
        (r"\s+AS\d+\b", ""),
        (r"\(\s*AS\d+\s*\)", ""),
        (r"\(\s*\)", ""),
        (r" {2,}", " "),
    ):
        t = F.regexp_replace(t, pattern, to)
    return F.nullif(F.btrim(t, F.lit(" \t\r\n")), F.lit(""))


def truncate_utf8(text: Column, limit: int = vocab.ORG_MAX_BYTES) -> Column:
    """At most `limit` bytes of UTF-8, never half a character.

    `limit` characters hold at least `limit` bytes, so only they are encoded.  When
    the byte after the cut continues a character, its first one to three bytes go.
    """
    h = F.hex(F.encode(F.substring(text, 1, limit + 1), "UTF-8"))
    byte = lambda i: F.substring(h, 2 * (limit - i) - 1, 2)  # i-th byte before the cut
    split = F.substring(h, 2 * limit + 1, 2).rlike("^[89AB]")
    drop = F.when(~split, 0).when(byte(0) >= "C0", 1).when(byte(1) >= "C0", 2).otherwise(3)
    head = F.substr(h, F.lit(1), 2 * (limit - drop))
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.decode(F.unhex(head), "UTF-8"))


def _html_text(col: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(col, r"\s+", " ")), F.lit(""))


TITLE = r"(?is)<title[^>]*>\s*(.{1,300}?)\s*</title>"
DESC_A = r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["'](.{1,300}?)["']"""
DESC_B = r"""(?is)<meta[^>]+content=["'](.{1,300}?)["'][^>]+name=["']description["']"""


def page_title(html: Column) -> Column:
    return _html_text(F.regexp_extract(html, TITLE, 1))


def page_description(html: Column) -> Column:
    got = lambda p: F.nullif(F.regexp_extract(html, p, 1), F.lit(""))
    return _html_text(F.coalesce(got(DESC_A), got(DESC_B)))


def extract_json(text: Column) -> Column:
    """JSON object text inside model output: the whole text, then a fenced block,
    then the widest braces.  Null when none parses."""
    whole = F.trim(text)
    fenced = F.regexp_extract_all(text, F.lit(r"(?s)```(?:json)?\s*(\{.*?\})\s*```"), F.lit(1))
    widest = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    candidates = F.concat(F.array(whole), fenced, F.array(widest))
    return F.try_element_at(
        F.filter(candidates, lambda c: (c != "") & F.try_parse_json(c).isNotNull()), F.lit(1))


def matches_sweep(description: Column, sweep: str) -> Column:
    return F.coalesce(description.rlike(vocab.SWEEPS[sweep]), F.lit(False))


def registry_date(text: Column) -> Column:
    t = F.trim(text)
    good = t.rlike(r"^\d{8}$") & ~t.isin("00000000", "19700101")
    return F.when(good, F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))


def complete_slot(now: Column, lag_hours: int = 3) -> Column:
    """Newest even-hour slot that is at least `lag_hours` old, as YYYYMMDD.HHMM."""
    t = now - F.expr(f"interval {lag_hours} hours")
    h = F.date_trunc("hour", t)
    return F.date_format(F.timestamp_seconds(F.unix_timestamp(h) - F.hour(h) % 2 * 3600), "yyyyMMdd.HHmm")


def sunday_tags(today: Column, n: int = 8) -> Column:
    """The last n Sundays up to `today`, newest first, as vYYYY.MM.DD."""
    sunday = F.date_sub(today, (F.dayofweek(today) - 1).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.date_format(F.date_sub(sunday, (i * 7).cast("int")), "'v'yyyy.MM.dd"))


def age_hours(build_id: Column, now: Column) -> Column:
    at = F.try_to_timestamp(build_id)
    return (F.unix_timestamp(now) - F.unix_timestamp(at)) / 3600.0


def is_stale(build_id: Column, now: Column) -> Column:
    return age_hours(build_id, now) > vocab.STALE_HOURS


def registry_country(text: Column) -> Column:
    t = F.trim(text)
    return F.when(~t.isin("", "*", "ZZ"), t)


def canonical_registry(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in vocab.REGISTRY_OF.items():
        out = F.when(F.lower(token) == k, F.lit(v)).otherwise(out)
    return out


def bogon_asn(asn: Column) -> Column:
    return (asn <= 0) | (asn == 23456) | asn.between(64496, 131071) | (asn >= 4200000000)


def admissible(refs: Column) -> Column:
    """References are `id|url|stated_in` items separated by blanks.

    No reference at all is admissible.  Otherwise some reference id must cite no
    restricted host and no restricted item: the ids minus the tainted ids.
    """
    items = F.filter(F.split(F.coalesce(refs, F.lit("")), " "), lambda r: ~r.startswith("|") & (r != ""))
    ref_id = lambda r: F.split(r, r"\|")[0]
    part = lambda r, i: F.coalesce(F.try_element_at(F.split(r, r"\|"), F.lit(i)), F.lit(""))
    tainted = lambda r: restricted_url(part(r, 2)) | F.element_at(F.split(part(r, 3), "/"), -1).isin(
        vocab.RESTRICTED_STATED_IN)
    ids = F.transform(items, ref_id)
    bad = F.transform(F.filter(items, tainted), ref_id)
    return (F.size(items) == 0) | (F.size(F.array_except(ids, bad)) > 0)


def canonical_json(cols: dict[str, Column]) -> Column:
    """JSON object with keys in name order and every scalar as text; nested dicts allowed."""
    def build(d):
        return F.struct(*[
            (build(d[k]) if isinstance(d[k], dict) else d[k].cast("string")).alias(k) for k in sorted(d)])

    return F.to_json(build(cols), {"ignoreNullFields": "false"})
