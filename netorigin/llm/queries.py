"""The queries opN_<name> over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netorigin.llm import alignment, bpe, centroids, fingerprints, licenses, neardup, ngramjoin, packing, quality, secrets, substrings, toxicity, urls

WORDS = r"[x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark, folder):
    d = quality.quality(table(spark, folder, "documents").select("doc_id", "text"))
    return d.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op2_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), keep_ids=False)


def op3_byte_bpe(spark, folder):
    import public_tokenizers

    return bpe.encode(table(spark, folder, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests_only=True)


def op5_secret_scan(spark, folder):
    d = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = [secrets.of_kind(F.col("spans"), kind) for kind in secrets.BASE]
    return d.select("doc_id", *[F.size(b).cast("bigint").alias(f"n_{kind}") for kind, b in zip(secrets.BASE, base, strict=True)],
                    F.sha2(secrets.as_text(secrets.of_kind(F.col("spans"), *secrets.BASE)), 256).alias("base_sha256"),
                    secrets.as_text(F.col("spans")).alias("spans"))


def op6_license_scan(spark, folder):
    return licenses.licenses(table(spark, folder, "documents"))


def op4_substring_dedup(spark, folder):
    return substrings.drop_repeats(table(spark, folder, "documents"), digests_only=True)


def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, toxicity.grades(table(spark, folder, "labels"))))


def op8_url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages"))


def op10_near_dedup(spark, folder):
    return neardup.classes(table(spark, folder, "documents"))


def op9_fingerprints(spark, folder):
    return fingerprints.compare_edited(table(spark, folder, "documents"))


def op11_token_alignment(spark, folder):
    import public_tokenizers

    return alignment.align(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), public_tokenizers.PATTERN, tokenizer_file("piece_bpe_32k.model"))


def op12_ngram_join(spark, folder):
    return ngramjoin.join(table(spark, folder, "documents"))


def op13_centroid_clusters(spark, folder):
    return centroids.cluster(table(spark, folder, "embeddings"))


def _ngram_sql() -> str:
    """Links of distinct shingle sets, then the least document id over all that is reached."""
    n, percent = ngramjoin.SHINGLE, ngramjoin.PERCENT
    lower = WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return rf"""
with recursive w as (select doc_id, {lower} as w from documents),
s as materialized (select doc_id, case when len(w) = 0 then [] when len(w) < {n} then [array_to_string(w, ' ')]
        else list_sort(list_distinct([array_to_string(list_slice(w, i, i + {n - 1}), ' ') for i in range(1, len(w) - {n - 2})])) end as s from w),
u as materialized (select row_number() over () as u, s, len(s) as n, min(doc_id) as least from s where len(s) > 0 group by s),
e as materialized (select u, n, unnest(s) as x from u),
l as materialized (select a.u as a, b.u as b from e a join e b on a.x = b.x and a.u < b.u and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
      group by a.u, b.u, a.n, b.n having 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
g as materialized (select a, b from l union all select b, a from l),
r as (select u as a, u as b from u union select r.a, g.b from r join g on r.b = g.a),
c as (select a as u, min(x.least) as component_id from r join u x on r.b = x.u group by a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(c.component_id, s.doc_id) as component_id
from s left join u on u.s = s.s left join c on c.u = u.u"""


def _centroid_sql() -> str:
    """Every round as a pair of tables: all distances, then the floors of the means."""
    dim, count, scale, seed = centroids.DIMENSION, centroids.CENTROIDS, centroids.SCALE, centroids.SEED
    parts = [f"""
v as materialized (select row_number() over () as r, vec_id, [cast(floor({scale} * cast(e as double)) as bigint) for e in embedding] as x from embeddings
      where len(embedding) = {dim} and len([e for e in embedding if e is not null and isfinite(e)]) = {dim}),
c0 as materialized (select row_number() over (order by sha256('{seed}:' || vec_id) nulls last, x) - 1 as k, x as c from v
       qualify k < {count})"""]
    for i in range(centroids.ROUNDS + 1):
        parts.append(f"""
a{i} as materialized (select r, arg_min(k, (d, k)) as k, min(d) as d from
       (select r, k, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x, c)])::bigint as d from v, c{i}) group by r)""")
        if i < centroids.ROUNDS:
            parts.append(f"""
m{i} as materialized (select k, list(m order by j) as c from (select k, j, (s - ((s % n + n) % n)) // n as m from
       (select k, j, sum(e)::bigint as s, count(*) as n from (select k, unnest(x) as e, generate_subscripts(x, 1) as j from a{i} join v using (r)) group by k, j)) group by k),
c{i + 1} as materialized (select k, coalesce(m{i}.c, c{i}.c) as c from c{i} left join m{i} using (k))""")
    last = centroids.ROUNDS
    return f"""with {",".join(parts)}
select vec_id, cast(k as integer) as cluster, d as distance, cast(sum(d) over (partition by k) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256 from a{last} join v using (r) join c{last} using (k)"""


def _quality_sql() -> str:
    stop = ", ".join(f"'{x}'" for x in sorted({f for w in quality.STOP_WORDS for f in (w, w.capitalize())}))
    fails = []
    for r in quality.RULES:
        for sign, limit in ((">", r.most), ("<", r.least)):
            if limit is not None:
                fails.append(f"(100 * {r.over} {sign} {limit} * {r.under} and n_words >= {r.min_words})")
    return rf"""
with d as (select doc_id, coalesce(text, '') as text, {WORDS} as w,
                  [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ln from documents),
win as (select doc_id, i, list_slice(w, i, i + {quality.WINDOW - 1}) as g
        from (select doc_id, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) as i from d)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from win) where n > 1),
cov as (select doc_id, cast(sum(least({quality.WINDOW}, coalesce(nx - i, {quality.WINDOW}))) as bigint) as n
        from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nx from rep) group by 1),
m as (select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(list_aggregate(list_concat(w, ['']), 'string_agg', '')) as bigint) as word_chars,
             cast(len(regexp_replace(text, '[^#*$%&|<>]', '', 'gs')) as bigint) as n_symbols,
             cast(len(ln) - len(list_distinct(ln)) as bigint) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words,
             cast(len(ln) as bigint) as n_lines, cast(len(regexp_replace(text, '[^A-Z]', '', 'gs')) as bigint) as n_capitals,
             cast(len([p for p in list_zip(w[:-2], w[2:]) if p[1] = p[2]]) as bigint) as n_stutter_words,
             cast(len([x for x in w if x in ({stop})]) as bigint) as n_stop_words
      from d left join cov on cov.doc_id = d.doc_id),
b as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select *, not base_failed and not ({" or ".join(fails)}) as kept from b"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_packing, op3_byte_bpe, op4_substring_dedup, op5_secret_scan, op6_license_scan, op7_toxicity,
                            op8_url_filter, op9_fingerprints, op10_near_dedup, op11_token_alignment, op12_ngram_join, op13_centroid_clusters)}

ORACLES: dict[str, str] = {"op1_quality_rules": _quality_sql(), "op12_ngram_join": _ngram_sql(), "op13_centroid_clusters": _centroid_sql()}
