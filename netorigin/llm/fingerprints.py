"""Document fingerprints: bottom-k sketches of five-word shingle hashes.

A sketch is the sorted array of the k least distinct hashes.  Sketches of parts merge into the sketch of the whole, and
estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.llm.columns import bucket_of, grams, let, ordered_buckets, parts, text_or_empty, words

K = 128
SHINGLE = 5


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), F.lit(1), F.lit(k))


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Bottom-k sketch of a text.  A text shorter than a shingle is one shingle; without words the sketch is empty."""
    return let(words(text), lambda w: least(F.when(
        (F.size(w) > 0) & (F.size(w) < shingle), F.array(F.xxhash64(w))).otherwise(grams(w, shingle)), k))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.array_sort(F.array_union(a, b)), F.lit(1), F.lit(k))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's sketch found in both.  Two empty sketches are alike (1)."""
    return let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated distinct shingles: exact below k, else from the k-th least hash's share of the 64-bit range."""
    share = (F.get(a, F.size(a) - 1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    j, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.hex(h)), ",")


def with_next(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, text, next_text): the text of the next document in descending id order, the first one's after the last.

    Ids are cut into buckets of equal size; inside a bucket a window finds the next row, and the last row of a bucket
    takes the first text of the next bucket that has rows.  Texts are shuffled once.  Ties of an id are ordered by text; null ids
    come last.
    """
    d = docs.select(F.col(doc).cast("bigint").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    bounds = ordered_buckets(d, "doc_id", 4 * parts(d))
    null = len(bounds) + 1
    place = F.when(F.col("doc_id").isNull(), F.lit(null)).otherwise(len(bounds) - bucket_of(F.col("doc_id"), bounds))
    d = d.withColumn("bucket", place.cast("int"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    inside = d.withColumn("next_text", F.lead("text").over(Window.partitionBy("bucket").orderBy(*order)))
    # One row a bucket, at most as many as there are bounds and two: the id that comes first, then its text.
    first = d.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    heads = (d.join(F.broadcast(first.withColumnRenamed("bucket", "b")), (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("top")))
             .groupBy("bucket").agg(F.min("text").alias("head")))
    ring = heads.select("bucket", F.coalesce(
        F.lead("head").over(Window.orderBy("bucket")),
        F.first("head").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    return inside.join(ring, "bucket", "left").select("doc_id", "text", F.coalesce("next_text", "after").alias("next_text"))


def fingerprints(docs: DataFrame, text: str = "text", doc: str = "doc_id", k: int = K) -> DataFrame:
    """doc_id, sketch and distinct shingles of each text; null texts are empty."""
    d = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    return d.select("doc_id", sketch(F.col("text"), k).alias("sketch")).withColumn("distinct_shingles", distinct_count(F.col("sketch"), k))


def compare_edited(docs: DataFrame, text: str = "text", doc: str = "doc_id", k: int = K) -> DataFrame:
    """Fingerprints of each text and of the text whose second half is replaced from the next document, and their likeness."""
    d = with_next(docs, text, doc).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half))
    d = d.withColumn("edited", edited).withColumns({"a": sketch(F.col("text"), k), "e": sketch(F.col("edited"), k), "n": sketch(F.col("next_text"), k)})
    return d.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("a")).alias("fingerprint"),
                    as_text(F.col("e")).alias("edited_fingerprint"), resemblance(F.col("a"), F.col("e"), k).alias("near_edited"),
                    resemblance(F.col("a"), F.col("n"), k).alias("near_next"))
