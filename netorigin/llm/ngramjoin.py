"""N-gram Jaccard join, size-aware: small sets by fixed-size subsets, large sets by inverted lists.

A text's set has its distinct five-word shingles, as 64-bit hashes.  Sets of sizes a and b link when they share `needed(a, b)` shingles or more.  Texts
with one set are one node.

* Light: a set of up to `boundary` shingles files all its subsets of `needed(a, b)` shingles for every partner size b up to the boundary.  Two small sets
  link exactly when they file the same subset under the same sizes, so a subset's sets are linked to one of them, and nothing is compared.
* Heavy: a pair with a larger set must share one of its first n - ceil(0.8 n) + 1 shingles, in any one order of all shingles.  Shingles that are frequent in the
  corpus come last, most others are rare.  These postings make the inverted lists.  A list of up to `SHORT` sets gives all its pairs that sizes and places
  allow.  In a longer list each set meets the list's first.  Then the lists that still hold several classes are gone through in full: their members are
  dealt to blocks, all blocks meet but those of the list's largest class among themselves, and each pair of different classes that
  sizes, places and short signatures allow is compared.  So no link between two classes is lost, and no list is expanded into pairs that are known to be connected.
* The boundary is the one of least cost: subsets filed by the small sets, against list entries met by the others, both counted on the data.

Candidates whose parity signatures leave too few common shingles go; the others get the exact shingle counts.  Classes are the connected components.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netorigin.llm.bytewords import Words, words_by_block
from netorigin.llm.neardup import components
from netorigin.llm.wordhash import runs
from netorigin.operators.lineage import cut

SHINGLE, PERCENT = 5, 80
MOST_SMALL = 24  # no larger set is filed by subsets
ENTRY_COST = 8  # a met list entry, whose two sets are to be compared, against a filed subset or a posted shingle
FREQUENT = 65_536  # a shingle with more than one in so many places is frequent; at most so many are
REPORTED = 16  # places in a task below which a shingle is not reported as frequent
SHORT = 3
BROADCAST_KEYS = 200_000  # rows of three numbers
BLOCK = 4_096  # most sets of a list in a block
SIGN_BYTES = 128  # of a folded signature, which entries of mixed lists carry
NO_HASHES = np.zeros(0, dtype=np.uint64)


def needed(a, b, percent: int = PERCENT):
    """Least number of common shingles of two linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, most: int, percent: int = PERCENT) -> range:
    """Sizes up to `most` of sets that can link with a set of n."""
    return range(-(-percent * n // 100), min(most, 100 * n // percent) + 1)


def filed(n: int, most: int, percent: int = PERCENT) -> int:
    """Subsets that a set of n files when the boundary is `most`."""
    return sum(math.comb(n, needed(n, b, percent)) for b in partners(n, most, percent) if needed(n, b, percent) <= min(n, b))


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Per text the ascending hashes of its distinct runs of `size` words; fewer words are one run, no words none."""
    codes = words.hashes()
    h = runs(codes, size)
    return [np.unique(h[a:b - size + 1]) if b - a >= size else runs(codes[a:b], b - a) if b > a else NO_HASHES
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)]


def signature(s: np.ndarray) -> bytes:
    """Parity bits of the set: bit i tells whether an odd number of hashes end in i.  Between two and four bits a shingle, 64 at least."""
    bits = 1 << max(6, (2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(sign: bytes, size: int) -> bytes:
    """A signature of `size` bytes: halves of a longer one laid over each other, a shorter one as it is, filled up with zeros.  Only equal lengths compare."""
    a = np.frombuffer(sign, dtype=np.uint8)
    while len(a) > size:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a.tobytes().ljust(size, b"\0")


def differing(x: bytes, y: bytes) -> int:
    """A lower bound of the number of shingles that are in one set alone: each changes one bit of its signature."""
    a, b = sorted((np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)), key=len)
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def frequent_shingles(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Hashes of frequent shingles, the rarest first; at most `FREQUENT`.

    A task keeps the commonest of the shingles it has met, so its memory is bounded, and reports those with `REPORTED` places and its share.  The table only orders shingles: whatever it holds, the join is exact.
    """
    def run(batches):
        codes, counts, total = NO_HASHES, np.zeros(0, np.int64), 0
        for b in batches:
            for _, words in words_by_block(b.column("text"), lower=True):
                h = np.concatenate([NO_HASHES, *shingle_sets(words, size)])
                total += len(h)
                u, n = np.unique(h, return_counts=True)
                codes, inverse = np.unique(np.concatenate([codes, u]), return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([counts, n]), minlength=len(codes)).astype(np.int64)
                if len(codes) > 4 * FREQUENT:
                    top = np.sort(np.argsort(-counts, kind="stable")[:2 * FREQUENT])
                    codes, counts = codes[top], counts[top]
        often = (counts * FREQUENT > total) & (counts >= REPORTED)
        yield pa.RecordBatch.from_arrays([pa.array([None, *codes[often].view(np.int64).tolist()], pa.int64()),
                                          pa.array([total, *counts[often].tolist()], pa.int64())], names=["shingle", "n"])

    got = cut(docs.select(F.lit(0).alias("k"), F.col(text).alias("text")).mapInArrow(run, "shingle bigint, n bigint")
              .groupBy("shingle").agg(F.sum("n").alias("n")))
    total = got.filter("shingle is null").agg(F.sum("n")).first()[0] or 0
    rows = got.filter(F.col("shingle").isNotNull() & (F.col("n") * FREQUENT > total)).orderBy("n", "shingle").limit(FREQUENT).select("shingle").collect()
    return np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)


def sketched(docs: DataFrame, frequent: np.ndarray, text: str, doc: str, size: int, percent: int) -> DataFrame:
    """(doc_id, th, uid, node, n, rare, prefix, whole, sign, short), one row per document.

    `node` is the same for the same set; `prefix` has the shingles to post in order, the first `rare` of them not frequent; `whole` is the set if it is small,
    `sign` its signature, `short` the folded one.
    """
    by_hash = np.argsort(frequent)
    known = frequent[by_hash]

    def lists(parts):
        flat = np.concatenate([NO_HASHES, *parts]).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat))

    def run(batches):
        for b in batches:
            nodes, ns, rare, prefix, whole, signs, short = [], [], [], [], [], [], []
            for _, words in words_by_block(b.column("text"), lower=True):
                for s in shingle_sets(words, size):
                    n = len(s)
                    signs.append(signature(s))
                    short.append(folded(signs[-1], SIGN_BYTES))
                    take = n - -(-percent * n // 100) + 1 if n else 0
                    nodes.append(hashlib.md5(s.tobytes()).digest())
                    ns.append(n)
                    whole.append(s if n <= MOST_SMALL else NO_HASHES)
                    if len(known) and n:
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        often = known[at] == s
                        plain, ranked = s[~often], s[often][np.argsort(by_hash[at[often]])]
                        rare.append(min(take, len(plain)))
                        s = np.concatenate([plain[:take], ranked[:max(0, take - len(plain))]])
                    else:
                        rare.append(take)
                    prefix.append(s[:take])
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("th"), b.column("uid"), pa.array(nodes, pa.binary()), pa.array(ns, pa.int64()), pa.array(rare, pa.int64()),
                lists(prefix), lists(whole), pa.array(signs, pa.binary()), pa.array(short, pa.binary())],
                names=["doc_id", "th", "uid", "node", "n", "rare", "prefix", "whole", "sign", "short"])

    return docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"),
                       F.monotonically_increasing_id().alias("uid"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, th bigint, uid bigint, node binary, n bigint, rare bigint, prefix array<bigint>, whole array<bigint>, sign binary, short binary")


def boundary(small: DataFrame, percent: int) -> int:
    """Size up to which sets are filed by subsets: the least sum of subsets filed, shingles posted and list entries met, among the sets of up to `MOST_SMALL`."""
    entries = small.select("n", F.explode("prefix").alias("token"))
    lists = entries.groupBy("token").agg(F.count("*").alias("length"))
    sizes = entries.groupBy("token", "n").agg(F.count("*").alias("sets"))
    met = {r["n"]: float(r["met"]) for r in sizes.join(lists, "token").groupBy("n").agg(F.sum(F.col("sets") * (F.col("length") - 1)).alias("met")).collect()}
    sets = {r["n"]: r["count"] for r in small.groupBy("n").count().collect()}

    def cost(most: int) -> float:
        light = sum(k * filed(n, most, percent) for n, k in sets.items() if n <= most)
        posted = sum(k * (n - -(-percent * n // 100) + 1) for n, k in sets.items() if 100 * n >= percent * (most + 1))
        return light + posted + ENTRY_COST * sum(v for n, v in met.items() if n > most)

    return min(range(MOST_SMALL + 1), key=lambda most: (cost(most), most))


def light_links(small: DataFrame, most: int, percent: int) -> DataFrame:
    """(a, b) links that connect all small sets that are to be connected: a subset's sets to its least set of the other size."""
    def run(batches):
        for b in batches:
            keys, side, uids = [], [], []
            for uid, n, s in zip(*(b.column(c).to_pylist() for c in ("uid", "n", "whole")), strict=True):
                for m in partners(n, most, percent):
                    k, low, high = needed(n, m, percent), min(n, m), max(n, m)
                    if k > low:
                        continue
                    for sub in combinations(s, k):
                        keys.append(hashlib.md5(f"{low},{high},{','.join(map(str, sub))}".encode()).digest())
                        side.append(2 if n == m else int(n == high))
                        uids.append(uid)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(side, pa.int32()), pa.array(uids, pa.int64())], names=["key", "side", "uid"])

    rows = small.filter(F.col("n") <= most).select("uid", "n", "whole").mapInArrow(run, "key binary, side int, uid bigint")
    hubs = (rows.groupBy("key").agg(F.min(F.when(F.col("side") != 1, F.col("uid"))).alias("low"), F.min(F.when(F.col("side") != 0, F.col("uid"))).alias("high"),
                                    F.count("*").alias("n")).filter("n > 1").drop("n"))
    hub = F.when(F.col("side") == 0, F.col("high")).otherwise(F.col("low"))
    return rows.join(hubs, "key").select("uid", hub.alias("hub")).filter("hub <> uid").select(
        F.least("uid", "hub").alias("a"), F.greatest("uid", "hub").alias("b")).distinct()


def possible(na, pa_, nb, pb, most: int, percent: int):
    """Whether sizes and the places (from 1) of a common shingle allow a link of sets of which one is above the boundary."""
    return ((np.minimum(na, nb) * 100 >= percent * np.maximum(na, nb)) & (np.maximum(na, nb) > most)
            & (1 + np.minimum(na - pa_, nb - pb) >= needed(na, nb, percent)))


def met_in_lists(postings: DataFrame, most: int, percent: int) -> DataFrame:
    """(token, uid, n, pos, hub): candidates (uid, hub) without a token, and the entries of lists of more than `SHORT` sets without a hub.

    A partition is read in token order; of a list that goes on in the next batch only its first entry is held once it is long.
    """
    names = ["token", "uid", "n", "pos", "hub"]

    def run(batches):
        held, told = np.zeros((4, 0), dtype=np.int64), False  # told: the held entry is the first of a long list and was given out

        def pairs(x, i, j):
            ok = possible(x[2][i], x[3][i], x[2][j], x[3][j], most, percent)
            return np.stack([np.minimum(x[1][i], x[1][j])[ok], np.maximum(x[1][i], x[1][j])[ok]])

        def out(p, entries):
            n, m = p.shape[1], entries.shape[1]
            none = pa.nulls(n, pa.int64())
            cols = [pa.concat_arrays([a, pa.array(e)]) for a, e in zip([none, pa.array(p[0]), none, none], entries, strict=True)]
            return pa.RecordBatch.from_arrays([*cols, pa.concat_arrays([pa.array(p[1]), pa.nulls(m, pa.int64())])], names=names)

        for b in chain(batches, [None]):
            x = held if b is None else np.concatenate([held, np.array([b.column(c).to_numpy() for c in names[:4]])], axis=1)
            if not x.shape[1]:
                continue
            start = np.flatnonzero(np.append(True, x[0][1:] != x[0][:-1]))
            length = np.diff(np.append(start, x.shape[1]))
            run_of = np.repeat(np.arange(len(start)), length)
            is_long = length > SHORT
            is_long[0] |= told
            is_open = np.zeros(len(start), dtype=bool)
            is_open[-1] = b is not None
            found = []
            for d in range(1, SHORT):
                i = np.flatnonzero((run_of[d:] == run_of[:-d]) & ~(is_long | is_open)[run_of[d:]])
                found.append(pairs(x, i, i + d))
            rest = np.flatnonzero(is_long[run_of] & (np.arange(x.shape[1]) != start[run_of]))
            found.append(pairs(x, start[run_of[rest]], rest))
            entry = is_long[run_of]
            entry[0] &= not told
            yield out(np.concatenate(found, axis=1), x[:, entry])
            told = bool(is_open[-1] and is_long[-1])
            held = x[:, start[-1]:start[-1] + 1] if told else x[:, start[-1]:] if is_open[-1] else x[:, :0]

    return postings.repartition("token").sortWithinPartitions("token", "uid").mapInArrow(run, "token bigint, uid bigint, n bigint, pos bigint, hub bigint")


def mixed_members(entries: DataFrame, labels: DataFrame, signs: DataFrame) -> DataFrame:
    """(token, i, j, block, uid, n, pos, label, sign): the entries of the lists that hold several classes, dealt to tasks (i, j) of two blocks each."""
    rows = entries.join(labels.select(F.col("node").alias("uid"), "label"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    sizes = rows.groupBy("token", "label").agg(F.count("*").alias("k"))
    mixed = (sizes.groupBy("token").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("k")).filter("top.k < k")
             .select("token", F.col("top.label").alias("top"), (F.col("k") <= BLOCK).alias("one"),
                     F.ceil((F.col("k") - F.col("top.k")) / BLOCK).alias("others"), F.ceil(F.col("top.k") / BLOCK).alias("tops")))
    is_top, salt = F.col("label") == F.col("top"), F.xxhash64("uid")
    block = F.when(F.col("one"), F.lit(0)).when(is_top, F.col("others") + F.pmod(salt, "tops")).otherwise(F.pmod(salt, "others"))
    last = F.when(F.col("one"), F.lit(0)).when(is_top, F.col("others") - 1).otherwise(F.col("others") + F.col("tops") - 1)
    return (rows.join(mixed, "token").join(signs.select("uid", "sign"), "uid")
            .select("token", "uid", "n", "pos", "label", "sign", block.cast("int").alias("block"), F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("other"))
            .select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "uid", "n", "pos", "label", "sign"))


def met_in_blocks(members: DataFrame, most: int, percent: int) -> DataFrame:
    """(a, b) of different classes in one task that sizes, places and folded signatures allow."""
    def run(t: pa.Table) -> pa.Table:
        block, uid, n, pos, label, i, j = (np.asarray(t.column(c).to_numpy()) for c in ("block", "uid", "n", "pos", "label", "i", "j"))
        order = np.argsort(n, kind="stable")
        block, uid, n, pos, label = block[order], uid[order], n[order], pos[order], label[order]
        sign = np.frombuffer(b"".join(t.column("sign").to_pylist()), dtype="<u8").reshape(len(n), -1)[order]
        # signatures that were shorter before they were filled up compare with their like alone
        bits = np.minimum(1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64)), 8 * SIGN_BYTES)
        upto = np.searchsorted(n, 100 * n // percent, side="right")
        found = [np.zeros((2, 0), dtype=np.int64)]
        for k in range(len(n)):
            r = np.arange(k + 1, upto[k])
            r = r[(label[r] != label[k]) & ((block[r] != block[k]) | (i[0] == j[0]))]
            r = r[possible(n[k], pos[k], n[r], pos[r], most, percent)]
            apart = np.where(bits[r] == bits[k], np.bitwise_count(sign[r] ^ sign[k]).sum(1, dtype=np.int64), 0)
            r = r[apart <= n[k] + n[r] - 2 * needed(n[k], n[r], percent)]
            found.append(np.stack([np.minimum(uid[k], uid[r]), np.maximum(uid[k], uid[r])]))
        p = np.concatenate(found, axis=1)
        return pa.table({"a": pa.array(p[0], pa.int64()), "b": pa.array(p[1], pa.int64())})

    return members.groupBy("token", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def likely(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of `pairs` whose signatures allow a link: an exact filter that needs a small part of the sets' bytes."""
    def run(batches):
        for b in batches:
            na, nb, x, y = (b.column(c).to_pylist() for c in ("na", "nb", "xa", "xb"))
            ok = [differing(s, t) <= m + n - 2 * needed(m, n, percent) for m, n, s, t in zip(na, nb, x, y, strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda of: table.select(F.col("uid").alias(of), F.col("n").alias("n" + of), F.col("sign").alias("x" + of))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a bigint, b bigint")


def sets_of(docs: DataFrame, heads: DataFrame, pairs: DataFrame, text: str, doc: str, size: int) -> DataFrame:
    """(uid, shingles): the sets of the nodes in `pairs`, taken again from a document of each.

    The keys of the documents asked for are broadcast while they are few by count, and joined by shuffle beyond that.
    """
    def run(batches):
        for b in batches:
            for at, words in words_by_block(b.column("text"), lower=True):
                sets = shingle_sets(words, size)
                yield pa.RecordBatch.from_arrays([b.column("uid").slice(at, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["uid", "shingles"])

    uids = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    asked = cut(heads.join(uids, "uid", "left_semi").select("uid", F.col("doc_id").alias("_doc"), "th"))
    if asked.count() <= BROADCAST_KEYS:
        asked = F.broadcast(asked)
    rows = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).withColumn("_th", F.xxhash64(F.coalesce("text", F.lit(""))))
    return (rows.join(asked, (rows["_th"] == asked["th"]) & rows["doc_id"].eqNullSafe(asked["_doc"])).select("uid", "text").mapInArrow(run, "uid bigint, shingles binary")
            .groupBy("uid").agg(F.min("shingles").alias("shingles")))  # repeated rows have the same


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of `pairs` whose sets link."""
    def linked(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
        at = np.searchsorted(x, y)
        both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches):
        for b in batches:
            ok = [linked(x, y) for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(sets.select(F.col("uid").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint"))


def join(docs: DataFrame, text: str = "text", doc: str = "doc_id", size: int = SHINGLE, percent: int = PERCENT, most: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per document: the smallest id that links lead to, its own included.

    Texts that are null or without words have no set and link with nothing: their component is their own id.  Rows with one set link, copies and repeated rows
    included.  Null ids stay null and give no component its name; a component of them alone has none.  Other columns are not carried, an empty table gives an
    empty table.  `most` sets the boundary between small and large sets, which is chosen by cost otherwise; it changes no result.
    """
    table = cut(sketched(docs, frequent_shingles(docs, text, size), text, doc, size, percent))
    heads = cut(table.filter("n > 0").groupBy("node").agg(F.min(F.struct("uid", "doc_id", "th")).alias("h")).select("h.*"))
    rows = table.select("uid", "n", "rare", "prefix", "whole")
    small = cut(rows.filter(F.col("n").between(1, MOST_SMALL)).join(heads.select("uid"), "uid", "left_semi"))
    most = boundary(small, percent) if most is None else most
    posted = (rows.filter(100 * F.col("n") >= percent * (most + 1)).join(heads.select("uid"), "uid", "left_semi")
              .select("uid", "n", "rare", F.posexplode("prefix").alias("at", "token")))
    entry = [F.col("token"), F.col("uid"), F.col("n"), (F.col("at") + 1).cast("bigint").alias("pos")]
    met = cut(met_in_lists(posted.filter("at < rare").select(*entry), most, percent))
    often = cut(posted.filter("at >= rare").select(*entry))
    hubs = often.groupBy("token").agg(F.min(F.struct("uid", "n", "pos")).alias("hub"), F.count("*").alias("k")).filter("k > 1")
    least, greatest = F.least("n", "hub.n"), F.greatest("n", "hub.n")
    fits = ((100 * least >= percent * greatest) & (greatest > most)
            & ((100 + percent) * (1 + F.least(F.col("n") - F.col("pos"), F.col("hub.n") - F.col("hub.pos"))) >= percent * (least + greatest)))
    with_hubs = often.join(hubs, "token").filter(fits & (F.col("uid") != F.col("hub.uid"))).select(F.col("hub.uid").alias("a"), F.col("uid").alias("b"))
    signs = table.select("uid", "n", "sign")
    pairs = cut(met.filter("hub is not null").select(F.col("uid").alias("a"), F.col("hub").alias("b")).union(with_hubs).distinct())
    entries = met.filter("hub is null").drop("hub").union(often)

    def linked(candidates: DataFrame) -> DataFrame:
        some = cut(likely(candidates, signs, percent))
        return confirmed(some, cut(sets_of(docs, heads, some, text, doc, size)), percent)

    labels = components(cut(light_links(small, most, percent).union(linked(pairs))))
    found = cut(linked(met_in_blocks(mixed_members(entries, labels, table.select("uid", F.col("short").alias("sign"))), most, percent).join(pairs, ["a", "b"], "left_anti")))
    if not found.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).filter("a <> b").union(found))
    named = table.select("doc_id", "uid", "n", "node")
    head = named.filter("n > 0").groupBy("node").agg(F.min("uid").alias("head"), F.min("doc_id").alias("least"))
    of = head.join(labels.withColumnRenamed("node", "head"), "head", "left").withColumn("label", F.coalesce("label", "head"))
    least_of = of.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = of.join(least_of, "label").select("node", "component_id")
    return named.join(ids, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
