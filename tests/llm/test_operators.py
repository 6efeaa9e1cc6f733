"""The text operators against brute force, and their odd cases: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import base64
import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from netorigin.llm import bpe, fingerprints, licenses, neardup, packing, quality, secrets, substrings, toxicity, urls
from netorigin.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = np.random.default_rng(3)
VOCAB = [*["the", "of", "and"] * 8, *("w%d" % i for i in range(200))]


def prose(n):
    return " ".join(RNG.choice(VOCAB, n))


BASE = prose(120)
NEAR = " ".join(["changed" if i == 60 else w for i, w in enumerate(BASE.split())])
ROWS = [
    (1, BASE), (2, NEAR), (3, BASE), (3, BASE), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, prose(3000)), (None, prose(40)), (None, BASE),
    (9, "x " * 50 + "\nsame line here\nsame line here\n"), (10, "Token = 'abcdefghijkl' AKIAABCDEFGHIJKLMN 0123456789abcdef, password: short"),
    (11, "éà 漢字かな " * 30), (12, prose(30) + " " + " ".join(BASE.split()[10:50]) + " " + prose(30)), (13, "a" * 3000), (14, "CC-BY; All rights\nreserved. cc by"),
]


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(i, t, "en", "kept", 7, "clash") for i, t in ROWS]
    return spark.createDataFrame(extra, "doc_id bigint, text string, lang string, kept string, n_words int, spans string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_quality(docs, none):
    got = quality.quality(docs)
    assert got.count() == len(ROWS) and quality.quality(none).count() == 0
    for r in got.collect():
        w, seen, cover = WORD.findall(r.text or ""), defaultdict(list), set()
        for i in range(len(w) - 7):
            seen[tuple(w[i:i + 8])].append(i)
        for at in seen.values():
            if len(at) > 1:
                cover.update(x for i in at for x in range(i, i + 8))
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w)) and not (r.base_failed and r.kept)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.filter("text is null").count() == 0 and kept.filter("doc_id = 1").count() == 1


def test_packing(docs, none):
    path = tokenizer_file("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = packing.pack(docs.repartition(2), path).collect()
    assert packing.pack(none, path).count() == 0
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids)
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i in {i for i, _ in ROWS if i not in (3, None)}:
        want = [*t.encode(dict(ROWS)[i] or "", add_special_tokens=False).ids, 1]
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for p in parts for x in p.ids] == want and {p.doc_tokens for p in parts} == {len(want)}
        assert [p.start for p in parts] == list(np.cumsum([0, *(p.length for p in parts[:-1])]))
    for s in by_seq.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == list(np.cumsum([0, *(r.length for r in s[:-1])]))
        total = sum(r.length for r in s)
        assert total <= 2048 and total & (total - 1) == 0


def test_sum_of_squares_level():
    """Every placement is one that makes the sum of squared counts least."""
    p = packing.Packer(16)
    for size in RNG.integers(1, 16, 300):
        before = p.levels.copy()
        level = p._level(int(size))
        def cost(lv):
            n = before.copy()
            n[lv] -= lv > 0
            n[lv + size] += lv + size < 16
            return int((n[1:16] ** 2).sum())
        legal = [0, *(lv for lv in range(1, 17 - size) if before[lv])]
        assert level in legal and cost(level) == min(map(cost, legal))
        list(p.add(0, np.zeros(size, dtype="<u4")))


def test_bpe(spark, docs, none):
    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect():
        raw = bytes(r.decoded)
        want = e.encode_ordinary(raw.decode())
        assert r.ids == want and r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()
        if r.doc_id not in (3, None):
            assert raw.decode() == (dict(ROWS)[r.doc_id] or "")
    assert bpe.encode(none, path, public_tokenizers.PATTERN).count() == 0


def test_substrings(docs, none):
    first = {}
    for i, t in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)):
        w = WORD.findall(t or "")
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p:p + 13]), i)
    want = []
    for i, t in ROWS:
        w, gone = WORD.findall(t or ""), set()
        for p in range(len(w) - 12):
            f = first[tuple(w[p:p + 13])]
            if f is not None and (i is None or f < i):
                gone.update(range(p, p + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i if i is not None else -1, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substrings.drop_repeats(docs)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == sorted(want)
    assert got.columns == ["doc_id", "text", "lang", "kept", "spans", "n_words", "n_removed", "kept_text", "kept_sha256"]
    assert substrings.drop_repeats(none).count() == 0


def test_secrets(docs, none):
    py = {r.kind: (re.compile(r.pattern), r.group, r.least) for r in secrets.RULES}
    got = secrets.scan(docs)
    assert got.count() == len(ROWS) and secrets.scan(none).count() == 0
    for r in got.select("text", secrets.as_text(F.col("spans")).alias("s")).collect():
        spans = sorted((m.start(), n, m.end(), k) for n, (k, (p, g, least)) in enumerate(py.items()) for m in p.finditer(r.text or "") if len(m.group(g)) >= least)
        assert r.s == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    assert clean.filter("doc_id = 10").first().text == "[SECRET]' [SECRET] [SECRET], password: short"
    assert clean.filter("doc_id = 1").first().text == BASE


def test_whole_keys_and_long_tokens_go(spark):
    body = [base64.b64encode(RNG.bytes(48)).decode() for _ in range(25)] + ["c2hvcnQ="]
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    cut = "\n".join([head, *body])
    jwt = "eyJ" + "a" * 1500 + ".eyJ" + "b" * 9000 + "." + "c" * 1200
    made = [("\n".join([head, *body, end]), ""), ("\n".join([head, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", "", *body, end]), ""),
            ("\\n".join([head, *body, end]), '"'), (" ".join([head, *body, end]), " and on"), ("\r\n".join([head, *body]), "\r\n\r\nnext words"),
            (cut, "\n\nProse after it"), (cut, "\nand words after it"), ("\n".join([head, "Proc-Type: 4,ENCRYPTED", "", *body]), "\n\nnext"), (head, " is its first line"), (head, "\nNote: no key here\n"),
            ("\n".join([head, *["> " + x for x in body], end]), "\n"), (jwt, " x"), ("ghp_" + "a" * 900, " x"), ("xoxb-" + "1" * 900, " x"), ("sk_live_" + "Z" * 900, " x")]
    rows = [(i, "before " + s + rest) for i, (s, rest) in enumerate(made)]
    docs = spark.createDataFrame([*rows, (99, head + "\n" + "x - y\n" * 200_000)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert {i: got[i] for i, _ in rows} == {i: "before [SECRET]" + rest for i, (_, rest) in enumerate(made)}
    assert got[99].startswith("[SECRET]\nx - y")
    for r in secrets.scan(docs).select("text", secrets.as_text(F.col("spans")).alias("s")).collect():
        spans = sorted((m.start(), n, m.end(), k.kind) for n, k in enumerate(secrets.RULES) for m in re.finditer(k.pattern, r.text) if len(m.group(k.group)) >= k.least)
        assert r.s == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def test_trigram_queries_hold_for_every_match():
    made = {"assign": "API_KEY = 'abcdefghijkl'", "access": "AKIAABCDEFGHIJKLMN", "github": "ghp_" + "a" * 36, "slack": "xoxb-1234567890", "google": "AIza" + "b" * 35,
            "stripe": "sk_live_" + "1" * 16, "jwt": "eyJ" + "a" * 10 + ".eyJ" + "b" * 10 + "." + "c" * 10, "private_key": "-----BEGIN RSA PRIVATE KEY-----"}
    for r in secrets.RULES:
        q = secrets.trigram_query(r.pattern)
        if r.kind in made:
            assert re.search(r.pattern, made[r.kind]) and any(all(t in made[r.kind].lower() for t in c) for c in q) and frozenset() not in q
        else:
            assert q == frozenset([frozenset()])


def test_licenses(docs, none):
    phrases = {p: [x for x in p.split()] for p in licenses.PHRASES}
    got = licenses.licenses(docs).collect()
    assert len(got) == len(ROWS) and licenses.licenses(none).count() == 0
    by = dict(ROWS)
    for r in got:
        if r.doc_id in (3, None):
            continue
        low = re.sub("[A-Z]", lambda m: m[0].lower(), by[r.doc_id] or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(i, licenses.PHRASES[p]) for p, x in phrases.items() for i in range(len(w)) if w[i:i + len(x)] == x]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None)
        assert r.base_labels == ",".join(sorted({n for _, n in at})) and 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(","))


def test_license_notice_with_words_put_in(spark):
    t = prose(20) + " Licensed under the (well known) Apache License, Version 2.0. " + prose(20)
    r = licenses.licenses(spark.createDataFrame([(1, t)], "doc_id bigint, text string")).first()
    assert r.labels == "apache" and r.n_base == 0


def test_toxicity(spark, docs, none):
    bad = ["vile", "scum", "idiot"]
    rows = [(i, prose(40) + (f" {bad[i % 3]} {bad[(i + 1) % 3]}" if i % 4 == 0 else "")) for i in range(600)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0 if i % 8 == 0 else 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    m = toxicity.fit(d, toxicity.grades(labels), sample=400)
    held = [r for r in toxicity.score(d, m).collect() if r.doc_id >= 400]
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.severity <= 2 for r in held) and m.thresholds[0] < m.thresholds[1]
    assert toxicity.score(docs, m).count() == len(ROWS) and toxicity.score(none, m).count() == 0
    assert toxicity.fit(none, toxicity.grades(labels)).weights == {}


def test_urls(spark):
    rows = [(1, "http://A.com/x?q#f"), (2, None), (3, "no scheme"), (4, "https://x.example.com/en/1"), (5, "https://www.example.com/en/1"), (6, "http://b.net/es/"),
            (7, "http://b.net/es"), (8, "http://com"), (9, "http://q.org/en/z"), (9, "http://q.org/en/z")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame([(*r, "h") for r in rows], "page_id bigint, url string, host string")).collect()}
    assert [got[i].rule for i in range(1, 10)] == ["com/", None, None, "example.com/en/", "www.example.com/en/", "net/es/", None, None, None]
    assert [got[i].verdict for i in (1, 4, 5, 6)] == ["allow", "block", "allow", "block"]
    assert (got[1].host, got[1].path, got[2].host, got[3].path) == ("a.com", "/x", "", "")
    assert urls.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_fingerprints(spark, docs, none):
    got = fingerprints.compare_edited(docs)
    assert got.count() == len(ROWS) and fingerprints.compare_edited(none).count() == 0
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want.append((str(i), len(t), hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got.collect()) == sorted(want)
    a, b = prose(900).split(), prose(900).split()
    d = spark.createDataFrame([(" ".join(a + b[:300]), " ".join(a), " ".join(b))], "x string, y string, z string").select(
        *[fingerprints.sketch(F.col(c)).alias(c) for c in "xyz"])
    r = d.select(fingerprints.resemblance(F.col("x"), F.col("y")).alias("j"), fingerprints.containment(F.col("y"), F.col("x")).alias("c"),
                 fingerprints.distinct_count(F.col("x")).alias("n"), (fingerprints.merge(F.col("y"), F.col("z")) == fingerprints.merge(F.col("z"), F.col("y"))).alias("m")).first()
    assert abs(r.j - 0.75) < 0.15 and r.c > 0.85 and abs(r.n - 1196) < 300 and r.m


def test_near_dedup(docs, none):
    got = neardup.classes(docs, keep_row=True).collect()
    assert len(got) == len(ROWS) and neardup.classes(none).count() == 0
    cls = defaultdict(set)
    for r in got:
        cls[r.class_id].add(r.doc_id)
    assert cls[1] == {1, 2, 3, None} and cls[4] == {4, 5, 6} and cls[12] == {12}
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(cls)


def test_near_dedup_finds_pairs_behind_a_common_passage(spark):
    """Texts of one bucket that are alike to none of its first members: classes equal brute force over all pairs."""
    passage, rows = prose(110), []
    for i in range(70):
        own = ["own%d_%d" % (i, j) for j in range(60)]
        rows += [(2 * i, passage + " " + " ".join(own)), (2 * i + 1, passage + " " + " ".join([*own[:40], "x", *own[41:]]))]
    codes = [(neardup.KNOWN.of(t.split()) >> np.uint64(48)).astype("<u2").tobytes() for _, t in rows]
    want = {i: i for i, _ in rows}
    for i, j in itertools.combinations(range(len(rows)), 2):
        if neardup.alike(codes[i], codes[j]):
            low, high = sorted((want[i], want[j]))
            want = {k: low if v == high else v for k, v in want.items()}
    assert len(set(want.values())) == 70
    table = neardup.cut(neardup.sketched(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("keys", F.array(F.lit(1).cast("bigint"))))
    first = neardup.components(neardup.cut(neardup.links(table)))  # one bucket for all: its first members find few links
    assert first.count() < 10
    label = {r.node: r.label for r in neardup.joined_classes(table, first).collect()}
    node = {r.doc_id: r.node for r in table.collect()}
    least = {}
    for i, _ in rows:
        least.setdefault(label[node[i]], i)
    assert {i: least[label[node[i]]] for i, _ in rows} == want


def test_near_dedup_of_one_template(spark):
    """Texts of one template, all nearly alike: every edited copy is found behind the others, also where blocks are small."""
    rng, rows = np.random.default_rng(11), []
    template = ["t%d" % i for i in range(400)]
    for i in range(500):
        a = template + ["own%d_%d" % (i, j) for j in range(50)]
        b = list(a)
        for k in rng.choice(len(a), 9, replace=False):
            b[k] = "edit%d_%d" % (i, k)
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    codes = [(neardup.KNOWN.of(t.split()) >> np.uint64(48)).astype("<u2") for _, t in rows]
    sets = [np.unique(neardup.runs(c.astype(np.uint64), 5)) for c in codes]
    both = neardup.common(sets)
    for i, j in rng.integers(0, len(rows), (500, 2)):
        assert i == j or both[i, j] == len(np.intersect1d(sets[i], sets[j]))
    want = {i: i for i, _ in rows}
    size = np.array([len(x) for x in sets])
    for i, j in zip(*np.nonzero(np.triu(both / (size[:, None] + size[None, :] - both) >= neardup.SIMILARITY, 1)), strict=True):
        if want[i] != want[j] and neardup.alike(codes[i].tobytes(), codes[j].tobytes()):
            low, high = sorted((want[i], want[j]))
            want = {k: low if v == high else v for k, v in want.items()}
    assert sum(want[2 * i] == want[2 * i + 1] for i in range(500)) > 400 and len(set(want.values())) > 400
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == want


def test_mixed_buckets_in_small_blocks(spark, monkeypatch):
    """All nodes of different classes meet in some task, however the blocks are cut."""
    nodes = [bytes([i]) for i in range(40)]
    table = spark.createDataFrame([(x, b"ab", [1]) for x in nodes], "node binary, codes binary, keys array<bigint>")
    labels = spark.createDataFrame([(x, b"\x00") for x in nodes[:25]], "node binary, label binary")
    for block in (4, 30, 100):
        monkeypatch.setattr(neardup, "BLOCK", block)
        met = defaultdict(set)
        for r in neardup.mixed_members(table, labels).collect():
            met[r.i, r.j].add(bytes(r.node))
        pairs = {p for v in met.values() for p in itertools.permutations(v, 2)}
        assert all((a, b) in pairs for a in nodes for b in nodes[25:] if a != b)


def test_alignment_is_edit_distance():
    for _ in range(200):
        a, b = (RNG.integers(0, 4, RNG.integers(0, 25)) for _ in range(2))
        d = np.arange(len(b) + 1)
        for x in a:
            n = [d[0] + 1]
            for j, y in enumerate(b):
                n.append(min(d[j] + (x != y), d[j + 1] + 1, n[j] + 1))
            d = n
        for most in (3, 10, 40):
            assert neardup.edits(a, b, most) == min(d[-1], most + 1)
