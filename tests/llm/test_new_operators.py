"""Token alignment, the n-gram join and centroid clustering against brute force, and their odd cases."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from netorigin.llm import alignment, centroids, ngramjoin, packing, secrets, substrings, toxicity, urls
from netorigin.llm.queries import tokenizer_file

A, B, PATTERN = "byte_bpe_50k.json", "piece_bpe_32k.model", public_tokenizers.PATTERN
DOCS = "doc_id bigint, text string, uid string, token int, pairs string, node string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", 2) for i, t in rows], DOCS)


# --- token alignment


def mixed_text(rng):
    kinds = ["ab cd  '  \n\t ", "éß漢字 😀", "0123 456", "<s></s>", "▁\x00", "'s 're I'LL", "the and of "]
    return "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([1, 2, 9, 60])))


def align_rows():
    rng = random.Random(4)
    odd = [None, "", " ", "  ", " a", "a  ", "<|endoftext|> a <s> b </s> <0x41>", "x▁y", "\n\nnew\n lines ", "é" * 40, "a" * 3000, "the cat " * 3000]
    return [*enumerate([*odd, *(mixed_text(rng) for _ in range(60))]), (None, "the cat"), (3, "the cat"), (3, "the cat")]


def align_brute(rows):
    a = Tokenizer.from_file(tokenizer_file(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B))
    left, right = alignment.sides(tokenizer_file(A), PATTERN, tokenizer_file(B))
    counts, each = {}, []
    for _, t in rows:
        x, y = ([], []) if not t else (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t))
        if any(b"".join(s.tokens[i] for i in ids) != (" " + t).encode() for s, ids in ((left, x), (right, y)) if t):
            x = y = []
        ends = [list(itertools.accumulate(len(s.tokens[i]) for i in ids)) for s, ids in ((left, x), (right, y))]
        links = [(x[i], y[j]) for i, e in enumerate(ends[0]) for j in [ends[1].index(e) if e in ends[1] else None] if j is not None]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
            i, j = p, q
        each.append((x, y, groups, links))
        for k in links:
            counts[k] = counts.get(k, 0) + 1
    most = {}
    for (_, q), n in counts.items():
        most[q] = max(n, most.get(q, 0))
    out = []
    for (doc, _), (x, y, groups, links) in zip(rows, each, strict=True):
        text = ";".join(groups)
        out.append((doc, len(x), len(y), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links),
                    hashlib.sha256(text.encode()).hexdigest() if x else "", text))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_alignment(spark):
    rows = align_rows()
    got = alignment.align(frame(spark, rows).repartition(3), tokenizer_file(A), PATTERN, tokenizer_file(B), keep_groups=True)
    want = align_brute(rows)
    assert order(got.collect()) == order(want)
    assert sum(r[1] == 0 for r in want) < 30
    assert alignment.align(frame(spark, []), tokenizer_file(A), PATTERN, tokenizer_file(B)).collect() == []


def test_lockstep_lanes():
    rng = np.random.default_rng(1)
    for total in (0, 1, 5, alignment.LANE, 3 * alignment.LANE + 7, 50_000):
        a, b = (np.unique(np.append(rng.integers(1, total + 1, total // 3), total)) if total else np.zeros(0, dtype=np.int64) for _ in "ab")
        stops = np.unique(np.append(rng.choice(np.intersect1d(a, b), 3), total)) if total else np.zeros(1, dtype=np.int64)
        i, j = alignment.lockstep(a, b, np.append(0, stops[:-1]), stops)
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


# --- n-gram join


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def join_brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(words, places, rng):
    out = list(words)
    for p in places:
        out[p] = "e%d" % rng.integers(1_000_000)
    return " ".join(out)


@pytest.fixture(scope="module")
def join_rows():
    rng = np.random.default_rng(6)
    word = lambda n: ["w%d" % x for x in rng.integers(0, 5000, n)]
    texts = [None, "", " \t", "one", "ONE", "one two", "two one", "a a a a a", "a a a a a a a", "é É", "x y z v w"]
    for n in [*range(5, 30), 60, 200]:  # copies with edits at the ends, in the middle, and cut short: likeness on both sides of 0.8
        base = word(n)
        texts += [" ".join(base), " ".join(base).upper(), " ".join(base[1:]), " ".join(base[:-1]), " ".join([*base, "tail"]), " ".join([*base, *word(max(1, n // 5))]),
                  edited(base, [0], rng), edited(base, [n - 1], rng), edited(base, [n // 2], rng)]
    passage = word(60)
    texts += [" ".join([*word(8), *passage, *word(k)]) for k in range(0, 40)]  # a common passage: chains of links
    common = word(100)
    texts += [" ".join([*common, *word(24)]) for _ in range(30)]  # a template: no links
    long = word(6000)
    texts += [" ".join(long), edited(long, rng.integers(0, 6000, 100), rng), edited(long, rng.integers(0, 6000, 400), rng)]
    crowd = word(150)
    texts += [edited(crowd, rng.integers(0, 150, rng.integers(1, 8)), rng) for _ in range(120)]
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows = [(None if d is None else int(d), t) for d, t in rows]
    return [*rows, (None, " ".join(crowd)), (None, "only null"), (None, None), (5, " ".join(long)), (100, "one"), (100, "one"), (7, None)]


@pytest.mark.parametrize("most", [None, 0, 9])
def test_join(spark, join_rows, monkeypatch, most):
    monkeypatch.setattr(ngramjoin, "BLOCK", 8)  # lists of several blocks
    got = ngramjoin.join(frame(spark, join_rows).repartition(3), most=most).collect()
    want = join_brute(join_rows)
    assert order(got) == order(want)
    assert 20 < len({c for _, _, c in want}) < len(want) - 100


def test_join_odd_tables(spark):
    assert ngramjoin.join(frame(spark, [])).collect() == []
    assert order(ngramjoin.join(frame(spark, [(1, None), (None, ""), (1, " ")])).collect()) == order([(1, 0, 1), (None, 0, None), (1, 0, 1)])


def test_needed_and_filed():
    for a, b in itertools.product(range(1, 40), repeat=2):
        k = ngramjoin.needed(a, b)
        assert 100 * k >= 80 * (a + b - k) and 100 * (k - 1) < 80 * (a + b - k + 1)
    assert ngramjoin.filed(1, 0) == 0 and ngramjoin.filed(1, 5) == 1 and ngramjoin.filed(4, 24) == 1 + 1 and ngramjoin.filed(10, 10) == 10 + 10 + 45


def test_lists_over_batches(spark):
    """A list that goes on over many batches gives what it gives in one."""
    rng = np.random.default_rng(2)
    rows = [(int(t), int(u), 10, 1) for t in range(12) for u in rng.choice(1000, [1, 2, 3, 4, 9, 40][t % 6], replace=False)]
    posted = spark.createDataFrame(rows, "token bigint, uid bigint, n bigint, pos bigint").coalesce(1)
    got = {}
    for size in ("1", "2", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            m = ngramjoin.met_in_lists(posted, 0, 80).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        got[size] = (sorted({(r.uid, r.hub) for r in m if r.hub is not None}), sorted((r.token, r.uid) for r in m if r.hub is None))
    lists = {}
    for t, u, *_ in rows:
        lists.setdefault(t, []).append(u)
    want = set()
    for us in lists.values():
        us = sorted(us)
        want |= {(x, y) for x, y in itertools.combinations(us, 2) if len(us) <= ngramjoin.SHORT or x == us[0]}
    assert all(g == (sorted(want), sorted((t, u) for t, us in lists.items() if len(us) > ngramjoin.SHORT for u in us)) for g in got.values())


# --- centroid clustering


def cluster_brute(rows, count, rounds, dim):
    kept = [(i, [int(np.floor(256 * float(v))) if abs(v) < 1e15 else int(v) * 256 for v in x]) for i, x in rows
            if x is not None and len(x) == dim and all(v is not None and np.isfinite(v) for v in x)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    cs = [x for _, x in sorted(kept, key=key)[:count]]

    def assigned():
        return [min((sum((p - q) ** 2 for p, q in zip(x, c, strict=True)), k) for k, c in enumerate(cs)) for _, x in kept]

    for _ in range(rounds):
        at = [k for _, k in assigned()]
        for k in range(len(cs)):
            mine = [x for (_, x), a in zip(kept, at, strict=True) if a == k]
            if mine:
                cs[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    end = assigned()
    sums = [sum(d for d, k in end if k == c) for c in range(len(cs))]
    fit = lambda v: v if v < 1 << 63 else None
    return [(i, k, fit(d), fit(sums[k]), fit(sum(sums)), hashlib.sha256(",".join(map(str, cs[k])).encode()).hexdigest()) for (i, _), (d, k) in zip(kept, end, strict=True)]


@pytest.mark.parametrize("spread", [0.01, 1.0, 1e6, 1e20])
def test_clusters(spark, spread):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6)) * spread
    x[100:140] = x[99]  # equal vectors, equal centroids among them
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[3][1]), (None, rows[4][1]), (900, None), (901, []), (902, [1.0] * 5), (903, [1.0] * 7),
             (904, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (905, [float("nan")] * 6), (906, [float("inf")] + [0.0] * 5), (907, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, 3, 0, "x") for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, x int, label string").repartition(3)
    got = centroids.cluster(df, count=12, rounds=3, dimension=6)
    assert order(got.collect()) == order(cluster_brute(rows, 12, 3, 6))


def test_clusters_odd_tables(spark):
    shape = "vec_id bigint, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], shape)).collect() == []
    assert centroids.cluster(spark.createDataFrame([(1, None)], shape)).collect() == []
    few = centroids.cluster(spark.createDataFrame([(1, [0.5] * 64), (2, [1.5] * 64)], shape)).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in few) == [(1, 0, 0), (2, 0, 0)]


def test_search_skips(monkeypatch):
    """The inequalities do reject, and never a nearest centroid."""
    rng = np.random.default_rng(1)
    c = rng.integers(-500, 500, (60, 16)) + rng.integers(-2000, 2000, (60, 1))
    x = (c[rng.integers(0, 60, 2000)] + rng.integers(-60, 60, (2000, 16))).astype(np.float64)
    looked, plain = [], centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda a, b: looked.append(len(a)) or plain(a, b))
    which, d = centroids.Search.of(c.tolist()).nearest(x)
    full = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (which == full.argmin(1)).all() and (d == full.min(1)).all() and sum(looked) < 0.2 * full.size


# --- substring dedup on columns that clash with its own, and spans


def test_repeats_carry_any_column(spark):
    rng = np.random.default_rng(9)
    words = ["w%d" % x for x in rng.integers(0, 300, 200)]
    passage = words[50:80]
    rows = [(3, " ".join(words)), (7, "x y " + " ".join(passage) + "\n z"), (None, " ".join(passage[:13])), (2, None), (9, " ".join(passage[:12])), (7, "q " + " ".join(passage))]
    names = ["doc_id", "text", "_id", "_text", "_z", "row", "batch", "none", "found", "group", "removed_spans"]
    df = spark.createDataFrame([(i, t, *(f"{n}{k}" for n in names[2:])) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names[2:]))
    got = substrings.drop_repeats(df)
    assert got.columns == [*names, "n_words", "n_removed", "kept_text", "kept_sha256"]
    assert order(got.select(*names).collect()) == order(df.collect())
    found = {(r.doc_id, r.found.n_words): r.found for r in substrings.find_repeats(df).collect()}
    assert [tuple(s) for s in found[7, 33].removed_spans] == [(2, 30)] and found[7, 33].kept_text == "x y z"
    assert [tuple(s) for s in found[7, 31].removed_spans] == [(1, 30)] and found[None, 13].n_removed == 13
    assert found[3, 200].removed_spans == [] and found[3, 200].n_removed == 0 and found[9, 12].n_removed == 0 and found[2, 0].kept_text == ""


def test_packing_special_tokens(spark):
    """A special token written in a text is one id, as in the library."""
    lib = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    texts = ["a <|endoftext|> b", "A<|endoftext|>B", "<|ENDOFTEXT|> X", "x\x1cy\x1fz", "İI H̱ Σς　w", "'S 'RE <|startoftext|><|endoftext|>", "", None]
    got = packing.pack(frame(spark, list(enumerate(texts))).coalesce(1), tokenizer_file("word_bpe_49k.json")).collect()
    ids = {}
    for r in sorted(got, key=lambda r: r.start):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    assert ids == {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)} and 49407 in ids[0] + ids[5]


def test_signature_bounds_the_difference():
    rng = np.random.default_rng(3)
    for n, k in itertools.product((1, 5, 40, 500, 3000), (0, 1, 3, 50, 400)):
        common, x, y = (rng.integers(0, 2**63, m).astype(np.uint64) for m in (n, k, k // 2))
        a, b = (np.unique(np.concatenate([common, z])) for z in (x, y))
        apart = len(np.setxor1d(a, b))
        d = ngramjoin.differing(ngramjoin.signature(a), ngramjoin.signature(b))
        assert d <= apart and d == ngramjoin.differing(ngramjoin.signature(b), ngramjoin.signature(a)) and (d > 0 or apart == 0 or k < 5)


# --- url rules, columns that clash in redaction, repeated ids in a fit


def urls_brute(rows, support, confidence):
    """Verdicts of urls that no fixed rule decides: (token set, verdict) of the decided ones, all token combinations counted."""
    labelled, asked = [r for r in rows if r[1]], [r for r in rows if not r[1]]
    where = {}
    for i, (ts, _) in enumerate(labelled):
        for t in ts:
            where.setdefault(t, set()).add(i)
    least = max(1, -(-int(round(support * len(labelled) * 1000)) // 1000))
    where = {t: w for t, w in where.items() if len(w) >= least}
    rep = {t: min(u for u in where if where[u] == w) for t, w in where.items() if len({labelled[i][1] for i in w}) > 1}
    rules = []

    def rule(ts, rows_in):
        for v in ("allow", "block"):
            k = sum(labelled[i][1] == v for i in rows_in)
            if k >= least and k / len(rows_in) >= confidence:
                rules.append((tuple(sorted(ts)), v, k / len(rows_in), k / len(labelled)))

    for t, w in where.items():
        rule([t], w)
    one = {(r[0][0], r[1]): r[2] for r in rules}
    reps = sorted(set(rep.values()))
    for n in range(2, len(reps) + 1):
        for ts in itertools.combinations(reps, n):
            both = set.intersection(*(where[t] for t in ts))
            if both:
                rule(ts, both)
    rules = [r for r in rules if len(r[0]) == 1 or not any(one.get((t, r[1]), -1) >= r[2] for t in r[0])]
    out = []
    for ts, _ in asked:
        has = ts | {rep[t] for t in ts if t in rep}
        fit = [r for r in rules if set(r[0]) <= has]
        out.append(min(fit, key=lambda r: (-r[2], -r[3], -len(r[0]), r[0], r[1]))[1] if fit else "allow")
    return out


def test_mined_verdicts(spark):
    rng = random.Random(12)
    urls_ = []
    for _ in range(500):
        host = rng.choice(["x.example.com", "b.net", "www.example.com", "c.org", "d.org"])
        path = "/".join(p for p in ("en", "shop", "deals", "news", "misc", "top") if rng.random() < 0.45)
        urls_.append(f"http://{host}/{path}")
    urls_ += [f"http://q{i % 9}.net/es/a/b/c" for i in range(40)] + [f"http://q{i % 9}.io/a/b/k" for i in range(10)]
    df = spark.createDataFrame(list(enumerate(urls_)), "page_id bigint, url string")
    got = {r.page_id: r for r in urls.judge(df, support=0.03, confidence=0.7).collect()}

    def tokens(u):
        host, path = u[7:].partition("/")[::2]
        return {"h:" + x for x in re.split("[.-]+", host)} | {"p:" + x for x in re.split("[/._-]+", "/" + path) if not x.isdigit() and x}

    rows = [(tokens(u), got[i].verdict if got[i].rule else None) for i, u in enumerate(urls_)]
    want = iter(urls_brute(rows, 0.03, 0.7))
    assert [got[i].verdict for i in range(len(urls_)) if not got[i].rule] == [next(want) for r in rows if not r[1]]
    assert {got[i].verdict for i in range(len(urls_)) if not got[i].rule} == {"allow", "block"}


@pytest.mark.parametrize("parts", [16, 40])
def test_long_shared_paths(spark, parts):
    deep = "/".join(f"part{i}" for i in range(parts))
    rows = [f"http://a{i % 50}.com/x{i % 20}/y" for i in range(1000)] + [f"http://b{i}.net/es/{deep}/z{i}" for i in range(30)] + [f"http://free.org/{deep}"]
    rows += [f"http://b{i}.com/mixed/{deep}" for i in range(20)] + [f"http://b{i}.net/fr/mixed/{deep}" for i in range(20)]
    began = time.time()
    got = urls.judge(spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")).collect()
    assert len(got) == len(rows) and time.time() - began < 60


def test_redaction_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "key AKIAABCDEFGHIJKLMN end", "a", "b", "c"), (2, None, "d", None, "e")], "doc_id bigint, text string, spans string, row string, _d string")
    got = sorted(map(tuple, secrets.redact(df).collect()))
    assert secrets.redact(df).columns == df.columns and got == [(1, "key [SECRET] end", "a", "b", "c"), (2, None, "d", None, "e")]


def test_fit_of_repeated_ids(spark):
    rows = [(i % 40, f"{'vile ugly' if i % 4 == 0 else 'calm clear'} words of {i}") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id bigint, quality int, toxic int")
    models = [toxicity.fit(spark.createDataFrame(r, "doc_id bigint, text string").repartition(n), toxicity.grades(labels)) for r, n in ((rows, 1), (rows[::-1], 5))]
    assert models[0].weights == models[1].weights and models[0].thresholds == models[1].thresholds
