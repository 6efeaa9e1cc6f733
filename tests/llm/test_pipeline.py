"""The pipeline and the SQL of the text queries on the smallest given tables."""

import itertools
import os
import re

import duckdb
import pytest
from check_sql import compare, duck_views
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from netorigin.llm import neardup, secrets
from netorigin.llm.queries import tokenizer_file

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op12_ngram_join", "op13_centroid_clusters"])
def test_twin(spark, name):
    assert compare(entry.queries()[name](spark, FOLDER), duck_views(FOLDER), entry.oracle_sql()[name]) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first, left = docs, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, FOLDER).write.parquet(out := str(tmp_path / str(i)))
        docs = spark.read.parquet(out)
        assert docs.dtypes == first.dtypes
        left.append(docs.count())
    assert first.count() > left[0] > left[1] >= left[2] == left[3]
    assert docs.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == left[3]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def likely_alike(a, b):
    x, y = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    if not x & y or len(x & y) < neardup.SIMILARITY * len(x | y):
        return False
    row = list(range(len(b) + 1))  # plain edit distance
    for i, u in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, v in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (u != v))
    return row[-1] <= (1 - neardup.SIMILARITY) * max(len(a), len(b)) + 1e-9


def plain_stages(rows, kept):
    """The first four stages without Spark: {doc_id: text} after each."""
    out = [{i: t for i, t in rows.items() if i in kept}]
    words = {i: WORD.findall(t or "") for i, t in out[0].items()}
    top = {i: i for i in words}
    for i, j in itertools.combinations(sorted(words), 2):
        if top[i] != top[j] and (words[i] == words[j] or likely_alike(words[i], words[j])):
            low, high = sorted((top[i], top[j]))
            top = {k: low if v == high else v for k, v in top.items()}
    out.append({i: t for i, t in out[0].items() if top[i] == i})
    first, left = {}, {}
    for i in sorted(out[1]):
        for p in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][p:p + 13]), i)
    for i, t in out[1].items():
        gone = {k for p in range(len(words[i]) - 12) if first[tuple(words[i][p:p + 13])] < i for k in range(p, p + 13)}
        if len(gone) < len(words[i]) or not gone:
            left[i] = t if not gone else " ".join(w for k, w in enumerate(words[i]) if k not in gone)
    out.append(left)
    clean = {}
    for i, t in left.items():
        spans = sorted((m.start(), m.end()) for r in secrets.RULES for m in re.finditer(r.pattern, t or "") if len(m.group(r.group)) >= r.least)
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        at, parts = 0, []
        for a, b in merged:
            parts += [t[at:a], "[SECRET]"]
            at = b
        clean[i] = t if not merged else "".join(parts) + t[at:]
    out.append(clean)
    return out


def test_against_plain_python(spark, tmp_path):
    """Ids and texts after each of the first four stages, and the ids of the packed pieces, are those of a plain version."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    head = given.orderBy("doc_id").limit(4).collect()
    extra = [(100_000 + k, r.text + more, r.lang, r.source, 0) for k, (r, more) in enumerate(zip(head, ("", " AKIAABCDEFGHIJKLMN", " password = 'abcdefghijkl123'", " x"), strict=True))]
    docs = given.unionByName(spark.createDataFrame(extra, given.schema))
    docs.withColumn("n_chars", F.length("text").cast("bigint")).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    kept = {r[0] for r in con.sql(f"select doc_id from ({entry.oracle_sql()['op1_quality_rules']}) where kept").fetchall()}
    want = plain_stages(rows, kept)
    assert len(want[0]) > len(want[1]) > 50
    for i, ((name, stage), state) in enumerate(zip(corpus_pipeline.STAGES[:-1], want, strict=True)):
        stage(spark, docs, FOLDER).write.parquet(out := str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(out)
        assert {r.doc_id: r.text for r in docs.collect()} == state, name
    lib = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids, places = {}, {}
    for r in sorted(pieces, key=lambda r: r.start):
        assert r.start == len(ids.setdefault(r.doc_id, []))
        ids[r.doc_id] += r.ids
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert ids == {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in want[-1].items()}
    for parts in places.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 2048
