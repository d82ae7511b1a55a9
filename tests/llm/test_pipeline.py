"""The pipeline and the registered queries."""

import re
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from framelark.llm.queries import ORACLES, QUERIES
from framelark.llm.tokens import encoder

SMALL = "/root/testdata/sf0.001"


def test_thirteen_operators_and_the_pipeline():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES if q.startswith("op")) == list(range(1, 14))
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def stages(spark):
    """The documents after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = spark.createDataFrame([(9_000_001, None, "en", "x", 0), (9_000_002, "...!", None, None, 4), (9_000_003, "", "en", "x", 0)], docs.schema)
    docs = docs.unionByName(more)
    found = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stage(spark, found[-1], SMALL).cache())
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_language_stage_drops_only_texts_of_no_language(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(before) - set(after) == {9_000_001, 9_000_002, 9_000_003}


def test_one_of_each_group_of_copies_stays(stages):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    before, after = texts(stages[1]), texts(stages[2])
    bags = {i: shingles(t) for i, t in before.items()}
    parent = {i: i for i in before}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    ids = sorted(bags)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if len(bags[i] & bags[j]) >= 0.8 * len(bags[i] | bags[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert set(after) == {root(i) for i in ids}


def test_personal_values_are_gone_and_nothing_else(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert set(before) == set(after)
    personal = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+1 \(\d{3}\) \d{3}-\d{4}")
    changed = [i for i in before if before[i] != after[i]]
    for i, t in before.items():
        assert all(v.rstrip(".") not in after[i] for v in personal.findall(t))
        assert re.sub(r"[\w+@.()-]*\d[\w+@.()-]*|\w+@\S+", "", t) == re.sub(r"[\w+@.()-]*\d[\w+@.()-]*|\w+@\S+", "", after[i])
    assert changed and all(re.search(r"\d", before[i]) for i in changed)


def test_the_mix_near_its_targets(stages):
    size = lambda t: len(t.encode().split())
    before, after = stages[3].collect(), stages[4].collect()
    total = sum(size(r.text) for r in before)
    assert abs(sum(size(r.text) for r in after) - 1.5 * total) <= 0.02 * total + max(size(r.text) for r in before) * 20
    assert max(Counter(r.doc_id for r in after).values()) <= 2 and set(map(tuple, after)) <= set(map(tuple, before))


def test_packing_covers_the_mix(stages):
    n = sum(len(encoder()(r.text or "")) + 1 for r in stages[4].collect())
    pieces = stages[5].collect()
    sequences = Counter()
    for r in pieces:
        sequences[r.sequence_id] += r.length
    assert sum(sequences.values()) == n and max(sequences.values()) <= 1024 and len(sequences) <= n / 1024 * 1.05 + 2


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = QUERIES[name](spark, SMALL)
    cursor = con.execute(ORACLES[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == sorted(found.columns)
    assert Counter(map(tuple, found.select(*order).collect())) == Counter(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.startswith("op")))
def test_every_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, SMALL)
    number = int(re.match(r"op(\d+)_", name)[1])
    table = "embeddings" if number in (3, 11, 12, 13) else "documents"
    rows = spark.read.parquet(f"{SMALL}/{table}.parquet")
    if number in (3, 13):
        every, k = (20, 20) if number == 3 else (100, 10)
        assert found.count() == k * rows.filter(f"vec_id % {every} = 0").count()
    elif table == "embeddings":
        assert sorted(r.vec_id for r in found.collect()) == sorted(r.vec_id for r in rows.collect())
    else:
        assert {r.doc_id for r in found.select("doc_id").distinct().collect()} == {r.doc_id for r in rows.select("doc_id").collect()}
