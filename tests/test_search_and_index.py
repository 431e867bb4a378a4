import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import index, search

SCHEMA = "chunk_id string, source_id string, source_file string, content string, message_id string, sender string, sent_date timestamp, page_number int, tax_topic string, entities array<string>, business_units array<string>, jurisdictions array<string>, tax_concepts array<string>, material_facts array<string>, evidence_type string, semantic_state string, search_score double"


def doc(k, content, entities=None, jurisdictions=None, state="SETTLED", topic="Nexus", page=4):
    return (f"SRC-{k}::c1", f"SRC-{k}", f"f{k}.pdf", content, None, None, None, page, topic, entities, None, jurisdictions, None, None, "Tax Memo", state, 0.5)


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame([doc(9, "payroll tax in New York", ["UnitA"], ["New York City"]), doc(10, "payroll payroll", ["UnitB"], None, "SUPERSEDED"), doc(11, "nothing here", None, ["Ohio"], None), doc(12, None)], SCHEMA)


def test_filters(chunks):
    kept = search.apply_filter(chunks, search.Filters(entities=("UnitA",), boost_jurisdictions=("Philadelphia",)))
    assert [r["source_id"] for r in kept.collect()] == ["SRC-9"]
    assert search.apply_filter(chunks, search.Filters(entities=("UnitA", "UnitB"))).count() == 2
    assert search.build_filter(search.Filters(boost_jurisdictions=("x",))) is None and search.Filters().is_empty()
    with pytest.raises(ValueError, match="boosts"):
        search.assert_filterable("jurisdictions")
    with pytest.raises(ValueError, match="not filterable"):
        search.assert_filterable("nonsense")


def test_bm25_against_formula(chunks):
    got = {r["chunk_id"]: r["keyword_score"] for r in search.bm25(chunks, "payroll york").collect()}
    texts = {r["chunk_id"]: (r["content"] or "").lower().split() for r in chunks.collect()}
    mean = sum(map(len, texts.values())) / len(texts)
    want = {}
    for key, words in texts.items():
        count, score = Counter(words), 0.0
        for t in ("payroll", "york"):
            df = sum(t in w for w in texts.values())
            score += math.log(1 + (4 - df + 0.5) / (df + 0.5)) * count[t] * 2.2 / (count[t] + 1.2 * (0.25 + 0.75 * len(words) / mean))
        if score:
            want[key] = score
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_search(chunks):
    assert [r["source_id"] for r in search.search(chunks, "payroll").collect()] == ["SRC-10", "SRC-9"]
    assert search.search(chunks.where("false"), "payroll").count() == 0
    assert search.search(chunks, "").count() == 0
    boosted = search.search(chunks, "payroll", search.Filters(boost_jurisdictions=("New York City",)), 1).collect()
    assert len(boosted) == 1
    states = {r["source_id"]: r["semantic_state"] for r in search.evidence(chunks).collect()}
    assert states["SRC-11"] == "UNKNOWN"


def test_no_jurisdiction_filter_in_plan(chunks):
    plan = search.apply_filter(chunks, search.Filters(entities=("UnitA",), boost_jurisdictions=("Ohio",)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Ohio" not in plan


def test_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0]), (5, None)], "vec_id long, embedding array<float>")
    assert {r["vec_id"]: round(r["vector_score"], 6) for r in search.vector_scores(rows, [1.0, 1.0]).collect()} == {1: 0.707107, 2: 0.707107}
    assert {r["vec_id"] for r in index.wrong_width(rows, 2).collect()} == {4, 5}


def test_index(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(map(tuple, index.upsert(old, new, "k").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    log = spark.createDataFrame([("d", "EXTRACTED", 1, None), ("d", "FAILED", 2, "x" * 2000)], "document_id string, status string, at int, error string")
    row = index.status_view(log).first()
    assert (row["status"], row["created"], row["updated"], len(row["error"])) == ("FAILED", 1, 2, 1000)
    assert index.clear(old, F.col("v") > 5).count() == 2
    blobs = spark.createDataFrame([("x/a.pdf",), ("x/b.pdf",), ("c.pdf",)], "name string")
    manifest = spark.createDataFrame([("x/a.pdf", ["S2", "S1"]), ("b.pdf", ["S3"]), ("b.pdf", None), ("c.pdf", ["n/a"])], "key string, scenario_ids array<string>")
    assert {r["name"]: r["scenario_id"] for r in index.manifest_lookup(blobs, manifest).collect()} == {"x/a.pdf": "S1", "x/b.pdf": "S3", "c.pdf": "n/a"}


def test_invented(spark):
    claims = spark.createDataFrame([("r", "SRC-9"), ("r", "SRC-9999")], "request_id string, source_id string")
    known = spark.createDataFrame([("r", "SRC-9")], "request_id string, source_id string")
    assert [r["source_id"] for r in search.invented_citations(claims, known).collect()] == ["SRC-9999"]


def test_vector_top_of_many_queries(spark):
    rows = [(k, [float((k * j * 37 + j) % 11 - 5) for j in range(1, 9)]) for k in range(230)] + [(300, None), (350, [0.0] * 8), (400, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    got = {}
    for r in search.vector_top(vectors.where("vec_id % 50 = 0"), vectors, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["vector_score"], 6)))
    assert set(got) == {0, 50, 100, 150, 200, 400} and [x[1] for x in got[400]] == [400]
    for q in (0, 50, 200):
        want = sorted((-r["vector_score"], r["vec_id"]) for r in search.vector_scores(vectors, rows[q][1]).collect())[:5]
        assert [x[2] for x in sorted(got[q])] == [round(-s, 6) for s, _ in want]


def test_contract_and_filters_of_a_question(spark):
    from ledgerloom.functions import headers
    from ledgerloom.operators import index, search
    from ledgerloom.vocabulary import JURISDICTION_ALIASES, JURISDICTIONS

    fields = index.schema()
    assert len(fields) == 30 and fields["content_vector"].metadata["searchable"] and not fields["content"].metadata["filterable"]
    search.assert_filterable("source_file")
    for name in ("jurisdictions", "chunk_id", "sender"):
        with pytest.raises(ValueError):
            search.assert_filterable(name)
    filters = search.filters_of({"entities": ["UnitA"], "topic": "Nexus", "jurisdictions": ["Ohio"]})
    assert filters.entities == ("UnitA",) and filters.tax_topic == "Nexus" and filters.boost_jurisdictions == ("Ohio",)
    rows = spark.createDataFrame([("the UK branch",), ("ohio",), ("n/a",), (None,), ("Bavaria",)], "v string")
    assert [r[0] for r in rows.select(headers.coerce(rows["v"], JURISDICTIONS, aliases=JURISDICTION_ALIASES)).collect()] == ["United Kingdom", "Ohio", "n/a", "n/a", "n/a"]
    empty = spark.createDataFrame([], "chunk_id string, content string, jurisdictions array<string>, semantic_state string, evidence_type string, search_score double")
    assert search.search(empty, "payroll factor").count() == 0
