from pyspark.sql import functions as F

from ledgerloom.operators import providers


def test_classified(spark):
    docs = spark.createDataFrame([("a", "S1", "n/a", "text a"), ("b", "n/a", "2020", "bad"), ("c", "n/a", "n/a", None)], "document_id string, scenario_id string, tax_year string, content string")

    def model(texts):
        if "bad" in texts:
            raise RuntimeError("refused")
        return [{"tax_topic": "nexus", "jurisdiction": "State of Illinois", "scenario_id": "S9", "tax_year": 2024, "confidence": 7, "extra": 1} for _ in texts]

    answers = providers.answered(docs, "document_id", "content", model, size=1, attempts=2, wait=0.0)
    rows = {r["document_id"]: r for r in providers.classified(docs, answers).collect()}
    assert rows["a"]["tax_topic"] == "Nexus" and rows["a"]["jurisdiction"] == "Illinois" and rows["a"]["scenario_id"] == "S1" and rows["a"]["tax_year"] == "2024" and rows["a"]["confidence"] == 1.0
    assert rows["b"]["enrichment_status"] == "failed" and "refused" in rows["b"]["error"] and rows["b"]["tax_year"] == "2020"


def test_understood(spark):
    drafts = spark.createDataFrame([("q1", '{"intent": "COMPARISON", "entity": "UnitA", "jurisdictions": ["NY", " ", "PA"], "surprise": "x"}'), ("q2", None)], "key string, answer string")
    rows = {r["request_id"]: r for r in providers.understood(drafts).collect()}
    assert rows["q1"]["entities"] == ["UnitA"] and rows["q1"]["jurisdictions"] == ["NY", "PA"] and rows["q1"]["unknown_fields"] == ["surprise"]
    assert rows["q2"]["intent"] is None


def test_embeddings(spark):
    rows = spark.createDataFrame([("a b",), ("b a",), ("",), (None,)], "t string").select(providers.embedder(16)("t").alias("v")).collect()
    assert rows[0]["v"] == rows[1]["v"] and len(rows[0]["v"]) == 16 and rows[2]["v"] is None and rows[3]["v"] is None
    frame = spark.createDataFrame([(["a", "b", "c"], ["c"])], "r array<string>, w array<string>")
    assert frame.select(providers.hit_at(F.col("r"), F.col("w"), 2).alias("two"), providers.hit_at(F.col("r"), F.col("w"), 3).alias("three")).first().asDict() == {"two": False, "three": True}
    runs = spark.createDataFrame([("a", "x", "1"), ("a", "x", "2")], "k string, p string, q string")
    assert {r["field"]: r["values"] for r in providers.varying_fields(runs, "k", ["p", "q"]).collect()} == {"p": 1, "q": 2}
