"""The stored ledger: policies and ablations without reading a text again."""

from pyspark.sql import functions as F

from bazaarlake.llm import quality_rules
from bazaarlake.session import work_dir

SF = "/root/testdata/sf0.001"


def test_policies_read_the_stored_ledger_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (7, ""), (7, "a b c")], "doc_id long, text string")
    table = quality_rules.LedgerTable(spark, work_dir(spark, "ledger"))
    table.add(docs.where("doc_id % 2 = 0"), 1)
    table.add(docs.where("doc_id % 2 = 1"), 2)
    table.add(docs.where("doc_id % 2 = 1"), 2)  # again
    for policy in quality_rules.POLICIES:
        kept = table.kept(policy)
        assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()
        want = quality_rules.keep(docs, policy)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in want.collect())
        got = sorted(map(tuple, table.ablations(policy).collect()))
        assert got == sorted(map(tuple, quality_rules.ablations(quality_rules.ledger(docs), policy).collect()))
    table.add(odd, 3)
    rows = table.entries().where("batch = 3").collect()
    assert len(rows) == 3 and all(r["bits"] & 1 for r in rows) and table.kept().count() == quality_rules.keep(docs).count()
    assert table.entries().select(F.sum("n_words")).first()[0] == quality_rules.ledger(docs).select(F.sum("ledger.n_words")).first()[0] + 3
