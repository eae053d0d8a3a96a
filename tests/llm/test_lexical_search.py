"""Ranked lexical search: block-max pruning against scoring every document."""

import duckdb
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.llm import lexical_search


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score double")


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    docs = [(i, " ".join(words[(i * k) % 10] for k in range(1, 2 + i % 7)) + f" N{i % 13}", 0.0) for i in range(400)]
    docs += [(1000 + i, "Alpha BETA, gamma!", None) for i in range(30)]  # equal scores: ties by doc_id
    docs += [(None, "alpha alpha", None), (2 ** 60 + 1, "ALPHA beta", None), (5000, None, None), (5001, "", None),
             (5002, "naïve café ÄLPHA alpha", None), (5003, "x" * 20000 + " alpha", None),
             (5004, "beta gamma", 1.0), (5004, "beta gamma", 2.0)]  # a repeated row is one document
    items = [(1, "alpha beta"), (2, "gamma gamma delta"), (3, None), (4, "nothing-here zzz"), (5, "n3 alpha"),
             (6, "café")]
    got = lexical_search.search(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"),
                                block=4).collect()
    assert sorted(tuple(r) for r in got) == sorted(lexical_search.brute_force([d[:2] for d in docs], items))


def test_empty_tables(spark):
    empty = _docs(spark, [])
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert lexical_search.search(empty, items).collect() == []


def test_query_equals_sql(spark, folder):
    from labelloom.llm import queries
    got = sorted(tuple(r) for r in queries.op13_lexical_search(spark, folder).collect())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = sorted(tuple(r) for r in con.execute(lexical_search.sql()).fetchall())
    assert got == want and len(got) > 0


def test_texts_are_cut_once(spark):
    """Postings are gathered and stored once; they were made again for weights, blocks and placing."""
    rows = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda text: rows.add(1) or text).asNondeterministic()
    docs = _docs(spark, [(i, f"alpha beta n{i % 5}", 0.0) for i in range(40)]).withColumn("text", seen("text"))
    items = spark.createDataFrame([(1, "alpha n3")], "item_id long, text string")
    assert len(lexical_search.search(docs, items, block=4).collect()) == 10
    assert rows.value == 40


def test_vocabulary_beyond_a_broadcast(spark, monkeypatch):
    docs = [(i, f"Alpha w{i % 9} w{i % 4} w{i % 4}", 0.0) for i in range(60)]
    items = [(i, f"alpha w{i} w{i + 1}") for i in range(8)]
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 3)
    got = lexical_search.search(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"),
                                block=4).collect()
    assert sorted(tuple(r) for r in got) == sorted(lexical_search.brute_force([d[:2] for d in docs], items))
