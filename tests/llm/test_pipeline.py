"""Each stage of the pipeline against what it must keep, and the whole run."""

import corpus_pipeline as P
from labelloom.llm import bagminhash, decontam, langid, secret_scan

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(700_000, "1 2 3 --", "en", "s", 8), (700_001, None, "en", "s", 0)], docs.schema)
    copies = docs.filter("doc_id < 5").selectExpr("doc_id + 600000 as doc_id", "text", "lang", "source", "n_chars")
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").limit(1).selectExpr(
        "800000L as doc_id", "concat('Before it. ', text, ' And after.') as text", "'en' as lang", "'s' as source", "1L as n_chars")
    now = docs.unionByName(extra).unionByName(copies).unionByName(leak)
    ids, kept = {r[0] for r in now.select("doc_id").collect()}, {}
    for name, stage in P.STAGES:
        stage(spark, now, SF).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r[0] for r in now.select("doc_id").collect()}
        if name != "packing":
            assert now.columns == docs.columns
    assert ids - kept["language_id"] == {700_000, 700_001}
    gone = kept["language_id"] - kept["near_duplicates"]
    assert gone >= {600_000 + i for i in range(5)} & ids
    assert 800_000 not in kept["decontamination"]
    assert kept["decontamination"] == kept["secrets"] == kept["packing"]
    last = spark.read.parquet(f"{tmp_path}/secrets")
    assert all(not secret_scan.base_spans(r[0]) for r in last.select("text").collect())
    # Brute force over what each stage was given.
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/near_duplicates").collect()}
    items = [decontam.words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = set()
    for i, text in rows.items():
        ws = decontam.words(text)
        if any(len(set(item) & set(ws)) >= 0.6 * len(set(item)) and decontam.align(item, ws)[0] >= 1.2 * len(item) for item in items):
            leaked.add(i)
    assert set(rows) - kept["decontamination"] == leaked
    assert langid.UNKNOWN == "und" and bagminhash.SIMILARITY == 0.8


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert len(P.STAGES) == 5
