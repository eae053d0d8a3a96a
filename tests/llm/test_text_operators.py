"""Language ID, secret scan, licences, decontamination against plain versions and planted cases."""

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib

import pytest
from labelloom.llm import decontam, langid, licenses, secret_scan

import __spark_entry__ as entry
from compare import difference, duck

SF = "/root/testdata/sf0.001"
KEY = "AKIA" + "ABCDEFGHIJ2345"
DOCS = "doc_id bigint, text string, lang string, n_chars bigint, key string, score string, h string"


def docs_of(spark, texts, langs=None):
    """Documents with extra columns whose names clash with internal ones."""
    rows = [(i, t, langs[i] if langs else "en", None, "k", "s", "h") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- secrets ----------------------------------------------------------------------------------------


def plain_base(text):
    """The three patterns as they are stated, failing matches dropped afterwards."""
    spans = [(m.start(), m.end(), "assign") for m in re.finditer(
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 12]
    spans += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(spans, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


def test_base_spans_equal_the_stated_patterns(spark):
    rng = random.Random(1)
    bits = ["token", "Secret=", "api_key: '", "APIKEY=", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef",
            " ", "=", "\n", "ſecret=", "é", "password = ", "a" * 12, "AKIAAKIA", "_"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(3000)]
    for t in texts:
        assert secret_scan.base_spans(t) == plain_base(t), t
    for row in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert secret_scan.base_spans(row[0]) == plain_base(row[0])


@pytest.mark.parametrize("wrap", [
    lambda s: base64.b64encode(s.encode()).decode(),
    lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    lambda s: base64.b64encode(zlib.compress(zlib.compress(s.encode()))).decode(),
    lambda s: base64.b64encode(urllib.parse.quote(f"k={s} ").replace("A", "%41").encode()).decode(),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in base64.b64encode(s.encode()).decode()),
])
def test_nested_layers_map_to_the_encoded_run(wrap):
    run = wrap(f"see {KEY} there")
    text = f"ééé before {run} after"
    base, every, layers, large = secret_scan.scan(text)
    assert ("access" in {k for _, _, k in every}) and layers >= 1 and large == 0
    start, end, _ = next(s for s in every if s[2] == "access")
    assert text.index(run) <= start < end <= text.index(run) + len(run)


def test_escapes_map_character_by_character_and_cycles_end():
    text = "x " + "".join(f"%{b:02X}" for b in b"AKIA") + KEY[4:] + " y"
    assert secret_scan.scan(text)[1] == [(2, 2 + 12 + 14, "access")]
    twice = urllib.parse.quote(urllib.parse.quote("password = correct-horse-battery", safe=""), safe="")
    assert [k for *_, k in secret_scan.scan(twice)[1]] == ["assign"]
    assert secret_scan.hide(f"a {KEY} b") == "a [SECRET] b"


@pytest.mark.parametrize("wrap", [
    lambda s: base64.b64encode(base64.b64encode(s.encode())).decode(),
    lambda s: base64.b64encode(urllib.parse.quote(s).replace("A", "%41").encode()).decode(),
    lambda s: base64.b64encode(s.encode()).decode().replace("Q", "%51"),
])
@pytest.mark.parametrize("between", [" and again ", ",\n"])
def test_copies_of_a_nested_run_are_found_at_each_place(wrap, between):
    run = wrap(f"see {KEY} there, it is the key")
    text = f"{run}{between}{run}"
    starts = {s for s, _, k in secret_scan.scan(text)[1] if k == "access"}
    assert any(s < len(run) for s in starts) and any(s >= len(run) + len(between) for s in starts)
    hidden = secret_scan.hide(text)
    assert hidden.count("[SECRET]") == 2 and run not in hidden


def test_scan_rows_and_redaction(spark):
    texts = [None, "", f"token = '{'0123456789abcdef' * 2}'", "clean text", KEY, KEY]
    docs = docs_of(spark, texts)
    rows = {r["doc_id"]: r for r in secret_scan.scan_documents(docs).collect()}
    assert len(rows) == 6 and rows[0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and rows[0]["spans"] == ""
    assert (rows[2]["n_assign"], rows[2]["n_hex"]) == (1, 1) and rows[2]["spans"] == "assign:0:41,hex:9:41"
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns
    kept = {r["doc_id"]: r for r in clean.collect()}
    assert kept[0]["text"] is None and kept[3]["text"] == "clean text" and kept[4]["text"] == "[SECRET]"
    assert kept[4]["n_chars"] == 8 and secret_scan.scan_documents(docs.limit(0)).count() == 0


# --- language ---------------------------------------------------------------------------------------


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in found)
    assert len(found) > 200 and right >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_kernel_is_the_number_of_shared_grams():
    texts = ["abcab", "bcd", "xyz"]
    model = langid.learn(texts, ["a", "b", "c"], landmarks=3)

    def grams(t):
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            want = len(grams(a) & grams(b)) / (len(grams(a)) * len(grams(b))) ** 0.5
            assert abs(model.kernel([a])[0, j] - want) < 1e-5
    assert model.predict(texts)[0] == ["a", "b", "c"]


def test_language_edge_cases(spark):
    docs = docs_of(spark, [None, "", "123 --", "the cat", "the cat"], [None, None, None, None, None])
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0
    real = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("source", "lang_pred")
    more = real.unionByName(docs.selectExpr("doc_id + 900000 as doc_id", "text", "lang", "key as lang_pred", "n_chars"))
    rows = {r["doc_id"]: r for r in langid.identify(more).collect()}
    assert [rows[900000 + i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert rows[900003]["lang_pred"] == rows[900004]["lang_pred"] != "und"
    kept = langid.keep_identified(more)
    assert kept.columns == more.columns and kept.count() == real.count() + 2


# --- licences ---------------------------------------------------------------------------------------


def test_licenses_equal_their_sql(spark):
    assert difference(spark, duck(SF), SF, "op1_license_scan", entry) == ""


def test_licenses_in_edited_and_wrapped_texts(spark):
    mit = licenses.TEMPLATES["MIT"][2].replace("Software", "Program", 1)
    wrapped = "Intro words here.\n\n" + "\n".join(re.findall(r".{1,70}(?:\s|$)", mit)) + "\n\nThe end."
    docs = docs_of(spark, [None, "", wrapped, "Released under the MIT Licence.\nelse", "clean text of the day", "MIT"])
    rows = {(r["doc_id"], r["license"]): r for r in licenses.scan(docs).collect()}
    assert set(rows) == {(2, "MIT")} and rows[2, "MIT"]["dice"] < 1
    again = licenses.scan(docs_of(spark, ["x\nReleased under the MIT License.", "x\nReleased under the MIT License."]))
    assert sorted((r["doc_id"], r["license"], r["dice"]) for r in again.collect()) == [(0, "MIT", 1.0), (1, "MIT", 1.0)]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_size_bounds_lose_nothing():
    rng = random.Random(2)
    known = [b for texts in licenses.TEMPLATES.values() for b in map(licenses.template_bigrams, texts)]
    for own in known:
        for _ in range(30):
            unit = [b for b in own if rng.random() < 0.8] + [f"x{i} y" for i in range(rng.randint(0, len(own)))]
            dice = 2 * len(set(unit) & set(own)) / (len(unit) + len(own)) if unit else 0
            if dice >= 0.8:
                low, high = licenses.bounds(len(own), 0.8)
                assert low <= len(unit) <= high


# --- decontamination --------------------------------------------------------------------------------


def plain_alignment(a, b):
    best, rows = 0, [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, rows[-1][j - 1] + (2 if x == y else -1), rows[-1][j] - 1, row[j - 1] - 1))
        rows.append(row)
        best = max(best, *row)
    return best


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (rng.choices("abcd", k=rng.randint(1, 14)) for _ in "xy")
        score, start, end = decontam.align(a, b)
        assert score == plain_alignment(a, b)
        if score:
            assert plain_alignment(a, b[start:end]) == score
    assert decontam.align([], ["a"]) == (0, 0, 0)


def test_planted_leaks_are_found_and_clean_documents_stay(spark):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    some = items.orderBy("item_id").limit(8).collect()
    filler = " ".join(r["text"] for r in docs.filter("lang = 'en'").orderBy("doc_id").limit(3).collect())
    planted = []
    for k, r in enumerate(some):
        ws = r["text"].split()
        edited = [w if rng.random() > 0.12 else "changed" for w in ws]
        del edited[len(edited) // 2]
        planted.append((500_000 + k, f"{filler[:400]} {' '.join(edited if k % 2 else ws).upper()} {filler[400:800]}"))
    made = spark.createDataFrame(planted, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' as lang", "'s' as source", "1L as n_chars")
    more = docs.unionByName(made)
    rows = [r for r in decontam.leaks(more, items).collect() if r["doc_id"] >= 500_000]
    assert {(r["doc_id"] - 500_000, r["item_id"]) for r in rows} >= {(k, r["item_id"]) for k, r in enumerate(some)}
    kept = decontam.drop_leaking(more, items)
    assert kept.columns == more.columns and kept.filter("doc_id >= 500000").count() == 0
    # Brute force: every window of every document against every item, for the documents at hand.
    every = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, items).collect()}
    asked = [(r["item_id"], decontam.words(r["text"])) for r in items.collect()]
    for d in docs.select("doc_id", "text").limit(60).collect():
        text = decontam.words(d["text"])
        for item, ws in asked:
            if len(set(ws) & set(text)) >= 0.6 * len(set(ws)):
                want = decontam.align(ws, text)[0] >= decontam.LEAK * 2 * len(ws)
                assert want == ((d["doc_id"], item) in every), (d["doc_id"], item)


def test_decontamination_edge_cases(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "zq wx"), (3, "zq wx")], "item_id bigint, text string")
    docs = docs_of(spark, [None, "", "a zq wx b", "zq b wx"])
    assert [(r["doc_id"], r["item_id"], r["score"]) for r in decontam.leaks(docs, items).collect()] == [(2, 3, 1.0)] * 2
    assert decontam.leaks(docs, items.limit(0)).count() == 0 and decontam.leaks(docs.limit(0), items).count() == 0
    assert sorted(r["doc_id"] for r in decontam.drop_leaking(docs, items).collect()) == [0, 1, 3]
