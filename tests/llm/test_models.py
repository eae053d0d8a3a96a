"""The lattice language model, packing and archives against plain versions and exact round trips."""

import hashlib
import itertools
import math
import zlib

import numpy as np
import pytest
from labelloom.llm import lattice_lm, packing, warc

SF = "/root/testdata/sf0.001"


# --- language model ---------------------------------------------------------------------------------


def plain_probability(lattice, text):
    """The sum over all segmentations, listed one by one."""
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        parts, at = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(text[at:i])
                at = i
        parts.append(text[at:])
        logs = [lattice.log[p] if p in lattice.log else lattice._spelled(p) if len(p) == 1 else None for p in parts]
        if None not in logs:
            total += math.exp(sum(logs))
    return total


@pytest.fixture(scope="module")
def lattice():
    path = lattice_lm.vocabulary_path()
    size = lattice_lm.loaded(path).size
    counts = np.random.default_rng(9).integers(0, 1000, size)
    return lattice_lm.Lattice(path, lattice_lm.logarithms(path, counts, 50))


@pytest.mark.parametrize("word", ["the", "thereof", "éà", "日x", "😀", "a\u0001b", "internati"])
def test_forward_adds_all_segmentations(lattice, word):
    want = plain_probability(lattice, lattice_lm.START + word)
    assert abs(lattice.word(word.encode()) - math.log(want)) < 1e-9
    assert abs(np.exp(lattice.weights).sum() - 1) < 1e-9


def test_expected_counts_spell_the_word(lattice):
    into = np.zeros(lattice.own.size)
    lattice.expect(b"whenever", 2.0, into)
    names = {i: p for p, i in lattice.own.ids.items()}
    assert abs(sum(n * len(names[i]) for i, n in enumerate(into) if n) - 2 * 9) < 1e-6


def test_many_words_at_once(lattice):
    words = [b"the", b"whenever", "éà日".encode(), b"", b"x" * 50, b"the", "日本".encode(), b"abcdefgh"]
    assert np.allclose(lattice.all_words(words), [lattice.word(w) for w in words])
    one, many = np.zeros(lattice.own.size), np.zeros(lattice.own.size)
    for k, w in enumerate(words):
        lattice.expect(w, k + 1.0, one)
    lattice.expect_all(words, np.arange(1.0, len(words) + 1), many)
    assert np.allclose(one, many)


def crc(x):
    return zlib.crc32(str(x).encode())


def test_scores_equal_a_plain_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    texts = {r[0]: r[1] for r in docs.collect()}
    texts |= {10_001: None, 10_002: "", 10_003: "THE the Zzzqjあ"}
    rows = spark.createDataFrame([(i, t, "w", 1) for i, t in texts.items()], "doc_id bigint, text string, word string, row int")
    found = {r["doc_id"]: r for r in lattice_lm.score(rows, rounds=0).collect()}
    split = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    train = [w for i, ws in split.items() if crc(i) % 5 != 1 for w in [*ws, None]]
    counts = {w: train.count(w) for ws in split.values() for w in [*ws, None]}
    kinds = len(set(train))
    own = lattice_lm.loaded(lattice_lm.vocabulary_path())
    pieces = np.zeros(own.size)
    for w in train:
        if w is not None:
            np.add.at(pieces, own.model.encode(w.decode()), 1)
    model = lattice_lm.Lattice(own.path, lattice_lm.logarithms(own.path, pieces, counts[None]))
    for i, ws in split.items():
        r, every = found[i], [*ws, None]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (crc(i) % 5 == 1, len(every), len(train))
        assert r["n_known"] == sum(counts[w] > 0 for w in every)
        base = sum(math.log10((counts[w] + 0.5) / (len(train) + 0.5 * (kinds + 1))) for w in every)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        score = (sum(model.word(w) for w in ws) + model.weights[own.end]) / math.log(10)
        assert abs(r["score"] - score) < 1e-6 * max(1, abs(score))
    assert len(found) == len(texts)


def test_rare_words_take_the_same_way(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40)
    docs = docs.union(docs.limit(3))
    want = sorted(map(tuple, lattice_lm.score(docs, rounds=1).collect()))
    monkeypatch.setattr(lattice_lm, "FREQUENT", 20)
    found = sorted(map(tuple, lattice_lm.score(docs, rounds=1).collect()))
    assert len(found) == 43 and [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in want])
    assert lattice_lm.score(docs.limit(0)).count() == 0


def test_expectation_maximisation_helps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    train = [sum(r["score"] for r in lattice_lm.score(docs, rounds=k).filter("not held_out").collect()) for k in (0, 1)]
    assert train[1] > train[0]


# --- packing ----------------------------------------------------------------------------------------


def test_cached_encoding_equals_the_tokenizer(spark):
    from tokenizers import Tokenizer
    path = packing.tokenizer_path()
    plain, own = Tokenizer.from_file(path), packing.Encoder(path)
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(80).collect()]
    texts += ["Straße, ÀÉÎõü! WORD.; a\u0301b é\u0301 ª º µm Œuvre ÿŸ x² don't ﬁn ..., !?", "", " ", "\n\n a b c \x1c\x1dd", "It's we'll 123 '' 've", "é ́x", "ΑΣ Σ", "a<|endoftext|>b", "\t x\r\n"]
    assert [i.tolist() for i in own.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def check_pieces(rows, texts):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, packing.END] for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            cut = ids[i][r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[i])
            assert r["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[i])
    lengths = []
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
        lengths.append(at)
    return lengths


def test_every_id_lies_in_one_piece(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r[0]: r[1] for r in docs.collect()} | {10**6: None, 10**6 + 1: ""}
    rows = spark.createDataFrame([(i, t, 5, "k") for i, t in texts.items()], "doc_id bigint, text string, n int, key string")
    lengths = check_pieces(packing.pack(rows).collect(), texts)
    assert sum(n < packing.WINDOW for n in lengths) <= 1
    lengths = check_pieces(packing.pack(rows, shard_tokens=20_000).collect(), texts)
    assert 1 < sum(n < packing.WINDOW for n in lengths) <= sum(lengths) / 20_000 + 1
    assert packing.pack(rows.limit(0)).count() == 0


def test_neighbours_come_by_falling_bm25():
    rng = np.random.default_rng(10)
    docs = [np.append(rng.integers(100 * (d % 3), 100 * (d % 3) + 100, 300), 2) for d in range(30)]
    df = np.zeros(400, np.int64)
    for ids in docs:
        df[np.unique(ids)] += 1
    index = packing.Index(docs, df, 30, 301.0)
    for seed in (0, 7):
        want = []
        for ids in docs:
            score = 0.0
            for t in np.unique(docs[seed]):
                tf = (ids == t).sum()
                score += math.log1p((30 - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(ids) / 301))
            want.append(score)
        assert np.allclose(index.scores(seed, 30), want)
    made = packing.pack_shard(docs, df, 30, 301.0)
    # A window of 13 documents: the ten of the seed's kind come first.
    first = [d for d, _, _, s, _ in made if s == 0]
    assert len({d % 3 for d in first[:10]}) == 1


# --- archives ---------------------------------------------------------------------------------------


def page_rows(spark):
    big = "<p>é" * 300
    rows = [(i, f"http://h/{i}", t, "x") for i, t in enumerate(
        ["", None, "small", "small", big, big, "x" * 100_001 + "é\r\n\r\nWARC/1.1\r\n", "y" * 999, "y" * 999])]
    rows += [(9, "http://h/9", big, "x"), (None, None, big, "x"), (12, "a\r\nb", "z" * 40_000 + "😀" * 10, "x"), (3, "again", "small", "x")]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")


def test_archive_round_trip(spark):
    rows, pages = page_rows(spark)
    found = [r.asDict() for r in warc.round_trip(pages).collect()]
    assert len(found) == len(rows) and all(r["problem"] is None for r in found)
    for page, _, html, _ in rows:
        data = (html or "").encode()
        own = [r for r in found if r["page_id"] == page]
        assert all(r["payload_digest"] == hashlib.sha1(data).hexdigest() and r["payload_bytes"] == len(data) for r in own)
        same = [p for p, _, h, _ in rows if h == html and len(data) >= 1000]
        head = max((p for p in same if p is not None), default=None)
        want = ("revisit", head) if len(same) > 1 and page != head else ("response", None)
        assert all((r["record_type"], r["refers_to"]) == want for r in own)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payloads_come_back_and_damage_is_named(spark, tmp_path):
    rows, pages = page_rows(spark)
    warc.write(pages, f"{tmp_path}/good")
    read = warc.read(spark, f"{tmp_path}/good").filter("type = 'response'").collect()
    payloads = {r["record"].split(":")[2]: bytes(r["payload"]).decode() for r in read}
    assert all(payloads[str(i)] == (h or "") for i, _, h, _ in rows if str(i) in payloads) and len(payloads) >= 8
    # Segments in separate files, one missing, one twice, a wrong digest, a wrong total.
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"0123456789" * 5

    def record(kind, name, part, *lines):
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"Content-Length: {len(part)}", *lines])
        return head.encode() + b"\r\n\r\n" + part + b"\r\n\r\n"

    def segments(name, numbers, total):
        out = []
        for n in numbers:
            extra = [f"WARC-Segment-Number: {n}"] + ([f"WARC-Segment-Origin-ID: <{name}>"] if n > 1 else [])
            extra += [f"WARC-Segment-Total-Length: {total}"] if n == 3 else []
            out.append(record("response" if n == 1 else "continuation", name if n == 1 else f"{name}-{n}", block[(n - 1) * 30:n * 30], *extra))
        return out

    out = segments("ok", [3, 1, 2], len(block)) + segments("gap", [1, 3], len(block)) + segments("total", [1, 2, 3], 7)
    out += segments("open", [1, 2], 0) + [record("response", "digest", block, "WARC-Payload-Digest: sha1:00")]
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    out += [record("response", "chunks", chunked + b"5;x=y\r\nab\r\nc\r\n0\r\n\r\n"), record("response", "short", chunked + b"9\r\nab\r\n")]
    (tmp_path / "bad").mkdir()
    for i, data in enumerate(out):
        (tmp_path / "bad" / f"{i}.warc").write_bytes(data)
    import gzip
    (tmp_path / "bad" / "z.warc.gz").write_bytes(gzip.compress(record("response", "z1", block)) + gzip.compress(record("response", "z2", block)))
    rows = {r["record"]: r for r in warc.read(spark, f"{tmp_path}/bad").collect()}
    assert bytes(rows["ok"]["payload"]) == b"0123456789" * 5 and bytes(rows["chunks"]["payload"]) == b"ab\r\nc"
    assert bytes(rows["z2"]["payload"]) == b"0123456789" * 5
    problems = {k: rows[k]["problem"] for k in ("gap", "total", "open", "digest", "short")}
    assert problems == {"gap": "segment missing or repeated", "total": "total length differs", "open": "last segment missing",
                        "digest": "payload digest differs", "short": "chunk cut off"}
