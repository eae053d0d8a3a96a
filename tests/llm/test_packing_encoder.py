"""Token ids of batches: distinct parts, marks after words."""

from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from labelloom.llm import packing

TEXTS = ["The word*** the word%%% (the) Word,&&& don't word'", "", " ", "a\n\nb  c", "École,### naïve_ x_y 日本 95.93", "the" * 50]


def test_batches_give_the_ids_of_their_texts():
    plain = Tokenizer.from_file(packing.tokenizer_path())
    own = packing.Encoder(packing.tokenizer_path())
    want = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    for _ in range(2):
        assert [i.tolist() for i in own.encode(TEXTS)] == want
    assert [i.tolist() for i in own.encode(TEXTS[1:3])] == want[1:3] and own.encode([]) == []


def test_marks_after_a_word_take_no_full_pass(monkeypatch):
    """Words with marks like *** went through all passes of the tokenizer, each word for itself."""
    own, passed = packing.Encoder(packing.tokenizer_path()), []
    slow = own._slow
    monkeypatch.setattr(own, "_slow", lambda parts: passed.extend(parts) or slow(parts))
    own.encode([" ".join(f"{w}***" for w in ("alpha", "beta", "gamma"))])
    assert passed == ["***"]


def test_words_of_a_batch_go_through_the_merges_together(monkeypatch):
    """Every word was a call of its own; a capital or a mark does not make it another word."""
    own, passed = packing.Encoder(packing.tokenizer_path()), []
    merged = own._merged
    monkeypatch.setattr(own, "_merged", lambda words: passed.append(words) or merged(words))
    monkeypatch.setattr(packing, "MERGED", 2)
    text = "École, école zzqxv Zzqxv.** ÿÿ the"
    plain = Tokenizer.from_file(packing.tokenizer_path())
    assert [i.tolist() for i in own.encode([text])] == [plain.encode(text, add_special_tokens=False).ids]
    assert passed == [["école", "zzqxv", "ÿÿ", "the"]]


def test_tokenising_counts_documents_per_id(spark):
    """The frequencies took a pass of their own over all stored ids."""
    texts = ["a a b", None, "", "b c", "b"] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    made = packing.tokenised(rows, packing.tokenizer_path()).collect()
    docs = [np.frombuffer(r.ids, f"<u{r.width}") for r in made if r.n is not None]
    seen = [np.frombuffer(r.seen, "<i8") for r in made if r.n is None]
    assert len(docs) == len(texts) and all(r.seen is None for r in made if r.n is not None)
    want = Counter(i for d in docs for i in set(d.tolist()))
    got = Counter()
    for counts in seen:
        got.update({i: int(n) for i, n in enumerate(counts) if n})
    assert got == want
    doc, term, count = packing._terms(docs)
    assert [(d, t, c) for d, t, c in zip(doc, term, count)] == [
        (d, t, c) for d, ids in enumerate(docs) for t, c in zip(*packing.distinct(ids))]


def test_terms_of_many_or_wide_documents_are_counted_alike():
    import numpy as np
    from labelloom.llm import packing
    dice = np.random.default_rng(5)
    for kind, n in (("<u2", 50), ("<u4", 50), ("<u2", (1 << 16) + 3)):
        docs = [dice.choice([0, 1, 2, 40_000, np.iinfo(kind).max], dice.integers(1, 5)).astype(kind) for _ in range(n)]
        want = [(d, i, c) for d, ids in enumerate(docs) for i, c in zip(*map(np.ndarray.tolist, np.unique(ids, return_counts=True)))]
        assert list(zip(*map(np.ndarray.tolist, packing._terms(docs)))) == want
