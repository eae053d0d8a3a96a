"""Cross-tokenizer alignment against a brute force over all token pairs."""

import hashlib

from labelloom.llm import token_alignment as ta

TEXTS = ["Hello  world, this is a test.", "naïve café 中文 <|endoftext|> <s> tokens", None, "",
         "Hello  world, this is a test.", "ﬁne ligature", "tabs\tand\nlines\r\n", "x" * 3000 + " y",
         "The quick brown fox jumps over the lazy dog again and again"]


def _brute(sides, text):
    """Links by comparing every A token with every B token; groups by walking ends."""
    if not text:
        return None
    target = (" " + text).encode()
    a = sides.a.encode(" " + text, add_special_tokens=False).ids
    b = sides.b.encode(text)
    if b"".join(sides.a_bytes[i] for i in a) != target or b"".join(sides.b_bytes[i] for i in b) != target:
        return None
    def spans(ids, table):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(table[i])))
            at += len(table[i])
        return out
    sa, sb = spans(a, sides.a_bytes), spans(b, sides.b_bytes)
    links = [(a[i], b[j]) for i, (s1, e1) in enumerate(sa) for j, (s2, e2) in enumerate(sb) if s1 < e2 and s2 < e1]
    both = sorted({e for _, e in sa} & {e for _, e in sb})
    groups = []
    for k, end in enumerate(both):
        lo = both[k - 1] if k else 0
        ga = [str(a[i]) for i, (s, e) in enumerate(sa) if lo < e <= end]
        gb = [str(b[j]) for j, (s, e) in enumerate(sb) if lo < e <= end]
        groups.append(",".join(ga) + "|" + ",".join(gb))
    return len(a), len(b), len(both), ";".join(groups), links


def test_equals_brute_force(spark):
    sides = ta._Sides.get(None)
    rows = [(i if i != 3 else None, t, "extra") for i, t in enumerate(TEXTS)] + [(2 ** 60 + 1, TEXTS[0], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_links string")
    got = sorted((tuple(r) for r in ta.align(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    brute = [(d, _brute(sides, t)) for d, t, _ in rows]
    docs_per_pair = {}
    for _, res in brute:
        for p in set(res[4]) if res else ():
            docs_per_pair[p] = docs_per_pair.get(p, 0) + 1
    top = {}
    for (x, _), n in docs_per_pair.items():
        top[x] = max(top.get(x, 0), n)
    want = []
    for d, res in brute:
        if res is None:
            want.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_g, groups, links = res
        want.append((d, n_a, n_b, n_g, len(links), sum(docs_per_pair[p] == top[p[0]] for p in links),
                     sum(docs_per_pair[p] for p in links), hashlib.sha256(groups.encode()).hexdigest()))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0))
    assert got == want
    assert sum(1 for r in got if r[1] > 0) >= 5
    for text in TEXTS:
        res = _brute(sides, text)
        if res:
            assert ta.align_one(sides, text)[3].decode() == res[3]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align(df).collect() == []


def test_fast_encoder_equals_the_vocabulary_file():
    sides = ta._Sides.get(None)
    texts = [t for t in TEXTS if t] + ["   many   spaces\n\n\ttabs ", "<|endoftext|><|startoftext|>", "日本語 😀 x",
                                        "don't I'll we've 123456 3.14", "a" * 5000]
    for text in texts:
        assert sides.fast_a.encode_ordinary(" " + text) == sides.a.encode(" " + text, add_special_tokens=False).ids
