"""Text functions against small Python statements of the same rules."""

import re
import string
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from labelloom.functions import text as T

TEXTS = ["", " ", "A bb  ccc", "Élan naïve façade, 12_3 1e5 é!!", "x-ray __a__ *b* nan inf 1d 7 ٣",
         "Tab\there\nand there. Next! One? Yes", "a", "ab", "señor Ünïcode ßtraße ﬁn",
         "the THE The of", "...", "word" * 30]


def run(spark, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return [r[0] for r in rows.select("i", column.alias("v")).orderBy("i").select("v").collect()]


def test_word_punct(spark):
    assert run(spark, T.word_punct(F.col("t"))) == [re.findall(r"\w+|[^\w\s]+", t) for t in TEXTS]


def is_number(token):
    try:
        float(token)
        return True
    except ValueError:
        return False


def test_tokenise(spark):
    def expected(text):
        out = []
        for token in re.findall(r"\w+|[^\w\s]+", text):
            token = token.lower().strip().strip("_").strip("*")
            if token in ("the", "of") or is_number(token):
                continue
            if all(c in string.punctuation for c in token):
                continue
            out.append(token)
        return out
    assert run(spark, T.tokenise(F.col("t"), ("the", "of"))) == [expected(t) for t in TEXTS]


def test_switches(spark):
    got = run(spark, T.tokenise(F.col("t"), (), lower=False, strip=False))
    assert got[2] == ["A", "bb", "ccc"] and "__a__" in got[4]


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def test_accents(spark):
    got = run(spark, T.strip_accents(F.col("t")))
    # A ligature stands for two letters and is left as it is.
    assert got == [plain(t.replace("ﬁ", "%")).replace("%", "ﬁ") for t in TEXTS]


def test_words_and_ngrams(spark):
    words = [[w for w in re.findall(r"\w{2,}", plain(t.replace("ﬁ", "%").lower()).replace("%", "ﬁ"))
              if w != "the"] for t in TEXTS]
    assert run(spark, T.words(F.col("t"), ("the",))) == words
    grams = [[" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)] for w in words]
    assert run(spark, T.word_ngrams(T.words(F.col("t"), ("the",)), 1, 3)) == grams


def test_char_ngrams(spark):
    def expected(text, low, high):
        out = Counter()
        for word in plain(text.replace("ﬁ", "%").lower()).replace("%", "ﬁ").split():
            word = f" {word} "
            sizes = [n for n in range(low, high + 1) if n <= len(word)] or [low]
            out.update(word[i:i + n] for n in sizes for i in range(max(1, len(word) - n + 1)))
        return out
    for low, high in ((3, 5), (4, 9)):
        got = run(spark, T.char_ngrams(F.col("t"), low, high))
        assert [Counter(g) for g in got] == [expected(t, low, high) for t in TEXTS]


def test_counts_per_document(spark):
    got = run(spark, T.count_terms(T.word_punct(F.lower("t"))))
    want = [Counter(re.findall(r"\w+|[^\w\s]+", t.lower())) for t in TEXTS]
    assert [{s["term"]: s["tf"] for s in g} for g in got] == [dict(w) for w in want]


def test_lists(spark):
    rows = spark.createDataFrame([("a;b;;c",), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(T.split_list(F.col("t"))).collect()]
    assert got == [["a", "b", "", "c"], [""], []]
    assert [r[0] for r in rows.select(T.split_list(F.col("t"), False)).collect()] == [
        ["a", "b", "c"], [], []]
    assert rows.select(T.join_list(T.split_list(F.col("t")))).first()[0] == "a;b;;c"
    assert rows.select(T.detokenise(T.split_list(F.col("t")))).first()[0] == "a b  c"


def test_default_stop_words(spark):
    assert "the" in T.default_stop_words()
