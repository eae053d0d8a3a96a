"""Registered queries: each operator on the shared test tables, with its SQL twin.

A query takes ``(spark, folder)``. Its twin states the same result in plain SQL. Doubles are
rounded to six digits on both sides; arrays are compared as joined text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.functions import text as T
from labelloom.operators import classifiers as C
from labelloom.operators import enrich as E
from labelloom.operators import features as FT
from labelloom.operators import metrics as M
from labelloom.operators import selection as S
from labelloom.operators import split as SP
from labelloom.operators import tuning as TU
from labelloom.operators import vectors as V
from labelloom.plans import workflow as W
from labelloom.sources import articles as A
from labelloom.sources import sinks as K
from labelloom.streaming.scoring import score_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}

# The stop words of the test queries.
STOP = ("the", "and", "of", "to", "in", "der", "die", "und", "le", "la", "les", "de", "el", "los",
        "que", "qui", "aux")
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            TWINS[name] = sql
        return function
    return register


# --- inputs ---------------------------------------------------------------------------------------


def documents(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/documents.parquet")
    return scale.spread(table, "doc_id")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def multiclass(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with ``Text``; the language is the class."""
    return documents(spark, folder).select(
        F.col("doc_id").alias("Id"), F.col("text").alias("Text"), F.col("lang").alias("Category"))


def binary(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with ``Title`` and ``Abstract``; the quality label is the class."""
    title = F.substring_index("text", "\n", 1)
    return scale.attach(documents(spark, folder), labels(spark, folder), ["doc_id"], "inner").select(
        F.col("doc_id").alias("Id"), title.alias("Title"),
        F.substring(F.col("text"), F.length(title) + 2, F.length("text")).alias("Abstract"),
        F.col("quality").cast("string").alias("Category"))


BINARY_SQL = """
SELECT d.doc_id AS Id, split_part(d.text, chr(10), 1) AS Title,
       substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS Abstract,
       CAST(l.quality AS VARCHAR) AS Category
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """A prediction table that needs no model: long documents are called good."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "n_chars")
    return scale.attach(docs, labels(spark, folder), ["doc_id"], "inner").select(
        F.col("doc_id").alias("Id"), F.col("quality").cast("string").alias("Category"),
        F.when(F.col("n_chars") > 500, "1").otherwise("0").alias("prediction"),
        F.floor(F.col("n_chars") / 100).cast("double").alias("score"))


JUDGED_SQL = """
SELECT d.doc_id AS Id, CAST(l.quality AS VARCHAR) AS Category,
       CASE WHEN d.n_chars > 500 THEN '1' ELSE '0' END AS prediction,
       CAST(floor(d.n_chars / 100) AS DOUBLE) AS score
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def joined(column) -> F.Column:
    return F.array_join(column, "|")


def digest(column) -> F.Column:
    """Long lists are compared by count and hash."""
    return F.md5(F.array_join(column, chr(31)))


def r6(column: str) -> F.Column:
    return F.round(column, 6).alias(column)


# --- sources, projections, joins --------------------------------------------------------------------


def _as_csv(df: DataFrame) -> str:
    path = f"{scale.shared_folder(df.sparkSession)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_dataset(df, path)
    return path


@query("read_articles_csv", """
SELECT doc_id AS Id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n, lang AS Category
FROM documents""")
def _(spark, folder):
    path = _as_csv(multiclass(spark, folder))
    return A.read_articles(spark, path).select(
        "Id", F.md5("Text").alias("text_md5"), F.length("Text").cast("bigint").alias("n"), "Category")


@query("side_table_csv", """
SELECT doc_id AS Id, CASE WHEN toxic = 1 THEN 'toxic;flagged' ELSE '' END AS Terms,
       'quality ' || quality AS Keywords FROM labels""")
def _(spark, folder):
    toxic = F.col("toxic") == 1
    side = labels(spark, folder).select(
        F.col("doc_id").alias("Id"),
        F.when(toxic, F.array(F.lit("toxic"), F.lit("flagged"))).otherwise(
            F.array().cast("array<string>")).alias("Terms"),
        F.array(F.concat(F.lit("quality "), F.col("quality").cast("string"))).alias("Keywords"))
    path = f"{scale.shared_folder(spark)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_side_table(side, path)
    return A.fill_missing(A.read_side_table(spark, path))


@query("whitelist_projection", "SELECT doc_id AS Id, md5(text) AS text_md5, lang AS Category FROM documents")
def _(spark, folder):
    table = documents(spark, folder).withColumnsRenamed(
        {"doc_id": "Id", "text": "Text", "lang": "Category"})
    return A.whitelist(table).select("Id", F.md5("Text").alias("text_md5"), "Category")


@query("label_column", "SELECT doc_id AS Id, lang AS Category FROM documents")
def _(spark, folder):
    return A.split_label(multiclass(spark, folder))[1]


@query("select_item", f"SELECT md5(Title) AS title_md5 FROM ({BINARY_SQL})")
def _(spark, folder):
    return A.select_item(binary(spark, folder), "Title").select(F.md5("Title").alias("title_md5"))


@query("fill_missing", """
SELECT d.doc_id AS Id, coalesce(CAST(l.quality AS VARCHAR), '') AS Category,
       coalesce(CASE WHEN l.toxic = 1 THEN 'toxic' END, '') AS Terms
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, folder):
    side = labels(spark, folder).select(
        F.col("doc_id").alias("Id"), F.col("quality").cast("string").alias("Category"),
        F.when(F.col("toxic") == 1, "toxic").alias("Terms"))
    ids = documents(spark, folder).select(F.col("doc_id").alias("Id"))
    return A.fill_missing(A.join_side_table(ids, side, "left"), keep_null_label=True)


@query("text_column", f"SELECT Id, md5(Abstract) AS text_md5 FROM ({BINARY_SQL})")
def _(spark, folder):
    docs = binary(spark, folder)
    return docs.select("Id", F.md5(A.text_column(A.detect_shape(docs))).alias("text_md5"))


@query("append_column", "SELECT doc_id AS Id, CAST(length(text) AS BIGINT) AS n FROM documents")
def _(spark, folder):
    docs = multiclass(spark, folder)
    return A.with_column(docs, "n", F.length("Text").cast("bigint")).select("Id", "n")


@query("side_table_join", """
SELECT d.doc_id AS Id, d.lang AS Category, 'quality ' || l.quality AS Keywords
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, folder):
    side = labels(spark, folder).select(F.col("doc_id").alias("Id"), F.concat(
        F.lit("quality "), F.col("quality").cast("string")).alias("Keywords"))
    return A.load(multiclass(spark, folder), side).select("Id", "Category", "Keywords")


@query("side_table_left_join", """
SELECT d.doc_id AS Id, coalesce('quality ' || l.quality, '') AS Keywords
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, folder):
    side = labels(spark, folder).select(F.col("doc_id").alias("Id"), F.concat(
        F.lit("quality "), F.col("quality").cast("string")).alias("Keywords"))
    return A.load(multiclass(spark, folder), side, "left").select("Id", "Keywords")


@query("salted_join", """
SELECT d.lang, c.source, CAST(count(*) AS BIGINT) AS n, CAST(sum(c.n_chars) AS BIGINT) AS chars
FROM documents d JOIN (SELECT source, lang, n_chars FROM documents) c
  ON d.source = c.source AND d.lang = c.lang JOIN labels l ON d.doc_id = l.doc_id
GROUP BY ALL""")
def _(spark, folder):
    """The join for keys with most of the rows; pre-aggregated on the repeated side."""
    docs = documents(spark, folder).select("doc_id", "lang", "source", "n_chars")
    sizes = docs.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars"))
    left = scale.skew_join(docs.select("doc_id", "lang", "source"),
                           labels(spark, folder), ["doc_id"], "left_semi")
    return scale.skew_join(left, sizes, ["lang", "source"]).groupBy("lang", "source").agg(
        F.sum("rows").alias("n"), F.sum("chars").alias("chars"))


_WORDS_SQL = (f"list_filter(regexp_extract_all(strip_accents(lower({{0}})), "
              f"'[\\p{{{{L}}}}\\p{{{{N}}}}_]{{{{2,}}}}'), lambda t: t NOT IN {STOP_SQL})")


def words_sql(column: str) -> str:
    return _WORDS_SQL.format(column)


@query("relevance_lookup", f"""
WITH a AS (SELECT item_id AS Id, unnest(list_distinct({words_sql('text')})) AS term FROM benchmark),
c AS (SELECT doc_id AS cit_id, unnest(list_distinct({words_sql('text')})) AS term FROM documents),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
      FROM c GROUP BY term),
s AS (SELECT a.Id, c.cit_id, round(sum(i.idf), 9) AS relevance
      FROM a JOIN c USING (term) JOIN i USING (term) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY Id ORDER BY relevance DESC, cit_id) AS r FROM s)
SELECT m.item_id AS Id, b.cit_id, round(b.relevance, 6) AS relevance
FROM benchmark m LEFT JOIN b ON m.item_id = b.Id AND b.r = 1""")
def _(spark, folder):
    asked = spark.read.parquet(f"{folder}/benchmark.parquet").select(
        F.col("item_id").alias("Id"), F.col("text").alias("Title"))
    corpus = documents(spark, folder).select(
        F.col("doc_id").alias("cit_id"), F.col("text").alias("title"))
    return E.most_relevant(asked, corpus, stop_words=STOP).withColumn(
        "relevance", F.round("relevance", 6))


def citations(spark, folder) -> DataFrame:
    """Citation records shaped from the whole documents: every distinct word is a heading, every line a
    keyword list; some records lack one or the other."""
    headings = F.array_sort(F.array_distinct(T.words(F.col("text"))))
    return documents(spark, folder).select(
        F.col("doc_id").alias("cit_id"), F.col("text").alias("title"),
        F.when(F.col("source") != "src1", F.transform(
            headings, lambda w: F.struct(w.alias("DescriptorName")))).alias("mesh"),
        F.when(F.col("lang") != "de", F.transform(F.split("text", "\n"), lambda line: T.words(line)))
        .alias("keyword_lists"))


_ALL_WORDS = "regexp_extract_all(strip_accents(lower({0})), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
KEYWORDS_SQL = f"""
SELECT doc_id AS Id,
       CASE WHEN source <> 'src1'
            THEN array_to_string(list_sort(list_distinct({_ALL_WORDS.format('text')})), ';') ELSE '' END AS Terms,
       CASE WHEN lang <> 'de'
            THEN array_to_string({_ALL_WORDS.format("string_split(text, chr(10))[1]")}, ';') ELSE '' END AS Keywords
FROM documents"""


@query("keywords_and_terms", KEYWORDS_SQL)
def _(spark, folder):
    return E.keywords_and_terms(citations(spark, folder).withColumnRenamed("cit_id", "Id"))


@query("coverage_counts", f"""
SELECT count(*) AS articles, count(*) FILTER (Keywords <> '') AS with_keywords,
       count(*) FILTER (Terms <> '') AS with_terms FROM ({KEYWORDS_SQL})""")
def _(spark, folder):
    return E.coverage(E.keywords_and_terms(
        citations(spark, folder).withColumnRenamed("cit_id", "Id")))


@query("running_coverage", f"""
SELECT Id, CAST(count(*) OVER w AS BIGINT) AS articles,
       CAST(sum(CASE WHEN Keywords <> '' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS with_keywords,
       CAST(sum(CASE WHEN Terms <> '' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS with_terms
FROM ({KEYWORDS_SQL}) WINDOW w AS (ORDER BY Id ROWS UNBOUNDED PRECEDING)""")
def _(spark, folder):
    return E.running_coverage(E.keywords_and_terms(
        citations(spark, folder).withColumnRenamed("cit_id", "Id")))


# --- text ----------------------------------------------------------------------------------------


def per_document(spark, folder, value: Callable) -> DataFrame:
    """Count and hash of a list computed from each whole text."""
    out = documents(spark, folder).select("doc_id", value(F.col("text")).alias("v"))
    return out.select("doc_id", F.size("v").cast("bigint").alias("n"), digest("v").alias("h"))


def per_document_sql(value: str) -> str:
    return (f"SELECT doc_id, CAST(len(v) AS BIGINT) AS n, md5(array_to_string(v, chr(31))) AS h "
            f"FROM (SELECT doc_id, {value} AS v FROM documents)")


_SPACES = r"\s\p{Z}\x0B\x1C-\x1F\x{85}"
_CUT = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACES}]+"
WORD_PUNCT_SQL = f"regexp_extract_all(text, '{_CUT}')"
_STRIP_SQL = "trim(trim(trim({0}), '_'), '*')"
_NUMBER = r"^(\p{Nd}+(_\p{Nd}+)*(e\p{Nd}+(_\p{Nd}+)*)?|nan|inf|infinity)$"
_PUNCT = r"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]*$"
_LOWERED = f"list_transform({WORD_PUNCT_SQL}, lambda t: lower(t))"
_STRIPPED = f"list_transform({_LOWERED}, lambda t: {_STRIP_SQL.format('t')})"
TOKENS_SQL = (f"list_filter({_STRIPPED}, lambda t: t NOT IN {STOP_SQL} AND NOT "
              f"regexp_matches(t, '{_NUMBER}') AND NOT regexp_matches(t, '{_PUNCT}'))")


@query("sentence_split", per_document_sql(
    r"string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"))
def _(spark, folder):
    return per_document(spark, folder, T.sentences)


@query("word_punct_split", per_document_sql(WORD_PUNCT_SQL))
def _(spark, folder):
    return per_document(spark, folder, T.word_punct)


@query("lower_tokens", per_document_sql(_LOWERED))
def _(spark, folder):
    return per_document(spark, folder, lambda t: F.transform(T.word_punct(t), T.lower_token))


@query("strip_tokens", per_document_sql(
    f"list_transform({WORD_PUNCT_SQL}, lambda t: {_STRIP_SQL.format('t')})"))
def _(spark, folder):
    return per_document(spark, folder, lambda t: F.transform(T.word_punct(t), T.strip_token))


@query("stop_word_filter", per_document_sql(
    f"list_filter({_LOWERED}, lambda t: t NOT IN {STOP_SQL})"))
def _(spark, folder):
    return per_document(spark, folder, lambda t: F.filter(
        F.transform(T.word_punct(t), T.lower_token), lambda w: ~T.is_stop_word(w, STOP)))


@query("number_filter", per_document_sql(
    f"list_filter({_LOWERED}, lambda t: NOT regexp_matches(t, '{_NUMBER}'))"))
def _(spark, folder):
    return per_document(spark, folder, lambda t: F.filter(
        F.transform(T.word_punct(t), T.lower_token), lambda w: ~T.is_number(w)))


@query("punctuation_filter", per_document_sql(
    f"list_filter({WORD_PUNCT_SQL}, lambda t: NOT regexp_matches(t, '{_PUNCT}'))"))
def _(spark, folder):
    return per_document(spark, folder, lambda t: F.filter(
        T.word_punct(t), lambda w: ~T.is_punctuation(w)))


@query("tokenise", per_document_sql(TOKENS_SQL))
def _(spark, folder):
    return per_document(spark, folder, lambda t: T.tokenise(t, STOP))


@query("preprocess", f"""
SELECT doc_id AS Id, md5(array_to_string({TOKENS_SQL}, ';')) AS tokens_md5 FROM documents""")
def _(spark, folder):
    out = W.preprocess(multiclass(spark, folder), STOP)
    return out.select("Id", F.md5("Tokens").alias("tokens_md5"))


@query("split_list", per_document_sql("string_split(replace(text, ',', ';'), ';')"))
def _(spark, folder):
    return per_document(spark, folder, lambda t: T.split_list(F.translate(t, ",", ";")))


@query("detokenise", f"SELECT doc_id, md5(array_to_string({TOKENS_SQL}, ' ')) AS h FROM documents")
def _(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.md5(T.detokenise(T.tokenise(F.col("text"), STOP))).alias("h"))


@query("strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS h FROM documents")
def _(spark, folder):
    return documents(spark, folder).select("doc_id", F.md5(T.strip_accents(F.col("text"))).alias("h"))


@query("word_analyser", per_document_sql(words_sql("text")))
def _(spark, folder):
    return per_document(spark, folder, lambda t: T.words(t, STOP))


def ngrams_sql(array: str, low: int, high: int) -> str:
    """SQL text of all n-grams of a named list column."""
    sizes = [f"list_transform(range(1, greatest(1, len({array}) - {n} + 2)), "
             f"lambda i: array_to_string({array}[i:i+{n - 1}], ' '))" for n in range(low, high + 1)]
    return f"list_concat({', '.join(sizes)})" if len(sizes) > 1 else sizes[0]


@query("word_ngrams", f"""
WITH a AS (SELECT doc_id, {words_sql('text')} AS w FROM documents)
SELECT doc_id, CAST(len(v) AS BIGINT) AS n, md5(array_to_string(v, chr(31))) AS h
FROM (SELECT doc_id, list_concat({ngrams_sql('w', 1, 2)}, {ngrams_sql('w', 3, 3)}) AS v FROM a)""")
def _(spark, folder):
    return per_document(spark, folder, lambda t: T.word_ngrams(T.words(t, STOP), 1, 3))


def char_grams_sql(low: int, high: int, text: str = "text", table: str = "documents",
                   key: str = "doc_id") -> str:
    """One row per character n-gram occurrence: ``(key, term)``."""
    return f"""
SELECT {key}, substr(w, i, n) AS term FROM (
  SELECT {key}, w, n, unnest(range(1, greatest(1, length(w) - n + 1) + 1)) AS i FROM (
    SELECT {key}, w, unnest(range({low}, greatest({low}, least({high}, length(w))) + 1)) AS n FROM (
      SELECT {key}, ' ' || w || ' ' AS w FROM (
        SELECT {key}, unnest(regexp_split_to_array(strip_accents(lower({text})),
                                                   '[{_SPACES}]+')) AS w FROM {table})
      WHERE w <> '')))"""


@query("char_ngrams", f"""
SELECT term, CAST(count(DISTINCT doc_id) AS BIGINT) AS df, CAST(count(*) AS BIGINT) AS total_tf
FROM ({char_grams_sql(3, 5)}) GROUP BY term""")
def _(spark, folder):
    branch = FT.Branch("chars", "text", "chars", (3, 5))
    pairs = FT.term_counts(FT.doc_terms(documents(spark, folder), [branch], ["doc_id"]))
    return FT.vocabulary(pairs).drop("branch")


# Small dictionaries, the same rows in both engines.
LEXICON = (("thou", "PRP"), ("ended", "VBD"), ("er", "NN"), ("auf", "RB"), ("est", "VBZ"),
           ("reading", "VBG"), ("ent", "JJ"))
LEMMAS = (("ended", "v", "end"), ("est", "v", "be"), ("er", "n", "he"), ("ent", "a", "entish"),
          ("on", "n", "onn"))
SYNONYMS = (("end", "v", "stop"), ("onn", "n", "x-ray"), ("he", "n", "of"), ("be", "v", "Live_On"),
            ("for", "n", "per se"))


def _values(rows, names) -> str:
    lines = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return f"(VALUES {lines}) AS t({names})"


def dictionary(spark: SparkSession) -> DataFrame:
    return E.compose_dictionary(
        spark.sql(f"SELECT * FROM {_values(LEMMAS, 'token, pos, lemma')}"),
        spark.sql(f"SELECT * FROM {_values(SYNONYMS, 'lemma, pos, synonym')}"),
        spark.sql(f"SELECT * FROM {_values(LEXICON, 'token, tag')}"), STOP)


_SYNONYM_TOKENS = TOKENS_SQL.replace("(text,", "(synonym,")
DICTIONARY_SQL = f"""
tokens AS (SELECT doc_id, unnest(v) AS token, generate_subscripts(v, 1) AS place
           FROM (SELECT doc_id, {TOKENS_SQL} AS v FROM documents)),
tagged AS (SELECT tokens.*, CASE substr(tag, 1, 1) WHEN 'V' THEN 'v' WHEN 'R' THEN 'r'
                  WHEN 'J' THEN 'a' ELSE 'n' END AS pos
           FROM tokens LEFT JOIN (SELECT * FROM {_values(LEXICON, 'token, tag')}) USING (token)),
lemmatised AS (SELECT doc_id, place, token, pos, coalesce(l.lemma, token) AS lemma
               FROM tagged LEFT JOIN (SELECT * FROM {_values(LEMMAS, 'token, pos, lemma')}) l
               USING (token, pos)),
named AS (SELECT doc_id, place, token, pos, lemma, synonym FROM lemmatised
          LEFT JOIN (SELECT * FROM {_values(SYNONYMS, 'lemma, pos, synonym')}) USING (lemma, pos))"""


@query("word_class", f"""
WITH {DICTIONARY_SQL} SELECT pos, CAST(count(*) AS BIGINT) AS n FROM tagged GROUP BY pos""")
def _(spark, folder):
    lexicon = spark.sql(f"SELECT * FROM {_values(LEXICON, 'token, tag')}")
    stream = documents(spark, folder).select(
        "doc_id", F.explode(T.tokenise(F.col("text"), STOP)).alias("token"))
    return (scale.attach(stream, lexicon, ["token"]).groupBy(E.word_class(F.col("tag")).alias("pos"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("lemmas", f"""
WITH {DICTIONARY_SQL} SELECT lemma, CAST(count(*) AS BIGINT) AS n FROM lemmatised GROUP BY lemma""")
def _(spark, folder):
    stream = documents(spark, folder).select(
        "doc_id", F.explode(T.tokenise(F.col("text"), STOP)).alias("token"))
    found = scale.attach(stream, dictionary(spark).select("token", "lemma"), ["token"])
    return found.groupBy(F.coalesce("lemma", "token").alias("lemma")).agg(
        F.count(F.lit(1)).alias("n"))


@query("dictionary_tokens", f"""
WITH {DICTIONARY_SQL},
spread AS (SELECT doc_id, place, CASE WHEN synonym IS NULL THEN lemma ELSE synonym END AS word,
                  CASE WHEN synonym IS NULL THEN 1 ELSE len({_SYNONYM_TOKENS}) END AS times
           FROM named)
SELECT d.doc_id AS Id, CAST(coalesce(s.n, 0) AS BIGINT) AS n,
       md5(coalesce(s.words, '')) AS h
FROM documents d LEFT JOIN (
  SELECT doc_id, sum(times) AS n,
         string_agg(repeat(word || chr(31), CAST(times AS BIGINT)), '' ORDER BY place) AS words
  FROM spread GROUP BY doc_id) s ON d.doc_id = s.doc_id""")
def _(spark, folder):
    docs = multiclass(spark, folder).select("Id", T.tokenise(F.col("Text"), STOP).alias("Tokens"))
    out = E.normalise(docs, "Tokens", dictionary(spark))
    closed = F.transform("Tokens", lambda t: F.concat(t, F.lit(chr(31))))
    return out.select("Id", F.size("Tokens").cast("bigint").alias("n"),
                      F.md5(F.array_join(closed, "")).alias("h"))


# --- features ----------------------------------------------------------------------------------------

WORDS1 = FT.Branch("words", "Text", "words", (1, 1), STOP)
WORDS2 = FT.Branch("words", "Text", "words", (1, 2), STOP)
LIST2 = FT.Branch("tokens", "Tokens", "list", (1, 2))
CHARS = FT.Branch("chars", "Text", "chars", (3, 3))


def branch_sql(name: str, array: str, low: int, high: int, source: str = "documents",
               key: str = "doc_id") -> str:
    """One row per term occurrence of a list-valued branch: ``(Id, branch, term)``."""
    return (f"SELECT {key} AS Id, '{name}' AS branch, unnest({ngrams_sql('w', low, high)}) AS term "
            f"FROM (SELECT {key}, {array} AS w FROM {source})")


WORDS1_SQL = branch_sql("words", words_sql("text"), 1, 1)
WORDS2_SQL = branch_sql("words", words_sql("text"), 1, 2)
LIST2_SQL = branch_sql("tokens", TOKENS_SQL, 1, 2)
CHARS_SQL = f"SELECT doc_id AS Id, 'chars' AS branch, term FROM ({char_grams_sql(3, 3)})"


def tfidf_sql(occurrences: str, n: str = "(SELECT count(*) FROM documents)") -> str:
    """Common table expressions up to ``weighted(Id, branch, term, tf, df, idf, w)``."""
    return f"""
counted AS (SELECT Id, branch, term, CAST(count(*) AS BIGINT) AS tf FROM ({occurrences}) GROUP BY ALL),
vocab AS (SELECT branch, term, count(*) AS df, sum(tf) AS total_tf FROM counted GROUP BY ALL),
idf AS (SELECT *, ln((1 + {n}) / (1 + df)) + 1 AS idf FROM vocab),
raw AS (SELECT c.*, df, idf, tf * idf AS r FROM counted c JOIN idf USING (branch, term)),
weighted AS (SELECT *, r / sqrt(sum(r * r) OVER (PARTITION BY Id, branch)) AS w FROM raw)"""


def tokens_docs(spark, folder) -> DataFrame:
    return W.preprocess(multiclass(spark, folder), STOP)


def pairs_of(docs: DataFrame, *branches: FT.Branch) -> DataFrame:
    keep = ["Id", "Category"] if "Category" in docs.columns else ["Id"]
    return FT.term_counts(FT.doc_terms(docs, branches, keep))


def weighted_of(docs: DataFrame, *branches: FT.Branch) -> tuple[DataFrame, DataFrame]:
    counts, idf = V.fit_idf(docs, branches)
    return FT.weights(counts, idf), idf


def scaled_of(docs: DataFrame, *branches: FT.Branch) -> tuple[DataFrame, DataFrame]:
    counts, idf = V.fit_idf(docs, branches)
    return FT.scaled(counts, idf), idf


@query("term_counts", f"""
SELECT Id, term, CAST(count(*) AS BIGINT) AS tf FROM ({WORDS1_SQL}) GROUP BY ALL""")
def _(spark, folder):
    return pairs_of(multiclass(spark, folder), WORDS1).select("Id", "term", "tf")


@query("document_frequency", f"""
SELECT term, CAST(count(DISTINCT Id) AS BIGINT) AS df, CAST(count(*) AS BIGINT) AS total_tf
FROM ({WORDS2_SQL}) GROUP BY term""")
def _(spark, folder):
    return FT.vocabulary(pairs_of(multiclass(spark, folder), WORDS2)).drop("branch")


@query("smoothed_idf", f"""
WITH {tfidf_sql(WORDS2_SQL)} SELECT term, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM idf""")
def _(spark, folder):
    docs = multiclass(spark, folder)
    idf = FT.inverse_frequency(FT.vocabulary(pairs_of(docs, WORDS2)), docs)
    return idf.select("term", "df", r6("idf"))


@query("tfidf_words", f"""
WITH {tfidf_sql(WORDS1_SQL)} SELECT Id, term, tf, round(w, 6) AS w FROM weighted""")
def _(spark, folder):
    weighted, _ = weighted_of(multiclass(spark, folder), WORDS1)
    return weighted.select("Id", "term", "tf", r6("w"))


@query("tfidf_list", f"""
WITH {tfidf_sql(LIST2_SQL)}
SELECT term, CAST(count(*) AS BIGINT) AS df, round(sum(w), 6) AS w, round(max(w), 6) AS top
FROM weighted GROUP BY term""")
def _(spark, folder):
    weighted, _ = weighted_of(tokens_docs(spark, folder), LIST2)
    return weighted.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.round(F.sum("w"), 6).alias("w"),
        F.round(F.max("w"), 6).alias("top"))


@query("feature_union", f"""
WITH {tfidf_sql(f'{LIST2_SQL} UNION ALL {WORDS2_SQL} UNION ALL {CHARS_SQL}')}
SELECT Id, branch, CAST(count(*) AS BIGINT) AS n_terms, CAST(sum(tf) AS BIGINT) AS total_tf,
       round(sum(w), 6) AS w, round(max(w), 6) AS top FROM weighted GROUP BY ALL""")
def _(spark, folder):
    weighted, _ = weighted_of(tokens_docs(spark, folder), LIST2, WORDS2, CHARS)
    return weighted.groupBy("Id", "branch").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("total_tf"),
        F.round(F.sum("w"), 6).alias("w"), F.round(F.max("w"), 6).alias("top"))


DEFAULT_SQL = " UNION ALL ".join([
    branch_sql("tokens", TOKENS_SQL, 1, 3), branch_sql("text_words", words_sql("text"), 1, 2),
    f"SELECT doc_id AS Id, 'text_chars' AS branch, term FROM ({char_grams_sql(3, 7)})"])


@query("default_branches", f"""
WITH {tfidf_sql(DEFAULT_SQL)}
SELECT Id, branch, CAST(count(*) AS BIGINT) AS n_terms, CAST(sum(tf) AS BIGINT) AS total_tf,
       round(sum(w), 6) AS w, round(max(w), 6) AS top FROM weighted GROUP BY ALL""")
def _(spark, folder):
    """The union of a shape's own branches, with their full n-gram ranges."""
    from labelloom.plans import config
    weighted, _ = weighted_of(tokens_docs(spark, folder), *config.branches("multi-class", stop_words=STOP))
    return weighted.groupBy("Id", "branch").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("total_tf"),
        F.round(F.sum("w"), 6).alias("w"), F.round(F.max("w"), 6).alias("top"))


OPTIONAL_SQL = " UNION ALL ".join([
    branch_sql("title_words", words_sql("Title"), 1, 3, f"({BINARY_SQL})", "Id"),
    branch_sql("abstract_words", words_sql("Abstract"), 1, 3, f"({BINARY_SQL})", "Id"),
    "SELECT Id, 'title_chars' AS branch, term FROM ("
    + char_grams_sql(3, 9, "Title", f"({BINARY_SQL})", "Id") + ")",
    "SELECT Id, 'abstract_chars' AS branch, term FROM ("
    + char_grams_sql(3, 9, "Abstract", f"({BINARY_SQL})", "Id") + ")",
    branch_sql("terms", "string_split(Terms, ';')", 1, 1, f"({KEYWORDS_SQL})", "Id")
    + f" WHERE Id IN (SELECT doc_id FROM labels)",
    branch_sql("keywords", "string_split(Keywords, ';')", 1, 1, f"({KEYWORDS_SQL})", "Id")
    + f" WHERE Id IN (SELECT doc_id FROM labels)"])


@query("optional_branches", f"""
WITH c AS (SELECT Id, branch, term, count(*) AS tf FROM ({OPTIONAL_SQL}) GROUP BY ALL),
b AS (SELECT branch, CAST(count(*) AS BIGINT) AS n_entries,
             CAST(count(DISTINCT term) AS BIGINT) AS n_features,
             CAST(count(DISTINCT Id) AS BIGINT) AS n_rows FROM c GROUP BY branch)
SELECT branch, n_entries, n_features, n_rows FROM b""")
def _(spark, folder):
    from labelloom.plans import config
    side = E.keywords_and_terms(citations(spark, folder).withColumnRenamed("cit_id", "Id"))
    docs = A.join_side_table(binary(spark, folder), side)
    branches = config.branches("binary", ("title_words", "abstract_words", "title_chars",
                                          "abstract_chars", "terms", "keywords"), STOP)[1:]
    return FT.branch_counts(docs, branches)


@query("feature_counts", f"""
WITH c AS (SELECT DISTINCT Id, branch, term FROM ({WORDS2_SQL} UNION ALL {CHARS_SQL}))
SELECT branch, CAST(count(DISTINCT term) AS BIGINT) AS n_features, CAST(count(*) AS BIGINT) AS n_entries,
       CAST(count(DISTINCT Id) AS BIGINT) AS n_rows FROM c GROUP BY branch""")
def _(spark, folder):
    return FT.branch_counts(multiclass(spark, folder), [WORDS2, CHARS])


HELD_OUT_SQL = """
ranked AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
             ORDER BY md5(concat_ws('-', CAST(doc_id AS VARCHAR), '123456')), doc_id) AS r,
           count(*) OVER (PARTITION BY lang) AS n FROM documents),
split AS (SELECT doc_id AS Id, lang AS Category, r <= floor(n * 0.25 + 0.5) AS is_test FROM ranked)"""


@query("apply_fitted_features", f"""
WITH {HELD_OUT_SQL},
counted AS (SELECT Id, branch, term, count(*) AS tf FROM ({WORDS1_SQL}) GROUP BY ALL),
vocab AS (SELECT branch, term, count(*) AS df FROM counted
          WHERE Id IN (SELECT Id FROM split WHERE NOT is_test) GROUP BY ALL),
raw AS (SELECT c.Id, term, tf,
               tf * (ln((1 + (SELECT count(*) FROM split WHERE NOT is_test)) / (1 + df)) + 1) AS r
        FROM counted c JOIN vocab USING (branch, term)
        WHERE Id IN (SELECT Id FROM split WHERE is_test))
SELECT Id, term, CAST(tf AS BIGINT) AS tf,
       round(r / sqrt(sum(r * r) OVER (PARTITION BY Id)), 6) AS w FROM raw""")
def _(spark, folder):
    split = SP.holdout(multiclass(spark, folder))
    _, idf = V.fit_idf(split.filter("NOT is_test"), [WORDS1])
    new = scale.stage(FT.doc_terms(split.filter("is_test"), [WORDS1], ["Id"]), "counts")
    return FT.weights(new, idf).select("Id", "term", "tf", r6("w"))


# --- selection -----------------------------------------------------------------------------------------

def chi2_sql(occurrences: str) -> str:
    """Common table expressions up to ``scores(branch, term, score)`` against the language."""
    return f"""
{tfidf_sql(occurrences)},
classes AS (SELECT lang AS Category, count(*) / (SELECT count(*) FROM documents) AS share
            FROM documents GROUP BY lang),
observed AS (SELECT branch, term, lang AS Category, sum(w) AS o
             FROM weighted JOIN documents ON Id = doc_id GROUP BY ALL),
totals AS (SELECT branch, term, sum(o) AS total FROM observed GROUP BY ALL),
scores AS (SELECT t.branch, t.term,
                  sum((coalesce(o, 0) - total * share) ** 2 / (total * share)) AS score
           FROM totals t CROSS JOIN classes c
           LEFT JOIN observed o ON o.branch = t.branch AND o.term = t.term
                               AND o.Category = c.Category GROUP BY ALL)"""


CHI2_SQL = chi2_sql(WORDS2_SQL)


def chi2_of(spark, folder, branch=WORDS2) -> DataFrame:
    docs = multiclass(spark, folder)
    return S.chi2_scores(scaled_of(docs, branch)[0], None, docs)


@query("chi_squared", f"WITH {CHI2_SQL} SELECT term, round(score, 6) AS score FROM scores")
def _(spark, folder):
    return chi2_of(spark, folder).select("term", r6("score"))


@query("mutual_information", f"""
WITH {tfidf_sql(WORDS1_SQL)},
classes AS (SELECT lang AS Category, count(*) AS n_c FROM documents GROUP BY lang),
present AS (SELECT term, lang AS Category, round(w, 12) AS x, count(*) AS cell
            FROM weighted JOIN documents ON Id = doc_id GROUP BY ALL),
absent AS (SELECT t.term, c.Category, -1.0 AS x, c.n_c - coalesce(p.n, 0) AS cell
           FROM (SELECT DISTINCT term FROM present) t CROSS JOIN classes c
           LEFT JOIN (SELECT term, Category, sum(cell) AS n FROM present GROUP BY ALL) p
             ON p.term = t.term AND p.Category = c.Category),
cells AS (SELECT * FROM present UNION ALL SELECT * FROM absent WHERE cell > 0),
sums AS (SELECT *, sum(cell) OVER (PARTITION BY term, x) AS n_x FROM cells)
SELECT term, round(sum(cell / n * ln(cell * n / (n_x * n_c))), 6) + 0.0 AS score
FROM sums JOIN classes USING (Category), (SELECT count(*) AS n FROM documents)
GROUP BY term""")
def _(spark, folder):
    docs = multiclass(spark, folder)
    scores = S.mutual_information(*scaled_of(docs, WORDS1), docs)
    return scores.select("term", (F.round("score", 6) + F.lit(0.0)).alias("score"))


@query("select_k_best", f"""
WITH {CHI2_SQL} SELECT branch, term, round(score, 6) AS score FROM scores
ORDER BY round(scores.score, 9) DESC, branch DESC, term DESC LIMIT 200""")
def _(spark, folder):
    return S.select_k_best(chi2_of(spark, folder), 200).select("branch", "term", r6("score"))


@query("rank_terms", f"""
WITH {CHI2_SQL} SELECT term, CAST(row_number() OVER (
  ORDER BY round(score, 9) DESC, branch DESC, term DESC) AS BIGINT) AS rank FROM scores""")
def _(spark, folder):
    return S.rank_terms(chi2_of(spark, folder)).select("term", "rank")


@query("feature_vectors", f"""
WITH {CHI2_SQL},
best AS (SELECT branch, term FROM scores ORDER BY round(score, 9) DESC, branch DESC, term DESC LIMIT 200)
SELECT Id, term, round(w, 6) AS w FROM weighted JOIN best USING (branch, term)""")
def _(spark, folder):
    """The entries of the vectors handed to the classifier, by name."""
    docs = multiclass(spark, folder)
    fitted = V.fit_features(docs, [WORDS2], 200)
    entries = fitted.transform(docs, counts=fitted.counts, norms=fitted.norms).select(
        "Id", F.inline(F.filter(F.transform(vector_to_array("features"), lambda w, i: F.struct(
            i.alias("position"), w.alias("w"))), lambda e: e["w"] != 0)))
    named = scale.attach(entries, fitted.selected_terms(), ["position"], "inner")
    return named.select("Id", "term", r6("w"))


# --- split, folds, search -----------------------------------------------------------------------------


@query("stratified_holdout", f"WITH {HELD_OUT_SQL} SELECT Id, Category, is_test FROM split")
def _(spark, folder):
    return SP.holdout(multiclass(spark, folder)).select("Id", "Category", "is_test")


FOLDS_SQL = """
SELECT doc_id AS Id, lang AS Category,
       CAST(ntile(5) OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM documents"""


@query("stratified_folds", FOLDS_SQL)
def _(spark, folder):
    return SP.folds(multiclass(spark, folder), 5).select("Id", "Category", "fold")


FOLD_SCORES_SQL = f"""
rules AS (SELECT unnest([100, 500, 1000, 2000]) AS cut, unnest([0, 1, 2, 3]) AS candidate),
folded AS (SELECT Id, Category, score,
                  ntile(3) OVER (PARTITION BY Category ORDER BY Id) - 1 AS fold FROM ({JUDGED_SQL})),
scores AS (SELECT candidate, fold, avg(CASE WHEN (score * 100 >= cut) = (Category = '1')
                                            THEN 1.0 ELSE 0.0 END) AS score
           FROM folded CROSS JOIN rules GROUP BY ALL)"""


def fold_scores(spark, folder) -> DataFrame:
    """Candidates are length limits; each is scored on three folds of the labelled rows."""
    rows = SP.folds(judged(spark, folder), 3)
    limits = (100, 500, 1000, 2000)
    rules = F.array(*[F.struct(F.lit(i).alias("candidate"), F.lit(c).alias("cut"))
                      for i, c in enumerate(limits)])
    hit = (F.col("score") * 100 >= F.col("cut")) == (F.col("Category") == "1")
    return (rows.select("Category", "fold", "score", F.inline(rules))
            .groupBy("candidate", "fold").agg(F.avg(hit.cast("double")).alias("score")))


FOLD_TABLE_SQL = f"""
{FOLD_SCORES_SQL},
table_ AS (SELECT candidate, max(score) FILTER (fold = 0) AS fold_0,
                  max(score) FILTER (fold = 1) AS fold_1, max(score) FILTER (fold = 2) AS fold_2,
                  avg(score) AS mean_score, stddev_pop(score) AS std_score,
                  rank() OVER (ORDER BY round(avg(score), 12) DESC) AS rank
           FROM scores GROUP BY candidate)"""


@query("fold_table", f"""
WITH {FOLD_TABLE_SQL} SELECT candidate, round(fold_0, 6) AS fold_0, round(fold_1, 6) AS fold_1,
  round(fold_2, 6) AS fold_2, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score,
  CAST(rank AS INTEGER) AS rank FROM table_""")
def _(spark, folder):
    table = M.fold_table(fold_scores(spark, folder), 3)
    return table.select("candidate", *[r6(c) for c in ("fold_0", "fold_1", "fold_2", "mean_score",
                                                       "std_score")], "rank")


@query("best_candidate", f"""
WITH {FOLD_TABLE_SQL} SELECT candidate, round(mean_score, 6) AS mean_score FROM table_
ORDER BY round(table_.mean_score, 12) DESC, candidate LIMIT 1""")
def _(spark, folder):
    best = M.best_candidate(M.fold_table(fold_scores(spark, folder), 3))
    return best.select("candidate", r6("mean_score"))


@query("search_results_csv", f"""
WITH {FOLD_TABLE_SQL} SELECT candidate, round(mean_score, 6) AS mean_score,
  CAST(rank AS INTEGER) AS rank FROM table_""")
def _(spark, folder):
    path = f"{scale.shared_folder(spark)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_search_results(M.fold_table(fold_scores(spark, folder), 3), path)
    stored = "candidate int, fold_0 double, fold_1 double, fold_2 double, mean_score double, " \
             "std_score double, rank int"
    return spark.read.schema(stored).csv(path, header=True).select(
        "candidate", r6("mean_score"), "rank")


# --- evaluation ------------------------------------------------------------------------------------------


@query("accuracy", f"""
SELECT round(avg(CASE WHEN Category = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM ({JUDGED_SQL})""")
def _(spark, folder):
    return M.accuracy(M.confusion(judged(spark, folder))).select(r6("accuracy"))


REPORT_SQL = f"""
j AS ({JUDGED_SQL}),
k AS (SELECT DISTINCT Category AS class FROM j UNION SELECT DISTINCT prediction FROM j),
c AS (SELECT class, count(*) FILTER (Category = class AND prediction = class) AS tp,
             count(*) FILTER (prediction = class) AS claimed,
             count(*) FILTER (Category = class) AS support FROM k CROSS JOIN j GROUP BY class),
p AS (SELECT *, CASE WHEN claimed > 0 THEN tp / claimed ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM c),
report AS (SELECT *, CASE WHEN precision + recall > 0
                     THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM p)"""


@query("evaluation_report", f"""
WITH {REPORT_SQL}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM report
UNION ALL SELECT 'avg / total', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM report""")
def _(spark, folder):
    report = M.evaluation_report(M.confusion(judged(spark, folder)))
    return report.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


@query("confusion_table", f"""
SELECT Category AS truth, CAST(count(*) FILTER (prediction = '0') AS BIGINT) AS "0",
       CAST(count(*) FILTER (prediction = '1') AS BIGINT) AS "1" FROM ({JUDGED_SQL}) GROUP BY 1""")
def _(spark, folder):
    return M.confusion_table(M.confusion(judged(spark, folder)), ["0", "1"])


@query("positive_class_metrics", f"""
WITH {REPORT_SQL} SELECT round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1 FROM report WHERE class = '1'""")
def _(spark, folder):
    report = M.class_report(M.confusion(judged(spark, folder)))
    return report.filter(F.col("class") == "1").select(r6("precision"), r6("recall"), r6("f1"))


@query("averaged_metrics", f"""
WITH {REPORT_SQL}
SELECT 'macro' AS average, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
       round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM report
UNION ALL SELECT 'micro', round(sum(tp) / sum(claimed), 6), round(sum(tp) / sum(support), 6),
       round(2 * sum(tp) / (sum(claimed) + sum(support)), 6), CAST(sum(support) AS BIGINT) FROM report
UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM report""")
def _(spark, folder):
    out = M.averaged(M.class_report(M.confusion(judged(spark, folder))))
    return out.select("average", r6("precision"), r6("recall"), r6("f1"), "support")


@query("roc_auc", f"""
WITH j AS ({JUDGED_SQL}),
r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS k FROM j)
SELECT round((sum(k) FILTER (Category = '1') - p * (p + 1) / 2) / (p * n), 6) AS roc_auc
FROM r, (SELECT count(*) FILTER (Category = '1') AS p, count(*) FILTER (Category <> '1') AS n FROM j)
GROUP BY p, n""")
def _(spark, folder):
    return M.roc_auc(judged(spark, folder), "Category", "score", "1").select(r6("roc_auc"))


@query("average_precision", f"""
WITH j AS ({JUDGED_SQL}),
t AS (SELECT DISTINCT score,
             count(*) FILTER (Category = '1') OVER (ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS tp,
             count(*) OVER (ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS n FROM j),
s AS (SELECT *, tp - coalesce(lag(tp) OVER (ORDER BY score DESC), 0) AS gained FROM t)
SELECT round(sum(gained * tp / n) / (SELECT count(*) FROM j WHERE Category = '1'), 6)
  AS average_precision FROM s""")
def _(spark, folder):
    return M.average_precision(judged(spark, folder), "Category", "score", "1").select(
        r6("average_precision"))


@query("prediction_summary", f"""
SELECT prediction, CAST(count(*) AS BIGINT) AS documents FROM ({JUDGED_SQL}) GROUP BY prediction""")
def _(spark, folder):
    return M.prediction_summary(judged(spark, folder), "prediction")


@query("predictions_csv", f"SELECT Id, prediction AS Category FROM ({JUDGED_SQL})")
def _(spark, folder):
    path = f"{scale.shared_folder(spark)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_predictions(judged(spark, folder).select(
        "Id", F.col("prediction").alias("Category")), path)
    return A.read_csv(spark, path)


# --- votes -------------------------------------------------------------------------------------------------

VOTES_SQL = f"""
j AS ({JUDGED_SQL}),
votes AS (SELECT Id, CAST(tree AS INTEGER) AS tree, CAST(class AS INTEGER) AS class,
                 CASE WHEN (Id + tree) % 3 <> 0 THEN 0.0
                      WHEN (score >= 5 * tree) = (class = 1) THEN 1.0 ELSE 0.0 END AS vote
          FROM j CROSS JOIN (SELECT unnest(range(12)) AS tree) CROSS JOIN (SELECT unnest([0, 1]) AS class)),
running AS (SELECT *, sum(vote) OVER (PARTITION BY Id, class ORDER BY tree) AS votes_so_far FROM votes)"""


def votes(spark, folder) -> DataFrame:
    """Twelve length limits act as trees; each leaves out a third of the rows."""
    trees = F.posexplode(F.array(*[F.lit(5.0 * t) for t in range(12)])).alias("tree", "limit")
    rows = judged(spark, folder).select("Id", "score", trees)
    classes = F.explode(F.array(F.lit(0), F.lit(1))).alias("class")
    said = (F.col("score") >= F.col("limit")) == (F.col("class") == 1)
    unseen = (F.col("Id") + F.col("tree")) % 3 == 0
    return rows.select("Id", "tree", "score", "limit", classes).select(
        "Id", "tree", "class", F.when(unseen & said, 1.0).otherwise(0.0).alias("vote"))


@query("cumulative_votes", f"""
WITH {VOTES_SQL} SELECT Id, tree, class, vote + 0.0::DOUBLE AS vote,
  CAST(votes_so_far AS DOUBLE) AS votes_so_far FROM running""")
def _(spark, folder):
    return C.cumulative_votes(votes(spark, folder))


@query("oob_curve_of_votes", f"""
WITH {VOTES_SQL},
lead AS (SELECT Id, tree, max(votes_so_far) AS most,
                arg_min(class, (-votes_so_far, class)) AS top_class FROM running GROUP BY ALL)
SELECT CAST(tree + 1 AS INTEGER) AS n,
       round(avg(CASE WHEN top_class = CAST(Category AS INTEGER) THEN 1.0 ELSE 0.0 END), 6) AS oob_score
FROM lead JOIN j USING (Id) WHERE most > 0 GROUP BY tree""")
def _(spark, folder):
    truth = judged(spark, folder).select("Id", F.col("Category").cast("int").alias("label"))
    return C.curve(votes(spark, folder), truth, range(1, 13)).select("n", r6("oob_score"))


# --- enrichment end to end ------------------------------------------------------------------------------------

BEST_RECORD_SQL = f"""
a AS (SELECT item_id AS Id, unnest(list_distinct({words_sql('text')})) AS term FROM benchmark),
c AS (SELECT doc_id AS cit_id, unnest(list_distinct({words_sql('text')})) AS term FROM documents),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
      FROM c GROUP BY term),
s AS (SELECT a.Id, c.cit_id, round(sum(i.idf), 9) AS relevance
      FROM a JOIN c USING (term) JOIN i USING (term) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY Id ORDER BY relevance DESC, cit_id) AS r FROM s)"""


@query("enrich_articles", f"""
WITH {BEST_RECORD_SQL}
SELECT m.item_id AS Id, md5(coalesce(Terms, '')) AS terms_md5, md5(coalesce(Keywords, '')) AS keywords_md5
FROM benchmark m LEFT JOIN b ON m.item_id = b.Id AND b.r = 1 LEFT JOIN ({KEYWORDS_SQL}) k ON k.Id = b.cit_id""")
def _(spark, folder):
    """Titles to their most relevant record, whose terms and keywords are written as a side table and read."""
    asked = spark.read.parquet(f"{folder}/benchmark.parquet").select(
        F.col("item_id").alias("Id"), F.col("text").alias("Title"), F.lit("").alias("Abstract"))
    path = f"{scale.shared_folder(spark)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_side_table(W.enrich(asked, citations(spark, folder), STOP), path)
    side = A.fill_missing(A.read_side_table(spark, path))
    return side.select("Id", F.md5("Terms").alias("terms_md5"), F.md5("Keywords").alias("keywords_md5"))


@query("preprocess_with_dictionary", f"""
WITH {DICTIONARY_SQL},
spread AS (SELECT doc_id, place, CASE WHEN synonym IS NULL THEN lemma ELSE synonym END AS word,
                  CASE WHEN synonym IS NULL THEN 1 ELSE len({_SYNONYM_TOKENS}) END AS times
           FROM named)
SELECT d.doc_id AS Id, md5(coalesce(s.words, '')) AS h
FROM documents d LEFT JOIN (
  SELECT doc_id, rtrim(string_agg(repeat(word || ';', CAST(times AS BIGINT)), '' ORDER BY place), ';') AS words
  FROM spread GROUP BY doc_id) s ON d.doc_id = s.doc_id""")
def _(spark, folder):
    docs = W.preprocess(multiclass(spark, folder), STOP, dictionary(spark))
    return docs.select("Id", F.md5("Tokens").alias("h"))


# --- models on a planted rule ---------------------------------------------------------------------------------
#
# The class of a document is whether a certain word is among its terms. With one kept term, that term is the
# word, and every ensemble must give the rule back, which SQL states as well.

RULE = "that"
ONE = {"score": "chi2", "k": 1, "classifier": "extra_trees", "n_estimators": 8, "max_depth": 4}
PLANTED_SQL = f"""
SELECT doc_id AS Id, CASE WHEN list_contains({words_sql('text')}, '{RULE}') THEN 'with' ELSE 'without' END AS Category
FROM documents"""
PLANTED_SPLIT_SQL = f"""
rule AS ({PLANTED_SQL}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY Category
             ORDER BY md5(concat_ws('-', CAST(Id AS VARCHAR), '123456')), Id) AS r,
           count(*) OVER (PARTITION BY Category) AS n FROM rule),
split AS (SELECT Id, Category, r <= floor(n * 0.25 + 0.5) AS is_test FROM ranked)"""
NUMBERED_SQL = f"""
SELECT Id, CASE Category WHEN 'with' THEN 0.0 ELSE 1.0 END::DOUBLE AS label, label AS prediction FROM ({PLANTED_SQL})"""


def planted(spark, folder) -> DataFrame:
    has = F.array_contains(T.words(F.col("Text"), STOP), RULE)
    return multiclass(spark, folder).withColumn("Category", F.when(has, "with").otherwise("without"))


# Where rows are predicted that were not trained on, a weight below all trained ones must not decide: there the
# rule word stands in a short list of terms, next to language and source, and its weight hardly varies.
TERMS = FT.Branch("terms", "Terms", "list", (1, 1))


def planted_terms(spark, folder) -> DataFrame:
    word = F.when(F.col("Category") == "with", RULE)
    more = documents(spark, folder).select(F.col("doc_id").alias("Id"), "lang", "source")
    return planted(spark, folder).drop("Text").join(more, "Id").select(
        "Id", F.lit("").alias("Text"), F.concat_ws(";", word, "lang", "source").alias("Terms"), "Category")


def realistic(spark: SparkSession, folder: str) -> DataFrame:
    """Which language is each held-out document in? Extra trees on the 200 best word terms."""
    scored = W.score(multiclass(spark, folder), {"score": "chi2", "k": 200, "n_estimators": 30, "max_depth": 6},
                     [WORDS1]).scored
    return scored.select("Id", "Category", "predicted")


@query("categorise_held_out", f"""
WITH {PLANTED_SPLIT_SQL} SELECT Id, Category, Category AS predicted FROM split WHERE is_test""")
def _(spark, folder):
    scored = W.score(planted(spark, folder), ONE, [WORDS1]).scored
    return scored.select("Id", "Category", "predicted")


@query("train_and_predict", PLANTED_SQL)
def _(spark, folder):
    """Random forest trained on the labelled documents, applied to all documents."""
    docs = planted_terms(spark, folder)
    some = labels(spark, folder).select(F.col("doc_id").alias("Id"))
    model = W.train(scale.attach(docs, some, ["Id"], "left_semi"), {**ONE, "classifier": "random_forest"}, [TERMS])
    return W.predict(model, docs.drop("Category"))


@query("stage_metrics", f"""
WITH {PLANTED_SPLIT_SQL}
SELECT 'split' AS stage, count(*) AS rows, CAST(1 AS BIGINT) AS features FROM split
UNION ALL SELECT 'fit', count(*), 1 FROM split WHERE NOT is_test
UNION ALL SELECT 'evaluate', count(*), 1 FROM split WHERE is_test""")
def _(spark, folder):
    """Rows and features of each step of an evaluation; its seconds are not repeatable."""
    return W.score(planted(spark, folder), ONE, [WORDS1]).metrics.drop("seconds")


def same(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(Id, same)`` of two prediction tables; an Id of one side alone is not the same."""
    both = left.join(right.withColumnsRenamed({"Id": "_id", "Category": "_other"}), F.col("Id") == F.col("_id"), "full_outer")
    return both.select(F.coalesce("Id", "_id").alias("Id"),
                       (F.col("Id").isNotNull() & F.col("Category").eqNullSafe(F.col("_other"))).alias("same"))


SAME_SQL = "SELECT doc_id AS Id, TRUE AS same FROM documents"


def saved_and_loaded(spark, folder, **changes) -> DataFrame:
    docs = planted(spark, folder)
    model = W.train(docs, {**ONE, **changes}, [WORDS1])
    path = f"{scale.shared_folder(spark)}/labelloom/model-{uuid.uuid4().hex}"
    model.save(path)
    return same(model.predict(docs), W.LabelModel.load(spark, path).predict(docs))


@query("saved_model_predicts", SAME_SQL)
def _(spark, folder):
    """A model that was written and read back predicts as before."""
    return saved_and_loaded(spark, folder, k=50)


@query("saved_ensemble_predicts", SAME_SQL)
def _(spark, folder):
    return saved_and_loaded(spark, folder, k=20, classifier="random_threshold_trees", n_estimators=3)


@query("score_stream", SAME_SQL)
def _(spark, folder):
    """Predictions made while documents arrive as a stream of files are those made in one batch."""
    docs = planted(spark, folder)
    model = W.train(docs, ONE, [WORDS1])
    place = f"{scale.shared_folder(spark)}/labelloom/stream-{uuid.uuid4().hex}"
    arriving = spark.read.parquet(f"{folder}/documents.parquet").schema
    score_stream(spark, model, f"{folder}/documents*.parquet", arriving, f"{place}/out",
                 f"{place}/progress", prepare=lambda df: df.select(
                     F.col("doc_id").alias("Id"), F.col("text").alias("Text"))).awaitTermination()
    return same(model.predict(docs), spark.read.parquet(f"{place}/out").select("Id", "Category"))


def trained(spark, folder, classifier: str, **changes) -> DataFrame:
    """Labels and predictions of a model on the documents it was trained on."""
    docs = planted(spark, folder)
    scored = W.train(docs, {**ONE, "classifier": classifier, **changes}, [WORDS1]).score(docs)
    return TU.with_label(scored, ["with", "without"]).select("Id", "label", "prediction")


@query("random_threshold_trees", NUMBERED_SQL)
def _(spark, folder):
    return trained(spark, folder, "random_threshold_trees", n_estimators=4)


@query("boosted_trees", NUMBERED_SQL)
def _(spark, folder):
    return trained(spark, folder, "boosted_trees", n_estimators=4)


@query("leaf_limited_trees", NUMBERED_SQL)
def _(spark, folder):
    """Bagged trees grown best first to two leaves, split only where four rows meet: the rule is one split."""
    return trained(spark, folder, "best_first_trees", n_estimators=4, max_leaf_nodes=2, min_samples_split=4)


@query("random_split_trees", NUMBERED_SQL)
def _(spark, folder):
    """Extremely randomised trees: a threshold drawn between each node's own minimum and maximum."""
    return trained(spark, folder, "random_split_trees", n_estimators=4)


@query("saved_grown_trees_predict", SAME_SQL)
def _(spark, folder):
    return saved_and_loaded(spark, folder, k=20, classifier="best_first_trees", n_estimators=3, max_leaf_nodes=6)


def planted_vectors(spark, folder) -> DataFrame:
    docs = planted_terms(spark, folder)
    fitted = V.fit_features(docs, [TERMS], 1)
    return scale.stage(TU.with_label(fitted.transform(docs), TU.label_table(docs)).select(
        "Id", "Category", "label", "features"), "vectors")


OOB_SQL = "SELECT CAST(unnest(range(3, 9)) AS INTEGER) AS n, 1.0::DOUBLE AS oob_score FROM (SELECT count(*) FROM documents)"


@query("oob_curve", OOB_SQL)
def _(spark, folder):
    return C.BaggedTrees(8, 5).oob_curve(planted_vectors(spark, folder), 3)


@query("oob_curve_csv", OOB_SQL)
def _(spark, folder):
    """The curve written as a file and read back."""
    path = f"{scale.shared_folder(spark)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_oob_curve(C.BaggedTrees(8, 5).oob_curve(planted_vectors(spark, folder), 3), path)
    return spark.read.schema("n int, oob_score double").csv(path, header=True)


@query("feature_importances", f"""
WITH {chi2_sql(WORDS1_SQL)} SELECT branch, term FROM scores
ORDER BY round(scores.score, 9) DESC, branch DESC, term DESC LIMIT 200""")
def _(spark, folder):
    """The terms that a model's importances speak of are those that were selected."""
    model = W.train(multiclass(spark, folder), {**ONE, "k": 200}, [WORDS1])
    found = C.feature_importances(model.classifier, model.features.selected_terms())
    return found.filter("rank > 0 and importance >= 0 and std >= 0").select("branch", "term")


@query("sweep_selected_terms", "SELECT CAST(1 AS INTEGER) AS k, 1.0::DOUBLE AS score FROM (SELECT count(*) FROM documents)")
def _(spark, folder):
    return W.sweep_selection(planted_terms(spark, folder), [TERMS], (1,), 4, 4)


# A tree of depth 0 says the larger class of its training rows; one of depth 1 tells the rule.
SEARCH_SQL = f"""
folded AS (SELECT Id, Category, ntile(2) OVER (PARTITION BY Category ORDER BY Id) - 1 AS fold FROM ({PLANTED_SQL})),
sizes AS (SELECT fold, Category, count(*) AS n FROM folded GROUP BY ALL),
larger AS (SELECT 1 - fold AS fold, arg_max(Category, n) AS Category FROM sizes GROUP BY fold),
shares AS (SELECT fold, sum(n) FILTER (sizes.Category = larger.Category) / sum(n) AS score
           FROM sizes JOIN larger USING (fold) GROUP BY fold),
found AS (SELECT 0 AS max_depth, max(score) FILTER (fold = 0) AS fold_0, max(score) FILTER (fold = 1) AS fold_1 FROM shares
          UNION ALL SELECT 1, 1.0, 1.0)
SELECT CAST(max_depth AS VARCHAR) AS max_depth, round(fold_0, 6) AS fold_0, round(fold_1, 6) AS fold_1,
       round((fold_0 + fold_1) / 2, 6) AS mean_score, CAST(2 - max_depth AS INTEGER) AS rank FROM found"""


def _search(spark, folder, method: str, **settings) -> DataFrame:
    space = {"k": [1], "max_depth": [0, 1], "n_estimators": [3]}
    found = W.tune(planted_terms(spark, folder), method, "accuracy", [TERMS], space=space,
                   settings={"folds": 2, **settings})[1]
    return found.table.select(F.col("params")["max_depth"].alias("max_depth"), r6("fold_0"), r6("fold_1"),
                              r6("mean_score"), "rank")


@query("grid_search", f"WITH {SEARCH_SQL}")
def _(spark, folder):
    return _search(spark, folder, "grid")


@query("randomized_search", f"WITH {SEARCH_SQL}")
def _(spark, folder):
    return _search(spark, folder, "randomized", n_iter=2)


@query("evolutionary_search", f"WITH {SEARCH_SQL}")
def _(spark, folder):
    return _search(spark, folder, "evolutionary", population=6, generations=1)


# --- models on whole texts (no SQL form) ----------------------------------------------------------------------
#
# The planted twins above fit three terms a document. These run the same steps on all words (or character
# trigrams) of the texts; tests hold them on the smallest tables.

SMALL = {"score": "chi2", "k": 200, "n_estimators": 30, "max_depth": 6}


@query("train_and_predict_whole_text")
def _(spark, folder):
    """Random forest trained on the documents with a quality label, applied to all documents."""
    docs = documents(spark, folder).select(F.col("doc_id").alias("Id"), F.col("text").alias("Text"))
    side = labels(spark, folder).select(F.col("doc_id").alias("Id"), F.col("quality").cast("string").alias("Category"))
    model = W.train(A.join_side_table(docs, side), {**SMALL, "classifier": "random_forest"}, [CHARS])
    return W.predict(model, docs)


def text_vectors(spark, folder, k: int = 100) -> DataFrame:
    docs = multiclass(spark, folder)
    fitted = V.fit_features(docs, [WORDS1], k)
    vectors = fitted.transform(docs, counts=fitted.counts, norms=fitted.norms)
    return scale.stage(TU.with_label(vectors, TU.label_table(docs)).select(
        "Id", "Category", "label", "features"), "vectors")


@query("oob_curve_whole_text")
def _(spark, folder):
    return C.BaggedTrees(8, 5).oob_curve(text_vectors(spark, folder), 3)


@query("oob_curve_csv_whole_text")
def _(spark, folder):
    path = f"{scale.shared_folder(spark)}/labelloom/csv-{uuid.uuid4().hex}"
    K.write_oob_curve(C.BaggedTrees(8, 5).oob_curve(text_vectors(spark, folder), 3), path)
    return spark.read.schema("n int, oob_score double").csv(path, header=True)


@query("sweep_selected_terms_whole_text")
def _(spark, folder):
    return W.sweep_selection(multiclass(spark, folder), [WORDS1], (1, 50, 200), 4, 4)


def _text_search(spark, folder, method: str, space: dict, **settings) -> DataFrame:
    found = W.tune(multiclass(spark, folder), method, "f1_macro", [WORDS1], space=space,
                   settings={"folds": 2, **settings})[1]
    return found.table.withColumn("params", F.to_json("params"))


@query("grid_search_whole_text")
def _(spark, folder):
    return _text_search(spark, folder, "grid", {"k": [100], "max_depth": [2, 5], "n_estimators": [5]})


@query("randomized_search_whole_text")
def _(spark, folder):
    return _text_search(spark, folder, "randomized", {"k": [100], "max_depth": [2, 5], "n_estimators": [5, 10]}, n_iter=2)


@query("evolutionary_search_whole_text")
def _(spark, folder):
    return _text_search(spark, folder, "evolutionary", {"k": [100], "max_depth": [2, 5], "n_estimators": [4, 8]},
                        population=4, generations=1)
