"""Adding keywords, terms, lemmas and synonyms to articles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.functions import text as T

# --- citation records ------------------------------------------------------------------------


def heading_names(mesh: Column) -> Column:
    """All heading names of a citation record; missing means none."""
    return F.coalesce(F.transform(mesh, lambda h: h["DescriptorName"]),
                      F.array().cast("array<string>"))


def first_keywords(keyword_lists: Column) -> Column:
    """Only the first keyword list of a citation record; missing means none."""
    return F.coalesce(F.get(keyword_lists, F.lit(0)), F.array().cast("array<string>"))


def keywords_and_terms(matched: DataFrame) -> DataFrame:
    """``(Id, Terms, Keywords)`` as ``;`` lists from matched citation records."""
    return matched.select(
        "Id", T.join_list(heading_names(F.col("mesh"))).alias("Terms"),
        T.join_list(first_keywords(F.col("keyword_lists"))).alias("Keywords"))


def coverage(side: DataFrame) -> DataFrame:
    """Articles that got keywords and terms, in total."""
    return side.agg(F.count(F.lit(1)).alias("articles"),
                    F.count_if(F.col("Keywords") != "").alias("with_keywords"),
                    F.count_if(F.col("Terms") != "").alias("with_terms"))


def running_coverage(side: DataFrame) -> DataFrame:
    """The same counts as they grow in id order."""
    flags = side.groupBy("Id").agg(
        F.count(F.lit(1)).alias("articles"),
        F.count_if(F.col("Keywords") != "").alias("with_keywords"),
        F.count_if(F.col("Terms") != "").alias("with_terms"))
    counts = ["articles", "with_keywords", "with_terms"]
    return scale.running_totals(flags, ["Id"], counts).select(
        "Id", *[F.col(f"running_{c}").alias(c) for c in counts])


# --- relevance lookup --------------------------------------------------------------------------

# Terms in at most this many distinct corpus texts are looked up first; texts that these cannot
# settle are tried again with a limit that many times larger.
RARE_POSTINGS = 200
POSTINGS_GROWTH = 50


def _hashed_terms(df: DataFrame, key: str, text: str, stop_words: Iterable[str]) -> DataFrame:
    """Key, sorted distinct terms, and a hash of these."""
    terms = F.array_sort(F.array_distinct(T.words(F.col(text), stop_words)))
    return (df.select(key, terms.alias("terms"))
            .withColumn("h", F.sha2(F.array_join("terms", " "), 256)))


def _best_by_rare_terms(asked_terms: DataFrame, postings: DataFrame, known: DataFrame,
                        frequency: DataFrame, limit: int) -> DataFrame:
    """Best record per asked text among those sharing a term of at most ``limit`` postings.

    ``bound`` is what any other record can reach at most.
    """
    frequent = F.col("texts") > limit
    profile = asked_terms.groupBy("h").agg(
        F.sum(F.when(frequent, F.col("idf")).otherwise(0.0)).alias("bound"),
        F.collect_list(F.when(frequent, F.struct("term", "idf"))).alias("frequent"))
    rare = frequency.filter(~frequent).select("term", "idf")
    listed = scale.attach(postings.select("cit_id", "term"), rare, ["term"], "inner")
    candidates = scale.stage(
        scale.skew_join(asked_terms.select("h", "term"), listed, ["term"])
        .groupBy("h", "cit_id").agg(F.sum("idf").alias("rare_score")), "candidates")
    best_rare = candidates.groupBy("h").agg(F.max("rare_score").alias("best_rare"))
    # A candidate can gain at most ``bound``, so those further behind cannot win.
    hopeful = scale.stage(
        candidates.join(best_rare, "h").join(profile, "h")
        .filter(F.col("rare_score") + F.col("bound") >= F.col("best_rare") - 1e-9), "hopeful")
    scored = scale.skew_join(hopeful, known.select("cit_id", "terms"), ["cit_id"])
    gained = F.aggregate(
        F.filter("frequent", lambda s: F.array_contains(F.col("terms"), s["term"])),
        F.lit(0.0), lambda total, s: total + s["idf"])
    return (scored.withColumn("relevance", F.round(F.col("rare_score") + gained, 9))
            .groupBy("h").agg(F.max("relevance").alias("relevance"), F.max("bound").alias("bound"),
                              F.max_by("cit_id", F.struct("relevance", -F.col("cit_id")))
                              .alias("cit_id")))


def most_relevant(articles: DataFrame, corpus: DataFrame, title: str = "Title",
                  corpus_title: str = "title", stop_words: Iterable[str] = (),
                  rare_postings: int = RARE_POSTINGS) -> DataFrame:
    """``(Id, cit_id, relevance)``: the best corpus record per article, or nulls without any.

    Relevance is the summed idf of the shared terms; ties go to the lowest ``cit_id``. The result
    is exact, yet frequent terms are not multiplied out: candidates come from rare terms, where
    posting lists are short; their frequent shared terms are added afterwards. A record sharing
    only frequent terms cannot exceed the sum of the article's frequent terms, so an article whose
    best candidate is above that sum is settled. The others are tried again with longer posting
    lists until every article is settled. Equal texts are looked up once.
    """
    stop_words = tuple(stop_words)
    hashed = scale.stage(_hashed_terms(articles, "Id", title, stop_words), "articles")
    asked = hashed.groupBy("h").agg(F.first("terms").alias("terms"))
    known = scale.stage(
        _hashed_terms(corpus, "cit_id", corpus_title, stop_words).groupBy("h").agg(
            F.min("cit_id").alias("cit_id"), F.first("terms").alias("terms"),
            F.count(F.lit(1)).alias("copies")), "corpus")
    n = corpus.agg(F.count(F.lit(1))).scalar()

    wanted = asked.select(F.explode("terms").alias("term")).distinct()
    postings = known.select("cit_id", "copies", F.explode("terms").alias("term"))
    frequency = scale.stage(
        postings.groupBy("term").agg(F.sum("copies").alias("df"), F.count(F.lit(1)).alias("texts"))
        .join(wanted, "term", "left_semi")
        .withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1), "frequency")

    def valued(df: DataFrame) -> DataFrame:
        return scale.attach(df, frequency.select("term", "idf", "texts"), ["term"], "inner")

    still_open = scale.stage(valued(asked.select("h", F.explode("terms").alias("term"))), "open")
    longest = frequency.agg(F.max("texts")).first()[0] or 0
    found, limit = None, rare_postings
    while True:
        best = scale.stage(_best_by_rare_terms(still_open, postings, known, frequency, limit), "best")
        settled = best.filter(F.col("relevance") > F.col("bound") + 1e-9).select(
            "h", "cit_id", "relevance")
        found = settled if found is None else found.unionByName(settled)
        if limit >= longest:
            break
        still_open = scale.stage(still_open.join(settled.select("h"), "h", "left_anti"), "open")
        if still_open.isEmpty():
            break
        limit *= POSTINGS_GROWTH
    return scale.skew_join(hashed.select("Id", "h"), found, ["h"], "left").select(
        "Id", "cit_id", "relevance")


def lookup(articles: DataFrame, corpus: DataFrame, title: str = "Title",
           corpus_title: str = "title", stop_words: Iterable[str] = ()) -> DataFrame:
    """The side table ``(Id, Terms, Keywords)`` from the most relevant record per article."""
    found = scale.stage(most_relevant(articles, corpus, title, corpus_title, stop_words), "found")
    records = corpus.select("cit_id", "mesh", "keyword_lists")
    return keywords_and_terms(scale.skew_join(found, records, ["cit_id"], "left"))


# --- dictionaries ------------------------------------------------------------------------------

# First letter of a tag to its word class; any other tag is a noun.
WORD_CLASS = {"N": "n", "V": "v", "R": "r", "J": "a"}


def word_class(tag: Column) -> Column:
    out = F.lit("n")
    for letter, name in WORD_CLASS.items():
        out = F.when(F.substring(tag, 1, 1) == letter, name).otherwise(out)
    return out


def compose_dictionary(lemmas: DataFrame, synonyms: DataFrame, lexicon: DataFrame | None = None,
                       stop_words: Iterable[str] = (), once: bool = False) -> DataFrame:
    """``(token, out)``: what each dictionary token turns into.

    ``lexicon(token, tag)``, ``lemmas(token, pos, lemma)`` and ``synonyms(lemma, pos, synonym)``
    are folded into one table first, so that a token stream needs a single join. A synonym is cut
    into sub-tokens and the whole name is emitted once for each that survives cleaning.
    """
    keys = lemmas.select("token").union(synonyms.select(F.col("lemma").alias("token")))
    if lexicon is not None:
        keys = keys.union(lexicon.select("token"))
    tagged = keys.distinct()
    if lexicon is not None:
        tagged = tagged.join(lexicon, "token", "left")
    else:
        tagged = tagged.withColumn("tag", F.lit(None).cast("string"))
    named = (tagged.withColumn("pos", word_class(F.col("tag")))
             .join(lemmas, ["token", "pos"], "left")
             .withColumn("lemma", F.coalesce("lemma", "token"))
             .join(synonyms, ["lemma", "pos"], "left"))
    times = F.lit(1) if once else F.size(T.tokenise(F.col("synonym"), stop_words))
    return named.select("token", "tag", "pos", "lemma", "synonym", F.when(
        F.col("synonym").isNull(), F.array("lemma")).otherwise(
        F.array_repeat("synonym", times)).alias("out"))


def normalise(docs: DataFrame, tokens: str, dictionary: DataFrame) -> DataFrame:
    """Replace each token by its dictionary output; unknown tokens stay. Keeps token order.

    Only the distinct tokens of a row that the dictionary holds move: they come back to their row as a
    small map. Rows are told apart by a stored row number, so repeated ids stay apart.
    """
    entries = scale.stage(dictionary.groupBy("token").agg(
        F.flatten(F.array_sort(F.collect_list("out"))).alias("out")), "dictionary")
    rows = scale.stage(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    own = F.col(tokens)
    asked = rows.select("_row", F.explode(F.array_distinct(own)).alias("token"))
    found = scale.attach(asked, entries, ["token"], "inner").groupBy("_row").agg(
        F.map_from_entries(F.collect_list(F.struct("token", "out"))).alias("_known"))
    replaced = F.flatten(F.transform(own, lambda t: F.coalesce(
        F.when(F.col("_known").isNotNull(), F.try_element_at("_known", t)), F.array(t))))
    return (rows.join(found, "_row", "left")
            .withColumn(tokens, F.coalesce(replaced, F.array().cast("array<string>"))).select(*docs.columns))
