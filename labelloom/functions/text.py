"""Tokenising and normalising text as native column expressions.

Every function takes and returns Spark columns, so a whole cleaning chain stays one narrow
projection inside the JVM and never shuffles a document.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes are spelled out because ``\w`` and ``\s`` are ASCII-only in Java.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\s\p{Z}\x0B\x1C-\x1F\x{85}"
WORD_OR_PUNCT = rf"[{WORD_CHARS}]+|[^{WORD_CHARS}{SPACE_CHARS}]+"
WORDS_OF_TWO = rf"[{WORD_CHARS}]{{2,}}"
# What Python's float() accepts once a token holds no sign and no dot.
NUMBER = r"^(?i:\p{Nd}+(_\p{Nd}+)*(e\p{Nd}+(_\p{Nd}+)*)?|nan|inf|infinity)$"
# The 32 ASCII punctuation marks; the empty token matches as well.
ONLY_PUNCTUATION = r"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Lambda bodies re-evaluate outer expressions for each element; binding the value as a
    lambda variable of its own keeps it computed once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


# --- splitting -----------------------------------------------------------------------------

def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(text, r"(?<=[.!?])\s+")


def word_punct(text: Column) -> Column:
    """Runs of word characters and runs of punctuation, in order."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_PUNCT), F.lit(0))


def split_list(value: Column, keep_empty: bool = True) -> Column:
    """Split a ``;`` list; a missing value gives no items, ``''`` gives one empty item."""
    items = F.coalesce(F.split(value, ";"), _empty_strings())
    return items if keep_empty else F.filter(items, lambda t: t != "")


def join_list(items: Column) -> Column:
    return F.concat_ws(";", items)


def detokenise(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


# --- single-token rules ----------------------------------------------------------------------

def lower_token(token: Column) -> Column:
    return F.lower(token)


def strip_token(token: Column) -> Column:
    """Trim white space, then underscores, then asterisks."""
    return F.btrim(F.btrim(F.btrim(token), F.lit("_")), F.lit("*"))


def is_number(token: Column) -> Column:
    return token.rlike(NUMBER)


def is_punctuation(token: Column) -> Column:
    return token.rlike(ONLY_PUNCTUATION)


def is_stop_word(token: Column, stop_words: Iterable[str]) -> Column:
    words = sorted(set(stop_words))
    return token.isin(words) if words else F.lit(False)


def clean_tokens(tokens: Column, stop_words: Iterable[str] = (), lower: bool = True,
                 strip: bool = True) -> Column:
    """Lower, strip, then drop stop words, numbers and punctuation."""
    def shape(token: Column) -> Column:
        token = lower_token(token) if lower else token
        return strip_token(token) if strip else token

    def keep(token: Column) -> Column:
        return ~(is_stop_word(token, stop_words) | is_number(token) | is_punctuation(token))

    return F.filter(F.transform(tokens, shape), keep)


def tokenise(text: Column, stop_words: Iterable[str] = (), lower: bool = True,
             strip: bool = True) -> Column:
    """The full cleaning chain from raw text to tokens (dictionary steps excluded)."""
    return clean_tokens(word_punct(text), stop_words, lower, strip)


# --- accents -----------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str, str]:
    """(accented letters, their base letters, bare combining marks), derived from Unicode data.

    Holds each character of the basic plane outside the Asian blocks whose compatibility
    decomposition, without combining marks, is exactly one other character.
    """
    accented, plain, marks = [], [], []
    for point in (*range(0x80, 0x2E80), *range(0xFB00, 0xFB50), *range(0xFE20, 0xFE30),
                  *range(0xFF01, 0xFF60)):
        char = chr(point)
        base = "".join(c for c in unicodedata.normalize("NFKD", char)
                       if not unicodedata.combining(c))
        if not base:
            marks.append(char)
        elif base != char and len(base) == 1:
            accented.append(char)
            plain.append(base)
    return "".join(accented), "".join(plain), "".join(marks)


def strip_accents(text: Column) -> Column:
    """Replace accented letters by their base letter and drop combining marks."""
    accented, plain, marks = accent_table()
    return F.when(text.rlike(r"[^\x00-\x7F]"),
                  F.translate(text, accented + marks, plain)).otherwise(text)


# --- analysers -----------------------------------------------------------------------------------

def words(text: Column, stop_words: Iterable[str] = ()) -> Column:
    """Lower-cased words of two or more characters, accents and stop words removed."""
    found = F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(WORDS_OF_TWO), F.lit(0))
    stop_words = tuple(stop_words)
    return F.filter(found, lambda t: ~is_stop_word(t, stop_words)) if stop_words else found


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """Runs of ``low`` to ``high`` neighbouring tokens, joined by a blank."""
    if (low, high) == (1, 1):
        return tokens

    def of_size(array: Column, n: int) -> Column:
        if n == 1:
            return array
        starts = F.sequence(F.lit(1), F.size(array) - n + 1)
        grams = F.transform(starts, lambda i: F.array_join(F.slice(array, i, n), " "))
        return F.when(F.size(array) >= n, grams).otherwise(_empty_strings())

    return let(tokens, lambda a: F.concat(*[of_size(a, n) for n in range(low, high + 1)]))


def char_words(text: Column) -> Column:
    """The lower-cased words, accents removed, inside which character n-grams are cut."""
    clean = strip_accents(F.lower(text))
    return F.filter(F.split(clean, rf"[{SPACE_CHARS}]+"), lambda w: w != "")


def word_runs(word: Column, low: int, high: int) -> Column:
    """All character n-grams of one word with a blank on both sides; a shorter one gives itself."""
    def at(padded: Column, start: Column) -> Column:
        longest = F.least(F.lit(high), F.length(padded) - start + 1)
        return F.transform(F.sequence(F.lit(low), F.greatest(F.lit(low), longest)),
                           lambda n: F.substring(padded, start, n))

    def of_word(padded: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - low + 1))
        return F.flatten(F.transform(starts, lambda i: at(padded, i)))

    return let(F.concat(F.lit(" "), word, F.lit(" ")), of_word)


def char_ngrams(text: Column, low: int, high: int) -> Column:
    """Character n-grams that never cross a word border.

    Each word gets a blank on both sides; a padded word shorter than ``low`` is emitted once.
    """
    return F.flatten(F.transform(char_words(text), lambda w: word_runs(w, low, high)))


def count_terms(terms: Column) -> Column:
    """``array<string>`` to ``array<struct<term, tf>>``, one entry per distinct term.

    Sorts the array once and measures the runs of equal terms, so the count per document needs
    no shuffle: a document never leaves its row.
    """
    def runs(ordered: Column) -> Column:
        positions = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(positions, lambda i: (i == 0)
                          | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda p, j: F.struct(
            F.get(ordered, p).alias("term"),
            (F.coalesce(F.get(s, j + 1), F.size(ordered)) - p).cast("bigint").alias("tf"))))

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return let(F.sort_array(terms),
               lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty))


def default_stop_words(language: str = "english") -> Sequence[str]:
    """The stop-word list that ships with Spark ML. Pass a list of your own to replace it."""
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover.loadDefaultStopWords(language)
