"""Feature branches, fixed parameters and search spaces per article shape."""

from __future__ import annotations

from labelloom.functions import text as T
from labelloom.operators.classifiers import DEEPEST
from labelloom.operators.features import Branch

HOLDOUT_FRACTION = 0.25
SELECTED_TERMS = 4000


def branches(shape: str, optional: tuple[str, ...] = (), stop_words: tuple[str, ...] | None = None
             ) -> list[Branch]:
    """The branches of a shape, plus any of the optional binary ones by name.

    Word branches leave out the English stop words that ship with Spark unless told otherwise.
    """
    stop_words = tuple(T.default_stop_words() if stop_words is None else stop_words)
    if shape == "multi-class":
        return [Branch("tokens", "Tokens", "list", (1, 3)),
                Branch("text_words", "Text", "words", (1, 2), stop_words),
                Branch("text_chars", "Text", "chars", (3, 7))]
    known = {
        "title_words": Branch("title_words", "Title", "words", (1, 3), stop_words),
        "abstract_words": Branch("abstract_words", "Abstract", "words", (1, 3), stop_words),
        "title_chars": Branch("title_chars", "Title", "chars", (3, 9)),
        "abstract_chars": Branch("abstract_chars", "Abstract", "chars", (3, 9)),
        "terms": Branch("terms", "Terms", "list", (1, 1)),
        "keywords": Branch("keywords", "Keywords", "list", (1, 1)),
    }
    return [Branch("tokens", "Tokens", "list", (1, 2)), *[known[name] for name in optional]]


# The parameters used without a search. Trees without a depth limit grow as deep as Spark ML can.
FIXED = {
    "binary": {"score": "mutual_information", "k": 4000, "classifier": "extra_trees",
               "n_estimators": 1531, "max_depth": DEEPEST},
    "multi-class": {"score": "chi2", "k": 750, "classifier": "extra_trees",
                    "n_estimators": 1200, "max_depth": 10},
}

# Candidate values per search method and shape. ``without`` leaves a branch out. A depth of 40
# stands for the deepest tree that Spark ML grows.
SPACES = {
    "grid": {
        "binary": {"max_depth": [2, 5], "n_estimators": [10, 80],
                   "without": ["", "tokens"]},
        "multi-class": {"k": [1000], "max_depth": [2, 5], "n_estimators": [10, 80],
                        "without": ["", "tokens"]},
    },
    "randomized": {
        "binary": {"classifier": ["extra_trees"], "n_estimators": [1000]},
        "multi-class": {"k": [1000], "max_depth": [2, 5, 10, 20],
                        "n_estimators": [10, 20, 50, 80, 300], "without": ["", "tokens"]},
    },
    "evolutionary": {
        "binary": {"max_depth": [2, 10, DEEPEST], "n_estimators": [10, 80]},
        "multi-class": {"k": [1000], "max_depth": [2, 10, DEEPEST], "n_estimators": [10, 80, 300],
                        "without": ["", "tokens"]},
    },
}

# Folds, draws, seeds and the evolution's settings.
SEARCH = {
    "grid": {"folds": 2},
    "randomized": {"folds": 50, "n_iter": 1, "seed": 654321},
    "evolutionary": {"folds": 2, "population": 50, "mutation": 0.10, "crossover": 0.5,
                     "tournament": 3, "generations": 5, "seed": 32135},
}

# Numbers of terms tried by the sweep over k, and the smallest ensemble scored.
SWEEP = [100000 * i for i in range(1, 15)]
OOB_SMALLEST = 25
