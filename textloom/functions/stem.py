"""Porter stemming of distinct terms, and a stemming analyzer."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions.text import tokenize

# fixed values: English stop words of the analyzer
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "can", "for", "from", "have", "if", "in", "is", "it", "may", "not", "of", "on", "or", "tbd", "that", "the", "this", "to", "us", "we", "when", "will", "with", "yet", "you", "your"]
# fixed values: suffixes of steps 2, 3 and 4 of Porter's algorithm (1980)
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _shape(word: str) -> str:
    """c for consonants and v for vowels, place by place."""
    out = ""
    for i, ch in enumerate(word):
        out += "v" if ch in "aeiou" or ch == "y" and i and out[-1] == "c" else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _suffix(word: str, table) -> str:
    return next((s for s in sorted(table, key=len, reverse=True) if word.endswith(s)), "")


def porter(word: str) -> str:
    """The stem of a lower-case word."""
    if len(word) <= 2:
        return word
    if word.endswith("s"):
        word = word[:-2] if word.endswith(("sses", "ies")) else word if word.endswith("ss") else word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        s = _suffix(word, ("ed", "ing"))
        if s and "v" in _shape(word[: -len(s)]):
            word = word[: -len(s)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _cvc(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (STEP2, STEP3):
        s = _suffix(word, table)
        if s and _measure(word[: -len(s)]) > 0:
            word = word[: -len(s)] + table[s]
    s = _suffix(word, STEP4)
    if s and _measure(word[: -len(s)]) > 1 and (s != "ion" or word[: -len(s)].endswith(("s", "t"))):
        word = word[: -len(s)]
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _cvc(word[:-1]):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(StringType())
def _stem(words: pd.Series) -> pd.Series:
    return words.map(porter)


class Analyzer:
    """Frequencies of lower-case ASCII tokens (bytes) as those of the analyzer's terms: without stop words and single characters, stemmed.
    Stems are kept for up to twice `room` words; words that come again stay."""

    def __init__(self, room: int = 200_000):
        self.room, self.young, self.old, self.stop = room, {}, {}, {w.encode() for w in STOP_WORDS}

    def __call__(self, counts: dict) -> dict:
        out: dict = {}
        for word, n in counts.items():
            if len(word) > 1 and word not in self.stop:
                if (term := self.young.get(word)) is None:
                    if len(self.young) >= self.room:
                        self.young, self.old = {}, self.young
                    term = self.young[word] = self.old.get(word) or porter(word.decode()).encode()
                out[term] = out.get(term, 0) + n
        return out


def analyzed_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, term): tokens without stop words and single characters, stemmed.  Each distinct word is stemmed once."""
    tokens = docs.select(key, F.posexplode(tokenize(text)).alias("pos", "word")).filter((F.length("word") > 1) & ~F.col("word").isin(*STOP_WORDS))
    stems = tokens.select("word").distinct().withColumn("term", _stem("word"))
    return tokens.join(stems, "word").select(key, "pos", "term")
