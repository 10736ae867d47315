"""English contractions and their long forms."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import MARK, let, per_word

# The public list of English contractions.
CONTRACTIONS = {
    "ain't": "are not", "aren't": "are not", "can't": "cannot", "can't've": "cannot have", "'cause": "because",
    "could've": "could have", "couldn't": "could not", "couldn't've": "could not have", "didn't": "did not",
    "doesn't": "does not", "don't": "do not", "hadn't": "had not", "hadn't've": "had not have",
    "hasn't": "has not", "haven't": "have not", "he'd": "he would", "he'd've": "he would have",
    "he'll": "he will", "he'll've": "he will have", "he's": "he is", "how'd": "how did", "how'll": "how will",
    "how's": "how is", "i'd": "i would", "i'd've": "i would have", "i'll": "i will", "i'll've": "i will have",
    "i'm": "i am", "i've": "i have", "isn't": "is not", "it'd": "it would", "it'd've": "it would have",
    "it'll": "it will", "it'll've": "it will have", "it's": "it is", "let's": "let us", "ma'am": "madam",
    "mayn't": "may not", "might've": "might have", "mightn't": "might not", "must've": "must have",
    "mustn't": "must not", "needn't": "need not", "o'clock": "of the clock", "oughtn't": "ought not",
    "shan't": "shall not", "she'd": "she would", "she'll": "she will", "she's": "she is",
    "should've": "should have", "shouldn't": "should not", "so's": "so is", "so've": "so have",
    "that'd": "that would", "that'll": "that will", "that's": "that is", "there'd": "there would",
    "there'll": "there will", "there's": "there is", "they'd": "they would", "they'll": "they will",
    "they're": "they are", "they've": "they have", "this's": "this is", "to've": "to have",
    "wasn't": "was not", "we'd": "we would", "we'll": "we will", "we're": "we are", "we've": "we have",
    "weren't": "were not", "what'll": "what will", "what're": "what are", "what's": "what is",
    "what've": "what have", "when's": "when is", "when've": "when have", "where'd": "where did",
    "where's": "where is", "where've": "where have", "who'd": "who would", "who'll": "who will",
    "who's": "who is", "who've": "who have", "why'd": "why did", "why's": "why is", "why've": "why have",
    "will've": "will have", "won't": "will not", "would've": "would have", "wouldn't": "would not",
    "wouldn't've": "would not have", "y'all": "you all", "you'd": "you would", "you'll": "you will",
    "you're": "you are", "you've": "you have",
    "mightn't've": "might not have", "mustn't've": "must not have", "needn't've": "need not have",
    "oughtn't've": "ought not have", "sha'n't": "shall not", "shan't've": "shall not have",
    "she'd've": "she would have", "she'll've": "she will have", "shouldn't've": "should not have",
    "that'd've": "that would have", "there'd've": "there would have", "they'd've": "they would have",
    "they'll've": "they will have", "we'd've": "we would have", "we'll've": "we will have",
    "what'll've": "what will have", "who'll've": "who will have", "won't've": "will not have",
    "y'all'd": "you all would", "y'all'd've": "you all would have", "y'all're": "you all are",
    "y'all've": "you all have", "you'd've": "you would have", "you'll've": "you will have",
    "'tis": "it is", "'twas": "it was", "e'er": "ever", "ne'er": "never", "o'er": "over", "how'd'y": "how do you",
    "how're": "how are", "there're": "there are", "these're": "these are", "those're": "those are", "who're": "who are",
    "why're": "why are", "where're": "where are", "when'll": "when will", "where'll": "where will", "why'll": "why will",
    "what'd": "what did", "when'd": "when did", "daren't": "dare not", "everyone's": "everyone is",
    "somebody's": "somebody is", "something's": "something is", "someone's": "someone is",
    "gimme": "give me", "gonna": "going to", "gotta": "got to", "lemme": "let me", "wanna": "want to",
}

LONGEST = max(len(word) for word in CONTRACTIONS)
_JOINED = [word for word in CONTRACTIONS if "'" not in word]
# Letters with an apostrophe, from the beginning of a word only (long words stay linear).
APOSTROPHE_WORD = r"((?<![A-Za-z'])[A-Za-z]*+'[A-Za-z']*+)"
# The first letters by position: a cheap look ahead that spares most places the costlier tests.
_STARTS = "".join(
    "[" + "".join(sorted({c for word in _JOINED for c in (word[i], word[i].upper())})) + "]" for i in range(4)
)
JOINED_WORD = rf"(?={_STARTS})(?<!')\b((?i:{'|'.join(_JOINED)}))\b(?!')"


def _replace_words(text: Column, pattern: str) -> Column:
    """Look up every match of ``pattern``; an unknown word stays, a capital first letter stays a capital."""
    table = F.from_json(F.lit(json.dumps(CONTRACTIONS)), "map<string,string>")

    def word(token: Column) -> Column:
        def cased(full: Column) -> Column:
            capital = F.substring(token, 1, 1).rlike("^[A-Z]$")
            upper = F.concat(F.upper(F.substring(full, 1, 1)), F.substring(full, 2, 64))
            return F.when(full.isNull(), token).when(capital, upper).otherwise(full)

        # Between the matches lie long stretches of other text; only short pieces are worth a look.
        known = let(F.element_at(table, F.lower(token)), cased)
        return F.when(F.octet_length(token) <= LONGEST, known).otherwise(token)

    marked = F.regexp_replace(text, pattern, f"{MARK}$1{MARK}")
    return F.array_join(F.transform(F.split(marked, MARK), word), "")


def has_apostrophe(text: Column) -> Column:
    return text.contains("'")


def expand_apostrophes(text: Column) -> Column:
    return _replace_words(text, APOSTROPHE_WORD)


def expand_joined(text: Column) -> Column:
    return _replace_words(text, JOINED_WORD)


def expand_contractions(text: Column) -> Column:
    """Whole words only; a capital first letter stays a capital."""
    spelled = let(
        text,
        lambda t: F.when(has_apostrophe(t), per_word(t, has_apostrophe, expand_apostrophes)).otherwise(t),
    )
    return expand_joined(spelled)
