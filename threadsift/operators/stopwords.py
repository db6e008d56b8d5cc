"""Stop words for the hot-word counter.

The set is the union of an English list, domain words, the digits 0-9 and
the letters a-z. All of it is small and fixed, so membership is an
``InSet`` expression evaluated inside codegen; no join is needed. The
DataFrame form exists for the anti-join variant and for user lists that
may be large.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

# --- fixed values -----------------------------------------------------------
# English stop words (the widely used NLTK English list, in its order).
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "that'll", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did",
    "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't",
    "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain",
    "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn",
    "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)
# Domain words added to the English list by the hot-word analysis.
DOMAIN_STOP_WORDS = (
    "https", "com", "github", "using", "use", "add", "user",
    "githubusercontent", "would", "page", "const", "return", "new", "null",
    "true", "name", "string", "get", "id", "app", "like", "tried", "want",
    "one", "even", "make", "also", "much", "really", "could", "something",
    "time", "year", "way", "many", "still", "things", "us", "lot", "need",
    "see", "well", "know", "go", "used", "say", "point", "going", "without",
    "thing", "actually", "someone", "people", "think", "though", "probably",
    "seems", "sure", "may", "might", "take", "every",
)
# --------------------------------------------------------------------------


def default_stop_words(strip_apostrophes: bool = False) -> list[str]:
    """English list + domain words + single digits + single letters.

    ``strip_apostrophes`` also removes apostrophes from list entries; the
    tokens never contain apostrophes, so by default ``dont`` is counted.
    """
    words = list(ENGLISH_STOP_WORDS) + list(DOMAIN_STOP_WORDS)
    words += [str(i) for i in range(10)] + list(string.ascii_lowercase)
    if strip_apostrophes:
        words = [w.replace("'", "") for w in words]
    seen: dict[str, None] = {}
    for w in words:
        seen.setdefault(w, None)
    return list(seen)


def stop_words_frame(spark: SparkSession, words=None) -> DataFrame:
    """The stop words as a one-column DataFrame ``word``."""
    words = default_stop_words() if words is None else list(words)
    return spark.createDataFrame([(w,) for w in words], "word string")
