"""Text analyzers as Spark Column expressions (JVM-side, codegen-friendly).

Every function here takes and returns a ``Column`` so it composes into a
``select`` and stays inside whole-stage codegen; none of them is a UDF.

Two analyzers exist, mirroring the retrieval semantics we reproduce:

* ``index_tokens`` - lower-case, blank a fixed list of characters, split on
  whitespace. Builds the inverted index.
* ``ws_tokens`` - plain whitespace split of the raw text. Used on the scoring
  side for query terms and in-passage term counts (case and punctuation are
  kept, so ``Red`` and ``red.`` are different terms from ``red``).

Whitespace means exactly what Python's ``str.split()`` splits on; the
character class below lists it so Spark (Java regex) and DuckDB (RE2) agree.

Explode trap: project token arrays and their lengths in one ``select`` and
explode in the *next* one. Writing ``size(tokens(x))`` next to
``explode(tokens(x))`` makes Spark re-evaluate the length per exploded row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical tokens)
# ---------------------------------------------------------------------------
# Characters the index analyzer turns into spaces, exactly as written in the
# reference's literal (which looks like a regex but is iterated as single
# characters, so the letters a, z, A, Z and the digits 0, 9 are erased too).
INDEX_BLANK_CHARS = "[a-zA-Z0-9’!\"#$%&'()*+,-./:;<=>?@，。?★、…【】《》？“”‘’！[\\]^_`{|}~]+"

# Python str.split() whitespace. WS_CLASS lists it explicitly (valid in Java
# regex and RE2, used by the DuckDB oracle); Spark splits with the equivalent
# JAVA_WS_SPLIT: Java's Unicode whitespace plus the four separators
# U+001C..U+001F, which Python also splits on. It runs ~3x faster.
WS_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WS_SPLIT = WS_CLASS + "+"
JAVA_WS_SPLIT = r"(?U)[\s\x1C-\x1F]+"
EDGE_WS = "^" + WS_CLASS + "+|" + WS_CLASS + "+$"

# HTML to text: comments, script/style bodies, tags -> '' ; entities -> ' '.
HTML_COMMENT = r"(?s)<!--.*?-->"
HTML_SCRIPT_STYLE = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>"
HTML_TAG = r"(?s)<[^>]*>"
HTML_ENTITY = r"&#?[A-Za-z0-9]+;"

# Sentence boundary: terminal punctuation followed by whitespace.
SENTENCE_BREAK = r"([.!?])" + WS_CLASS + "+"
SENTENCE_MARK = "\u0001"

# Spark's default English stop-word list (StopWordsRemover, public), in its
# own order. Used by the passage side of the word-embedding features.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_ws(c: Column | str) -> Column:
    """Whitespace split without empty strings (Python ``str.split()``)."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), JAVA_WS_SPLIT, -1), lambda x: x != "")


def ws_tokens(c: Column | str) -> Column:
    """Raw scoring-side tokens: whitespace split, case and punctuation kept."""
    return split_ws(c)


def blank_index_chars(c: Column | str) -> Column:
    """Lower-case, then replace every character of INDEX_BLANK_CHARS by a space."""
    return F.translate(F.lower(_col(c)), INDEX_BLANK_CHARS, " " * len(INDEX_BLANK_CHARS))


def blanked(lowered: str) -> str:
    """``blank_index_chars`` of a lower-cased text inside a task."""
    for c in _BLANKS:
        lowered = lowered.replace(c, " ")
    return lowered


_BLANKS = tuple(dict.fromkeys(INDEX_BLANK_CHARS))


def index_tokens(c: Column | str) -> Column:
    """Index analyzer: lower-case, blank the fixed characters, whitespace split."""
    return split_ws(blank_index_chars(F.coalesce(_col(c), F.lit(""))))


def word_count(c: Column | str) -> Column:
    """Single-space split length, empty pieces counted; null counts as 'nan' (1)."""
    return F.size(F.split(F.coalesce(_col(c), F.lit("nan")), " ", -1))


def html_to_text(c: Column | str) -> Column:
    """Visible text of an HTML fragment, tags removed without a separator."""
    t = F.regexp_replace(_col(c), HTML_COMMENT, "")
    t = F.regexp_replace(t, HTML_SCRIPT_STYLE, "")
    t = F.regexp_replace(t, HTML_TAG, "")
    return F.regexp_replace(t, HTML_ENTITY, " ")


def letters_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^a-zA-Z]", " ")


def letter_text(c: Column | str) -> Column:
    """Lower-case letters and spaces of (possibly HTML) text: ``word_list`` before the split."""
    return F.lower(letters_only(html_to_text(F.coalesce(_col(c), F.lit("")))))


def word_list(c: Column | str, remove_stopwords: bool = False) -> Column:
    """Letters-only, lower-cased word list of (possibly HTML) text."""
    words = split_ws(letter_text(c))
    if remove_stopwords:
        words = drop_stop_words(words)
    return words


def drop_stop_words(words: Column) -> Column:
    # isin over a long literal list becomes an InSet (hash lookup) in Catalyst.
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def raw_sentences(c: Column | str) -> Column:
    """Split text into sentences after . ! or ? followed by whitespace.

    Empty pieces are dropped; a piece of only whitespace is kept (its word
    list is then empty), like a sentence tokenizer output of non-empty strings.
    """
    stripped = F.regexp_replace(F.coalesce(_col(c), F.lit("")), EDGE_WS, "")
    marked = F.regexp_replace(stripped, SENTENCE_BREAK, "$1" + SENTENCE_MARK)
    return F.filter(F.split(marked, SENTENCE_MARK, -1), lambda x: x != "")


def joined(tokens: Column) -> Column:
    """Space-joined token list, the scalar form used in result tables."""
    return F.array_join(tokens, " ")
