"""Text to terms, all as built-in column functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and token length that decide the term set.
URL_PATTERN = r"http\S+|www\.\S+"
URL_STARTS = ("http", "www.")
SPACE_PATTERN = r"\s+"
SPLIT_PATTERN = r"\W+"
MIN_TOKEN_LENGTH = 2

# The default English stop-word list of Spark's MLlib.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
    could here's how's let's ought that's there's what's when's where's who's
    why's would
    """.split()
)

# Words that turn a judgement round; dropping them loses pairs like "not good".
NEGATIONS = ("not", "no", "nor", "very")


def stop_words(keep_negations: bool = False) -> tuple[str, ...]:
    if not keep_negations:
        return STOP_WORDS
    return tuple(word for word in STOP_WORDS if word not in NEGATIONS)


def remove_urls(text: Column) -> Column:
    """URLs to a space. Texts without the start of one skip the pattern."""
    http, www = (text.contains(start) for start in URL_STARTS)
    return F.when(http | www, F.regexp_replace(text, URL_PATTERN, " ")).otherwise(text)


def clean_text(text: Column) -> Column:
    """URLs to a space, then lower case, then single spaces, then trimmed.

    URLs go before lower-casing, so an upper-case ``HTTP://`` stays.
    """
    return F.trim(F.regexp_replace(F.lower(remove_urls(text)), SPACE_PATTERN, " "))


def tokenize(text: Column, unicode_words: bool = False) -> Column:
    """Runs of word characters, two or more of them.

    The same tokens as splitting on non-word characters and dropping the short
    ones, without building those. Word characters are ASCII unless
    ``unicode_words`` is set, which keeps words with accents whole.
    """
    word = rf"\w{{{MIN_TOKEN_LENGTH},}}"
    return F.regexp_extract_all(text, F.lit(f"(?U){word}" if unicode_words else word), 0)


def remove_stop_words(
    tokens: Column, words: Iterable[str] = STOP_WORDS, lower_case: bool = False
) -> Column:
    """Drop stop words without regard to case.

    ``lower_case`` says that the tokens are in lower case already.
    """
    listed = [word.lower() for word in words]
    return F.filter(tokens, lambda t: ~(t if lower_case else F.lower(t)).isin(listed))


def term_tokens(
    text: Column, words: Iterable[str] = STOP_WORDS, unicode_words: bool = False
) -> Column:
    """Tokens of the cleaned text without stop words.

    Spaces are not collapsed first: no token holds one.
    """
    tokens = tokenize(F.lower(remove_urls(text)), unicode_words)
    return remove_stop_words(tokens, words, lower_case=True)


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs joined by a space; empty below two tokens."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )


def shorten(text: Column, width: int = 100) -> Column:
    """Text cut to ``width`` characters, the last three of them dots if cut."""
    cut = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
    return F.when(F.length(text) > width, cut).otherwise(text)
