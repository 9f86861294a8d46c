"""Expressions on text: tokens, words, n-grams and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, and the runs of characters between words.
WHITE_SPACE = " \t\n\x0b\f\r"
WORD_BREAK = r"[^\p{L}\p{N}_]+"
MIN_WORD_LENGTH = 2

# The English stop words that Spark's StopWordsRemover uses by default.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()


def space_tokens(text: Column) -> Column:
    """Lower-case tokens between single white-space characters, as Spark's Tokenizer makes them.

    Empty tokens inside the text are kept and those at its end are not, so a text of white space
    only has no token, while an empty text has one empty token.
    """
    lowered = F.lower(text)
    trimmed = F.rtrim(lowered, F.lit(WHITE_SPACE))
    only_space = (trimmed == "") & (text != "")
    return F.when(only_space, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s"))


def tokens_of_lower(text: str) -> list[str]:
    """What ``space_tokens`` finds, inside tasks, in a text that is in lower case already."""
    trimmed = text.rstrip(WHITE_SPACE)
    if text and not trimmed:
        return []
    for space in WHITE_SPACE[1:]:
        trimmed = trimmed.replace(space, " ")
    return trimmed.split(" ")


def without_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(STOP_WORDS))


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores with at least two characters."""
    runs = F.split(F.lower(text), WORD_BREAK)
    return F.filter(runs, lambda run: F.length(run) >= MIN_WORD_LENGTH)


def one_and_two_grams(word_list: Column) -> Column:
    """All words followed by all pairs of neighbouring words."""
    firsts = F.slice(word_list, F.lit(1), F.greatest(F.size(word_list) - 1, F.lit(0)))
    seconds = F.slice(word_list, F.lit(2), F.greatest(F.size(word_list) - 1, F.lit(0)))
    pairs = F.zip_with(firsts, seconds, lambda first, second: F.concat_ws(" ", first, second))
    return F.concat(word_list, pairs)


def token_count(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern))


def exclamation_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("!")))


def upper_ratio(text: Column) -> Column:
    """Share of capitals A to Z among all characters; 0 for an empty text."""
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(capitals / F.length(text))
