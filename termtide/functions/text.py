"""Text to terms: cleaning, tokens, stop words, n-grams. Built-in expressions only."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is removed from lower-cased text, tried in this order.
URL = r"((\w+:\/\/)[-a-zA-Z0-9:@;?&=\/%\+\.\*!'\(\),\$_\{\}\^~\[\]`#|]+)"
RETWEET = r"rt @[^:]+: "
HANDLE = r"@[^ ]+"
HASHTAG = r"#\w+"
NOISE = f"({URL})|({RETWEET})|({HANDLE})|({HASHTAG})"

# The default English stop words of Spark's StopWordsRemover.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very
s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

SIZES = (2, 3, 4, 5)


def clean_text(text: Column, pattern: str = NOISE) -> Column:
    return F.regexp_replace(F.lower(text), pattern, "")


def split_words(text: Column) -> Column:
    """Split at every character that is not an ASCII word character, accented letters
    included; neighbouring ones leave empty tokens."""
    return F.split(text, r"\W")


def tokenize(text: Column) -> Column:
    return F.filter(split_words(text), lambda word: word != "")


def remove_stop_words(tokens: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The array column of that name without the stop words and without empty tokens.

    As SQL text, so that the list is one literal set for the JVM, not a call per word.
    """
    unwanted = ", ".join(_literal(word) for word in ["", *stop_words])
    return F.expr(f"filter(`{tokens}`, word -> word not in ({unwanted}))")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lead_of(term: Column) -> Column:
    """The first two words of an n-gram; of one word or a hashtag, all of it."""
    return F.substring_index(term, " ", 2)


def word_windows(words: str, least: int, longest: int) -> Column:
    """From every word that has ``least`` words from it on, the next ``longest`` words or what there is."""
    return F.expr(
        f"""if(size({words}) >= {least},
               transform(sequence(1, size({words}) - {least - 1}), i -> array_join(slice({words}, i, {longest}), ' ')),
               cast(array() as array<string>))"""
    )


def ngrams_of_window(lead: str, tail: str, sizes: Sequence[int]) -> Column:
    """The n-grams a window begins with, one a size; its first two words and the others come apart."""
    def first(n: int) -> Column:
        return F.substring_index(tail, " ", n - 2)

    grams = []
    for n in sorted(sizes):
        gram = F.col(lead) if n == 2 else F.concat(lead, F.lit(" "), first(n))
        # A window at the end of a text may be shorter.
        grams.append(gram if n == min(sizes) else F.when(first(n) != first(n - 1), gram))
    return F.array_compact(F.array(*grams))


def longer_ngrams(ngrams: str, tokens: str, n: int) -> Column:
    """All n-grams, given the columns of all (n-1)-grams and of the tokens.

    Each gram is one concatenation of two known strings, where slicing the tokens at
    every position would copy n of them.
    """
    return F.expr(
        f"""zip_with(slice({ngrams}, 1, greatest(size({ngrams}) - 1, 0)),
                     slice({tokens}, {n}, greatest(size({tokens}) - {n - 1}, 0)),
                     (head, tail) -> concat(head, ' ', tail))"""
    )
