"""Fixed values shared by the Spark jobs and by the DuckDB oracle SQL.

Everything that decides which characters and words survive normalisation lives
here, so that the Spark side and the SQL side cannot drift apart.
"""

from __future__ import annotations

import functools
import string

# --- fixed values -----------------------------------------------------------
# The 32 ASCII punctuation characters (Python's ``string.punctuation``); they
# are deleted, not replaced by a space.
PUNCTUATION = string.punctuation
# A term is a run of at least two letters, digits or underscores (the default
# token rule of common bag-of-words vectorisers, written Unicode-aware so Java
# and RE2 agree on it).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Non-alphanumeric runs collapsed to one space in newswire bodies.
NON_ALNUM_PATTERN = "[^0-9a-zA-Z]+"
# Similarity a related term needs before it is added to a query.
EXPANSION_MIN_SIM = 0.75
# Bigrams kept by the bigram model need at least this many occurrences.
BIGRAM_MIN_COUNT = 5
# Terms enter the thesaurus / kNN feature space when their corpus frequency is
# strictly above this (a parameter of both jobs; 100 in the original project).
TOP_TERM_MIN_CF = 100
# Documents shown per ranked or Boolean query.
RESULTS_PER_QUERY = 5
# Related terms listed per term.
RELATED_PER_TERM = 10
# idf is rounded to IDF_SCALE decimal places; scores are summed exactly as
# integers in units of 10**-IDF_SCALE (order-independent) and divided at the end.
SCORE_DECIMAL = "DECIMAL(18,6)"
IDF_SCALE = 6
IDF_UNITS = 10 ** IDF_SCALE
# Stop words: the default English and French lists of Spark ML's StopWordsRemover.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()
FRENCH_STOP_WORDS = """
au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me même mes
moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu
un une vos votre vous c d j l à m n s t y été étée étées étés étant étante étants étantes suis
es est sommes êtes sont serai seras sera serons serez seront serais serait serions seriez
seraient étais était étions étiez étaient fus fut fûmes fûtes furent sois soit soyons soyez
soient fusse fusses fût fussions fussiez fussent ayant ayante ayantes ayants eu eue eues eus ai
as avons avez ont aurai auras aura aurons aurez auront aurais aurait aurions auriez auraient
avais avait avions aviez avaient eut eûmes eûtes eurent aie aies ait ayons ayez aient eusse
eusses eût eussions eussiez eussent
""".split()
# ---------------------------------------------------------------------------


@functools.lru_cache(maxsize=1)
def stop_words() -> tuple[str, ...]:
    """English and French stop words of Spark ML, every single ASCII letter and
    every single digit; sorted, without duplicates."""
    words = set(ENGLISH_STOP_WORDS) | set(FRENCH_STOP_WORDS)
    words |= set(string.ascii_lowercase)
    words |= {str(i) for i in range(10)}
    return tuple(sorted(words))


def sql_quote(value: str) -> str:
    """A single-quoted SQL string literal."""
    return "'" + value.replace("'", "''") + "'"
