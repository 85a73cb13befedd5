"""Small fixed word lists."""

# The customary English stop word list.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain
aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't
mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Ordered suffix rules (pattern, replacement with \1 for the kept group). Negated classes exclude the
# space, so that a rule means the same on one token and on a text of tokens.
SUFFIX_RULES = [
    ("sses$", "ss"),
    ("ies$", "i"),
    ("([^su ])s$", r"\1"),
    ("([aeiouy][a-z]*)(ed|ing)$", r"\1"),
    ("(at|bl|iz)$", r"\1e"),
    ("([aeiouy][a-z]*[^aeiou ])y$", r"\1i"),
    ("ational$", "ate"),
    ("ization$", "ize"),
    ("(ful|ous|ive)ness$", r"\1"),
    ("([a-z]{3})(ment|ness|ance|ence|able|ible)$", r"\1"),
]

# Adjective and noun word lists and endings for tagging.
ADJECTIVES = "good great bad new old big small easy hard fun nice fine long short high low free real whole main".split()
NOUNS = "game book story time way thing people home kitchen product price page level character music work year day life".split()
ADJECTIVE_ENDINGS = "ble ous ive ful less ish ic al".split()
NOUN_ENDINGS = "tion ment ness ity ance ence ship ing er or".split()

# Polarity and subjectivity of common opinion words.
SENTIMENT = """
good 0.7 0.6
great 0.8 0.75
excellent 1.0 1.0
amazing 0.6 0.9
awesome 1.0 1.0
best 1.0 0.3
better 0.5 0.5
perfect 1.0 1.0
love 0.5 0.6
loved 0.7 0.8
like 0.2 0.3
nice 0.6 1.0
fun 0.3 0.2
easy 0.43 0.83
happy 0.8 1.0
beautiful 0.85 1.0
wonderful 1.0 1.0
fine 0.42 0.5
new 0.14 0.45
real 0.2 0.3
bad -0.7 0.67
worse -0.4 0.6
worst -1.0 1.0
terrible -1.0 1.0
awful -1.0 1.0
horrible -1.0 1.0
poor -0.4 0.6
boring -1.0 1.0
hard -0.29 0.54
hate -0.8 0.9
hated -0.9 0.7
disappointed -0.75 0.75
disappointing -0.6 0.7
wrong -0.5 0.9
slow -0.3 0.4
broken -0.4 0.4
useless -0.5 0.2
waste -0.2 0.0
annoying -0.8 0.9
sad -0.5 1.0
"""
SENTIMENT = [(w, float(p), float(s)) for w, p, s in (line.split() for line in SENTIMENT.strip().splitlines())]

# Words that turn or strengthen the next one, and the factors applied.
NEGATIONS = "not no never cannot nor".split()
INTENSIFIERS = "very really extremely so too".split()
NEGATION_FACTOR = -0.5
INTENSIFIER_FACTOR = 1.3

# Everyday words of two or more syllables that do not count as difficult.
EASY_WORDS = """
about above after again against ago almost alone along already also although always animal another answer any anyone
anything around away baby became because become before began begin behind being believe below better between beyond
body brother building business busy carry center children city color coming country cover daughter different doing
during early easy enough even evening ever every everyone everything family father finally finger flower follow
forever forget garden going happen happy having heavy herself himself hundred idea into island itself language later
letter listen little living many maybe money morning mother mountain myself nature never nothing number often only
open other over paper party people person picture power pretty problem quickly ready really remember river second
seven sister something sometimes story student study summer sudden system table today together tomorrow under until
upon very visit water weather window winter without woman wonder yellow yesterday
""".split()
