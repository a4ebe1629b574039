"""Text expressions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define cleaned text. WORD and DIGIT spell out
# Unicode \w and \d, which Java would otherwise read as ASCII only.
SPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
URL = rf"http[^{SPACE}]+|www[^{SPACE}]+|https[^{SPACE}]+"
NOT_WORD = rf"[^\p{{L}}\p{{N}}_{SPACE}]"
DIGIT = r"\p{Nd}+"
GAP = r"[^\p{L}\p{N}_]+"

# The section headings of lyrics that are removed with their brackets.
SECTION_TAGS = [
    r"Intro\s*\d*",
    r"Chorus\s*\d*",
    r"Verse\s*\d*",
    r"Vers\s*\d*",
    r"Hook\s*\d*",
    r"Part\s*\d*",
    r"Interlude\s*\d*",
    r"Skit\s*\d*",
    r"Produced\s*\d*",
    r"Track\s*\d*",
    r"Refrain\s*\d*",
    r"Pre-?Chorus\s*\d*",
    r"Company\s*\d*",
    r"Backing\s+vocals",
    r"Sample\s*\d*",
    r"Segue\s+from",
    r"Instrumental",
    r"Pre-Hook",
    r"Pre Hook",
    r"Lyrical",
    r"Beat",
    r"Interview\s*\d*",
]

# Words a Treebank tokenizer splits in two (first part, second part).
SPLIT_WORDS = [
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
]

# English stop words as they occur in cleaned text (without apostrophes).
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more
most other some such no nor not only own same so than too very s t can will just don
should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn
mustn needn shan shouldn wasn weren won wouldn
""".split()


def stopwords(language: str) -> list[str]:
    """Stop words of cleaned text; other languages come from Spark's own lists."""
    if language == "english":
        return ENGLISH_STOPWORDS
    return StopWordsRemover.loadDefaultStopWords(language)


def combine_text(*columns: Column) -> Column:
    """Join columns by one space; an absent value keeps its separator."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])


def clean_text(text: Column) -> Column:
    """Lower case without URLs, punctuation and digits; single spaces.

    White space is no word character either, so one pass turns each gap into one space; only
    where digits go can two spaces meet again.
    """
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, URL, "")
    out = F.regexp_replace(out, GAP, " ")
    out = F.regexp_replace(out, DIGIT, "")
    out = F.regexp_replace(out, " {2,}", " ")
    return F.trim(out)


def clean_letters(text: Column, language: str = "english") -> Column:
    """Lower case with only the letters of the language and white space."""
    letters = "a-záéíóúüñ" if language == "spanish" else "a-zA-Z"
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"[^{letters}{SPACE}]", "")


def strip_section_tags(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?i)\[(?:{'|'.join(SECTION_TAGS)})[^\]]*\]", "")


def split_contractions(cleaned: Column) -> Column:
    initials = "".join(sorted({a[0] for a, _ in SPLIT_WORDS}))
    heads = "|".join(f"{a}(?={b}(?: |$))" for a, b in SPLIT_WORDS)
    return F.regexp_replace(cleaned, rf"(?=[{initials}])(?<![^ ])({heads})", "$1 ")


def tokenize(cleaned: Column) -> Column:
    """Words of cleaned text, with the split words in two parts."""
    return F.filter(F.split(split_contractions(cleaned), " "), lambda w: w != "")


def content_words(cleaned: Column, language: str | None = "english", longest_dropped: int = 2) -> Column:
    """Tokens without stop words (of `language`, if given) and short ones, in one filter."""
    words = F.split(split_contractions(cleaned), " ")
    if language is None:
        return drop_short(words, longest_dropped)
    listed = stopwords(language)
    return F.filter(words, lambda w: (F.length(w) > longest_dropped) & ~w.isin(listed))


def remove_stopwords(tokens: Column, language: str = "english") -> Column:
    """Tokens not in the list; the list is a constant set, so the test is a hash probe."""
    words = stopwords(language)
    return F.filter(tokens, lambda w: ~w.isin(words))


def drop_short(tokens: Column, longest_dropped: int = 2) -> Column:
    return F.filter(tokens, lambda w: F.length(w) > longest_dropped)


def token_estimate(text: Column) -> Column:
    """Tokens of a text for a request limit: four characters each."""
    return F.floor(F.length(text) / 4)


def ngrams(tokens: Column, longest: int = 2) -> Column:
    """All n-grams of 1..longest words, shorter ones first.

    The lambdas use their own arguments only: an outer array inside a lambda would be worked
    out once per element wherever the optimizer puts its definition in its place.
    """
    grams, shorter = tokens, tokens
    for n in range(2, longest + 1):
        last = F.slice(tokens, F.lit(n), F.greatest(F.size(tokens), F.lit(0)))
        padded = F.zip_with(shorter, last, lambda a, b: F.concat(a, F.lit(" "), b))
        shorter = F.filter(padded, lambda g: g.isNotNull())
        grams = F.concat(grams, shorter)
    return grams


def answer_to_label(answer: Column, positive: str = "explicit") -> Column:
    return F.when(F.lower(answer) == positive, 1).otherwise(0)
