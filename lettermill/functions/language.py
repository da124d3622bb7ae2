"""A language test for the build: English by its function words. Any three-valued Column function can take its place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.text import once, words

# Frequent function words that tell each language from the others.
FUNCTION_WORDS = {
    "en": ("the", "and", "of", "to", "is", "that", "for", "with", "you", "this", "have", "are", "your", "it", "we", "be", "will", "from"),
    "de": ("der", "und", "das", "nicht", "ist", "mit", "den", "ein", "eine", "sie", "auf", "für", "von", "wir", "werden", "dem"),
    "fr": ("le", "les", "et", "des", "est", "une", "dans", "que", "pour", "vous", "nous", "sur", "avec", "pas", "du", "votre"),
    "es": ("el", "los", "las", "y", "una", "por", "para", "con", "su", "está", "del", "usted", "más", "como", "pero", "nos"),
    "it": ("il", "gli", "che", "di", "è", "per", "una", "con", "sono", "non", "della", "questo", "alla", "nel", "più", "anche"),
    "pt": ("os", "não", "uma", "para", "com", "são", "você", "em", "do", "da", "mais", "seu", "pelo", "isso", "nós", "ou"),
    "nl": ("het", "een", "van", "niet", "dat", "voor", "met", "zijn", "deze", "ook", "naar", "wij", "uw", "wordt", "maar", "bij"),
}


def english(text: Column) -> Column:
    """Whether English has the most function words in a text; true before false where several have as many. Null for
    null texts, and where no language has any, so that nothing can be told."""

    def count(found: Column, own: tuple[str, ...]) -> Column:
        return F.size(F.filter(found, lambda w: w.isin(*own)))

    def of(found: Column) -> Column:
        n = {lang: count(found, own) for lang, own in FUNCTION_WORDS.items()}
        pair = F.struct(n["en"].alias("en"), F.greatest(*n.values()).alias("most"))
        return once(pair, lambda c: F.when(c["most"] > 0, c["en"] == c["most"]))

    return once(words(text), of)
