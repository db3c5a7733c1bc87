"""Canonical keys: one key for all spellings of a lead source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealtide.functions.text import blank_to_null

# Latin spelling of the Russian letters, in alphabet order.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z",
    "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "c", "ч": "ch", "ш": "sh",
    "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}


def transliterate(text: Column) -> Column:
    """Lower-case text with Russian letters in Latin; NULL gives the empty string."""
    single = {letter: latin for letter, latin in LATIN.items() if len(latin) == 1}
    silent = [letter for letter, latin in LATIN.items() if not latin]
    # translate() deletes the letters that have no counterpart.
    result = F.translate(
        F.lower(F.coalesce(text, F.lit(""))),
        "".join([*single, *silent]),
        "".join(single.values()),
    )
    for letter, latin in LATIN.items():
        if len(latin) > 1:
            result = F.replace(result, F.lit(letter), F.lit(latin))
    return result


def source_key(text: Column) -> Column:
    """``[a-z0-9]+`` words joined by ``_``; NULL if nothing is left."""
    words = F.regexp_replace(transliterate(text), "[^a-z0-9]+", "_")
    return blank_to_null(F.btrim(words, F.lit("_")))


def source_name(key: Column) -> Column:
    """Display name of a source key: ``trade_fair`` gives ``Trade Fair``."""
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))
