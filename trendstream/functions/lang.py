"""Language of a text: stop-word hits per language, arg-max, default 'en'.

Pure built-in expressions (regexp counting inside codegen), deterministic,
so the same column works in batch, in streams and in an SQL oracle.  A
token is a maximal run of letters of the lower-cased text; a hit is a token
equal to one of the language's stop words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stop words per language (fixed values); the order of the keys is the
# tie order, and 'en' is also the answer when no stop word is found.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "in", "is", "that", "with", "for", "was"],
    "de": ["der", "die", "das", "und", "ist", "ein", "nicht", "mit", "den", "von"],
    "fr": ["le", "la", "les", "des", "et", "est", "une", "dans", "pour", "par"],
    "es": ["el", "los", "las", "que", "del", "una", "por", "con", "para", "y"],
}
DEFAULT_LANGUAGE = "en"


def _word_pattern(words: list[str]) -> str:
    return "(?<!\\p{L})(?:" + "|".join(words) + ")(?!\\p{L})"


def stop_words_found(text, languages: list[str]) -> Column:
    """Every token of ``text`` that is a stop word of some language: one scan of the text."""
    c = F.col(text) if isinstance(text, str) else text
    words = sorted({w for lang in languages for w in STOP_WORDS[lang]})
    return F.regexp_extract_all(F.lower(c), F.lit(_word_pattern(words)), 0)


def stop_word_hits(found: Column, lang: str) -> Column:
    """Number of the stop words found that are of ``lang``."""
    return F.size(F.filter(found, lambda w: w.isin(*STOP_WORDS[lang])))


def _arg_max(hits: dict) -> Column:
    langs = list(hits)
    best = F.greatest(*hits.values()) if len(hits) > 1 else hits[langs[0]]
    out = F.when(F.coalesce(best, F.lit(0)) == 0, F.lit(DEFAULT_LANGUAGE))
    for lang in langs:
        out = out.when(hits[lang] == best, F.lit(lang))
    return out.otherwise(F.lit(DEFAULT_LANGUAGE))


def detect_language(text="text", languages: dict | None = None) -> Column:
    """ISO 639-1 code with the most stop-word hits; ties by list order; none -> 'en'."""
    langs = list((languages or STOP_WORDS).keys())
    found = stop_words_found(text, langs)
    return _arg_max({lang: stop_word_hits(found, lang) for lang in langs})


def with_language(df: DataFrame, text: str = "text", out: str = "language",
                  languages: dict | None = None) -> DataFrame:
    """``df`` plus the detected language; the stop words found and the counts are
    projected first, so a text is scanned once."""
    langs = list((languages or STOP_WORDS).keys())
    hits = {lang: f"_hits_{lang}" for lang in langs}
    counted = (df.withColumn("_found", stop_words_found(text, langs))
               .withColumns({c: stop_word_hits(F.col("_found"), lang) for lang, c in hits.items()}))
    return (counted.withColumn(out, _arg_max({lang: F.col(c) for lang, c in hits.items()}))
            .drop("_found", *hits.values()))


def detect_language_sql(text: str = "text") -> str:
    """The same scorer in DuckDB SQL (token lists instead of regex counting)."""
    tok = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}]+')"
    hits = {lang: f"len(list_filter({tok}, lambda x: list_contains({words!r}, x)))"
            for lang, words in STOP_WORDS.items()}
    best = "greatest(" + ", ".join(hits.values()) + ")"
    whens = " ".join(f"WHEN {h} = {best} THEN '{lang}'" for lang, h in hits.items())
    return f"CASE WHEN coalesce({best}, 0) = 0 THEN 'en' {whens} ELSE 'en' END"
