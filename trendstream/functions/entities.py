"""Named entities of a text as built-in column expressions.

* ``capitalised_entities``: runs of capitalised words (``Alte Warte``);
* ``gazetteer_entities``: runs of words of the text that appear in a
  small literal gazetteer (the streaming form; for large gazetteers use the
  join in ``operators.enrich``).

An empty result becomes ``["None"]`` as in the original enrichment.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder list for a text without entities (fixed value).
NO_ENTITIES = ["None"]
# A capitalised word, and runs of them separated by single spaces.
CAPITALISED_RUN = "\\p{Lu}\\p{Ll}+(?: \\p{Lu}\\p{Ll}+)*"

# Largest gazetteer (bytes) that travels with a query as literals.
LITERAL_MAX_BYTES = 4 << 20


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def or_none(arr: Column) -> Column:
    """Empty or NULL array -> ["None"]."""
    none = F.array(*[F.lit(x) for x in NO_ENTITIES])
    return F.when(F.coalesce(F.size(arr), F.lit(0)) > 0, arr).otherwise(none)


def capitalised_entities(text="text") -> Column:
    return or_none(F.regexp_extract_all(_c(text), F.lit(CAPITALISED_RUN), 0))


def capitalised_entities_sql(text: str = "text") -> str:
    arr = f"regexp_extract_all({text}, '{CAPITALISED_RUN}')"
    return f"CASE WHEN coalesce(len({arr}), 0) > 0 THEN {arr} ELSE ['None'] END"


def word_tokens(text="text") -> Column:
    """Maximal runs of letters, original case, empty strings removed."""
    return F.filter(F.split(_c(text), "[^\\p{L}]+"), lambda t: t != F.lit(""))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ngrams(tokens: Column, longest: int = 2) -> Column:
    """Space-joined runs of 1 to ``longest`` tokens, shorter ones first.

    Runs of n pair the runs of n - 1 with the tokens n - 1 places on
    (``zip_with``), so no array is evaluated once per position; the tokens and
    the runs of each length are made once.
    """
    if longest < 2:
        return tokens

    def longer(words: Column, runs: Column, n: int) -> Column:
        if n > longest:
            return runs
        later = F.slice(words, n, F.greatest(F.size(words) - (n - 1), F.lit(1)))
        paired = F.filter(F.zip_with(runs, later, lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b))),
                          lambda g: g.isNotNull())
        # what is left out stands at the end, so runs of n still start at tokens 1, 2, ...
        return F.concat(runs, _once(paired, lambda r: longer(words, r, n + 1)))
    return _once(tokens, lambda words: longer(words, words, 2))


def words_in(entry: str) -> int:
    """Words of a gazetteer entry, as ``word_tokens`` counts them."""
    return len([w for w in entry.split(" ") if w])


def gazetteer_entities(text, gazetteer: list[str]) -> Column:
    """N-grams of ``text`` found in a literal gazetteer, distinct; n goes up to its longest entry.

    Texts are cut once, and ``isin`` over many literals is a hash lookup.  The literals travel with
    every task, so their size is checked; a larger gazetteer is for the
    dictionary join.
    """
    size = sum(len(g.encode()) for g in gazetteer)
    if size > LITERAL_MAX_BYTES:
        raise ValueError(f"a gazetteer of {size} bytes is too large for a literal: use operators.enrich.tag_entities")
    by_length: dict[int, list[str]] = {}
    for g in gazetteer:
        by_length.setdefault(words_in(g), []).append(g)

    def runs(tokens: Column, n: int, entries: list[str]) -> Column:
        """Runs of n tokens that are entries; only those that begin like one are joined."""
        begin = sorted({g.split(" ")[0] for g in entries})
        places = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
        some = F.filter(places, lambda i: F.get(tokens, i - 1).isin(*begin))
        return F.filter(F.transform(some, lambda i: F.array_join(F.slice(tokens, i, n), " ")), lambda g: g.isin(*entries))

    def hits(tokens: Column) -> Column:
        found = [F.filter(tokens, lambda t: t.isin(*entries)) if n == 1 else runs(tokens, n, entries)
                 for n, entries in sorted(by_length.items()) if n]
        return F.array_distinct(F.concat(*found)) if found else F.array().cast("array<string>")
    return _once(_once(word_tokens(text), hits), or_none)
