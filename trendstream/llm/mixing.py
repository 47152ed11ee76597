"""Soft-membership mixing to target weights, in DataFrame expressions only.

A classifier learned from the labelled table gives every document a posterior
over domains.  Nonnegative document rates are then fitted so that the expected
tokens of each domain, the sum of rate * tokens * posterior, meet the targets.

Classifier: naive Bayes over hashed words, on whether a word occurs, and over
binned shares of capitals, of marks and of distinct words.  Only buckets whose
share in a domain, other than the most frequent one, is clearly (z-score) and
far (``RATIO``) above their share elsewhere count, present or absent; the others
would add noise, and common words would add up to the text's length.  Counts come from a bounded sample of
labelled rows (``LABELLED``).

Rates: projected gradient on the least-squares residual, whitened by the
domains' Gram matrix G = sum(tokens * p p') / N and measured per token.  With
that, the step 1 is 1 over the Lipschitz constant, so every step

    rate <- max(0, rate - p . G^-1 (S(rate) - T) / N)

lowers the residual; the fit ends at the targets or when steps gain next to
nothing.  A longer step, with G over the documents whose rate is not
at 0, is tried first and kept when it lowers the residual too.  S and G need one
aggregate of a few numbers for each pair of domains, combined on the map side
whatever the skew of sources; the step's direction is a number for each domain,
so rates are an expression over the posterior columns and nothing is written
between steps.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstream.llm.common import hash_below, quoted, text_or_empty, unpack
from trendstream.session import materialize

LABELLED = 10_000     # labelled rows to learn from, at most
BUCKETS = 1 << 15
BINS = 24             # bins of a share
Z = 5.0               # a bucket's weight counts from this z-score
RATIO = 3.0           # and if it is so many times as frequent
STEPS = 24
CLOSE = 1e-6          # residual over all tokens at which the fit ends
STALL = 0.02          # the fit also ends when a step lowers the residual by a smaller share
# Unicode classes; the ASCII ranges before them are parts of them that are quick to tell.
SEPARATOR = r"[^a-z0-9\p{L}\p{M}\p{N}]+"
NOT_CAPITAL = r"[ a-z\P{Lu}]+"
NOT_MARK = r"[ a-zA-Z0-9[^\p{P}\p{S}]]+"
# A character, with its combining marks, of a script written without spaces (none is below U+0E00).
UNSPACED = (r"[\u0E00-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}"
            r"\p{IsMyanmar}\p{IsJavanese}\p{IsBalinese}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}\p{IsTai_Viet}]]\p{M}*")


def quality_domain() -> Column:
    """Domains of the labels table: toxic, junk (not toxic, quality 0) and clean."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk")
            .when(F.col("quality") == 1, "clean"))


def with_words(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus ``words`` of column ``text``: lower-cased runs of letters, combining marks and digits.

    In scripts written without spaces each character is a word, so such texts
    count by their length.  A column of its own, so that the text is cut once
    for all that reads its words.
    """
    c = F.col(text)
    spaced = F.when(c.rlike(UNSPACED), F.regexp_replace(c, UNSPACED, " $0 ")).otherwise(c)
    return docs.withColumn("words", F.array_remove(F.split(F.lower(spaced), SEPARATOR), ""))


def _share(part: Column, whole: Column, first: int) -> Column:
    """The bucket of a share: BINS bins, finer for small shares."""
    share = F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1)))
    return (F.lit(first) + F.floor(F.sqrt(share) * (BINS - 1))).cast("int")


def _buckets(text: Column, words: Column) -> Column:
    """Buckets of a text: its words, then one for each binned share."""
    capitals = F.length(F.regexp_replace(text, NOT_CAPITAL, ""))
    marks = F.length(F.regexp_replace(text, NOT_MARK, ""))
    last = BUCKETS - 3 * BINS
    shares = F.array(_share(capitals, F.length(text), last), _share(marks, F.length(text), last + BINS),
                     _share(F.size(F.array_distinct(words)), F.size(words), last + 2 * BINS))
    return F.concat(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(last)).cast("int")), shares)


def _numbers(values: list[float]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def learn_domains(docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str],
                  id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> tuple[list[str], list[float], dict]:
    """(domains with labelled documents, their log-probability of a text without any bucket that counts,
    bucket -> what its presence adds in each domain)."""
    known = (labels.select(F.col(quoted(id_col)).alias("id"), domain.alias("domain"))
             .filter(F.col("id").isNotNull() & F.col("domain").isin(domains))
             .groupBy("id").agg(F.min("domain").alias("domain")).withColumn("h", F.xxhash64("id")))
    known = (known.filter(hash_below(F.col("h"), labelled, known.count()))
             .orderBy("h", "id").limit(labelled).select("id", "domain"))          # bounded: broadcast below
    sample = (docs.select(F.col(quoted(id_col)).alias("id"), text_or_empty(F.col(quoted(text_col))).alias("text"))
              .join(F.broadcast(known), "id"))
    words = materialize(with_words(sample, "text").select(
        "domain", F.array_distinct(_buckets(F.col("text"), F.col("words"))).alias("b")), "mix-sample")
    sizes = {r["domain"]: r["n"] for r in words.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = [d for d in domains if d in sizes]
    if not names:
        return [], [], {}
    total = sum(sizes.values())
    counts = (words.select("domain", F.explode("b").alias("bucket")).groupBy("bucket")
              .agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(names)]))
    counts = counts.withColumn("all", sum([F.col(f"n{i}") for i in range(len(names))], F.lit(0)))
    usual = max(names, key=sizes.get)
    odds, clear = [], F.lit(False)
    for i, d in enumerate(names):
        n, rest = sizes[d], max(1, total - sizes[d])
        here, there = (F.col(f"n{i}") + 0.5) / (n + 1), (F.col("all") - F.col(f"n{i}") + 0.5) / (rest + 1)
        both = (F.col("all") + 1) / (total + 2)
        score = (here - there) / F.sqrt(both * (1 - both) * (1 / n + 1 / rest) + 1e-12)
        if d != usual:
            clear = clear | ((score >= Z) & (here >= RATIO * there))
        odds += [F.log(here / (1 - here)).alias(f"w{i}"), F.log(1 - here).alias(f"a{i}")]
    # at most BUCKETS rows of as many numbers as domains
    rows = counts.filter(clear).select("bucket", *odds).collect() if len(names) > 1 else []
    weights = {r["bucket"]: [r[f"w{i}"] for i in range(len(names))] for r in rows}
    absent = [math.fsum(r[f"a{i}"] for r in rows) for i in range(len(names))]
    return names, [math.log(sizes[d] / total) + a for d, a in zip(names, absent)], weights


def weighted_buckets(text: Column, words: Column, weights: dict) -> Column:
    """The distinct buckets of a whole text that have a weight."""
    clear = _numbers([float(b in weights) for b in range(BUCKETS)])
    return F.array_distinct(F.filter(_buckets(text, words), lambda b: F.get(clear, b) > 0))


def domain_logits(hits: Column, shares: list[float], weights: dict) -> list[Column]:
    """Log of each domain's posterior, up to a constant."""
    logits = []
    for i, share in enumerate(shares):
        column = _numbers([weights[b][i] if b in weights else 0.0 for b in range(BUCKETS)])
        logits.append(_looked_up(hits, column, share))
    return logits


def _looked_up(hits: Column, values: Column, first: float) -> Column:
    return F.aggregate(hits, F.lit(first), lambda s, b: s + F.get(values, b))


def fit_rates(docs: DataFrame, tokens: str, members: list[str], targets: list[float], total: float | None = None,
              steps: int = STEPS) -> tuple[Column, list[float], list[float]]:
    """(rate expression, expected tokens of each domain, target tokens) for columns ``members`` of posteriors.

    ``targets`` are weights; ``total`` the tokens wanted in all, by default as
    many as leave the domain with the largest weight the tokens it has.
    """
    t, p = F.col(tokens), [F.col(m) for m in members]
    weight = np.array(targets, dtype=float) / sum(targets)
    rate = F.lit(1.0)
    all_tokens, have, free = _expected(docs, t, p, rate)
    if total is None:
        largest = int(weight.argmax())
        total = have[largest] / weight[largest]
    want = weight * total
    if all_tokens == 0:
        return rate, have.tolist(), want.tolist()
    whitened = np.linalg.pinv(free, rcond=1e-9, hermitian=True)
    now, metric = have, whitened
    for _ in range(steps):
        off = now - want
        if np.abs(off).max() <= CLOSE * all_tokens:
            break
        for inverse in (metric, whitened):
            step = [round(float(x), 12) for x in inverse @ off / all_tokens]
            tried = F.greatest(F.lit(0.0), rate - sum((F.lit(x) * c for x, c in zip(step[1:], p[1:])), F.lit(step[0]) * p[0]))
            _, then, free = _expected(docs, t, p, tried)
            lower = (then - want) @ whitened @ (then - want) < off @ whitened @ off
            if lower or inverse is whitened:
                break
        stalled = (then - want) @ whitened @ (then - want) > (1 - STALL) * (off @ whitened @ off)
        rate, now = tried, then
        if stalled:
            break
        metric = np.linalg.pinv(free, rcond=1e-9, hermitian=True) if lower else whitened
    return rate, now.tolist(), want.tolist()


def _expected(docs: DataFrame, t: Column, p: list[Column], rate: Column) -> tuple[float, np.ndarray, np.ndarray]:
    """All tokens, expected tokens of each domain, Gram matrix per token of documents whose rate isn't 0."""
    k = len(p)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = docs.select(t.alias("t"), rate.alias("rate"), *[c.alias(f"p{i}") for i, c in enumerate(p)]).agg(
        F.sum("t"), *[F.sum(F.col("t") * F.col("rate") * F.col(f"p{i}")) for i in range(k)],
        *[F.sum(F.when(F.col("rate") > 0, F.col("t") * F.col(f"p{i}") * F.col(f"p{j}"))) for i, j in pairs]).first()
    values = [float(x or 0) for x in got]
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, values[1 + k:]):
        gram[i, j] = gram[j, i] = v / values[0] if values[0] else 0.0
    return values[0], np.array(values[1:1 + k]), gram


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """(row, tokens, p_<domain> ..., rate, copies) for each row of ``docs``; see ``mix_with_totals``."""
    return mix_with_totals(docs, labels, targets, **options)[0]


def mix_with_totals(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: Column | None = None,
                    id_col: str = "doc_id", text_col: str = "text", total: float | None = None,
                    labelled: int = LABELLED) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(row, tokens, p_<domain> ..., rate, copies) for each row of ``docs``, and domain -> expected tokens
    under the fitted rates and tokens wanted, which differ where no rates meet the targets or the fit ended early.

    ``row`` holds all columns.  tokens counts the words of the text; rate is the
    fitted rate; copies is the rate rounded up or down with the fraction as the
    chance, decided by a hash of id and text, so equal rows decide alike.

    Targets of domains without a labelled document are left out and the others
    scaled up; without any labelled document all domains are equally likely.
    Null and empty texts have no tokens, the domains' shares as posterior and a
    rate like any other.  Labels with a null id or domain are ignored; of several
    labels of one id the first domain by name counts.  An empty table gives an
    empty result.
    """
    domain = quality_domain() if domain is None else domain
    names, shares, weights = learn_domains(docs, labels, domain, list(targets), id_col, text_col, labelled)
    if not names:
        names = list(targets)
        shares = [math.log(1 / len(names))] * len(names)
    scored = with_words(docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
                                    text_or_empty(F.col(quoted(text_col))).alias("text")), "text")
    scored = scored.select("row", F.size("words").cast("double").alias("tokens"),
                           weighted_buckets(F.col("text"), F.col("words"), weights).alias("hits"))
    scored = scored.withColumn("logits", F.array(*domain_logits(F.col("hits"), shares, weights)))
    raised = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    scored = (scored.withColumn("raised", raised)
              .withColumn("sum", F.aggregate("raised", F.lit(0.0), lambda s, x: s + x)))
    scored = materialize(scored.select("row", "tokens", *[(F.get("raised", F.lit(i)) / F.col("sum")).alias(f"p_{n}")
                                                          for i, n in enumerate(names)]), "mix-scored")
    members = [f"p_{n}" for n in names]
    rate, reached, wanted = fit_rates(scored, "tokens", members, [targets[n] for n in names], total)
    chance = F.pmod(F.xxhash64(F.col("row")[id_col], F.col("row")[text_col]), F.lit(1 << 30)) / float(1 << 30)
    rated = (scored.withColumn("rate", rate)
             .select("row", F.col("tokens").cast("long").alias("tokens"), *members, "rate",
                     F.floor(F.col("rate") + chance).cast("int").alias("copies")))
    return rated, {n: (r, w) for n, r, w in zip(names, reached, wanted)}


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """``docs`` with each row as often as its rate says; same columns."""
    mixed = mix(docs, labels, targets, **options)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def with_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """``docs`` plus tokens, posteriors, rate, copies and, in every row, the tokens of each domain that the rates
    reach and that were wanted (reached_<domain>, wanted_<domain>); columns of the same names are replaced."""
    mixed, totals = mix_with_totals(docs, labels, targets, **options)
    for name, (reached, wanted) in totals.items():
        mixed = mixed.withColumns({f"reached_{name}": F.lit(reached), f"wanted_{name}": F.lit(wanted)})
    return unpack(mixed, "row", [c for c in mixed.columns if c != "row"])
