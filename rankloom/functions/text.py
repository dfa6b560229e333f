"""Text analysis: strings to arrays of terms, all with built-in Column functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The analysers' patterns. The possessive quantifiers keep the matcher from
# recursing on very long runs; the matched language is the same without them.
WORD = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*+"
EMAIL = r"[\p{L}\p{N}]+(?:[._-][\p{L}\p{N}]+)*+@[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)++"
HOST = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)++"
CLASSIC = f"{EMAIL}|{HOST}|{WORD}"
LOOSE_WORD = r"""[^\s',:;@#$%&?!()\[\]{}<>"]+"""

# Latin letters that have no canonical decomposition, with their ASCII spelling.
LETTERS_WITHOUT_ACCENT = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "ı": "i", "ħ": "h"}
LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}


def _accented_latin() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by canonical decomposition."""
    accented, base = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = unicodedata.normalize("NFD", chr(code))[0]
        if letter != chr(code) and letter.isascii():
            accented.append(chr(code))
            base.append(letter)
    return "".join(accented), "".join(base)


def fold_ascii(text: Column) -> Column:
    """Lower-case Latin letters to ASCII: accents dropped, ligatures spelled out."""
    accented, base = _accented_latin()
    combining = "".join(chr(code) for code in range(0x0300, 0x0370))
    plain = F.translate(
        text,
        accented + "".join(LETTERS_WITHOUT_ACCENT) + combining,
        base + "".join(LETTERS_WITHOUT_ACCENT.values()),
    )
    for ligature, spelled in LIGATURES.items():
        plain = F.replace(plain, F.lit(ligature), F.lit(spelled))
    return plain


def standard_terms(text: Column) -> Column:
    """Words in lower case. Approximates Unicode word segmentation: ``3.14`` gives two terms."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def whitespace_terms(text: Column) -> Column:
    """Whitespace-separated terms, lower case, folded to ASCII."""
    return F.filter(F.split(fold_ascii(F.lower(text)), r"\s+"), lambda t: t != "")


def classic_terms(text: Column) -> Column:
    """As :func:`standard_terms`, but e-mail addresses and host names stay whole; folded to ASCII."""
    return F.regexp_extract_all(fold_ascii(F.lower(text)), F.lit(CLASSIC), F.lit(0))


def cased_words(text: Column) -> Column:
    """Words with their case kept."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def normalized(token: Column) -> Column:
    """Lower case, everything but ASCII letters, digits and hyphens dropped."""
    return F.regexp_replace(F.lower(token), r"[^a-zA-Z0-9\-]", "")


def normalized_terms(title: Column, content: Column) -> Column:
    """Normalised tokens of the content, then of the title (split on whitespace), longer than one.

    The content is split at whitespace, quotes and punctuation; dots and hyphens inside a token are
    left to the normaliser, so ``U.S.`` gives ``us`` and ``state-run`` stays whole.
    """
    tokens = F.concat(
        F.regexp_extract_all(F.lower(content), F.lit(LOOSE_WORD), F.lit(0)),
        F.split(F.lower(title), r"\s+"),
    )
    return F.filter(F.transform(tokens, normalized), lambda t: F.length(t) > 1)


def alphabetic(token: Column) -> Column:
    """Whether a token has letters only."""
    return token.rlike(r"^\p{L}+$")


def spaced(lemma: Column) -> Column:
    """Underscores to spaces."""
    return F.replace(lemma, F.lit("_"), F.lit(" "))


def valid_lemma(lemma: Column) -> Column:
    """Whether every word of a lemma is longer than two letters."""
    words = F.filter(F.split(spaced(lemma), r"\s+"), lambda w: w != "")
    return F.forall(words, lambda w: F.length(w) > 2)


def snippet(text: Column, length: int = 150) -> Column:
    return F.substring(text, 1, length)


def folded_standard_terms(text: Column) -> Column:
    """As :func:`standard_terms`, folded to ASCII."""
    return standard_terms(fold_ascii(F.lower(text)))


# Analyser of each index field; other text fields use the standard one.
FIELD_ANALYZERS = {
    "stemmed_content": folded_standard_terms,
    "custom_content": whitespace_terms,
    "whitespace_content": whitespace_terms,
    "classic_content": classic_terms,
}


def analyze(field: str, text: Column) -> Column:
    """Terms of ``text`` as the index field named ``field`` sees it."""
    return FIELD_ANALYZERS.get(field, standard_terms)(text)


def _counted(df: DataFrame, keep: list[str], tokens: str) -> tuple[DataFrame, Column]:
    """Rows with their sorted tokens, and the array of ``(term, tf)`` as an expression on them."""
    held = df.select(*keep, F.sort_array(tokens).alias("_terms"))
    terms, starts = F.col("_terms"), F.col("_starts")
    first_of_run = F.filter(
        F.sequence(F.lit(0), F.size(terms) - 1),
        lambda i: ~F.get(terms, i).eqNullSafe(F.get(terms, i - 1)),
    )
    runs = held.select(
        *keep,
        terms,
        F.when(F.size(terms) > 0, first_of_run)
        .otherwise(F.array().cast("array<int>"))
        .alias("_starts"),
    )
    counted = F.transform(
        starts,
        lambda start, i: F.struct(
            F.get(terms, start).alias("term"),
            (F.coalesce(F.get(starts, i + 1), F.size(terms)) - start).alias("tf"),
        ),
    )
    return runs, counted


def term_counts(df: DataFrame, keep: list[str], tokens: str = "tokens") -> DataFrame:
    """Distinct terms of each row's token array with their counts: ``(*keep, n_tokens, terms)``.

    ``terms`` is an array of ``(term, tf)`` in term order. Counted inside the row (sort, then run
    lengths), so no shuffle is needed: a text's tokens never leave its task.
    """
    runs, counted = _counted(df, keep, tokens)
    return runs.select(*keep, F.size("_terms").alias("n_tokens"), counted.alias("terms"))


def count_terms(df: DataFrame, keep: list[str], tokens: str = "tokens", outer: bool = False) -> DataFrame:
    """One row per distinct term of each row's token array: ``(*keep, n_tokens, term, tf)``.

    ``outer`` keeps rows without tokens, with a NULL term.
    """
    runs, counted = _counted(df, keep, tokens)
    unnest = F.inline_outer if outer else F.inline
    return runs.select(*keep, F.size("_terms").alias("n_tokens"), unnest(counted))


def open_terms(rows: DataFrame, keep: list[str], terms: str = "terms") -> DataFrame:
    """One row per entry of an array of structs with a ``term``: ``(*keep, ...)``.

    The outer form keeps the optimizer from inferring a filter on the array, which it would push
    below the expressions that make the array and so evaluate them again for every element.
    """
    return rows.select(*keep, F.inline_outer(terms)).where("term IS NOT NULL")
