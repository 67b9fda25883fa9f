"""Text functions as Column expressions; only NFKC and the name ratio need Python (Arrow batches)."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Fixed values that results depend on.
NAME_STOPWORDS = ["the", "a", "an", "of", "and", "in", "for", "to", "as", "on"]
TOKEN_STOPWORDS = ["a", "an", "the", "of", "in", "on", "for", "with", "to", "and", "or", "is", "are"]
TYPOGRAPHY = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "\u2011": "-", "\u00ad": "", "\u200b": "", "\u200c": "", "\u200d": "", "\ufeff": "", "\u00a0": " "}
BOILERPLATE = r"(?im)^\s*(?:©\s*20\d\d[^\n]{0,40}|All Rights Reserved|Page \d+ of \d+|Tel:[^\n]*|[a-z0-9.-]+\.(?:edu|com)\s*|MODULE \d+ UNIT \d+|(?:Video|Podcast) \d+ Transcript)\s*$"
KIND_HINTS = [
    (r"\b(theorem|law|rule|paradox|principle|hypothesis|lemma)\b", "principle"),
    (r"\b(method|elimination|algorithm|analysis|regression|clustering|testing|multiplication|addition|transposition|substitution|integration|regularisation|regularization|boosting|bagging|stacking|augmentation)\b", "method"),
    (r"\b(framework|model|architecture|network|matrix of|playbook)\b", "framework"),
    (r"\b(accuracy|precision|recall|score|metric|variance|deviation|value|determinant|auc|f1)\b", "metric"),
    (r"\b(diagram|table|tool|notation)\b", "tool"),
]
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def slug(c: Column) -> Column:
    """Lower case, other than a-z0-9 to single hyphens, none at the ends. Names without such letters give ''."""
    return F.regexp_replace(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def lesson_slug(c: Column) -> Column:
    """As ``slug``, without what stands in parentheses."""
    return slug(F.regexp_replace(F.lower(text_or_empty(c)), r"\([^)]*\)", " "))


def _words(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def name_key(c: Column) -> Column:
    """Words of a name without NAME_STOPWORDS, in order."""
    return F.array_join(F.filter(_words(c), lambda w: ~w.isin(NAME_STOPWORDS)), " ")


def token_set(c: Column) -> Column:
    """Distinct words of a name without TOKEN_STOPWORDS, sorted: equal sets are equal arrays."""
    return F.array_sort(F.array_distinct(F.filter(_words(c), lambda w: ~w.isin(TOKEN_STOPWORDS))))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def normalise(c: Column, compat: bool = False) -> Column:
    """Fold typographic variants; ``compat`` also applies NFKC, which Spark lacks, in Arrow batches."""
    one = [k for k, v in TYPOGRAPHY.items() if v]
    none = [k for k, v in TYPOGRAPHY.items() if not v]
    base = nfkc(text_or_empty(c)) if compat else text_or_empty(c)
    return F.translate(base, "".join(one + none), "".join(TYPOGRAPHY[k] for k in one))


def clean(c: Column, compat: bool = False) -> Column:
    """Drop boilerplate lines, join hyphenated lines, squeeze blank lines and runs of spaces, strip."""
    t = F.regexp_replace(normalise(c, compat), BOILERPLATE, "")
    t = F.regexp_replace(t, r"-\s*\n\s*", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " ")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def fold(c: Column, compat: bool = False) -> Column:
    """Only 0-9a-z words, single spaces: what verbatim evidence is compared in."""
    t = F.regexp_replace(normalise(c, compat), r"-\s*\n\s*", "")
    return F.trim(F.regexp_replace(F.lower(t), "[^0-9a-z]+", " "))


def html_text(c: Column, entities: bool = True) -> Column:
    """Visible text of HTML: entities, scripts and styles, block ends to newlines, other tags to spaces."""
    t = text_or_empty(c)
    for k, v in ENTITIES.items() if entities else ():
        t = F.replace(t, F.lit(k), F.lit(v))
    t = F.regexp_replace(t, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</p>|</li>|</div>|</h[1-6]>", "\n")
    t = F.regexp_replace(F.regexp_replace(t, "<[^>]+>", " "), r"[ \t]{2,}", " ")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def trigrams(c: Column) -> Column:
    """Distinct trigrams of a name key padded by two spaces on each side; none for an empty key."""
    # Values are bound to lambda variables, so that they are computed once and not for each
    # trigram; characters are an array, since a substring by position reads from the start.
    keys = F.transform(F.array(name_key(c)), lambda k: F.when(k == "", "").otherwise(F.concat(F.lit("  "), k, F.lit("  "))))
    chars = F.transform(keys, lambda s: F.array_remove(F.split(s, ""), ""))
    grams = F.transform(chars, lambda cs: F.array_compact(F.transform(cs, lambda x, i: F.concat(x, F.get(cs, i + 1), F.get(cs, i + 2)))))
    return F.array_distinct(F.coalesce(F.get(grams, F.lit(0)), F.array().cast("array<string>")))


def guess_kind(c: Column) -> Column:
    """First matching hint's kind, else definition."""
    low, out = F.lower(text_or_empty(c)), F.lit("definition")
    for pattern, kind in reversed(KIND_HINTS):
        out = F.when(low.rlike(pattern), kind).otherwise(out)
    return out


@F.pandas_udf(DoubleType())
def name_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; it is not symmetric, so call it with a < b."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(text_or_empty(c), r"(?U)\s+", " "))


def cache_key(*parts: Column) -> Column:
    """First 32 hex digits of SHA-256 over parts joined by NUL."""
    return F.substring(F.sha2(F.concat_ws("\0", *[text_or_empty(p) for p in parts]), 256), 1, 32)


def sql_literal(c: Column) -> Column:
    """A string as an SQL literal; null and empty are NULL."""
    return F.when(text_or_empty(c) == "", "NULL").otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")))


def or_default(c: Column, default) -> Column:
    """Null and the type's empty value (0, '') both give the default."""
    empty = "" if isinstance(default, str) else 0
    return F.coalesce(F.nullif(c, F.lit(empty)), F.lit(default))
