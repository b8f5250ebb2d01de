"""Entity extraction as native Column expressions (no Python UDF).

Symbol identification: a symbol is a prefix (``$``, ``#`` or full-width
``＃``), then the symbol as it is listed (any case), and the next character
is neither an ASCII letter nor ``|``. Symbols may hold digits, dots or other
letters, but no blank and no prefix sign. The candidates of a text are
therefore, for each run of other characters after a prefix, its beginnings
that are not followed by an ASCII letter or ``|``; for a run of ASCII letters
that is the run alone. Every listed symbol that stands there counts.
When the universe is a list of ASCII-letter symbols, one regex with the
longest length finds the same matches directly.
Matching the text joined with its context equals the union of the
matches of the pieces, because a match never spans the blank separator.

Hashtags follow the Unicode word class ``[\\p{L}\\p{N}_]`` so that
accented tags stay whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SYMBOL_PREFIXES, TICKERS

# Patterns (Java regex syntax; these are also valid RE2).
SYMBOL_SIGN = "[" + SYMBOL_PREFIXES.replace("$", "\\$") + "]"
# The blanks of \s by name: inside a negated class Java looks \s up several times slower.
_NO_RUN = " \\t\\n\\x0B\\f\\r" + SYMBOL_PREFIXES.replace("$", "\\$")
SYMBOL_RUN = SYMBOL_SIGN + "([^" + _NO_RUN + "]+)"
HASHTAG = "#([\\p{L}\\p{N}_]+)"
CASHTAG = "\\$([\\p{L}\\p{N}_]+)"
# A hashtag with the character that follows it when that is a '|'.
HASHTAG_WITH_PIPE = "#([\\p{L}\\p{N}_]+\\|?)"
CASHTAG_WITH_PIPE = "\\$([\\p{L}\\p{N}_]+\\|?)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract_upper(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.upper)


def bounded_candidate_pattern(max_len: int) -> str:
    """Prefix, 1..``max_len`` ASCII letters, then neither a letter nor ``|``.

    Runs longer than the longest symbol can never match, so they are
    rejected inside the regex engine instead of becoming array elements.
    """
    return ("[" + SYMBOL_PREFIXES.replace("$", "\\$") + "]([A-Za-z]{1," + str(max_len)
            + "})(?![A-Za-z|])")


def prefix_lengths(lengths) -> list[int]:
    """Lengths of the beginnings that can name symbols of these lengths.

    Upper-casing turns a character into three at most (``ß`` into two), so a
    beginning may be shorter than the upper-cased symbol that it names.
    """
    return sorted({i for n in lengths for i in range(-(-n // 3), n + 1) if i})


def symbol_lengths(universe: DataFrame) -> list[int]:
    """``prefix_lengths`` of a one-column table of symbols: one row a distinct length reaches the driver."""
    return prefix_lengths(r[0] for r in universe.select(F.length(F.upper(F.col(universe.columns[0])))).distinct().collect() if r[0])


def _continues(c: Column) -> Column:
    """Whether one character is an ASCII letter or ``|``; comparisons, since a pattern costs several times as much per call."""
    return c.between("A", "Z") | c.between("a", "z") | (c == "|")


def beginnings(run: Column, lengths: Sequence[int] | None = None) -> Column:
    """The beginnings of a run that are not followed by an ASCII letter or ``|``.

    ``lengths`` names the lengths that can matter; without it every length is
    tried, which is quadratic in the run and fit for short runs only.
    """
    alone = F.array(run)  # a run of letters has no beginning but itself
    if lengths is not None:
        alone = F.filter(alone, lambda r: F.length(r).isin(list(lengths)))
    return F.when(run.rlike("^[A-Za-z]+\\z"), alone).otherwise(_cuts(run, lengths))


def _cuts(run: Column, lengths: Sequence[int] | None = None) -> Column:
    """``beginnings`` of a run that is not of ASCII letters alone."""
    n = F.length(run)
    tried = F.sequence(F.lit(1), n) if lengths is None else F.array(*[F.lit(i) for i in lengths]).cast("array<int>")
    ends = F.filter(tried, lambda i: (i == n) | ((i < n) & ~_continues(F.substring(run, i + 1, F.lit(1)))))
    return F.transform(ends, lambda i: F.substring(run, F.lit(1), i))


def symbol_candidates(text, lengths: Sequence[int] | None = None) -> Column:
    """Upper-cased distinct candidates of a text (null for null text), of the given lengths (see ``prefix_lengths``)."""
    if not lengths:
        runs = F.array_distinct(F.regexp_extract_all(_col(text), F.lit(SYMBOL_RUN), F.lit(1)))
        return F.array_distinct(F.transform(F.flatten(F.transform(runs, lambda r: beginnings(r, lengths))), F.upper))
    # beginnings of ASCII letters come from one pattern; only runs with another character near their front are cut up
    longest = max(lengths)
    letters = F.regexp_extract_all(_col(text), F.lit(SYMBOL_SIGN + "([A-Za-z]{1," + str(longest) + "}+)(?![A-Za-z|])"), F.lit(1))
    if len(lengths) < longest:
        letters = F.filter(letters, lambda r: F.length(r).isin(list(lengths)))
    # a run is read one length beyond the longest symbol, so none that is cut there looks like a whole one
    mixed = F.regexp_extract_all(_col(text), F.lit(SYMBOL_SIGN + "([A-Za-z]{0," + str(longest - 1) + "}+[^A-Za-z" + _NO_RUN + "][^"
                                                   + _NO_RUN + "]{0," + str(longest) + "}+)"), F.lit(1))
    cut = F.flatten(F.transform(F.array_distinct(mixed), lambda r: _cuts(r, lengths)))
    return F.array_distinct(F.transform(F.concat(letters, cut), F.upper))


def _candidates_for(text, universe: Sequence[str]) -> Column:
    """Candidates that are enough for a literal universe."""
    if all(s.isascii() and s.isalpha() for s in universe):
        return _extract_upper(_col(text), bounded_candidate_pattern(max((len(s) for s in universe), default=1)))
    return symbol_candidates(text, prefix_lengths(len(s.upper()) for s in universe))


def keep_universe(cands: Column, universe: Sequence[str]) -> Column:
    """Sorted distinct candidates that are universe symbols.

    ``isin`` with many literals becomes a hashed ``InSet``, so the cost per
    candidate is constant whatever the universe size.
    """
    u = list(dict.fromkeys(s.upper() for s in universe))
    kept = F.filter(cands, lambda c: c.isin(u))
    return F.array_sort(F.array_distinct(kept))


def identify_tickers(text, context=None, universe: Sequence[str] = TICKERS,
                     strict_compat: bool = False, context_is_struct: bool = True) -> Column:
    """Symbols a post is about, from its text and its conversation context.

    ``context`` is an array of referenced posts (structs with ``text``) or
    of strings. Default mode treats a missing text or context as empty;
    ``strict_compat=True`` returns NULL when either is NULL, as the
    original job did.
    """
    t = _col(text)
    cands = F.coalesce(_candidates_for(t, universe), F.array().cast("array<string>"))
    ctx = None
    if context is not None:
        ctx = _col(context)
        if context_is_struct:
            extra = F.flatten(F.transform(ctx, lambda r: F.coalesce(
                _candidates_for(r["text"], universe), F.array().cast("array<string>"))))
        else:
            extra = F.flatten(F.transform(ctx, lambda r: F.coalesce(
                _candidates_for(r, universe), F.array().cast("array<string>"))))
        cands = F.concat(cands, F.coalesce(extra, F.array().cast("array<string>")))
    out = keep_universe(cands, universe)
    if strict_compat:
        null_in = t.isNull() if ctx is None else (t.isNull() | ctx.isNull())
        out = F.when(null_in, F.lit(None).cast("array<string>")).otherwise(out)
    return out


def extract_hashtags(text) -> Column:
    """Upper-cased hashtags in text order, duplicates kept; ``[]`` for null text."""
    return F.coalesce(_extract_upper(_col(text), HASHTAG), F.array().cast("array<string>"))


def extract_cashtags(text) -> Column:
    """Upper-cased ``$`` tags in text order, duplicates kept; ``[]`` for null text."""
    return F.coalesce(_extract_upper(_col(text), CASHTAG), F.array().cast("array<string>"))


def tag_tokens(text, prefix: str = "#") -> Column:
    """Tags as written, with a directly following ``|``, in text order."""
    pattern = HASHTAG_WITH_PIPE if prefix == "#" else CASHTAG_WITH_PIPE
    return F.coalesce(F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(1)), F.array().cast("array<string>"))


def tag_of(token: Column) -> Column:
    return F.upper(F.regexp_replace(token, r"\|$", ""))


def non_symbol_tags(text, universe: Sequence[str] = TICKERS, prefix: str = "#") -> Column:
    """Tags of a text that do not name a universe symbol.

    A tag names a symbol when one of its beginnings (see ``beginnings``) is a
    universe symbol in any case; every other tag is kept, upper-cased, in text order.
    """
    u = list(dict.fromkeys(s.upper() for s in universe))
    kept = F.filter(tag_tokens(text, prefix), lambda tok: ~F.exists(beginnings(tok, prefix_lengths(len(s) for s in u)), lambda b: F.upper(b).isin(u)))
    return F.transform(kept, tag_of)
