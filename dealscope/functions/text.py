"""Scalar text helpers.  All are Catalyst expressions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealscope.settings import DEFAULT, Settings


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a let-binding).

    Catalyst does not eliminate common subexpressions inside conditional
    branches, so an expensive value used twice under a CASE WHEN would be
    computed twice per row; binding it to a lambda variable avoids that."""
    return F.transform(F.array(value), fn).getItem(0)


def has_text(x) -> Column:
    """NOT NULL and non-blank after trimming spaces; never NULL itself."""
    c = _c(x)
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))


def any_text(*xs) -> Column:
    out = has_text(xs[0])
    for x in xs[1:]:
        out = out | has_text(x)
    return out


def strip_html(x, cut_at: int = 2000) -> Column:
    """Remove tags, cut to ``cut_at`` characters, trim (in that order)."""
    return F.trim(F.left(F.regexp_replace(_c(x), r"<[^>]+>", ""), F.lit(cut_at)))


def cut(x, n: int) -> Column:
    return F.left(_c(x), F.lit(n))


# ASCII whitespace, spelled out so Java regex and RE2 agree exactly.
WS = r"[\t\n\x0B\f\r ]+"


def collapse_ws(x) -> Column:
    return F.trim(F.regexp_replace(_c(x), WS, " "))


def words(x) -> Column:
    """Whitespace-collapsed words (``['']`` for an empty text)."""
    return F.split(collapse_ws(x), " ")


def word_count(x) -> Column:
    """Number of words; 0 for NULL or blank text."""
    return bind(collapse_ws(x), lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) == 0, F.lit(0))
                .otherwise(F.size(F.split(c, " "))))


def first_words(x, n: int) -> Column:
    return F.array_join(F.slice(words(x), 1, n), " ")


def tokens(x) -> Column:
    """Lower-case ASCII alphanumeric tokens, used by the rule classifier."""
    return F.split(F.lower(_c(x)), r"[^a-z0-9]+")


def template_fill(template, values: dict[str, Column]) -> Column:
    """Fill ``{slot}`` markers by chained replacement, in ``values`` order.

    Like a chain of SQL ``REPLACE`` calls, a later slot is also replaced
    inside text inserted for an earlier one.
    """
    out = _c(template) if not isinstance(template, str) else F.lit(template)
    for slot, v in values.items():
        out = F.replace(out, F.lit("{" + slot + "}"), F.coalesce(v, F.lit("")))
    return out


def name_first(x) -> Column:
    return F.split(_c(x), " ").getItem(0)


def name_last(x) -> Column:
    parts = F.split(_c(x), " ")
    return F.get(parts, F.size(parts) - 1)


def generated_contact(x, settings: Settings = DEFAULT) -> Column:
    """``first.last@domain`` in lower case from a ``First ... Last`` name."""
    return F.concat(F.lower(name_first(x)), F.lit("."), F.lower(name_last(x)),
                    F.lit("@" + settings.email_domain))
