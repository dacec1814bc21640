"""Column -> Column helpers for ticket text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake import constants as C


def clean_ticket_text(x: Column, patterns: Sequence[str] = tuple(C.CLEANING_PATTERNS)) -> Column:
    """Strip tags, code and noformat blocks, user mentions and links, fold runs
    of blanks, trim spaces. Stays inside the JVM."""
    out = F.coalesce(x, F.lit(""))
    for pattern in patterns:
        out = F.regexp_replace(out, pattern, " ")
    return F.trim(out)


def text_length(x: Column) -> Column:
    return F.length(F.coalesce(x, F.lit("")))


def long_enough(x: Column, n: int) -> Column:
    return F.length(F.coalesce(x, F.lit(""))) >= n


def layout(parts: Sequence[tuple[str, Column, str, int | None]], total: int | None = None) -> Column:
    """Lines ``label: value``; each part is (label, value, default, cut)."""
    pieces: list[Column] = []
    for i, (label, value, default, cut) in enumerate(parts):
        value = F.coalesce(value.cast("string"), F.lit(default))
        if cut:
            value = F.substring(value, 1, cut)
        pieces += [F.lit(("\n" if i else "") + f"{label}: "), value]
    text = F.concat(*pieces)
    return F.substring(text, 1, total) if total else text


def text_noco(summary: Column, priority: Column, status: Column, description: Column) -> Column:
    return layout(
        [("TICKET", summary, "", None), ("PRI", priority, "", None),
         ("STATUS", status, "", None), ("DESC", description, "", 1500)],
        2000,
    )


def text_rich(
    summary: Column, priority: Column, status: Column, n_comments: Column,
    description: Column, discussion: Column,
) -> Column:
    return layout(
        [("TICKET", summary, "", None), ("PRIORITY", priority, "Unknown", None),
         ("STATUS", status, "Unknown", None), ("N_COMMENTS", n_comments, "0", None),
         ("DESCRIPTION", description, "", 2000), ("DISCUSSION", discussion, "", 2500)],
        6000,
    )


def text_cause_input(
    summary: Column, priority: Column, status: Column, description: Column, comments: Column
) -> Column:
    return layout(
        [("Summary", summary, "", None), ("Priority", priority, "", None),
         ("Status", status, "", None), ("Description", description, "", 1500),
         ("Comments", comments, "", 1000)],
        3500,
    )


def text_enriched(
    summary: Column, priority: Column, status: Column, cause: Column, comments: Column,
    label: Column | None = None,
) -> Column:
    """Enriched layout. ``label`` puts the target label into the text and so
    leaks it; leave it out except to compare with the leaking variant."""
    head = [("TICKET", summary, "", None)]
    if label is None:
        head += [("PRI", priority, "", None)]
    else:
        both = F.concat(label, F.lit(" | PRI: "), F.coalesce(priority, F.lit("")))
        head += [("TYPE", both, "", None)]
    return layout(
        head + [("STATUS", status, "", None), ("RCA", cause, "", None),
                ("COMMENTS", comments, "", 1500)],
        2500,
    )


#: Every blank of Unicode, and the separators that only some tools take for blanks.
BLANK = r"(?U)[\s\x1c-\x1f]"


def stripped(x: Column) -> Column:
    """Without blanks at both ends; NULL gives the empty text."""
    return F.regexp_replace(F.coalesce(x, F.lit("")), f"^{BLANK}+|{BLANK}+$", "")


def tokens(x: Column) -> Column:
    """Lower-cased words between blanks of any alphabet; NULL gives no words."""
    words = F.split(F.lower(F.coalesce(x, F.lit(""))), f"{BLANK}+")
    return F.filter(words, lambda w: w != "")


def with_query_prefix(x: Column, prefix: str = C.QUERY_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.coalesce(x, F.lit("")))


def tidy_response(x: Column) -> Column:
    """Trim, strip double then single quotes."""
    return F.btrim(F.btrim(F.btrim(x, F.lit(" \n\r\t")), F.lit('"')), F.lit("'"))
