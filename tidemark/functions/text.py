"""Text helpers for imports, statistics keys and trace labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms after which a company name is cut, in this order.
COMPANY_ENDINGS = (" group", " corp", " inc", " co.", " llc", " limited", ".com")
# Characters that a table name drops.
DROPPED_CHARACTERS = ",.&')("


def clean_name(name: Column) -> Column:
    """Company name -> table name part: lower case, no legal form, underscores."""
    endings = "|".join(ending.replace(".", "\\.") for ending in COMPANY_ENDINGS)
    # Everything from the earliest ending on goes. Cutting at each ending in turn
    # gives the same: a later cut can only shorten the text further.
    kept = F.regexp_replace(F.lower(name), f"(?s)({endings}).*$", "")
    kept = F.regexp_replace(kept, r"^\s+|\s+$", "")
    plain = F.translate(kept, "- " + DROPPED_CHARACTERS, "__")
    return F.replace(plain, F.lit("__"), F.lit("_"))


def file_stem(path: Column) -> Column:
    """Lower-case file name without folder and last extension."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""))


def clean_blob(raw: Column) -> Column:
    """Bytes -> text: broken UTF-8 becomes the replacement character, NULs go."""
    return F.translate(F.make_valid_utf8(raw.cast("string")), "\u0000", "")


def int_or_text(text: Column) -> Column:
    """struct(int_value, text_value): exactly one is set for non-null input."""
    number = text.try_cast("bigint")
    return F.struct(
        number.alias("int_value"), F.when(number.isNull(), text).alias("text_value")
    )


def op_split(label: Column) -> Column:
    """Trace label -> struct(is_start, op); both null for labels that are no span edge."""
    starts, ends = label.endswith("_starts"), label.endswith("_ends")
    cut = lambda suffix: F.left(label, F.length(label) - len(suffix))
    return F.struct(
        F.when(starts, True).when(ends, False).alias("is_start"),
        F.when(starts, cut("_starts")).when(ends, cut("_ends")).alias("op"),
    )
