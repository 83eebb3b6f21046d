"""String rules as column expressions: clocks, scores, free-throw texts, person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the plain letters they become; kinds of free throws; suffixes that are no part of a name.
MARKED = "áàâäãåāčćçďđéèêëēėęíìîïīłñńňóòôöõøōřšśțţťúùûüūýÿžźżğ"
PLAIN = "aaaaaaacccddeeeeeeeiiiiilnnnooooooorsstttuuuuuyyzzzg"
FREE_THROW = r"(?s)^.*?free throw (technical|flagrant|clear path|) *([0-9]|) *(?:of ([0-9])|)"
SUFFIXES = ["jr", "sr", "ii", "iii", "iv"]


def clock_seconds(text: Column) -> Column:
    """Seconds of a MM:SS clock; null where it is not one."""
    part = F.split(text, ":")
    return F.try_add(F.expr("60") * F.get(part, F.lit(0)).try_cast("int"), F.get(part, F.lit(1)).try_cast("int"))


def padded_id(text: Column, width: int = 10) -> Column:
    return F.lpad(text.cast("string"), width, "0")


def margin(text: Column) -> Column:
    return F.when(text == "TIE", 0).otherwise(text.try_cast("int"))


def free_throw(text: Column) -> Column:
    """Struct kind ('' for common), n, of, made of a free throw's description.

    What follows "Free Throw" is read from left to right: a kind, the attempt's digit, and "of" with the trip's digit.
    """
    lower = F.lower(F.coalesce(text, F.lit("")))
    part = lambda i: F.regexp_extract(lower, FREE_THROW, i)
    # the code of a digit: a cast that fails, as on most rows, would build an error each time
    digit = lambda c: F.when(c != "", F.ascii(c) - 48)
    kind, n, of = part(1), digit(part(2)), digit(part(3))
    return F.struct(kind.alias("kind"), n.alias("n"), of.alias("of"), (~lower.startswith("miss")).alias("made"))


def person_name(text: Column) -> Column:
    """Lower-case name without marks, punctuation and suffixes; initials are joined.

    A suffix stays when it is the first word.  Letters outside the table of marks stay as they are.
    """
    plain = F.translate(F.lower(text), MARKED, PLAIN)
    plain = F.trim(F.regexp_replace(F.regexp_replace(plain, r"[.'’`]", ""), r"[^\p{L}\p{N} ]+", " "))
    plain = F.regexp_replace(plain, r"\s+", " ")
    joined = F.regexp_replace(plain, r"\b(\p{L}) (?=\p{L}\b)", "$1")
    return F.regexp_replace(joined, r"(?<=\S) (" + "|".join(SUFFIXES) + r")$", "")
