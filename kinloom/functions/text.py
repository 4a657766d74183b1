"""Text functions as Column expressions.

All of them treat null as the empty string and run in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space and noise classes, legal words, house-number label.
SPACES = r"\s\x1c-\x1f\x85\p{Z}"
WS = f"[{SPACES}]"
NOISE = f"[{SPACES}" + r"\-<>!@#$%\^*()\[\]{}|\\/+=~`'\".,:;]"
LEGAL_WORDS = (
    "inc incorporated ltd limited pvt private llc llp corp corporation co company "
    "sarl sas sa srl gmbh bv nv plc pllc the and & of for in"
).split()
LABELLED_NUMBER = r"(?i)(?<![\p{L}\p{N}_])No\.?" + WS + r"*(\p{Nd}+)"
NUMBER = r"\p{Nd}+"
# Fixed values of the optional canonical forms.
CANONICAL = {
    "corp": "corporation", "inc": "incorporated", "ltd": "limited", "pvt": "private", "co": "company",
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "&": "and",
}
LANDMARK = r"(?i)^(?:near|opp\.?|opposite|behind|beside|next to)(?![\p{L}\p{N}_])"


def let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` computed once for all its uses."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip_space(c) -> Column:
    """White space of every kind off both ends; ``trim`` knows U+0020 alone."""
    return F.regexp_replace(text(c), rf"\A{WS}+|{WS}+\z", "")


def clean_token(c) -> Column:
    return F.regexp_replace(text(c), rf"\A{NOISE}+|{NOISE}+\z", "")


def strip_noise(c) -> Column:
    return F.regexp_replace(clean_token(c), f"{WS}+", " ")


def is_latin(c) -> Column:
    return text(c).rlike(r"\p{IsLatin}")


def lower_latin(c) -> Column:
    """Lower case where a Latin letter occurs, other scripts as they are."""
    return let(text(c), lambda x: F.when(x.rlike(r"\p{IsLatin}"), F.lower(x)).otherwise(x))


def normalize_name(c) -> Column:
    return F.regexp_replace(F.translate(strip_noise(c), "-", " "), f"{WS}+", " ")


def significant_tokens(c, extra: Iterable[str] = ()) -> Column:
    """Words that tell names apart; the first word where all are stop words."""
    stops = F.array(*(F.lit(w) for w in dict.fromkeys([*LEGAL_WORDS, *extra])))
    words = F.filter(F.transform(F.split(normalize_name(c), f"{WS}+"), clean_token), lambda x: x != "")

    def kept(all_words: Column) -> Column:
        telling = F.filter(all_words, lambda x: ~F.array_contains(stops, F.lower(x)))
        return let(telling, lambda t: F.when(F.size(t) > 0, t).otherwise(F.slice(all_words, 1, 1)))

    return let(F.transform(words, lower_latin), kept)


def first_prefix(tokens: Column, n: int = 3) -> Column:
    return F.coalesce(F.substring(F.get(tokens, F.lit(0)), 1, n), F.lit(""))


def last_prefix(tokens: Column, n: int = 3) -> Column:
    return F.coalesce(F.substring(F.try_element_at(tokens, F.lit(-1)), 1, n), F.lit(""))


def name_prefix(c, extra: Iterable[str] = (), last: bool = False) -> Column:
    return let(significant_tokens(c, extra), last_prefix if last else first_prefix)


def last_segment(c) -> Column:
    """The last comma-separated part with anything in it, lower-cased if Latin."""
    parts = F.filter(F.transform(F.split(text(c), ","), strip_noise), lambda x: x != "")
    return lower_latin(F.try_element_at(parts, F.lit(-1)))


def house_number(c) -> Column:
    """The number behind a ``No`` label, else the first number."""
    return F.coalesce(F.nullif(F.regexp_extract(text(c), LABELLED_NUMBER, 1), F.lit("")), F.regexp_extract(text(c), NUMBER, 0))


def country_label(c) -> Column:
    return F.lower(strip_noise(c))


def encode_ids(ids: Column) -> Column:
    return F.concat_ws(",", F.sort_array(ids))


def decode_ids(c) -> Column:
    """Items of a comma list; none for an empty or blank one."""
    return F.when(strip_space(c) == "", F.array().cast("array<string>")).otherwise(F.split(text(c), ","))


def show_examples(ids: Column, most: int = 5) -> Column:
    """Up to ``most`` sorted ids, with the total where there are more."""

    def shown(x: Column) -> Column:
        head = F.concat_ws(", ", F.slice(x, 1, most))
        return F.when(F.size(x) > most, F.concat(F.size(x).cast("string"), F.lit(" total, e.g. "), head, F.lit(", ..."))).otherwise(head)

    return let(F.sort_array(ids), shown)


def canonical_words(c) -> Column:
    """Common abbreviations spelled out, landmark parts taken out, lower case."""
    table = F.create_map(*(F.lit(x) for kv in CANONICAL.items() for x in kv))
    parts = F.filter(F.transform(F.split(text(c), ","), strip_noise), lambda x: (x != "") & ~x.rlike(LANDMARK))
    words = lambda x: F.transform(F.split(F.lower(x), f"{WS}+"), lambda w: let(clean_token(w), lambda y: F.coalesce(F.try_element_at(table, y), F.try_element_at(table, w), y)))
    return F.concat_ws(", ", F.transform(parts, lambda p: F.concat_ws(" ", words(p))))
