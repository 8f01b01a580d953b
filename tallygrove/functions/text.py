"""Text, key and formatting functions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """By Unicode's rule: what ASCII is left of each character's compatibility decomposition, and of its canonical one without marks.

    The first leaves out characters of which nothing is left, the second those that do not
    change or fall into several letters (Hangul syllables, some Indic vowels), which stay
    composed. đ has no decomposition and counts as d.
    """
    folded, bare = {}, {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20)):
        c = chr(code)
        if (plain := unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()) != "":
            folded[c] = plain
        apart = unicodedata.normalize("NFD", c)
        kept = "".join(x for x in apart if unicodedata.category(x) != "Mn")
        if len(kept) < 2 and kept != c:
            bare[c] = kept
    for c, d in (("đ", "d"), ("Đ", "D")):
        folded[c] = bare[c] = d
    return folded, bare


def character_class(characters: Iterable[str]) -> str:
    """A regular expression's class of these characters, as ranges."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(chr(x) if x == y else f"{chr(x)}-{chr(y)}" for x, y in spans) + "]"


FOLDED, _BARE = _decompositions()
_MARKS = character_class(c for c, p in _BARE.items() if not p)
_UNMARKED = {c: p for c, p in _BARE.items() if p}
#: Characters that become one, and what they become.
MARKED, PLAIN = "".join(c for c, p in FOLDED.items() if len(p) == 1), "".join(p for p in FOLDED.values() if len(p) == 1)
#: Characters that become several: ligatures, fractions, digraphs, abbreviations.
SEVERAL = {c: p for c, p in FOLDED.items() if len(p) > 1}
_SEVERAL_CLASS = character_class(SEVERAL)
#: Neither stands in a decomposition.
_PAIR, _ITEM = "\x01", "\x02"
_SEVERAL_MAP = _ITEM.join(c + _PAIR + p for c, p in SEVERAL.items())


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def spelled_out(c: Column) -> Column:
    """A text with each character that stands for several in their place."""
    t = text_or_empty(c)
    table = F.str_to_map(F.lit(_SEVERAL_MAP), F.lit(_ITEM), F.lit(_PAIR))
    # a character of ASCII is none of them, and is told by one comparison instead of by all ranges of the class
    odd = F.array_distinct(F.regexp_extract_all(t, F.lit(r"(?![\x00-\x7F])" + _SEVERAL_CLASS), F.lit(0)))
    return F.reduce(odd, t, lambda out, x: F.replace(out, x, table[x]))


def fold(c: Column) -> Column:
    """Lower-cased ASCII of the compatibility decomposition; what has none is dropped.

    The tables are long and stand in every plan that folds, so each stands there once.
    """
    t = text_or_empty(c)
    whole = F.regexp_replace(F.translate(spelled_out(c), MARKED, PLAIN), r"[^\x00-\x7F]", "")
    # as many bytes as characters: ASCII, and nothing to look for
    return F.lower(F.when(F.octet_length(t) == F.char_length(t), t).otherwise(whole))


def fold_keeping(c: Column) -> Column:
    """Lower-cased without combining marks; characters that are not ASCII stay."""
    t = text_or_empty(c)
    whole = F.regexp_replace(F.translate(F.lower(t), "".join(_UNMARKED), "".join(_UNMARKED.values())), r"(?![\x00-\x7F])" + _MARKS, "")
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(whole)  # ASCII has no marks


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def lookup(c: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """A small fixed table as a map literal; unknown keys give default."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    found = F.try_element_at(pairs, c)
    return found if default is None else F.coalesce(found, default)


def item_key(item: Mapping[str, Column]) -> Column:
    """A stable key of nine facts that never change; prices and status are left out on purpose.

    item holds the columns case_ref, auction_id, description, estimated_value,
    auction_round, decision_date, publish_start, scope and property_type.
    """
    facts = [
        item["case_ref"],
        item["auction_id"],
        F.substring(item["description"], 1, 400),
        item["estimated_value"].cast("decimal(16,2)").cast("string"),
        item["auction_round"],
        F.date_format(item["decision_date"], "yyyy-MM-dd"),
        F.date_format(item["publish_start"], "yyyy-MM-dd"),
        item["scope"],
        item["property_type"],
    ]
    digest = F.sha1(F.concat_ws("|", *(text_or_empty(x.cast("string")) for x in facts)).cast("binary"))
    auction = text_or_empty(item["auction_id"])
    return F.when(auction != "", F.concat(F.lit("nad-"), auction, F.lit("-"), F.substring(digest, 1, 8))).otherwise(
        F.concat(F.lit("spis-"), F.substring(digest, 1, 16))
    )


# Fixed value: what does not tell descriptions apart.
NOISE = r"[\s.,;:()\[\]\-/]+"


def property_fingerprint(case_ref: Column, description: Column) -> Column:
    """Same case and same description but for spacing and punctuation: the same property."""
    words = F.trim(F.regexp_replace(fold(description), NOISE, " "))
    return F.substring(F.sha1(F.concat(text_or_empty(case_ref), F.lit("|"), words).cast("binary")), 1, 16)


def build_slug(label: Column, place: Column, key: Column) -> Column:
    """Label and place, then the key; a neutral word where both are missing."""
    head = slugify(F.concat_ws("-", F.nullif(label, F.lit("")), F.nullif(place, F.lit(""))))
    return F.concat(F.when(head == "", F.lit("nekretnina")).otherwise(head), F.lit("-"), slugify(key))


def first_filled(*columns: Column, default: str = "") -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(default))


def hr_plural(n: Column, one: str, few: str, many: str) -> Column:
    """The Croatian noun form for a count."""
    tens, unit = F.abs(n) % 100, F.abs(n) % 10
    teen = tens.between(11, 14)
    return F.when((unit == 1) & ~teen, one).when(unit.between(2, 4) & ~teen, few).otherwise(many)


def swap_separators(c: Column) -> Column:
    """1,234.50 to 1.234,50."""
    return F.translate(c, ",.", ".,")


# The space that holds a number and its unit together, and what stands for a missing value.
NBSP = "\u00a0"
MISSING = "—"


def _number(c: Column, places: int) -> Column:
    """1,234.50 with so many places, half up."""
    return F.format_number(F.round(c.cast("decimal(18,6)"), places), places)


def _shown(c: Column, shown: Column) -> Column:
    return F.when(c.isNull(), MISSING).otherwise(shown)


def format_eur(c: Column) -> Column:
    """1 234,50 €, and cents only where there are any."""
    return _shown(c, F.concat(F.regexp_replace(F.translate(_number(c, 2), ",.", NBSP + ","), ",00$", ""), F.lit(NBSP + "€")))


def format_pct(c: Column) -> Column:
    """12,5 %, without signs for thousands."""
    return _shown(c, F.concat(F.translate(_number(c, 1), ".,", ","), F.lit(NBSP + "%")))


def format_pct_plain(c: Column) -> Column:
    """13 %"""
    return _shown(c, F.concat(F.translate(_number(c, 0), ",", ""), F.lit(" %")))


def format_area(c: Column) -> Column:
    """1 234 m²"""
    return _shown(c, F.concat(F.translate(_number(c, 0), ",", NBSP), F.lit(NBSP + "m²")))


def format_ppm(c: Column) -> Column:
    """1 234 €/m², with plain spaces."""
    return _shown(c, F.concat(F.translate(_number(c, 0), ",", " "), F.lit(" €/m²")))


def format_days(n: Column) -> Column:
    """The number of days that are left."""
    return F.concat_ws(" ", F.lit("još"), n.cast("string"), hr_plural(n, "dan", "dana", "dana"))


def format_items(n: Column) -> Column:
    return F.concat_ws(" ", n.cast("string"), hr_plural(n, "nekretnina", "nekretnine", "nekretnina"))


def format_subjects(n: Column) -> Column:
    return F.concat_ws(" ", n.cast("string"), hr_plural(n, "predmet", "predmeta", "predmeta"))


def format_date(c: Column) -> Column:
    return _shown(c, F.date_format(c, "dd.MM.yyyy."))


def format_datetime(c: Column) -> Column:
    return _shown(c, F.date_format(c, "dd.MM.yyyy. 'u' HH:mm"))


def xml_escape(c: Column) -> Column:
    out = text_or_empty(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def sorted_words(c: Column) -> Column:
    """Words of a folded name in order, so reversed names meet."""
    return F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " ")), " ")), " ")


def trim_at_stop_word(c: Column, stop_words: list[str]) -> Column:
    """A name up to the first word that is a stop word but for case and marks (no whole folding: it is looked at word by word)."""
    words = F.split(F.trim(text_or_empty(c)), r"\s+")
    bare = F.transform(words, lambda w: F.array_contains(F.array(*map(F.lit, stop_words)), F.lower(F.translate(F.regexp_replace(w, r"^[,.;]+|[,.;]+$", ""), MARKED, PLAIN))))
    first = F.array_position(bare, True)
    kept = F.when(first > 0, F.slice(words, F.lit(1), (first - 1).cast("int"))).otherwise(words)
    return F.regexp_replace(F.array_join(kept, " "), r"^[ ,.;-]+|[ ,.;-]+$", "")


def grounded(name: Column, text: Column) -> Column:
    """Whether a name stands in a text as whole words; hyphen and space are one."""
    plain = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " ")), F.lit(" "))
    return (F.trim(plain(name)) != "") & F.contains(plain(text), plain(name))
