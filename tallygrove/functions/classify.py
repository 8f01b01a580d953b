"""Ordered classifications, generated from tables of needles."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold, text_or_empty

# Property types with their needles, narrow ones first, on folded text.
PROPERTY_NEEDLES: list[tuple[str, list[str]]] = [
    ("stan", ["stan ", "stana ", "stanu ", "stan,", "stan.", "apartman", "garsonijer", "stambena jedinica", "etazno vlasnistvo stana", "dvosoban", "trosoban", "jednosoban", "cetverosoban"]),
    ("kuca", ["kuca", "obiteljska kuca", "stambena zgrada", "stambena kuca", "vikendica", "kuce", "kucom", "stambeni objekt", "stambena gradevina"]),
    ("poslovni-prostor", ["poslovni prostor", "poslovnog prostora", "poslovnom prostoru", "ured", "restoran", "hotel", "skladiste", "trgovina", "ugostitelj", "poslovna zgrada", "poslovni objekt", "proizvodna hala", "hala", "radionica", "pogon", "kamp", "benzinska", "silos", "staja", "klaonica", "mlin"]),
    ("gradevinsko-zemljiste", ["gradevinsko zemlj", "gradiliste", "gradjevinsko zemlj", "zemljiste za gradnju", "gradevno zemlj"]),
    ("poljoprivredno-zemljiste", ["poljoprivredno zemlj", "oranica", "livada", "vinograd", "vocnjak", "pasnjak", "njiva", "maslinik", "vrt", "sljivik", "bara", "trstik", "ribnjak", "poljoprivredno"]),
    ("sumsko-zemljiste", ["sumsko zemlj", "suma", "sume", "sumom", "sumski"]),
    ("garaza", ["garaza", "garazno mjesto", "parkirno mjesto", "parkiralisno", "garazni prostor", "parkirno-garazno"]),
    ("zemljiste", ["zemljiste", "dvoriste", "cestica", "k.c.", "kc.br", "ckbr", "zemljista", "neplodno"]),
]
PROCEDURES = [("OVR", "ovrha"), ("ST", "stecaj"), ("OSIG", "osiguranje"), ("OS-", "osiguranje"), ("INS", "insolvencija")]
ROUNDS = {"prva": 1, "druga": 2, "treća": 3, "četvrta": 4}


# Fixed values, on folded text: what makes an estate of goods listed as property, and beginnings of words for goods.
ESTATE_CUES = [r"\bzk\.?\s*ul", r"\bk\.?\s*[oc]\b", "zemljist", "nekretnin"]
GOODS = "vozil automobil stroj oprem plovil brodic prikolic vilicar goved krav junic telad svinj roba zalih komada proizvodnj marke udjel dionic potrazivanj".split()


def by_needles(text: Column, table: Sequence[tuple[str, Sequence[str]]], default: str, short: int = 5) -> Column:
    """The first class of which a needle stands in the text.

    A needle that is letters alone but for blanks around them, up to `short` of them, must
    begin a word and be followed by three word characters at most; others match anywhere.
    """
    out = None
    for name, needles in table:
        parts = []
        for n in needles:
            bare = n.strip()
            parts.append(rf"\b{re.escape(bare)}\w{{0,3}}\b" if bare.isalpha() and len(bare) <= short else re.escape(n).replace(r"\ ", " "))
        hit = text.rlike("|".join(parts))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(default)


def property_type(description: Column, kind: Column) -> Column:
    """Movables and rights by their kind; goods listed as property, if nothing names an estate, as movables; else by the description."""
    return folded_property_type(fold(description), fold(kind))


def folded_property_type(text: Column, k: Column) -> Column:
    """property_type of a folded description and kind, which are best columns of a projection of their own, as they are looked at ten times."""
    goods = (k == "imovina") & ~text.rlike("|".join(ESTATE_CUES)) & text.rlike(rf"\b(?:{'|'.join(GOODS)})")
    return (
        F.when((k == "pokretnina") | goods, "pokretnina")
        .when(k == "pravo", "pravo")
        .otherwise(by_needles(text, PROPERTY_NEEDLES, "ostalo"))
    )


def procedure_type(case_ref: Column) -> Column:
    upper = F.upper(text_or_empty(case_ref))
    out = None
    for prefix, name in PROCEDURES:
        out = F.when(upper.startswith(prefix), name) if out is None else out.when(upper.startswith(prefix), name)
    return out.otherwise("ostalo")


def issuer_type(issuer: Column, folded: Column | None = None) -> Column:
    """The kind of an issuing body; folded is its folded name, if that is a column already."""
    text, low = F.trim(text_or_empty(issuer)), fold(issuer) if folded is None else folded
    return (
        F.when(text == "", "nepoznato")
        .when(text.rlike(r"(?iu)^javn\p{L}*\s+bilježnik"), "javni_biljeznik")
        .when(low.contains("trgovacki sud"), "trgovacki_sud")
        .when(low.contains("opcinski") & low.contains("sud"), "opcinski_sud")
        .when(low.contains("sud"), "sud")
        .when(low.contains("fina"), "fina")
        .otherwise("ostalo")
    )


def issuer_name(issuer: Column) -> Column:
    """The institution; a notary's own name never."""
    name = F.trim(text_or_empty(issuer))
    return F.when(name == "", "Nepoznato tijelo").when(name.rlike(r"(?iu)^javn\p{L}*\s+bilježnik"), "Javni bilježnik").otherwise(name)


def round_number(name: Column) -> Column:
    out = F.lit(None).cast("int")
    for text, n in ROUNDS.items():
        out = F.when(F.lower(F.trim(name)).isin(text, f"{text} dražba"), n).otherwise(out)
    return out
