"""Personal data: detectors, redaction in a fixed order, names by a gazetteer."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import MARKED, PLAIN, character_class, text_or_empty

# The registry's identifiers and contact notations. Two are widened: a bare
# identifier may end a clause, and an address may have several dots.
REGISTRY = {
    "iban": r"(?i)\bHR\s?\d{2}(?:[\s\-]?\d{4}){4}[\s\-]?\d{1,3}\b",
    "email": r"\b[\w.+\-]+@[\w\-]+(?:\.[\w\-]+)*\.[A-Za-z]{2,}\b",
    "phone_labelled": r"(?i)\b(?:tel|telefon|mob|mobitel|kontakt|gsm)[\s.:]*\+?[\d][\d\s\-/.()]{5,}\d",
    "phone_intl": r"\+385[\s\-/.]?\d[\d\s\-/.]{6,12}\d",
    "phone_mobile": r"(?<!\d)09\d[\s\-/.]?\d{3}[\s\-/.]?\d{3,4}(?!\d)",
    "oib_labelled": r"(?i)\bOIB[\s:.\-]*\d{11}\b",
    "oib_bare": r"(?<![\d/])(?<!\d[.,])\d{11}(?!\d)(?![.,/]\d)",
}
# What stands in a text for what was removed, by kind.
MASKS = {
    "oib": "[OIB uklonjen]", "iban": "[IBAN uklonjen]", "email": "[e-mail uklonjen]", "phone": "[telefon uklonjen]", "name": "[ime uklonjeno]",
}
#: Detectors without look-around, for corpora of other locales; other engines read them as well.
GENERAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"\+\d{1,3}[ (.-]{0,2}\d{3}[ ).-]{0,2}\d{3}[ .-]?\d{4}",
    "ip": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
    "digits16": r"\b\d{16}\b",
}
#: White space of any script.
SPACE = character_class(c for c in map(chr, range(0x3001)) if c.isspace())
# Beginnings of the words that name a party; each may go on with letters.
ROLES = ["ovršenik", "ovršenic", "stečajn dužnik", "stečajn upravitelj", "dužnik", "protivnik osiguranj", "prodavatelj", "upravitelj", "ovršitelj", "vjerovnik"]
ROLES += ["predlagatelj", "bilježnik", "povjerenik", "likvidator", "vlasnik", "suvlasnik"]
TRADES = ["vl. obrt", "vlasnik", "obrtnik"]
HONORIFICS = ["je", "gosp.", "gosp", "gđa.", "gđa", "g."]


def _words(beginnings: Sequence[str]) -> str:
    """Any of the beginnings, in any case, with the letters that may follow each of its words."""
    each = (r"\s*".join(re.escape(part) + ("" if part.endswith(".") else r"\p{L}*\s?") for part in b.split()).removesuffix(r"\s?") for b in beginnings)
    return "(?iu:" + "|".join(each) + ")"


def person_steps(mask: str) -> list[tuple[str, str, str]]:
    """(kind, pattern, replacement) in order: a name after a party's role, a name before a trade, a home after a masked name.

    A name is two or three words that begin with capitals; between a role and its name may
    stand punctuation and an honorific. A home is one or two such words after "iz", and
    then, after a comma, whatever ends in a house number.
    """
    capital = r"\p{Lu}[\p{L}-]+"
    name = rf"{capital}(?:\s+{capital}){{1,2}}"
    title = "(?iu:" + "|".join(re.escape(h) for h in HONORIFICS) + r")\s+"
    home = rf"{re.escape(mask)},?\s+iz\s+{capital}(?:\s+{capital})?(?:,[^,;\n\d]*\d+\p{{L}}?)?"
    return [
        ("person_name", rf"({_words(ROLES)}[\s:,-]+(?:{title})?){name}", "$1" + mask),
        ("person_name", rf"{name}(\s*,\s*{_words(TRADES)})", mask + "$1"),
        ("person_address", home, mask),
    ]


# Given names; words that open the name of a street; company suffixes; endings of declined given names.
GIVEN_NAMES = """
    ante anto boris božidar branko damir danijel dario darko davor denis dinko domagoj dragan dražen duje emil filip franjo goran hrvoje
    igor ilija ivan ivica jakov josip jozo jure karlo krešimir ladislav lovro luka marin marijan mario marko martin mate matej mihael milan
    mirko miroslav mladen nenad neven nikola ozren pavao petar predrag rade ranko robert roko sanjin saša silvio siniša slaven slavko srećko
    stanko stipe stjepan tihomir tomislav toni vedran velimir vinko vjekoslav vladimir vlado zdravko zlatko zoran zvonimir željko berislav
    borna bruno dalibor dean dejan drago edo fabijan gordan ivo krunoslav leon matko miljenko nikša patrik ratko sven tin viktor zdenko
    ana andreja anita antonija barbara biljana blanka bojana branka dubravka đurđica gordana helena ines irena iva ivana ivanka jadranka
    jasna jelena karmen katarina klara kristina lana lidija ljiljana maja mara marija marina marta martina melanija melita mia mirjana nada
    nadija nataša nevenka nikolina nina olga petra ranka renata ruža sanja sandra silvana slavica snježana sonja suzana tanja tatjana tea
    tihana valentina vanja vesna vlatka zdenka zrinka željka dijana danica verica zorica milka
""".split()
STREET_WORDS = r"ulic\w*|ul\.|trg\w*|put|puta|avenij\w*|obala|obali|šetališt\w*|cest\w*|odvojak|naselj\w*|kbr\.?|k\.?br\.?"
COMPANIES = r"d\.o\.o|j\.d\.o\.o|d\.d|obrt|k\.d"
ENDINGS = ["om", "em", "ova", "eva", "inu", "in", "a", "u", "e", "i", "o"]
#: Letters of a name's word: what stands for a letter whatever its case and marks.
_LETTERS = {"c": "cčćCČĆ", "d": "dđDĐ", "s": "sšSŠ", "z": "zžZŽ"}


def _trie(words: Iterable[str]) -> str:
    """A pattern of exactly these words, each letter looked at once: words are merged by their common beginnings."""
    ends, below = False, {}
    for w in words:
        if w:
            below.setdefault(w[0], []).append(w[1:])
        else:
            ends = True
    parts = [(f"[{_LETTERS.get(c, c + c.upper())}]" + _trie(rest)) for c, rest in sorted(below.items())]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)})" + "?+" * ends if ends or len(parts) > 1 else parts[0]


def declined(names: Iterable[str]) -> list[str]:
    """Names without diacritics in all their forms: as they are, with an ending, or with one in place of their last vowel."""
    plain = {n.translate(str.maketrans(MARKED, PLAIN)).lower() for n in names}
    stems = {n[:-1] for n in plain if n[-1] in "aeo"}
    return sorted(plain | {n + e for n in plain for e in ENDINGS} | {n + e for n in stems for e in ENDINGS})


def gazetteer(given_names: Iterable[str]) -> str:
    """A pattern of persons' names by a list of given names: two or three capitalised words of which the first is a given name, declined or not.

    A trie of all forms tells given names; every word is tried as the first of a name,
    from left to right. Names of streets (a street word up to two words before), house
    numbers and companies (right after) are no persons. A word is a capital with small
    letters, or capitals alone, or several of those with hyphens.
    """
    part = r"(?:[A-ZČĆĐŠŽ][a-zčćđšž]++|[A-ZČĆĐŠŽ]{2,}+)"
    word = rf"{part}(?:-{part})*+-?+"
    begin = r"(?<![\p{L}\p{N}_])"
    # looking behind needs bounded lengths and no repeated groups
    short = r"[A-ZČĆĐŠŽ][A-ZČĆĐŠŽa-zčćđšž\-]{1,40}\s{1,3}"
    sign = rf"{begin}(?iu:{STREET_WORDS.replace('w*', 'p{L}{0,8}')})\s{{1,3}}"
    street = "".join(f"(?<!{sign}{short * k})" for k in range(3))
    given = rf"(?=\p{{Lu}}[\p{{L}}-]++\s)(?={_trie(declined(given_names))}(?![\p{{L}}\p{{N}}_]))"
    number, company = r"(?!\s*\d+\s*[a-zA-Z]?(?![\p{L}\p{N}_]))", rf"(?!\s*,?\s*(?i:{COMPANIES}))"
    # what begins no name is told by one character
    return rf"(?=[A-ZČĆĐŠŽ]){begin}{given}{street}(?>{word}(?:\s+{word}){{1,2}}+){number}{company}"


def scan(text: Column, detectors: Mapping[str, str] = REGISTRY) -> Column:
    """array<struct<kind, hit>> of all hits, detector by detector."""

    def hits(kind: str, pattern: str) -> Column:
        found = F.regexp_extract_all(text_or_empty(text), F.lit(pattern), F.lit(0))
        return F.transform(found, lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("hit")))

    return F.concat(*(hits(k, p) for k, p in detectors.items()))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value computed once, however often then names it: a lambda's variable, where a column would be put in place each time."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def redact(text: Column, detectors: Mapping[str, str] = REGISTRY, mask: str | None = None, roles: bool = True, given_names: Sequence[str] = tuple(GIVEN_NAMES)) -> Column:
    """struct<text, removed map<kind, count>>; each count is taken on the text of its own step.

    Steps: names by their roles, then the detectors in order, then names by the gazetteer of
    given names. mask stands for all kinds; without it each has its own.
    """
    of = lambda kind: mask or MASKS[kind.split("_")[0]]
    steps = person_steps(of("name")) if roles else []
    steps += [(k, p, of(k)) for k, p in detectors.items()]
    if given_names:
        steps.append(("person_name_gazetteer", gazetteer(given_names), of("name")))

    def after(now: Column, left: list, counts: dict[str, Column]) -> Column:
        if not left:
            tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace(now, f"{SPACE}{{2,}}", " "), f"^{SPACE}+|{SPACE}+$", ""), f"[,;]{SPACE}*([,;])", "$1")
            removed = F.create_map(*(x for kind, n in counts.items() for x in (F.lit(kind), n)))
            return F.struct(tidy.alias("text"), F.map_filter(removed, lambda _, n: n > 0).alias("removed"))
        kind, pattern, into = left[0]

        def counted(done: Column) -> Column:
            # unchanged: no hit, unless hits were masks already
            none = (done == now) & ~F.contains(now, F.lit(into.replace("$1", "")))
            n = F.when(none, 0).otherwise(F.regexp_count(now, F.lit(pattern)))
            return after(done, left[1:], counts | {kind: counts[kind] + n if kind in counts else n})

        return _once(F.regexp_replace(now, pattern, into), counted)

    return _once(text_or_empty(text), lambda now: after(now, steps, {}))


def residual_names(text: Column, given_names: Sequence[str] = tuple(GIVEN_NAMES)) -> Column:
    """The persons' names that the gazetteer finds in a text."""
    return F.regexp_extract_all(text_or_empty(text), F.lit(gazetteer(given_names)), F.lit(0))


# Beginnings of the days' names.
DAYS = ["ponedjelj", "utor", "srijed", "četvrt", "petak", "petk", "subot", "nedjelj"]


def viewing_window(text: Column) -> Column:
    """The day and hours of a viewing note, or the phrase for by appointment; redacted, and blank if a detector still hits.

    From the first day's name to the end of the line or of a hundred characters; of the hours
    there, the first two bound the slot. Without an hour there is no slot.
    """
    raw = text_or_empty(text)
    from_day = F.regexp_extract(raw, rf"(?iu)\b(?:{'|'.join(DAYS)})\p{{L}}*[^;\n]{{0,100}}", 0)
    hours = F.slice(F.regexp_extract_all(from_day, F.lit(r"(?iu)(\d{1,2}(?:[.,:]\d{2}|\s*(?:h\b|sati)))"), F.lit(1)), 1, 2)
    first, last = F.get(hours, 0), F.get(hours, 1)
    begin = F.position(first, from_day, F.lit(1))
    after = begin + F.char_length(first)
    end = F.coalesce(F.position(last, from_day, after) + F.char_length(last), after)
    slot = F.when(first.isNotNull(), F.substring(from_day, F.lit(1), end - 1))
    found = F.coalesce(slot, F.when(raw.rlike(r"(?iu)\bpo\s+dogovoru\b"), "Po dogovoru"), F.lit(""))
    clean = F.trim(redact(found)["text"])
    return F.when(F.size(scan(clean)) == 0, clean).otherwise("")
