"""Text, amount and URL column functions; all stay in the JVM."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key words, compared with folded text.
UP_TO = ("jusqu'a", "jusqu a", "jusqu’a", "up to", "max ")
SIGN_UP = ("a l'inscription", "a l inscription", "a l’inscription", "offert a l'inscription", "bonus de bienvenue", "prime de bienvenue", "pour votre inscription", "en vous inscrivant", "de bienvenue")
GIFT_CARD = ("bon d'achat", "bon d achat", "bons d'achat", "carte cadeau", "e-carte", "gift card")
NEW_CUSTOMER = ("nouveau client", "nouveaux clients", "premiere commande", "1re commande")
SALE_EXCLUDED = ("hors soldes", "soldes exclues", "hors promotions", "hors promo")
MARKETPLACE_EXCLUDED = ("hors marketplace", "marketplace exclue", "hors place de marche")
# Tokens that don't tell merchants apart, and second-level domains of no company.
NOISE = ("fr", "france", "com", "www", "shop", "store", "boutique", "officiel", "official", "en", "ligne", "online", "site")
SECOND_LEVEL = ("co", "com", "org", "net", "gouv")
# Fixed value: an amount is 1-4 digits, up to two decimals, then % or euros; a no-break space counts as a blank.
AMOUNT = r"(?<![0-9.,])([0-9]{1,4}(?:[.,][0-9]{1,2})?)(?U:\s*)(%|€|(?iU:euros?\b))"

MONEY = "decimal(10,3)"


@lru_cache
def _accents() -> tuple[str, str, dict[str, str]]:
    """Characters of the Basic Multilingual Plane whose compatibility form, without marks, is one other
    character (and that character), and those of Latin, letterlike and number forms whose form is longer."""
    one, longer = {}, {}
    for c in map(chr, (*range(0xA0, 0xAC00), *range(0xF900, 0xFFF0))):
        form = unicodedata.normalize("NFKD", c)
        plain = re.sub(r"[\u0300-\uFE2F]", lambda m: "" if unicodedata.combining(m[0]) else m[0], form)
        if plain == c or unicodedata.combining(c):
            continue
        if len(plain) == 1:
            one[c] = plain
        elif plain and (c < "\u0250" or "\u1E00" <= c < "\u2190" or "\uFB00" <= c < "\uFB07"):
            longer[c] = plain
    return "".join(one), "".join(one.values()), longer


@lru_cache
def _marks() -> str:
    """All nonspacing marks."""
    return "".join(c for c in map(chr, range(0x300, 0x1F000)) if unicodedata.category(c) == "Mn") + "".join(c for c in map(chr, range(0xE0100, 0xE01F0)) if unicodedata.category(c) == "Mn")


def once(c: Column, use) -> Column:
    """use(c), where c is evaluated once however often it is used."""
    return F.transform(F.array(c), use)[0]


def strip_accents(c: Column) -> Column:
    """Compatibility form without combining marks."""
    one, to, longer = _accents()
    # Marks stand behind the characters that become another one, so they have none to become: they go.
    plain = F.translate(c, one + _marks(), to)
    # Few texts hold a character with a longer form; they are put together character by character.
    forms = F.from_json(F.lit(json.dumps(longer)), "map<string,string>")
    spelt = lambda p: F.array_join(F.transform(F.split(p, ""), lambda x: F.coalesce(F.try_element_at(forms, x), x)), "")
    whole = once(plain, lambda p: F.when(F.length(p) == F.octet_length(p), p).when(F.translate(p, "".join(longer), "") != p, spelt(p)).otherwise(p))
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(whole)


def fold(c: Column) -> Column:
    """Without accents, lower case, single blanks, trimmed."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), r"(?U)\s+", " "))


def hits(folded: Column, *lists: tuple[str, ...]) -> Column:
    """The words of the lists that stand in the text, overlapping ones too."""
    words = F.array(*(F.lit(w) for words in lists for w in words))
    return once(folded, lambda t: F.filter(words, lambda w: F.contains(t, w)))


def any_of(found: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words is among the hits."""
    return F.arrays_overlap(found, F.array(*map(F.lit, words)))


def has_any(folded: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words (no signs that mean something in a pattern) stands in the text."""
    return folded.rlike("|".join(words))


def true_or_null(condition: Column) -> Column:
    """Tri-state flag: true where told, else not known."""
    return F.when(condition, F.lit(True))


def to_decimal(c: Column) -> Column:
    """A French or English number; null where it isn't one."""
    return F.trim(F.replace(c, F.lit(","), F.lit("."))).try_cast(MONEY)


def classify(c: Column) -> Column:
    """What an offer rewards; sign-up words beat gift-card words."""
    folded = fold(c)
    return F.when(has_any(folded, SIGN_UP), "signup_bonus").when(has_any(folded, GIFT_CARD), "giftcard").otherwise("purchase")


def unit_of(token: Column) -> Column:
    return F.when(token == "%", "percent").otherwise("fixed_eur")


# What may stand in an amount besides its number, blanks of all scripts among it.
NO_NUMBER = "%€eurosEUROS\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def extract_amounts(c: Column) -> Column:
    """All amounts in order: array of struct(value, unit)."""
    found = F.regexp_extract_all(c, F.lit(AMOUNT), F.lit(0))
    return F.transform(found, lambda x: F.struct(to_decimal(F.translate(x, NO_NUMBER, "")).alias("value"), unit_of(F.right(x, F.lit(1))).alias("unit")))


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def normalize_name(c: Column) -> Column:
    """Slug tokens without noise words, joined by blanks; repeated tokens stay."""
    return F.array_join(F.filter(F.split(slugify(c), "-"), lambda t: (t != "") & ~t.isin(*NOISE)), " ")


def compact(c: Column) -> Column:
    return F.replace(normalize_name(c), F.lit(" "), F.lit(""))


def domain_root(c: Column) -> Column:
    """Host without scheme, path and one www."""
    host = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^http://", ""), "^https://", "")
    return F.regexp_replace(F.split(host, "/")[0], r"^www\.", "")


def domain_key(c: Column) -> Column:
    """Registrable domain; null for fewer than two labels."""
    labels = F.filter(F.split(F.split(domain_root(c), ":")[0], r"\."), lambda x: x != "")
    n = F.size(labels)
    three = (n >= 3) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL) & (F.length(F.try_element_at(labels, F.lit(-1))) == 2)
    keep = F.when(three, 3).otherwise(2)
    return F.when(n >= 2, F.array_join(F.slice(labels, -keep, keep), "."))


def title_from_slug(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))
