"""Identity normalisers, key hashing and name similarity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Placeholder identities that must never link two users.
EMAIL_PLACEHOLDERS = ("test@%", "noreply@%", "no-reply@%", "%@example.com", "%@test.com")
PHONE_PLACEHOLDERS = (
    "0000000000", "1111111111", "2222222222", "3333333333", "4444444444", "5555555555",
    "6666666666", "7777777777", "8888888888", "9999999999", "1234567890", "0123456789",
)
ZIP_PLACEHOLDERS = ("00000", "00003")
STREET_PLACEHOLDERS = ("MAIL RETURN", "PLEASE UPDATE")


def email_norm(email: Column) -> Column:
    """Lower-cased, trimmed address; null when blank or a placeholder."""
    clean = F.lower(F.trim(email))
    dummy = F.lit(False)
    for pattern in EMAIL_PLACEHOLDERS:
        dummy = dummy | clean.like(pattern)
    return F.when((clean != "") & ~dummy, clean)


def phone_norm(phone: Column) -> Column:
    """Last ten digits; null when shorter or a placeholder."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    last = F.right(digits, F.lit(10))
    return F.when((F.length(digits) >= 10) & ~last.isin(*PHONE_PLACEHOLDERS), last)


def address_key(street: Column, zip_code: Column) -> Column:
    """``STREET|zip``; null when either part is blank or a placeholder."""
    street_clean, zip_clean = F.upper(F.trim(street)), F.trim(zip_code)
    usable = (
        (street_clean != "") & (zip_clean != "")
        & ~zip_clean.isin(*ZIP_PLACEHOLDERS) & ~street_clean.isin(*STREET_PLACEHOLDERS)
    )
    return F.when(usable, F.concat(street_clean, F.lit("|"), zip_clean))


def node_key(normalised: Column) -> Column:
    """SHA-256 of a normalised value; null stays null."""
    return F.sha2(normalised, 256)


TAKEN = "\x00"  # stands for a letter that has been matched; names hold none


def _common(a: Column, b: Column) -> Column:
    """(a, b, rest, hits): a's letters found in b near their place, in order, and b with those letters taken."""
    reach = F.greatest(F.floor(F.greatest(F.length(a), F.length(b)) / 2) - 1, F.lit(0)).cast("int")
    state = lambda a, b, reach, rest, hits: F.struct(
        a.alias("a"), b.alias("b"), reach.alias("reach"), rest.alias("rest"), hits.alias("hits"))

    def step(s: Column, i: Column) -> Column:
        first = F.greatest(i - s["reach"], F.lit(1))
        letter = F.substring(s["a"], i, F.lit(1))
        at = F.position(letter, F.substring(s["rest"], first, i + s["reach"] - first + 1))
        return F.when(at == 0, s).otherwise(state(
            s["a"], s["b"], s["reach"], F.overlay(s["rest"], F.lit(TAKEN), first + at - 1, F.lit(1)), F.concat(s["hits"], letter)))
    return F.aggregate(F.sequence(F.lit(1), F.length(a)), state(a, b, reach, b, F.lit("")), step)


def _jaro_winkler(s: Column) -> Column:
    """The similarity, 0..1, from the letters that two names have in common."""
    letter = lambda text, i: F.substring(text, i, F.lit(1))
    m = F.length(s["hits"])
    places = F.filter(F.sequence(F.lit(1), F.length(s["b"])), lambda j: letter(s["rest"], j) == TAKEN)
    swapped = F.size(F.filter(F.arrays_zip(F.sequence(F.lit(1), m).alias("i"), places.alias("j")),
                              lambda z: letter(s["hits"], z["i"]) != letter(s["b"], z["j"])))
    jaro = (m / F.length(s["a"]) + m / F.length(s["b"]) + (m - F.floor(swapped / 2)) / m) / 3
    same = [F.substring(s["a"], 1, k) == F.substring(s["b"], 1, k) for k in (1, 2, 3, 4)]
    long_enough = [(F.length(s["a"]) >= k) & (F.length(s["b"]) >= k) for k in (1, 2, 3, 4)]
    prefix = sum((F.when(x & y, 1).otherwise(0) for x, y in zip(same, long_enough)), F.lit(0))
    return F.when(m == 0, 0.0).when(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro)).otherwise(jaro)


def name_similarity(left: Column, right: Column) -> Column:
    """Jaro-Winkler similarity of two names, 0..100, case and edge blanks ignored; no Python worker is involved."""
    a, b = F.upper(F.trim(left)), F.upper(F.trim(right))
    # The array binds what the formula reads many times to one value.
    scored = F.element_at(F.transform(F.array(_common(a, b)), _jaro_winkler), 1)
    return F.when(a == b, 100.0).when((a == "") | (b == ""), 0.0).when(a.isNotNull() & b.isNotNull(), 100.0 * scored)
