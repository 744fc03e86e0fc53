"""Note cleaners and word helpers as native column expressions.

Every cleaner is a chain of built-in string functions, so it stays inside
whole-stage codegen.  Accent stripping (Unicode NFD/NFKD followed by
removal of combining marks) has no SQL function; the fast path uses a
``translate`` table derived once from :mod:`unicodedata` by rule (every
code point whose decomposition, stripped of marks, is a single ASCII letter
or digit).
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes kept by the cleaners.
KEEP_BASIC = "a-záéíóúüñ"          # lower-case letters, accents and ñ kept
KEEP_STRICT = "a-zñ0-9"            # after accent stripping
KEEP_NOTEBOOK = "a-zñáéíóúü0-9"    # notebook variant (accents already gone)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=None)
def accent_table(form: str = "NFD") -> tuple[str, str]:
    """``(from, to)`` strings for ``translate``: each code point of the BMP
    whose ``form`` decomposition minus combining marks is one ASCII
    letter/digit maps to that character.  Built by rule, not listed."""
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        dec = unicodedata.normalize(form, ch)
        if dec == ch:
            continue
        if form == "NFD":
            base = "".join(c for c in dec if unicodedata.category(c) != "Mn")
        else:
            base = "".join(c for c in dec if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base.isalnum():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def lower_text(c) -> Column:
    """Case fold; NULL becomes the empty string like the cleaners."""
    return F.lower(F.coalesce(_col(c), F.lit("")))


def strip_accents(c, form: str = "NFD") -> Column:
    """Decompose and drop combining marks (maps ñ to n)."""
    src, dst = accent_table(form)
    mark = r"\p{Mn}" if form == "NFD" else r"[\p{Mn}\p{Me}]"
    s = _col(c)                                    # a text of ASCII only has nothing to strip
    return F.when(F.octet_length(s) == F.length(s), s).otherwise(F.regexp_replace(F.translate(s, src, dst), mark, ""))


def keep_chars(c, keep: str) -> Column:
    """Every character outside ``[keep]`` and whitespace becomes a space."""
    return F.regexp_replace(_col(c), f"[^{keep}\\s]", " ")


def drop_digits(c) -> Column:
    """Digit runs become a space."""
    return F.regexp_replace(_col(c), r"[0-9]+", " ")


def collapse_spaces(c) -> Column:
    """Whitespace runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def _letters_only(s: Column, keep: str) -> Column:
    """``keep_chars`` + (``drop_digits``) + ``collapse_spaces`` in one pass:
    every maximal run of characters outside ``[keep]`` -- whitespace
    included -- becomes one space, then the ends are trimmed.  Same output
    as the step-by-step chain, one regex scan instead of two or three."""
    return F.trim(F.regexp_replace(s, f"[^{keep}]+", " "))


def clean_basic(c) -> Column:
    """Lower, keep letters/accents/ñ, collapse.  The cleaner the app uses."""
    return _letters_only(lower_text(c), KEEP_BASIC)


def clean_strict(c) -> Column:
    """Lower, strip accents (NFD), keep [a-zñ0-9], drop digits, collapse."""
    # digits are kept by the class and then dropped: letters only remain.
    # After accent stripping no ñ can be left (it decomposes to n + mark),
    # so the kept class is exactly [a-z] -- and Java's regex engine is far
    # faster with the plain ASCII class.
    return _letters_only(strip_accents(lower_text(c), "NFD"), "a-z")


def clean_nb_nfd(c) -> Column:
    """Notebook cleaner, NFD accent strip, digits kept."""
    # ñ and the accented vowels of KEEP_NOTEBOOK cannot survive the accent
    # stripping: the class is exactly [a-z0-9] on the stripped text
    return _letters_only(strip_accents(lower_text(c), "NFD"), "a-z0-9")


MARK = "\ue000"         # a private character: stands for any that NFKD expands


def clean_nb_nfkd(c) -> Column:
    """Notebook cleaner with NFKD.  Characters that NFKD expands to
    several letters (ligatures, fractions) have no place in a ``translate``
    table, so the same pass that strips accents turns them into a mark; only
    a text that then holds one replaces the few such characters it has by
    their letters, looked up in a constant map."""
    s = lower_text(c)
    src, dst = accent_table("NFKD")
    rare = expansions()
    bare = F.translate(s, src + "".join(rare), dst + MARK * len(rare))
    letters, full = (F.split(F.lit("\x01".join(x)), "\x01") for x in (rare.keys(), rare.values()))
    found = F.array_distinct(F.regexp_extract_all(s, F.lit(f"([{expanding_class()}])")))
    wide = F.aggregate(found, s, lambda text, ch: F.replace(text, ch, F.element_at(F.map_from_arrays(letters, full), ch)))
    native = _letters_only(F.regexp_replace(bare, r"[\p{Mn}\p{Me}]", ""), "a-z0-9")          # ñ is stripped to n
    return F.when(F.contains(bare, F.lit(MARK)), _letters_only(strip_accents(wide, "NFKD"), "a-z0-9")).otherwise(native)


@lru_cache(maxsize=None)
def expansions() -> dict[str, str]:
    """The code points that NFKD turns into text with an ASCII letter or
    digit and that ``accent_table`` does not hold (several characters, or one
    from outside the BMP), with that text less its marks.  Built by rule."""
    held = set(accent_table("NFKD")[0])
    out = {}
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or ch in held:
            continue
        dec = unicodedata.normalize("NFKD", ch)
        if dec != ch and any(x.isascii() and x.isalnum() for x in dec):
            out[ch] = "".join(x for x in dec if not unicodedata.combining(x))
    return out


@lru_cache(maxsize=None)
def expanding_class() -> str:
    """Regex class (ranges) of the code points of :func:`expansions`."""
    cps, out, lo = [ord(c) for c in expansions()], [], None
    for a, b in zip(cps, cps[1:] + [None]):
        lo = a if lo is None else lo
        if b != a + 1:
            out.append(f"\\x{{{lo:x}}}-\\x{{{a:x}}}")
            lo = None
    return "".join(out)
