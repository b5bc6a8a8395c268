"""English stemming (the published Porter algorithm), a helper for single terms."""

from __future__ import annotations

import re

_C = "[^aeiou](?:[^aeiouy])*"
_V = "[aeiouy](?:[aeiou])*"
_POSITIVE = re.compile(f"^(?:{_C})?{_V}{_C}")
_ONE = re.compile(f"^(?:{_C})?{_V}{_C}(?:{_V})?$")
_MORE = re.compile(f"^(?:{_C})?{_V}{_C}{_V}{_C}")
_VOWEL = re.compile(f"^(?:{_C})?[aeiouy]")
_DOUBLE = re.compile(r"([^aeiouylsz])\1$")
_SHORT = re.compile(f"^{_C}[aeiouy][^aeiouwxy]$")

# Suffix rewrites of steps 2 and 3, suffixes of step 4.
STEP_2 = dict(ational="ate", tional="tion", enci="ence", anci="ance", izer="ize", bli="ble", alli="al",
              entli="ent", eli="e", ousli="ous", ization="ize", ation="ate", ator="ate", alism="al",
              iveness="ive", fulness="ful", ousness="ous", aliti="al", iviti="ive", biliti="ble", logi="log")
STEP_3 = dict(icate="ic", ative="", alize="al", iciti="ic", ical="ic", ful="", ness="")
STEP_4 = ("al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize").split()

_BY_LENGTH = lambda names: sorted(names, key=len, reverse=True)
_ORDER_2, _ORDER_3, _ORDER_4 = _BY_LENGTH(STEP_2), _BY_LENGTH(STEP_3), _BY_LENGTH(STEP_4)


def _rewrite(word: str, order: list[str], table: dict[str, str]) -> str:
    for suffix in order:
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            return head + table[suffix] if _POSITIVE.match(head) else word
    return word


def stem_english(term: str) -> str:
    """The stem of a lower-case English word; anything not a–z is returned as it is."""
    if len(term) < 3 or not term.isascii() or not term.isalpha():
        return term
    word = "Y" + term[1:] if term[0] == "y" else term

    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        if _POSITIVE.match(word[:-3]):
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            head = word[: -len(suffix)]
            if word.endswith(suffix) and _VOWEL.match(head):
                word = head
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif _DOUBLE.search(word):
                    word = word[:-1]
                elif _SHORT.match(word):
                    word += "e"
                break

    if word.endswith("y") and _VOWEL.match(word[:-1]):
        word = word[:-1] + "i"
    word = _rewrite(word, _ORDER_2, STEP_2)
    word = _rewrite(word, _ORDER_3, STEP_3)

    for suffix in _ORDER_4:
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            if _MORE.match(head):
                word = head
            break
    else:
        if word.endswith(("sion", "tion")) and _MORE.match(word[:-3]):
            word = word[:-3]

    if word.endswith("e"):
        head = word[:-1]
        if _MORE.match(head) or (_ONE.match(head) and not _SHORT.match(head)):
            word = head
    if word.endswith("ll") and _MORE.match(word):
        word = word[:-1]
    return "y" + word[1:] if word[:1] == "Y" else word
