"""Stems of English, German, French and Spanish words by the published Snowball rules.

Each language is a few steps; a step takes the longest of its endings that the word has and, if the ending lies in the
region that the step asks for, replaces it. R1 is what follows the first consonant after a vowel, R2 the same
within R1, RV a region of the Romance languages. Words are expected in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache


def _longest(word: str, endings) -> str:
    """The longest of the endings that the word has, or nothing."""
    return max((e for e in endings if word.endswith(e)), key=len, default="")


def _after(word: str, start: int, vowels: str) -> int:
    """Where the region begins that follows the first consonant after a vowel."""
    for i in range(start + 1, len(word)):
        if word[i] not in vowels and word[i - 1] in vowels:
            return i + 1
    return len(word)


class _Word:
    """A word with its regions, which stay where they were found."""

    def __init__(self, text: str, vowels: str, r1: int | None = None):
        self.text, self.vowels = text, vowels
        self.r1 = _after(text, 0, vowels) if r1 is None else r1
        self.r2 = _after(text, self.r1, vowels) if self.r1 < len(text) else len(text)
        self.rv = len(text)

    def ends(self, ending: str, region: int = 0) -> bool:
        return self.text.endswith(ending) and len(self.text) - len(ending) >= region

    def cut(self, n: int | str, put: str = "") -> None:
        n = n if isinstance(n, int) else len(n)
        self.text = self.text[: len(self.text) - n] + put

    def drop(self, endings, region: int) -> bool:
        """Remove the longest of the endings if it lies in the region."""
        found = _longest(self.text, endings.split() if isinstance(endings, str) else endings)
        if found and self.ends(found, region):
            self.cut(found)
            return True
        return False

    def before(self, ending: str) -> str:
        return self.text[: len(self.text) - len(ending)]


# -- English ------------------------------------------------------------------------------------------------------

# Fixed values of the English rules.
_EN_VOWELS = "aeiouy"
_EN_WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
             "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
             "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
_EN_STOP = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_EN_STEP2 = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
             "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
             "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
             "fulli": "ful", "lessli": "less", "li": ""}
_EN_STEP3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
_EN_STEP4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
_EN_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")


def _en_short_syllable(text: str) -> bool:
    """Whether the text ends in a short syllable."""
    v = _EN_VOWELS
    if len(text) == 2:
        return text[0] in v and text[1] not in v
    return len(text) > 2 and text[-1] not in v + "wxY" and text[-2] in v and text[-3] not in v


def english(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in _EN_WHOLE:
        return _EN_WHOLE[word]
    text = word.replace("’", "'").removeprefix("'")
    text = re.sub(r"^y|(?<=[aeiouy])y", "Y", text)
    fixed = re.match("gener|commun|arsen", text)
    w = _Word(text, _EN_VOWELS, fixed.end() if fixed else None)
    w.cut(_longest(w.text, ("'", "'s", "'s'")))

    found = _longest(w.text, ("sses", "ied", "ies", "s", "us", "ss"))
    if found == "sses":
        w.cut(2)
    elif found in ("ied", "ies"):
        w.cut(2 if len(w.text) > 4 else 1)
    elif found == "s" and any(c in _EN_VOWELS for c in w.text[:-2]):
        w.cut(1)
    if w.text in _EN_STOP:
        return w.text

    found = _longest(w.text, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if found in ("eed", "eedly"):
        if w.ends(found, w.r1):
            w.cut(found, "ee")
    elif found and any(c in _EN_VOWELS for c in w.before(found)):
        w.cut(found)
        if w.text.endswith(("at", "bl", "iz")):
            w.text += "e"
        elif w.text.endswith(_EN_DOUBLE):
            w.cut(1)
        elif len(w.text) <= w.r1 and _en_short_syllable(w.text):
            w.text += "e"
    if len(w.text) > 2 and w.text[-1] in "yY" and w.text[-2] not in _EN_VOWELS:
        w.cut(1, "i")

    found = _longest(w.text, _EN_STEP2)
    if found and w.ends(found, w.r1):
        stem = w.before(found)
        if (found != "ogi" or stem.endswith("l")) and (found != "li" or stem[-1:] in tuple("cdeghkmnrt")):
            w.cut(found, _EN_STEP2[found])
    found = _longest(w.text, _EN_STEP3)
    if found and w.ends(found, w.r2 if found == "ative" else w.r1):
        w.cut(found, _EN_STEP3[found])
    found = _longest(w.text, _EN_STEP4)
    if found and w.ends(found, w.r2) and (found != "ion" or w.before(found).endswith(("s", "t"))):
        w.cut(found)
    if w.ends("e", w.r2) or w.ends("e", w.r1) and not _en_short_syllable(w.text[:-1]):
        w.cut(1)
    elif w.ends("l", w.r2) and w.text.endswith("ll"):
        w.cut(1)
    return w.text.lower()


# -- German -------------------------------------------------------------------------------------------------------

_DE_VOWELS = "aeiouyäöü"


def german(word: str) -> str:
    text = word.replace("ß", "ss")
    text = re.sub(f"(?<=[{_DE_VOWELS}])[uy](?=[{_DE_VOWELS}])", lambda m: m.group().upper(), text)
    w = _Word(text, _DE_VOWELS)
    w.r1 = max(w.r1, min(3, len(text)))  # R2 was found from R1 as it was

    found = _longest(w.text, "em ern er e en es s".split())
    if found and w.ends(found, w.r1):
        if found != "s":
            w.cut(found)
            if found in ("e", "en", "es") and w.text.endswith("niss"):
                w.cut(1)
        elif w.before(found)[-1:] in tuple("bdfghklmnrt"):
            w.cut(found)
    found = _longest(w.text, "en er est st".split())
    if found and w.ends(found, w.r1):
        if found != "st" or len(w.text) >= 6 and w.before(found)[-1:] in tuple("bdfghklmnt"):
            w.cut(found)
    found = _longest(w.text, "end ung ig ik isch lich heit keit".split())
    if found and w.ends(found, w.r2):
        if found in ("end", "ung"):
            w.cut(found)
            if w.ends("ig", w.r2) and not w.text.endswith("eig"):
                w.cut(2)
        elif found in ("ig", "ik", "isch"):
            if not w.before(found).endswith("e"):
                w.cut(found)
        elif found in ("lich", "heit"):
            w.cut(found)
            w.drop("er en", w.r1)
        else:
            w.cut(found)
            w.drop("lich ig", w.r2)
    return w.text.lower().translate(str.maketrans("äöü", "aou"))


# -- Spanish ------------------------------------------------------------------------------------------------------

# Fixed values of the Spanish rules.
_ES_VOWELS = "aeiouáéíóúü"
_ES_PLAIN = str.maketrans("áéíóú", "aeiou")
_ES_PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
_ES_R2 = ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas "
          "amiento amientos imiento imientos").split()
_ES_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
_ES_STEP1 = {"logía": "log", "logías": "log", "ución": "u", "uciones": "u", "encia": "ente", "encias": "ente"}
_ES_Y = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
_ES_VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré "
    "irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían "
    "aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais "
    "arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos").split()


def _es_rv(text: str) -> int:
    v = _ES_VOWELS
    if len(text) < 2:
        return len(text)
    if text[1] not in v:
        return next((i + 1 for i in range(2, len(text)) if text[i] in v), len(text))
    if text[0] in v:
        return next((i + 1 for i in range(2, len(text)) if text[i] not in v), len(text))
    return min(3, len(text))


def _es_endings(w: _Word) -> bool:
    """Step 1; whether an ending was removed."""
    rest = "amente mente idad idades iva ivo ivas ivos".split()
    found = _longest(w.text, [*_ES_R2, *_ES_IC, *_ES_STEP1, *rest])
    if not found or not w.ends(found, w.r1 if found == "amente" else w.r2):
        return False
    w.cut(found, _ES_STEP1.get(found, ""))
    if found in _ES_IC:
        w.drop("ic", w.r2)
    elif found == "amente":
        if w.drop("iv", w.r2):
            w.drop("at", w.r2)
        else:
            w.drop("os ic ad", w.r2)
    elif found == "mente":
        w.drop("ante able ible", w.r2)
    elif found in ("idad", "idades"):
        w.drop("abil ic iv", w.r2)
    elif found in ("iva", "ivo", "ivas", "ivos"):
        w.drop("at", w.r2)
    return True


def spanish(word: str) -> str:
    w = _Word(word, _ES_VOWELS)
    w.rv = _es_rv(word)
    found = _longest(w.text, _ES_PRONOUNS)
    if found:
        stem = w.before(found)
        verb = _longest(stem, "iéndo ándo ár ér ír ando iendo ar er ir yendo".split())
        if verb and len(stem) - len(verb) >= w.rv and (verb != "yendo" or stem.endswith("uyendo")):
            w.cut(found)
            if verb in ("iéndo", "ándo", "ár", "ér", "ír"):
                w.cut(verb, verb.translate(_ES_PLAIN))
    if not _es_endings(w):
        found = _longest(w.text[w.rv :], _ES_Y)
        if found and w.before(found).endswith("u"):
            w.cut(found)
        else:
            found = _longest(w.text[w.rv :], [*_ES_VERBS, "en", "es", "éis", "emos"])
            if found:
                w.cut(found)
                if found in ("en", "es", "éis", "emos") and w.text.endswith("gu"):
                    w.cut(1)
    found = _longest(w.text[w.rv :], "os a o á í ó e é".split())
    if found:
        w.cut(found)
        if found in ("e", "é") and w.text.endswith("gu") and w.ends("u", w.rv):
            w.cut(1)
    return w.text.translate(_ES_PLAIN)


# -- French -------------------------------------------------------------------------------------------------------

# Fixed values of the French rules.
_FR_VOWELS = "aeiouyâàëéêèïîôûù"
_FR_R2 = "ance iqUe isme able iste eux ances iqUes ismes ables istes".split()
_FR_IC = "atrice ateur ation atrices ateurs ations".split()
_FR_STEP1 = {"logie": "log", "logies": "log", "usion": "u", "ution": "u", "usions": "u", "utions": "u", "ence": "ent", "ences": "ent"}
_FR_REST = "ement ements ité ités if ive ifs ives eaux aux euse euses issement issements amment emment ment ments".split()
_FR_I = ("îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais issait "
         "issant issante issantes issants isse issent isses issez issiez issions issons it").split()
_FR_E = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez".split()
_FR_A = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions".split()


def _fr_rv(text: str) -> int:
    v = _FR_VOWELS
    if text.startswith(("par", "col", "tap")) or len(text) > 2 and text[0] in v and text[1] in v:
        return min(3, len(text))
    return next((i + 1 for i in range(1, len(text)) if text[i] in v), len(text))


def _fr_endings(w: _Word) -> str:
    """Step 1; the ending that changed the word."""
    found = _longest(w.text, [*_FR_R2, *_FR_IC, *_FR_STEP1, *_FR_REST])
    if not found:
        return ""
    if found in _FR_STEP1 or found in _FR_R2 or found in _FR_IC:
        if not w.ends(found, w.r2):
            return ""
        w.cut(found, _FR_STEP1.get(found, ""))
        if found in _FR_IC and w.text.endswith("ic"):
            w.cut(2, "" if w.ends("ic", w.r2) else "iqU")
    elif found in ("ement", "ements"):
        if not w.ends(found, w.rv):
            return ""
        w.cut(found)
        if w.text.endswith("iv"):
            if w.drop("iv", w.r2):
                w.drop("at", w.r2)
        elif w.text.endswith("eus"):
            if not w.drop("eus", w.r2) and w.ends("eus", w.r1):
                w.cut(3, "eux")
        elif w.text.endswith(("abl", "iqU")):
            w.drop("abl iqU", w.r2)
        elif w.text.endswith(("ièr", "Ièr")) and w.ends("ièr", w.rv) | w.ends("Ièr", w.rv):
            w.cut(3, "i")
    elif found in ("ité", "ités"):
        if not w.ends(found, w.r2):
            return ""
        w.cut(found)
        if w.text.endswith("abil"):
            w.cut(4, "" if w.ends("abil", w.r2) else "abl")
        elif w.text.endswith("ic"):
            w.cut(2, "" if w.ends("ic", w.r2) else "iqU")
        else:
            w.drop("iv", w.r2)
    elif found in ("if", "ive", "ifs", "ives"):
        if not w.ends(found, w.r2):
            return ""
        w.cut(found)
        if w.drop("at", w.r2) and w.text.endswith("ic"):
            w.cut(2, "" if w.ends("ic", w.r2) else "iqU")
    elif found == "eaux":
        w.cut(1)
    elif found == "aux":
        if not w.ends(found, w.r1):
            return ""
        w.cut(2, "l")
    elif found in ("euse", "euses"):
        if w.ends(found, w.r2):
            w.cut(found)
        elif w.ends(found, w.r1):
            w.cut(found, "eux")
        else:
            return ""
    elif found in ("issement", "issements"):
        if not w.ends(found, w.r1) or w.before(found)[-1:] in tuple(_FR_VOWELS) or not w.before(found):
            return ""
        w.cut(found)
    elif found in ("amment", "emment"):
        if not w.ends(found, w.rv):
            return ""
        w.cut(found, "ant" if found == "amment" else "ent")
    else:  # ment, ments
        stem = w.before(found)
        if not stem or stem[-1] not in _FR_VOWELS or len(stem) - 1 < w.rv:
            return ""
        w.cut(found)
    return found


def _fr_verbs(w: _Word) -> bool:
    """Step 2; whether a verb ending was removed."""
    found = _longest(w.text[w.rv :], _FR_I)
    if found:
        stem = w.before(found)
        if len(stem) - 1 >= w.rv and stem[-1] not in _FR_VOWELS:
            w.cut(found)
            return True
    found = _longest(w.text[w.rv :], ["ions", *_FR_E, *_FR_A])
    if not found or found == "ions" and not w.ends(found, w.r2):
        return False
    w.cut(found)
    if found in _FR_A and w.ends("e", w.rv):
        w.cut(1)
    return True


def french(word: str) -> str:
    v = _FR_VOWELS
    text = re.sub(f"(?<=[{v}])[ui](?=[{v}])|(?<=[{v}])y|y(?=[{v}])|(?<=q)u", lambda m: m.group().upper(), word)
    w = _Word(text, v)
    w.rv = _fr_rv(text)
    found = _fr_endings(w)
    changed = bool(found)
    if not found or found in ("amment", "emment", "ment", "ments"):
        changed = _fr_verbs(w) or changed
    if changed:
        if w.text.endswith("Y"):
            w.cut(1, "i")
        elif w.text.endswith("ç"):
            w.cut(1, "c")
    else:
        if w.text.endswith("s") and len(w.text) > 1 and w.text[-2] not in "aiouès":
            w.cut(1)
        found = _longest(w.text[w.rv :], ("ion", "ier", "ière", "Ier", "Ière", "e"))
        if found == "ion":
            if w.ends(found, w.r2) and len(w.text) - 4 >= w.rv and w.text[-4] in "st":
                w.cut(found)
        elif found:
            w.cut(found, "" if found == "e" else "i")
    if w.text.endswith(("enn", "onn", "ett", "ell", "eill")):
        w.cut(1)
    w.text = re.sub(f"[éè](?=[^{v}]+$)", "e", w.text)
    return w.text.lower()


STEMMERS: dict[str, Callable[[str], str]] = {"en": english, "de": german, "es": spanish, "fr": french}


@lru_cache(maxsize=1 << 16)
def stem(word: str, language: str) -> str:
    return STEMMERS[language](word)
