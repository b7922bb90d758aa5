"""Porter stemmer for one lower-case ASCII word.

Written from M. F. Porter, "An algorithm for suffix stripping" (Program 14(3),
1980), with the later published revisions ("bli" -> "ble", "logi" -> "log")
and the common extensions: words of one or two letters stay as they are, a
short "-ies"/"-ied" word keeps "ie", "y" turns into "i" only after a
consonant that is not the first letter, and a few irregular forms map
directly.

This is a per-word helper: jobs apply it to a DISTINCT vocabulary through an
Arrow-batched pandas UDF, never per token row.
"""

from __future__ import annotations

# Irregular forms mapped directly.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_VOWELS = set("aeiou")


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """Number of VC sequences in [C](VC)^m[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        v = not _cons(stem, i)
        if prev_vowel and not v:
            m += 1
        prev_vowel = v
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    """Ends consonant-vowel-consonant, last not w, x or y."""
    if len(w) < 3:
        return False
    return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


def _step1a(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("ss"):
        return w
    if w.endswith("s"):
        return w[:-1]
    return w


def _step1b(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suf in ("ed", "ing"):
        if w.endswith(suf):
            stem = w[: -len(suf)]
            if not _has_vowel(stem):
                return w
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_cons(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            if _measure(stem) == 1 and _cvc(stem):
                return stem + "e"
            return stem
    return w


def _step1c(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        return w[:-1] + "i"
    return w


# Suffix rules of steps 2, 3 and 4, in the published order.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
    ("fulli", "ful"), ("lessli", "less"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _rules(w: str, rules, min_m: int) -> str:
    # the longest matching suffix decides; it fires only if the measure allows
    for suf, rep in sorted(rules, key=lambda r: -len(r[0])):
        if w.endswith(suf):
            stem = w[: -len(suf)]
            return stem + rep if _measure(stem) > min_m else w
    return w


def _step4(w: str) -> str:
    for suf in sorted(STEP4, key=len, reverse=True):
        if w.endswith(suf):
            stem = w[: -len(suf)]
            if _measure(stem) > 1 and (suf != "ion" or stem.endswith(("s", "t"))):
                return stem
            return w
    return w


def _step5(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


def stem(word: str) -> str:
    if word is None:
        return None
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _step1a(w)
    w = _step1b(w)
    w = _step1c(w)
    w = _rules(w, STEP2, 0)
    w = _rules(w, STEP3, 0)
    w = _step4(w)
    w = _step5(w)
    return w
