"""French suffix stemming (the published Snowball rules) for token tables.

Words are stemmed once per distinct word in Arrow batches and joined back.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

# Vowels and suffix groups of the published rules.
VOWELS = "aeiouyâàëéêèïîôûù"
NOUN = "ance iqUe isme able iste eux ances iqUes ismes ables istes".split()
AGENT = "atrice ateur ation atrices ateurs ations".split()
VERB_I = (
    "îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais "
    "issait issant issante issantes issants isse issent isses issez issiez issions issons it"
).split()
VERB_E = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez".split()
VERB_A = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions".split()
DOUBLED = ("enn", "onn", "ett", "ell", "eill")


def _marked(word: str) -> str:
    """Letters i, u, y that act as consonants in upper case."""
    out = list(word)
    for i, ch in enumerate(word):
        before = out[i - 1] if i else ""
        after = word[i + 1] if i + 1 < len(word) else ""
        if ch == "u" and before == "q":
            out[i] = "U"
        elif ch in "ui" and before and before in VOWELS and after and after in VOWELS:
            out[i] = ch.upper()
        elif ch == "y" and ((before and before in VOWELS) or (after and after in VOWELS)):
            out[i] = "Y"
    return "".join(out)


def _region(word: str, start: int) -> int:
    """Position after the first consonant that follows a vowel, from `start` on."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _verb_region(word: str) -> int:
    if word[:3] in ("par", "col", "tap") or (len(word) > 1 and word[0] in VOWELS and word[1] in VOWELS):
        return 3
    return next((i + 1 for i in range(1, len(word)) if word[i] in VOWELS), len(word))


def _longest(word: str, endings) -> str:
    return max((e for e in endings if word.endswith(e)), key=len, default="")


def _standard(word: str, rv: int, r1: int, r2: int) -> tuple[str, bool]:
    """Step 1: the new word, and whether verb endings must still be looked at."""

    def cut(text, ending, region):
        return text[: len(text) - len(ending)] if text.endswith(ending) and len(text) - len(ending) >= region else None

    def trim(text, *rules):
        """First rule whose ending is present: delete it inside its region, else use its replacement."""
        for ending, region, other in rules:
            if text.endswith(ending):
                shorter = cut(text, ending, region)
                if shorter is not None:
                    return shorter
                return text[: len(text) - len(ending)] + other if other is not None else text
        return text

    endings = [*NOUN, *AGENT, "logie", "logies", "usion", "ution", "usions", "utions", "ence", "ences", "ement", "ements", "ité", "ités",
               "if", "ive", "ifs", "ives", "eaux", "aux", "euse", "euses", "issement", "issements", "amment", "emment", "ment", "ments"]
    end = _longest(word, endings)
    at = len(word) - len(end)
    stem = word[:at]
    if not end:
        return word, True
    if end in NOUN:
        return (stem, False) if at >= r2 else (word, True)
    if end in AGENT:
        return (trim(stem, ("ic", r2, "iqU")), False) if at >= r2 else (word, True)
    if end.startswith("logie"):
        return (stem + "log", False) if at >= r2 else (word, True)
    if end in ("usion", "ution", "usions", "utions"):
        return (stem + "u", False) if at >= r2 else (word, True)
    if end.startswith("ence"):
        return (stem + "ent", False) if at >= r2 else (word, True)
    if end in ("ement", "ements"):
        if at < rv:
            return word, True
        if stem.endswith("iv"):
            shorter = trim(stem, ("iv", r2, None))
            return (trim(shorter, ("at", r2, None)) if shorter != stem else stem), False
        if stem.endswith("eus"):
            shorter = cut(stem, "eus", r2)
            if shorter is None:
                shorter = stem[:-3] + "eux" if len(stem) - 3 >= r1 else stem
            return shorter, False
        if stem.endswith(("abl", "iqU")):
            return trim(stem, ("abl", r2, None), ("iqU", r2, None)), False
        if stem.endswith(("ièr", "Ièr")) and len(stem) - 3 >= rv:
            return stem[:-3] + "i", False
        return stem, False
    if end in ("ité", "ités"):
        return (trim(stem, ("abil", r2, "abl"), ("ic", r2, "iqU"), ("iv", r2, None)), False) if at >= r2 else (word, True)
    if end in ("if", "ive", "ifs", "ives"):
        if at < r2:
            return word, True
        shorter = trim(stem, ("at", r2, None))
        return (trim(shorter, ("ic", r2, "iqU")) if shorter != stem else stem), False
    if end == "eaux":
        return stem + "eau", False
    if end == "aux":
        return (stem + "al", False) if at >= r1 else (word, True)
    if end in ("euse", "euses"):
        if at >= r2:
            return stem, False
        return (stem + "eux", False) if at >= r1 else (word, True)
    if end in ("issement", "issements"):
        return (stem, False) if at >= r1 and stem and stem[-1] not in VOWELS else (word, True)
    if end in ("amment", "emment"):
        return (stem + end[0] + "nt" if at >= rv else word), True
    # ment, ments after a vowel of the verb region
    return (stem if at - 1 >= rv and stem[-1] in VOWELS else word), True


def _verbs(word: str, rv: int, r2: int) -> str:
    """Steps 2a and 2b, inside the verb region only."""
    tail = word[rv:]
    end = _longest(tail, VERB_I)
    if end and len(tail) > len(end) and tail[-len(end) - 1] not in VOWELS:
        return word[: len(word) - len(end)]
    end = _longest(tail, ["ions", *VERB_E, *VERB_A])
    if not end:
        return word
    shorter = word[: len(word) - len(end)]
    if end == "ions":
        return shorter if len(shorter) >= r2 else word
    if end in VERB_A and shorter.endswith("e") and len(shorter) > rv:
        return shorter[:-1]
    return shorter


def _residue(word: str, rv: int, r2: int) -> str:
    """Step 4."""
    if len(word) > 1 and word[-1] == "s" and word[-2] not in "aiouès":
        word = word[:-1]
    tail = word[rv:]
    end = _longest(tail, ["ion", "ier", "ière", "Ier", "Ière", "e", "ë"])
    if end == "ion":
        return word[:-3] if len(word) - 3 >= r2 and len(tail) > 3 and tail[-4] in "st" else word
    if end in ("ier", "ière", "Ier", "Ière"):
        return word[: len(word) - len(end)] + "i"
    if end == "e" or (end == "ë" and tail[:-1].endswith("gu")):
        return word[:-1]
    return word


def stem(word: str) -> str:
    word = _marked(word.lower())
    rv, r1 = _verb_region(word), _region(word, 0)
    r2 = _region(word, r1)
    new, look_on = _standard(word, rv, r1, r2)
    if look_on:
        verbs = _verbs(new, rv, r2)
        changed, new = verbs != new or new != word, verbs
    else:
        changed = new != word
    if changed:
        new = new[:-1] + {"Y": "i", "ç": "c"}.get(new[-1:], new[-1:])
    else:
        new = _residue(new, rv, r2)
    if new.endswith(DOUBLED):
        new = new[:-1]
    end = len(new)
    while end and new[end - 1] not in VOWELS:
        end -= 1
    if 0 < end < len(new) and new[end - 1] in "éè":
        new = new[: end - 1] + "e" + new[end:]
    return new.lower()


@F.pandas_udf(StringType())
def stem_words(words: pd.Series) -> pd.Series:
    return words.map(stem)


def stem_tokens(tokens: DataFrame, word: str = "word", out: str = "stem") -> DataFrame:
    """Add the stem of every token; only distinct words pass through Python."""
    known = tokens.select(word).distinct().withColumn(out, stem_words(word))
    return tokens.join(known, word)
