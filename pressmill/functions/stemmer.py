"""The published Spanish stemmer of the Snowball project: regions R1, R2 and RV, and suffixes removed in ordered steps.

It runs once for each different word of a vocabulary, never for each occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

VOWELS = "aeiouáéíóúü"
UNACCENTED = str.maketrans("áéíóú", "aeiou")

# The suffixes of the published algorithm, step by step.
PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
BEFORE_PRONOUN = "iéndo ándo ár ér ír ando iendo ar er ir yendo".split()
STANDARD = {
    "delete": "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos".split(),
    "ic": "adora ador ación adoras adores aciones ante antes ancia ancias".split(),
    "log": "logía logías".split(),
    "u": "ución uciones".split(),
    "ente": "encia encias".split(),
    "amente": ["amente"],
    "mente": ["mente"],
    "idad": "idad idades".split(),
    "iv": "iva ivo ivas ivos".split(),
}
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
GU_VERBS = "en es éis emos".split()
VERBS = """
arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos
erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste
an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses
ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos
""".split()
RESIDUAL, RESIDUAL_E = "os a o á í ó".split(), "e é".split()


def ending(suffixes: list[str]) -> Callable[[str], str]:
    """The longest of the suffixes that a word ends with, or an empty string."""
    found = re.compile(f"(?:{'|'.join(sorted(suffixes, key=len, reverse=True))})\\Z")
    return lambda word: m.group() if (m := found.search(word)) else ""


PRONOUN, VERBAL, Y_VERB, VERB, LAST = map(ending, (PRONOUNS, BEFORE_PRONOUN, Y_VERBS, GU_VERBS + VERBS, RESIDUAL + RESIDUAL_E))
KIND = {suffix: kind for kind, suffixes in STANDARD.items() for suffix in suffixes}
SUFFIX = ending(list(KIND))
AFTER_VOWEL = re.compile(f"[{VOWELS}][^{VOWELS}]")


def regions(word: str) -> tuple[int, int, int]:
    """Where RV, R1 and R2 begin."""
    first = AFTER_VOWEL.search(word)
    r1 = first.end() if first else len(word)
    second = AFTER_VOWEL.search(word, r1)
    r2 = second.end() if second else len(word)
    if word[1:2] and word[1] not in VOWELS:
        wanted, start = f"[{VOWELS}]", 2
    elif word[:1] and word[0] in VOWELS:
        wanted, start = f"[^{VOWELS}]", 2
    else:
        return min(3, len(word)), r1, r2
    found = re.compile(wanted).search(word, start)
    return found.end() if found else len(word), r1, r2


def without_pronoun(word: str, rv: int) -> str:
    pronoun = PRONOUN(word)
    if not pronoun or len(word) - len(pronoun) < rv:
        return word
    rest = word[: -len(pronoun)]
    verbal = VERBAL(rest)
    if not verbal or len(rest) - len(verbal) < rv or (verbal == "yendo" and not rest.endswith("uyendo")):
        return word
    return rest[: -len(verbal)] + verbal.translate(UNACCENTED)


def without_standard(word: str, r1: int, r2: int) -> str:
    suffix = SUFFIX(word)
    if not suffix:
        return word
    kind, rest = KIND[suffix], word[: -len(suffix)]
    if len(rest) < (r1 if kind == "amente" else r2):
        return word

    def less(rest: str, *befores: str) -> str:
        """Also without what stands before, if that is in R2."""
        for before in befores:
            if rest.endswith(before) and len(rest) - len(before) >= r2:
                return rest[: -len(before)]
        return rest

    if kind in ("log", "u", "ente"):
        return rest + kind
    if kind == "amente":
        if rest.endswith("iv"):
            return less(less(rest, "iv"), "at") if len(rest) - 2 >= r2 else rest
        return less(rest, "os", "ic", "ad")
    befores = {"ic": ("ic",), "mente": ("ante", "able", "ible"), "idad": ("abil", "ic", "iv"), "iv": ("at",)}
    return less(rest, *befores.get(kind, ()))


def without_verb(word: str, rv: int) -> str:
    suffix = Y_VERB(word[rv:])
    if suffix and word[: -len(suffix)].endswith("u"):
        return word[: -len(suffix)]
    suffix = VERB(word[rv:])
    if not suffix:
        return word
    rest = word[: -len(suffix)]
    return rest[:-1] if suffix in GU_VERBS and rest.endswith("gu") else rest


def stem(word: str) -> str:
    """The stem of a word, which is taken in lower case."""
    word = word.lower()
    rv, r1, r2 = regions(word)
    word = without_pronoun(word, rv)
    after = without_standard(word, r1, r2)
    if after == word:
        after = without_verb(word, rv)
    last = LAST(after[rv:])
    if last:
        after = after[: -len(last)]
        if last in RESIDUAL_E and after.endswith("gu") and len(after) - 1 >= rv:
            after = after[:-1]
    return after.translate(UNACCENTED)


def _stems(words: pd.Series) -> pd.Series:
    return words.map(stem, na_action="ignore")


def stems(words: Column | str) -> Column:
    return F.pandas_udf(_stems, StringType())(words)
