"""One name, as typed, read into purpose, number, given name and the distinctive rest.

What counts as a purpose comes from a Lexicon learned from the table's own names (see names.learn).
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from typing import NamedTuple

from harborlens.llm import name_lexicon as L


class Purpose(NamedTuple):
    """A phrase of common words, and what the names that hold it look like."""

    words: tuple[str, ...]
    person: bool
    doctor: bool
    numbered: bool


class Form(NamedTuple):
    """A name without a purpose, seen from one of its words: the others' initials in order of the alphabet, and the others.

    role: whole, less (a name that is like this form lacks a word of this name) or acronym (this name is short for one like this form).
    """

    initials: str
    anchor: str
    rest: list[str]
    role: str


class Parts(NamedTuple):
    """kind: body, person or other; purpose: '' where none was given; number: '' where there is none.

    core is what remains in the order written, turned what remains in order of the alphabet; forms are those of kind other.
    """

    kind: str
    purpose: str
    number: str
    given: str
    initial: str
    doctor: bool
    core: str
    turned: str
    forms: list[Form]


SMALL = {"of", "and", "for", "at"}
_SKIPPED = set(L.LEGAL) | set(L.TITLES) | set(L.FILLERS)
GIVEN = {short: given for given, forms in reversed(L.GIVEN.items()) for short in forms.split()} | {g: g for g in L.GIVEN}
#: Words of a name up to which it is met by names that lack one of them.
MOST_WORDS = 32
#: Tokens a reader remembers; a bound of memory that changes no result.
REMEMBERED = 200_000
_ROMAN = re.compile(r"x{0,3}(ix|iv|v?i{0,3})$")


def within(a: str, b: str, most: int) -> bool:
    """Whether a and b are at most that many edits (transpositions of neighbours count as one) apart."""
    if abs(len(a) - len(b)) > most:
        return False
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if older is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], older[j - 2] + 1)
        if min(row) > most:
            return False
    return row[-1] <= most


def _letters(word: str) -> int:
    mask = 0
    for c in word:
        mask |= 1 << (ord(c) & 31)
    return mask


_NAMES = [(n, _letters(n)) for n in GIVEN if len(n) >= 4]


def abbreviates(token: str, word: str) -> bool:
    """Whether token keeps some of word's letters in order, the first among them."""
    if len(token) >= len(word) or len(token) < 2 or token[0] != word[0]:
        return False
    it = iter(word)
    return all(c in it for c in token)


def fold(name: str) -> list[str]:
    """Lower-case words without marks, dots of abbreviations, or blanks of any kind."""
    s = unicodedata.normalize("NFKC", name)
    s = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])", " ", s)
    s = "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).lower()
    s = re.sub(r"['’`]", "", s)
    s = re.sub(r"\bco-op\b", "coop", s)
    s = re.sub(r"\b((?:[a-z]\.){2,})", lambda m: m[1].replace(".", "") + " ", s)
    s = s.replace("&", " and ").replace("+", " and ").replace("#", " no ")
    s = re.sub(r"(?<=[a-z])(?=\d)", " ", s)
    return re.findall(r"[^\W_]+", s)


def _number(token: str) -> str:
    if token.isdigit():
        return str(int(token))
    if token and _ROMAN.match(token):
        value, total = {"i": 1, "v": 5, "x": 10}, 0
        for a, b in zip(token, token[1:] + " ", strict=True):
            total += -value[a] if value.get(b, 0) > value[a] else value[a]
        return str(total)
    return ""


def content(tokens: list[str]) -> list[str]:
    """The words that can tell names apart or say a purpose."""
    return [t for t in tokens if len(t) > 1 and t not in _SKIPPED and not _number(t)]


def alike(a: str, b: str) -> bool:
    return a == b or abbreviates(a, b) or within(a, b, 1 if len(b) < 8 else 2)


def damaged(short: tuple[str, ...], whole: tuple[str, ...]) -> bool:
    """Whether short's words stand, in order, for some of whole's: abbreviated, mistyped, or some of them lost."""
    rest = iter(whole)
    return short != whole and all(any(alike(a, b) for b in rest) for a in short)


def prune(found: dict[tuple[str, ...], int], share: float) -> list[tuple[str, ...]]:
    """The phrases that are none of a more frequent one of as many words damaged or turned, and not mostly what is left of longer ones."""
    kept = []
    for p, n in sorted(found.items()):
        same = any(len(q) == len(p) and m > n and (damaged(p, q) or sorted(p) == sorted(q)) for q, m in found.items())
        longer = sum(m for q, m in found.items() if len(q) > len(p) and damaged(p, q))
        if not same and n >= share * longer:
            kept.append(p)
    return kept


@dataclass
class Reader:
    """Reads names by a lexicon. What a token may stand for is remembered for as long as the reader lives."""

    purposes: list[Purpose]

    def __post_init__(self):
        self.purposes = sorted(self.purposes, key=lambda p: (-len(p.words), p.words))
        self.words = frozenset(w for p in self.purposes for w in p.words)
        self.vocabulary = sorted(self.words | {w for w in L.LEGAL if len(w) > 5})
        self.masks = [(w, _letters(w)) for w in self.vocabulary]
        self.whole = frozenset(self.vocabulary)
        self.known: dict[str, dict[str, int]] = {}
        self.names: dict[str, str] = {}

    def readings(self, token: str) -> dict[str, int]:
        """The vocabulary words that a token may stand for, with a cost: 0 as it is, 1 abbreviated, 2 or 3 mistyped."""
        if (found := self.known.get(token)) is not None:
            return found
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = self.known[token] = {}
        if L.SHORT_WORDS.get(token) in self.words:
            found[L.SHORT_WORDS[token]] = 1
            found.update({w: 1 for w in self.vocabulary if abbreviates(token, w)})
            return found
        if token in self.whole:
            found[token] = 0
            return found
        mask, size = _letters(token), len(token)
        for word, letters in self.masks:
            same_start = word[0] == token[0]
            if same_start and not mask & ~letters and abbreviates(token, word) and (size <= 5 or size >= len(word) - 1 or word.startswith(token)):
                found[word] = 1
            elif size >= 4 and (mask ^ letters).bit_count() <= 4 and within(token, word, 1 if len(word) < 8 else 2):
                found[word] = 2
            elif size >= 5 and same_start and len(word) > size and (mask & ~letters).bit_count() <= 1 and any(within(token, word[:k], 1) for k in (size - 1, size, size + 1)):
                found[word] = 3
        return found

    def given_name(self, token: str) -> str:
        """The full given name a token stands for, or ''."""
        if token in GIVEN:
            return GIVEN[token]
        if not 4 <= len(token) <= 11:
            return ""
        if token not in self.names:
            if len(self.names) > REMEMBERED:
                self.names.clear()
            mask = _letters(token)
            close = (
                GIVEN[name]
                for name, letters in _NAMES
                if (mask ^ letters).bit_count() <= 4 and within(token, name, 1 if len(name) < 8 else 2) and (len(name) >= 5 or token[0] == name[0])
            )
            self.names[token] = next(close, "")
        return self.names[token]

    def split_joined(self, tokens: list[str]) -> list[str]:
        """Words run together are parted where a long vocabulary word starts or ends one."""
        out = []
        for t in tokens:
            if len(t) >= 11 and not self.readings(t):
                for word in self.vocabulary:
                    if len(word) < 5 or not (t.endswith(word) or t.startswith(word)):
                        continue
                    rest = t[: -len(word)] if t.endswith(word) else t[len(word) :]
                    if len(rest) >= 4 or rest in SMALL:
                        t = t[: -len(word)] + " " + word if t.endswith(word) else word + " " + t[len(word) :]
                        break
            out += t.split()
        return out

    def phrase(self, tokens: list[str]) -> tuple[int, int, Purpose] | None:
        """(start, end, purpose) that the words name best: most words, then least cost."""
        at_word = [i for i, t in enumerate(tokens) if t in self.words or t not in L.FILLERS]
        costs: dict[str, dict[int, int]] = {}
        for i in at_word:
            costs.setdefault(tokens[i], {})[i] = 0
            for w, c in self.readings(tokens[i]).items():
                if len(w) > 3:
                    costs.setdefault(w, {}).setdefault(i, c)
        best = None
        for purpose in self.purposes:
            n = len(purpose.words)
            if best and n < -best[0][0]:
                break  # purposes come in order of length
            if any(w not in costs for w in purpose.words):
                continue
            for k in range(len(at_word) - n + 1):
                at = at_word[k : k + n]
                if at[-1] - at[0] > n + 1:
                    continue
                each = [costs[w].get(i) for i, w in zip(at, purpose.words, strict=True)]
                if None in each or (n == 1 and each[0] == 1 and len(tokens[at[0]]) < 3 and tokens[at[0]] not in L.SHORT_WORDS):
                    continue
                key = (-n, sum(each))
                if best is None or key < best[0]:
                    best = (key, (at[0], at[-1] + 1, purpose))
        return best[1] if best else None

    def parse(self, tokens: list[str]) -> Parts:
        """tokens: what fold gives."""
        every = tokens
        tokens = self.split_joined(tokens)
        number, purpose = "", None
        if found := self.phrase(tokens):
            start, end, purpose = found
            tokens = tokens[:start] + tokens[end:]
        if purpose and purpose.numbered:
            hit = [(i, n) for i, n in enumerate(map(_number, tokens)) if n]
            if hit:
                i, number = next(((i, n) for i, n in hit if tokens[i].isdigit()), hit[-1])
                tokens = tokens[:i] + tokens[i + 1 :]
        elif digits := [t for t in tokens if t.isdigit()]:
            number, tokens = str(int(digits[0])), [t for t in tokens if t != digits[0]]
        doctor = "dr" in tokens
        tokens = [t for t in tokens if t not in L.TITLES and t not in L.FILLERS]
        said = " ".join(purpose.words) if purpose else ""
        if purpose and not purpose.person:
            rest = [t for t in tokens if t not in L.LEGAL and not (len(t) > 3 and any(w in L.LEGAL for w in self.readings(t)))] or tokens
            return Parts("body", said, number, "", "", doctor, "".join(rest), "".join(sorted(rest)), [])
        letters, long = [t for t in tokens if len(t) == 1], [t for t in tokens if len(t) > 1]
        given = next(((t, g) for t in long if (g := self.given_name(t))), None) if purpose or len(long) in (2, 3) else None
        if purpose or given:
            rest = [t for t in long if not given or t != given[0]]
            initial = given[1][0] if given else (letters[0] if letters else "")
            return Parts("person", said, number, given[1] if given else "", initial, doctor or bool(purpose and purpose.doctor), "".join(rest), "".join(sorted(rest)), [])
        own = [t for t in tokens if not t.isdigit()] or [t for t in every if not t.isdigit()]
        return Parts("other", "", number, "", "", doctor, " ".join(own), "", forms(own))


def _form(anchor: str, rest: list[str], role: str = "whole") -> Form:
    rest = sorted(rest)
    return Form("".join(w[0] for w in rest), anchor, rest, role)


def forms(tokens: list[str]) -> list[Form]:
    """How a name without a purpose can be met: from its first and its last word, as letters alone, from the word an acronym
    stands beside; and, for one that may be met with a word less, without each of its later words."""
    if not tokens:
        return []
    out = [_form("".join(tokens), []), _form("".join(sorted(tokens)), [])]
    if len(tokens) > 1:
        out += [_form(tokens[0], tokens[1:]), _form(tokens[-1], tokens[:-1])]
    if len(tokens) == 2:
        for acronym, word in (tokens, tokens[::-1]):
            if 2 <= len(acronym) <= 5 < len(word) and acronym[0] == word[0]:
                out.append(_form(word, list(acronym[1:]), "acronym"))
    if 2 < len(tokens) <= MOST_WORDS:
        out += [_form(tokens[0], tokens[1:i] + tokens[i + 1 :], "less") for i in range(1, len(tokens))]
    return list({(f.initials, f.anchor, tuple(f.rest), f.role): f for f in out}.values())
