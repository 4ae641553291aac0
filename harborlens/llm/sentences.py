"""Sentence units of texts in many languages and scripts, by cascading break and no-break rules.

Defined cases
    * null, empty and blank texts have no units; every other character than outer white space lies in exactly one unit.
    * blank lines and list marks bound units whatever the rules say; a piece without a sentence end is one unit.
    * the language is that of the column; where it is null or unknown, that of the text's script, and for Latin script
      the tables of all its languages together.
    * places count Unicode characters of the text as it stands; repeated texts give the same units.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from harborlens.llm import segmentation_rules as R

LINE = regex.compile(r"[^\r\n]*(?:\r\n|\r|\n|\Z)")
LIST_MARK = regex.compile(r"(?:[-*]|\p{N}+\.)[^\S\r\n]")
#: Quoted and bracketed spans; what ends inside one ends no unit.
PAIRS = regex.compile(
    r"„[^“”„]*[“”]|“[^“”]*”|«[^«»]*»|»[^«»]*«|「[^「」]*」|『[^『』]*』|\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]|(?<!\S)\"[^\"]*\""
)
#: Pieces that are data and not prose: JSON and tables.
STRUCTURE = regex.compile(r"\A\s*(?:[{\[][^\p{L}]*\"[\s\S]*?\"\s*[:,\]][\s\S]*|\|[^\n]*\|[^\n]*\n?[\s\S]*)\Z")
SCRIPTS = [("th", r"\p{Thai}"), ("ja", r"[\p{Hiragana}\p{Katakana}]"), ("zh", r"\p{Han}"), ("hi", r"\p{Devanagari}"), ("ar", r"\p{Arabic}"), ("el", r"\p{Greek}"), ("ru", r"\p{Cyrillic}")]
LATIN = ("en", "es", "de", "fr")
#: Share of a text's letters from which on a script decides its language; below it, letters of other scripts are strays.
SCRIPT_SHARE = 0.1


def may_break(piece: str, at: int, mark: str) -> bool:
    """Whether any rule could break here: not after a mark inside a token, as in addresses, versions and file names."""
    following = piece[at : at + 1]
    return not following or following.isspace() or following.isupper() or following.istitle() or not (mark.isascii() and piece[at - 1].isascii())


@lru_cache(maxsize=64)
def tables(lang: str) -> tuple:
    """(candidates, rules, rules for blanks or None) of a language, compiled. A rule is one pattern that looks both ways from a place."""
    of = LATIN if lang == "latin" else (lang,)
    rules: list[tuple[bool, str, str, bool]] = []
    for one in of:
        if one in R.NEVER:
            rules.append((False, R.NEVER[one], r"\s*[\p{L}\p{N}]", True))
        if one in R.BEFORE_NUMBER:
            rules.append((False, R.BEFORE_NUMBER[one], r"\s*\p{N}", True))
        rules += [(*rule, False) for rule in R.BY_LANGUAGE.get(one, [])]

    def compiled(table) -> tuple:
        return tuple((b, regex.compile((f"(?<={before})" if before else "") + (f"(?={after})" if after else "")).match, dot) for b, before, after, dot in table)

    blanks = compiled((*rule, False) for rule in R.THAI_BLANKS) if lang == "th" else None
    ends = regex.compile(f"({R.GREEK_ENDS if lang == 'el' else R.ENDS})" + R.CLOSERS)
    return ends, compiled(rules + [(*rule, False) for rule in R.COMMON]), blanks


def language(text: str, lang: str | None) -> str:
    """The tables to use: the column's, or where it says nothing, those of the script that the text is in."""
    if lang in R.NEVER or lang in ("zh", "ja"):
        return lang
    least = SCRIPT_SHARE * len(regex.findall(r"\p{L}", text))
    counts = {code: len(regex.findall(script, text)) for code, script in SCRIPTS}
    if counts["ja"] and counts["ja"] >= counts["zh"] / 4:  # kana stand among Han characters
        counts["ja"] += counts["zh"]
    code = max(counts, key=counts.__getitem__)
    return code if counts[code] and counts[code] >= least else "latin"


def pieces(text: str) -> Iterator[tuple[int, int]]:
    """Places between blank lines and before list marks."""
    start = end = None
    for line in LINE.finditer(text):
        a, b = line.span()
        if a == b:
            break
        if text[a:b].isspace():
            if start is not None:
                yield start, end
            start = None
            continue
        if start is not None and LIST_MARK.match(text, a):
            yield start, end
            start = None
        if start is None:
            start = a
        end = b
    if start is not None:
        yield start, end


def decide(rules: tuple, piece: str, at: int) -> bool:
    """The first rule that matches at the place; abbreviations only after a period."""
    dot = piece[at - 1] == "."
    for breaks, match, abbreviation in rules:
        if (dot or not abbreviation) and match(piece, at):
            return breaks
    return False


def boundaries(piece: str, lang: str) -> Iterator[int]:
    """Places in the piece where one unit ends and another may start."""
    ends, rules, blanks = tables(lang)
    spans = [m.span() for m in PAIRS.finditer(piece)]
    k = 0
    places = [(m.end(), rules) for m in ends.finditer(piece) if may_break(piece, m.end(), piece[m.end(1) - 1])]
    if blanks:
        places = sorted(places + [(m.start(), blanks) for m in regex.finditer(r"(?<=\S)\s+(?=\S)", piece)], key=lambda p: p[0])
    for at, table in places:
        while k < len(spans) and spans[k][1] <= at:
            k += 1
        if k < len(spans) and spans[k][0] < at:
            continue
        if decide(table, piece, at):
            yield at


def units(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit of a text."""
    if not text:
        return []
    lang, out = language(text, lang), []
    for a, b in pieces(text):
        piece = text[a:b]
        last = 0
        for at in [*(boundaries(piece, lang) if not STRUCTURE.match(piece) else ()), len(piece)]:
            unit = piece[last:at]
            if kept := unit.strip():
                start = a + last + unit.index(kept[0])
                out.append((start, start + len(kept)))
            last = at
    return out


def sentences(documents: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """key, start_pos, end_pos: one row per unit. Texts are split where they are read; nothing is shuffled."""
    schema = f"{key} bigint, start_pos bigint, end_pos bigint"

    def split(batches):
        import pyarrow as pa

        from harborlens.llm.batches import slices

        for batch in (part for whole in batches for part in slices(whole, 1)):
            keys, starts, ends = [], [], []
            for doc, body, code in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for a, b in units(body, code):
                    keys.append(doc)
                    starts.append(a)
                    ends.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=[key, "start_pos", "end_pos"])

    return documents.select(key, text, lang).where(f"{text} is not null").mapInArrow(split, schema)
