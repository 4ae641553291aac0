"""Ordered break and no-break rules, as cascading tables.

A rule is (breaks, before, after): ``before`` must match at the end of what precedes a candidate position (its end marks
and closing marks included), ``after`` at the start of what follows; both see the whole piece. At each position the tables of the language are
tried first, then the common ones; the first rule that matches decides, and a position no rule matches is no boundary.
"""

from __future__ import annotations

#: What can end a sentence; ``;`` ends one in Greek only.
ENDS = r"[.!?…‼⁇-⁉。！？．｡؟۔।॥]+"
GREEK_ENDS = r"[.!?…;;]+"
CLOSERS = r"(?:[)\]}\"'”’»›」』）】》]|(?<=„[^“„]*)“|\s?»)*"
CLOSE = r"[)\]}\"'“”’»›」』）】》]"

_TITLE = r"(?<![\p{L}\p{N}])"


def _words(*words: str) -> str:
    return _TITLE + "(?:" + "|".join(w.replace(" ", r"\s+") for w in words) + ")"


#: Abbreviations that never end a sentence, as they are written with names or in front of more words.
NEVER = {
    "en": _words(r"[Dd]r\.", r"[Mm]r\.", r"[Mm]rs\.", r"[Mm]s\.", r"[Pp]rof\.", r"[Gg]en\.", r"[Cc]ol\.", r"[Ll]t\.", r"[Ss]gt\.", r"[Cc]apt\.", r"[Rr]ev\.", r"[Hh]on\.", r"[Ss]t\.", r"[Mm]t\.", r"cf\.", r"e\.g\.", r"i\.e\.", r"vs\.", r"viz\.", r"approx\.", r"incl\.", r"resp\.", r"ca\."),
    "es": _words(r"[Dd]r\.", r"[Dd]ra\.", r"[Ss]r\.", r"[Ss]ra\.", r"[Ss]rta\.", r"[Dd]\.", r"[Dd]ña\.", r"[Uu]d\.", r"[Uu]ds\.", r"[Ii]ng\.", r"[Ll]ic\.", r"p\. ej\.", r"aprox\.", r"[Aa]v\.", r"[Aa]vda\.", r"[Cc]ía\.", r"[Pp]rof\."),
    "de": _words(r"[Dd]r\.", r"[Pp]rof\.", r"Dipl\.", r"Dipl\.-Ing\.", r"Ing\.", r"[Hh]r\.", r"[Ff]r\.", r"[Ff]a\.", r"St\.", r"z\. ?B\.", r"u\. ?a\.", r"d\. ?h\.", r"i\. ?d\. ?R\.", r"z\.", r"u\.", r"d\.", r"s\.", r"v\.", r"i\.", r"bzw\.", r"ca\.", r"vgl\.", r"sog\.", r"ggf\.", r"evtl\.", r"inkl\."),
    "fr": _words(r"M\.", r"MM\.", r"Dr\.", r"Pr\.", r"c\.-à-d\.", r"cf\.", r"env\.", r"p\. ex\.", r"St\.", r"Me\."),
    "ru": _words(r"т\. ?е\.", r"т\.", r"т\. ?к\.", r"г-н\.", r"см\.", r"ср\.", r"им\.", r"напр\.", r"т\. ?н\.", r"проф\.", r"акад\.", r"ул\.", r"гр\.", r"д-р\."),
    "el": _words(r"κ\.", r"κα\.", r"κκ\.", r"π\.χ\.", r"δηλ\.", r"[Ββ]λ\.", r"πρβλ\.", r"[Δδ]ρ\."),
    "ar": _words(r"د\.", r"أ\.", r"م\.", r"ص\.ب\."),
    "hi": _words(r"डॉ\.", r"श्री\.", r"प्रो\.", r"डा\."),
    "th": _words(r"ดร\.", r"ศ\.", r"รศ\.", r"ผศ\.", r"พ\.ศ\.", r"น\.ส\.", r"จ\.", r"อ\.", r"ต\."),
}
#: Abbreviations that go with a number and end no sentence before one.
BEFORE_NUMBER = {
    "en": _words(r"[Nn]os?\.", r"[Ff]igs?\.", r"[Tt]ab\.", r"[Pp]p?\.", r"[Ss]ec\.", r"[Cc]h\.", r"[Vv]ol\.", r"[Aa]rt\.", r"[Ee]q\.", r"Jan\.", r"Feb\.", r"Mar\.", r"Apr\.", r"Jun\.", r"Jul\.", r"Aug\.", r"Sept?\.", r"Oct\.", r"Nov\.", r"Dec\."),
    "es": _words(r"[Pp]ágs?\.", r"[Nn]úm\.", r"[Nn]\.º?", r"[Nn]o\.", r"[Cc]ap\.", r"[Aa]rt\.", r"[Ff]ig\.", r"[Pp]\.", r"[Tt]el\.", r"[Vv]ol\."),
    "de": _words(r"[Nn]r\.", r"[Aa]bs\.", r"S\.", r"Art\.", r"Abb\.", r"Tab\.", r"Kap\.", r"Bd\.", r"Tel\.", r"Ziff\.", r"Aufl\."),
    "fr": _words(r"pp?\.", r"[Nn]\.", r"art\.", r"fig\.", r"chap\.", r"vol\.", r"tél\.", r"al\."),
    "ru": _words(r"с\.", r"стр\.", r"рис\.", r"табл\.", r"гл\.", r"п\.", r"пп\.", r"ст\.", r"тел\.", r"д\.", r"кв\.", r"ч\."),
    "el": _words(r"σελ\.", r"αρ\.", r"άρθρ\.", r"εικ\.", r"πίν\.", r"τηλ\."),
    "ar": _words(r"ص\.", r"ج\."),
    "hi": _words(r"सं\.", r"पृ\."),
    "th": _words(r"หน้า\."),
}
#: German month names, after which no ordinal number ends a sentence.
_MONTHS_DE = "Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
_UPPER = r"[\p{Lu}\p{Lt}]"
_OPEN = r"[(\[{\"'“„‘«‹「『（【《¿¡–—*_#-]"

#: By language, tried in order before the common table.
BY_LANGUAGE = {
    "de": [
        (True, r"(?:u\.\s?[ÄäAa]\.|usw\.|u\.\s?s\.\s?w\.|etc\.|s\.\s?o\.|s\.\s?u\.)", r"\s+\p{Lu}"),
        (False, r"(?:^|\s)\d{1,2}\.", rf"\s+(?:{_MONTHS_DE})\b"),
        (False, r"(?:\b[Ii]m|\b[Aa]m|\b[Dd]e[mnrs]|\b[Dd]ie|\b[Dd]as|\b[Vv]om|\b[Zz]um|\b[Zz]ur|\b[Bb]eim|\b[Jj]ede[mnrs]?)\s+\d{1,3}\.", r"\s+\p{L}"),
    ],
    "es": [(False, r"(?<!\p{L})(?:\p{Lu}{2}\.\s?)+", r"\s*(?:\p{Lu}{2}\.|\p{Ll})"), (False, r"(?<!\p{L})[Nn]\.", r"\s?[ºª°]")],
    "ru": [(False, r"(?:^|\s)\p{Lu}\.", r"\s*\p{Lu}"), (False, r"(?:и|и\s+т)\.", r"\s*[дп]\.")],
    "zh": [(False, rf"{CLOSE}", r"\s*(?:之后|随后|然后|后|等|说|问|道|答|写|称|的|是|和|与|也|就|[（，、；：）——])")],
    "ja": [(False, rf"{CLOSE}", r"\s*(?:[ぁ-ゟ]|[（、：；）])")],
    "hi": [(False, rf"{CLOSE}", r"\s*(?:और|तथा|फिर|पर|ने|कहा|लिखा|बोले|[,;:(])")],
    "ar": [(False, rf"{CLOSE}", r"\s*(?:ثم|و|ف|قال|كتب|[،؛:(])")],
}

#: Thai has no end marks: there, each blank is a candidate as well, and these rules decide it.
THAI_BLANKS = [
    (False, r"(?:ดร\.|ศ\.|รศ\.|ผศ\.|นาย|นาง|นางสาว|คุณ|ของ|ที่|โดย|กับ|และ|หรือ|ใน|จาก|เมือง|พอร์ต|รุ่น|[:;,(/–-])", r""),
    (False, r"", r"\s*+[^ก-๛]"),
    (False, r"\d[%)]?", r""),
    (False, r"(?:ดร\.|ศ\.|รศ\.|ผศ\.|นาย|นาง|คุณ)\s+(?:[\p{Latin}\p{M}'’.-]+\s+)*[\p{Latin}\p{M}'’.-]+", r""),
    (False, r"", r"\s*(?:ๆ|ฯ)"),
    (True, r"[ก-๛\p{L}\p{N})”»]", r"\s*+[ก-๛]"),
]

#: The common table.
COMMON = [
    (False, r"(?:\A|\n)\s*\p{N}+\.", r""),  # a list mark
    (True, r"[。！？｡؟۔।॥？！]" + CLOSE + "*", r""),
    (True, r"(?<=[\p{Lo}])…+" + CLOSE + "*", r"\s*[\p{Lo}\p{Lu}\p{N}]"),
    (True, r"[\p{Ll}\p{N})]{2}[.!?]", r"\p{Lu}\p{Ll}"),  # the blank was left out
    (False, r"", r"\S"),
    (False, r"", r"\s+[,;:)\]}»»…]"),
    (False, r"", r"\s+\p{Ll}"),
    (False, r"(?<![\p{L}\p{N}])[ap]\.\s?m\.", r"\s+(?:\p{N}|\p{Lu}{2})"),
    (False, r"(?<![\p{L}\p{N}.])\p{Lu}\.", r"\s+\p{Lu}"),
    (True, r"[!?…;;]" + CLOSE + "*", r"\s"),
    (True, rf"\.{CLOSE}*", rf"\s+{_OPEN}*[\p{{Lu}}\p{{Lt}}\p{{Lo}}\p{{N}}]"),
    (True, rf"\.{CLOSE}*", rf"\s+{_OPEN}"),
    (True, rf"\.{CLOSE}*", r"\s+[^\p{L}\p{N}]"),
]
