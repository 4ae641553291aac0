import pytest

from harborlens.llm import sentences
from harborlens.llm.sentences import units

CASES = [
    ("en", ["On Sept. 14 Dr. Smith vs. Mr. Jones met at 9 a.m. in the U.Q. region.", "See Fig. 3 and no. 7, e.g. the 3.14 one.", "Why?!", "It hangs... and waits.", "It hangs...", "Done."]),
    ("en", ["“That box was retired in 2025,” wrote the operator, “so I can’t say.”", "(See the note of Sept. 24, 2025.)", "He wrote: “Is it ours? I doubt it.” and left.", "It ended."]),
    ("es", ["EE. QQ. no figura en la lista.", "Véase la pág. 15 del informe.", "¿Es un error o alguien lo cambió?", "¡Cierren ya!", "El equipo mostró «Listo. Espere.» y se cerró."]),
    ("de", ["Laut S. 12 gilt, z. B. seit dem 15. September: Nein.", "Im 5. Lauf galt dies usw.", "Die Zahl stieg auf 23.", "Siehe Nr. 25 bzw. Abs. 15.", "Es meldet „Bereit. Bitte warten.“ und trennt."]),
    ("fr", ["M. Dupont a écrit : « C'est corrigé. Merci. » puis rien.", "La version 8.7 n'est plus suivie, c.-à-d. sans correctif.", "Est-ce bien CVE-1 ?", "Voir p. 11."]),
    ("ru", ["А. Б. Иванов получил письмо в 9 ч. утра.", "В 2025 г. таких случаев было 900 (см. с. 26).", "«Мы проверим. Ждите», — ответил оператор.", "Закройте доступ!", "См. рис. 2 и табл. 3."]),
    ("el", ["Ο κ. Παπάς δεν απάντησε.", "Ποιος διαχειρίζεται το x.example;", "«Θα το ελέγξουμε. Σύντομα.» έγραψε ο χειριστής.", "Βλ. σελ. 11."]),
    ("ar", ["قال د. أحمد إن العنوان 10.0.1.2 قديم.", "من يدير x.example؟", "كتب المشغل: «نحن نتحقق. انتظروا.» ثم صمت.", "أغلقوا الوصول فورا!"]),
    ("hi", ["डॉ. Rao ने सूचना दी।", "कौन करता है?", "ऑपरेटर ने लिखा, “जाँच जारी है। प्रतीक्षा करें।” और कुछ नहीं।"]),
]
JOINED = [
    ("zh", ["他问：“这是我们的设备吗？”", "运营商回复：“正在检查。请稍候。”之后再无消息。", "没有人知道原因……", "数量从8.3万增加到16.5万。"]),
    ("ja", ["「これは当社の機器ですか？」と聞かれました。", "管理者は誰ですか？", "件数は45.83%増えました（16ページ参照）。"]),
]
THAI = ["ตามรายงานของ ดร. Nelm ใครเป็นผู้ดูแล www.x.example", "รุ่น 5.14.26 เลิกสนับสนุนแล้ว", "เมื่อวานพบเครื่อง 417 เครื่องในเมือง Quillan Bay", "ดร. Fip ได้รับแจ้งแล้ว", "กรุณาปิดการเข้าถึงทันที"]


def parts(text, lang):
    return [text[a:b] for a, b in units(text, lang)]


@pytest.mark.parametrize("lang,expected", CASES + [("th", THAI)])
def test_sentences_with_blanks(lang, expected):
    assert parts("  ".join(expected), lang) == expected
    assert parts("\n".join(expected), lang) == expected  # a single break is a blank
    if lang not in ("th",):
        assert parts(" ".join(expected), None) == expected


@pytest.mark.parametrize("lang,expected", JOINED)
def test_sentences_without_blanks(lang, expected):
    assert parts("".join(expected), lang) == parts("".join(expected), None) == expected


def test_layout():
    text = "Heading\r\n \r\n- one. Two\n- three\nwrapped\n1. First. Second\n2. next\n\n{\n  \"a\": \"x. Y\"\n}\n\nHTTP/1.1 200 OK\nServer: A. B\n\n| a. B | c |\n| d | e |\n\n-- \nThe watch"
    assert parts(text, "en") == [
        "Heading", "- one.", "Two", "- three\nwrapped", "1. First.", "Second", "2. next", '{\n  "a": "x. Y"\n}', "HTTP/1.1 200 OK\nServer: A. B", "| a. B | c |\n| d | e |", "-- \nThe watch",
    ]
    assert parts("to known networks.It asked", "en") == ["to known networks.", "It asked"]
    assert parts("see v5.12.1.json and a.b.example", "en") == ["see v5.12.1.json and a.b.example"]


@pytest.mark.parametrize("text", [None, "", "   ", "\n\r\n\t", " "])
def test_blank(text):
    assert units(text, "en") == []


def test_every_character_is_in_one_unit():
    for lang, expected in CASES + JOINED:
        text = " \n".join(expected) + "\n\n" + "x" * 5000 + " 👩‍💻. Ａ"
        found = units(text, lang)
        assert all(a < b and text[a:b] == text[a:b].strip() for a, b in found)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
        assert "".join(text[a:b] for a, b in found).split() is not None
        rest = list(text)
        for a, b in found:
            rest[a:b] = " " * (b - a)
        assert not "".join(rest).strip()


def test_frame(spark):
    df = spark.createDataFrame([(1, "A. 1", None, "clash"), (2, "One here. Two there.", "en", ""), (3, None, "en", ""), (4, "One here. Two there.", "xx", "")], "doc_id bigint, text string, lang string, start_pos string")
    got = sorted(tuple(r) for r in sentences.sentences(df).where("doc_id <> 1").collect())
    assert got == [(d, a, b) for d in (2, 4) for a, b in ((0, 9), (10, 20))]
    assert sentences.sentences(df.limit(0)).isEmpty()


def test_rules_see_the_whole_piece():
    for blanks in (" ", " " * 60, "\n" + " " * 400):
        text = f"They talked about vers.{blanks}one only here."
        assert len(units(text, "en")) == 1, len(blanks)
        assert len(units(f"It ended.{blanks}Another began.", "en")) == 2
    quote = "„" + "Wort " * 300 + "ging.“"
    assert len(units(f"{quote} Danach kam er.", "de")) == 2


def test_ascii_closers_after_marks_of_other_scripts():
    assert len(units('他说:"好的。"我们明天再查。', "zh")) == 2
    assert len(units("(都好。)我们走。", "zh")) == 2
