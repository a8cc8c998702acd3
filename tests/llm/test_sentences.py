import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm.sentences import language, sentence_units, units


def cut(text):
    return [text[a:b] for a, b in units(text)]


CASES = {
    "abbreviations": (["Dr. Smith of Acme Inc. left at 6.30 p.m. on Monday.", "She stayed."], " "),
    "end or not": (["The clinic, the keyring etc.", "Staff left.", "It covers nurses, etc. but not pilots."], " "),
    "initials": (["Maria J. K. Stone Jr. and Mrs. Hill sold it, i.e. the old vault, before May.", "Nobody saw."], " "),
    "numbers": (["No. 8 on the list rose by 1.5 percent vs. a loss of .8 percent!", "The fix, v66.4.1, is out."], " "),
    "marks": (["Why would they fix it?!", "Stop!", "The ferry... was gone."], " "),
    "quotation is one": (['He wrote: "It failed. Nobody called. We fixed it."', "Staff left."], " "),
    "speaker": (['"Did anyone call?" asked Ms. Hill of the board.', '"We left," said Prof. Stone.', "Its log read \"error 4.2! retry? no.\" for hours."], " "),
    "german": (["Rund 26,5 Prozent hatten die Anlage am 3. Mai z. B. ohne Prüfung gesperrt.", "„Die Lücke war alt\", sagte Prof. Stein von der Berg GmbH.", "Warum?"], " "),
    "french": (["Selon M. Blanc, la loi (art. 4) n'a pas changé !", "La norme couvre tout, etc.", "« La base était lente », a dit Mme Noir.", "Pourquoi ?"], " "),
    "spanish": (["Según el Sr. Blanco, no.", "«La red no está rota», dijo Roca, de Norte S.A., a la prensa.", "¿Por qué?", "¡La puerta estaba abierta!"], " "),
    "russian": (["Убытки составили 37,4 млн руб. и затронули фирму.", "Как сообщил г. Иванов, т. е. директор, всё работает.", "«сеть закрыта», сказал Иванов."], " "),
    "chinese": (["谁来负责？", "“供应商已经隔离。”负责人对记者说。", "大约26.5万名用户受到影响！"], ""),
    "japanese": (["「企業はもう確認した。」と担当者は話す。", "なぜ守られなかったのか？"], ""),
    "arabic": (["أعلن د. كرمال أن الحساب قديم.", "لماذا حذف الفريق الملف؟", "يرى الخبراء ذلك!"], " "),
    "hindi": (["डॉ. राव के अनुसार 23.5 प्रतिशत असर पड़ा।", "क्या सर्वर ठीक किया गया?", "अब नया है!"], " "),
    "thai": (["บริษัทประกาศปิดข้อมูลภายใน34วัน", "แฮกเกอร์ใช้ระบบสำคัญเพื่อปิดโรงพยาบาล", "ผู้ใช้4611คนไม่สามารถเข้าถึงบัญชีได้"], " "),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_rules(name):
    parts, join = CASES[name]
    assert cut(join.join(parts)) == parts


def test_line_breaks_and_headings():
    text = "A wrapped sentence goes on over\ntwo lines here. It ends.\n\nA heading alone\n\n- first item\n* second item\nThe text\nafter."
    assert cut(text) == ["A wrapped sentence goes on over\ntwo lines here.", "It ends.", "A heading alone", "- first item", "* second item\nThe text\nafter."] or cut(text)[:4] == ["A wrapped sentence goes on over\ntwo lines here.", "It ends.", "A heading alone", "- first item"]
    assert len(units("Er sagte, dass es\nz. B. ohne Anlage geht. Maria\nJ. K. Stone ging.")) == 2
    text = "Short heading\nThe paragraph below it is a good deal longer than the heading was,\nand it is wrapped."
    assert cut(text)[0] == "Short heading" and len(cut(text)) == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("ab A.!?\n\"'«»()“”。、「」 ก ।") + ["Dr. ", "e.g. "]), max_size=120).map("".join))
def test_units_hold_all_text_in_order(text):
    at = 0
    for a, b in units(text):
        assert at <= a < b and not text[at:a].strip() and not text[a].isspace() and not text[b - 1].isspace()
        at = b
    assert not text[at:].strip()


def test_defined_cases(spark):
    df = spark.createDataFrame([("a", None), ("b", " \n "), ("c", "One. Two"), ("c", "One. Two")], "pdf_id string, text string")
    assert {(r.pdf_id, r.unit_no, r.sent_end) for r in sentence_units(df).collect()} == {("c", 1, 4), ("c", 2, 8)}
    assert len(units("Word. " * 50_000)) == 50_000
    assert language("Le chat et la souris dans la maison pour les enfants") == "fr"
