import pytest

from trailmart.llm.sentences import find_sentences, sentences


def cut(text):
    return [" ".join(text[a:b].split()) for a, b in sentences(text)]


@pytest.mark.parametrize(
    "parts",
    [
        ["The rate is 237.36 per night, approx. 9.3 km from the station.", "Not yet."],
        ["The folder arrived at 5 p.m.", "Is it open?"],
        ["We arrive on Oct. 4 at 9 p.m. by train.", "Thanks!"],
        ["The folder arrived at 5 p.m.", "ok with me."],
        ["We leave St. Orvel at 3:54 a.m.", "iPads show it."],
        ["Please pay Quarsk & Co. before Nov. 23, i.e. before the audit.", "The U.K. branch of Belcor Ltd. checked it today."],
        ["The invoice of 3,572.52 goes to Tindra Inc.", "18 guests are confirmed."],
        ["We met in Lindal Sq. No. 41, next to Olvenne Lodge.", "Dr. Yskdrazel asked for room no. 16."],
        ['"Is it still free?" asked L. Golpem.', '"Who sent it?! I did not," wrote B. Mor.', "Really?!"],
        ["They replied: “We never sent it.”", "Between 8:00 and 5 p.m. nobody measured it; later K. Golhultho left."],
        ["(The receipt is out of order.)", "See https://a.example/r/zel.html?id=739.0&p=a.b for it."],
        ["Stop... the dataset is strange!", "Wait...", "Rows 1 to 2 of dest.v3.tar.gz were lost."],
        ["Nice work 🙂", "What a table 👩‍👧!", "Nice work ✈️", "ok with me."],
        ["Am Di., den 9.3., wurde die Rechnung über 5.938,50 Euro bezahlt.", "Wir kommen z. B. am 1.11. gegen 3 Uhr an.", "Das Bad im 2. Stock ist zu."],
        ["„Ist das Zimmer noch frei?“, fragte Narka.", "Siehe Abb. 15 in train.v3.csv usw.", "Nr. 64 fehlt."],
        ["« Il reste une clé ? » demanda Kanar.", "M. Fasov et Mme Dradra arrivent le 8 mars à 10 h.", "Quel dommage !"],
        ["«¿Hay desayuno?», preguntó Daka.", "Véase la pág. 57 del informe a.csv.", "Ud. debe firmar aquí."],
        ["«Есть ли завтрак?» — спросила Mika.", "Номер стоит 58,80 руб. за ночь.", "Г-н Ibeta живёт на ул. Садовой, д. 61.", "Спасибо!"],
        ["وصل د. Fabri أمس مساء.", "هل الغرفة 17 متاحة؟", "قالت: «سنصل غدا.»", "شكرا جزيلا!"],
        ['"नाश्ता मिलेगा?" Pemzel ने पूछा।', "डॉ. Brifane कल आएँगे।", "धन्यवाद!"],
        ["ห้องพักราคา 229.14 ยูโรต่อคืนครับ", "รถไฟไปเมือง Tindra ออกเวลา 7:31 น. ตรงเวลาครับ", "ขอบคุณมากค่ะ"],
    ],
)
def test_sentences_with_spaces(parts):
    text = " ".join(parts)
    assert cut(text) == [" ".join(p.split()) for p in parts]


@pytest.mark.parametrize(
    "parts",
    [
        ["担当者は「明日返事します。」と言いました。", "請求書（第16号。写し）を送りました。", "鍵が見つかりません……困りました。", "本当ですか！？", "「満室ですか？」とOsdaさんに聞かれました。"],
        ["经理说：“可以。”然后挂了电话。", "他说：“我们明天出发。”", "“还有空房吗？”客人问道。", "钥匙不见了……我们还在找。", "开往St. Orvel的火车4:41出发；请提前到站。", "真的吗？！"],
        ["It comes later.", "Write to a.b@c.example or call."],
        ["It goes to Belcor Ltd.", "We met there."],
    ],
)
def test_sentences_without_spaces(parts):
    assert cut("".join(parts)) == parts


def test_mail_structure():
    text = (
        "From: A <a@b.example>\r\nContent-Type: multipart/mixed;\r\n boundary=\"=_x\"\r\n\r\nNot this.\r\n--=_x\r\nContent-Type: text/plain\r\n\r\nHi you,\r\n\r\n"
        "> One is\r\n> long. Two\r\n>> three\r\n\r\n-----Original Message-----\r\nFrom: x\r\n\r\n1. A thing.\r\n\r\n-- \r\nName\r\n--=_x\r\nContent-Type: text/html\r\n\r\n<p>No.</p>\r\n"
        "--=_x\r\nContent-Type: text/plain\r\nContent-Transfer-Encoding: base64\r\n\r\nAAAA\r\n--=_x--\r\nNor this.\r\n"
    )
    found = [text[a:b] for a, b in sentences(text)]
    assert found == ["Hi you,", "One is\r\n> long.", "Two", "three", "1. A thing."]


@pytest.mark.parametrize("text", [None, "", " \n\t\r\n", "From: a\nTo: b", "Content-Type: text/html\n\nHi.", "--\nX", "=====\nno\n", "Content-Type: multipart/mixed\n\nx"])
def test_nothing_to_find(text):
    assert sentences(text) == []


def test_damage_and_length():
    assert cut('He said "no. And left.') == ['He said "no.', "And left."]
    assert cut("Elle dit (oui. Non.") == ["Elle dit (oui.", "Non."]
    assert cut("â€žIst es frei?â€œ, fragte Mor.") == ["â€žIst es frei?â€œ, fragte Mor."]
    long = "This is one sentence of many. " * 20_000
    assert len(sentences(long)) == 20_000
    assert len(sentences("x" * 300_000)) == 1
    assert len(sentences('"' * 5001 + "(" * 5000)) == 1


@pytest.mark.parametrize(
    "text, parts",
    [
        ("1. Check the key.\n2. Call the hotel.", ["1. Check the key.", "2. Call the hotel."]),
        ("1. Check the key. 2. Call the hotel.", ["1. Check the key.", "2. Call the hotel."]),
        ("1. Keys\n2. Towels", ["1. Keys", "2. Towels"]),
        ("1.2. Scope\n1.3. Terms and\nmore\n2. Rest", ["1.2. Scope", "1.3. Terms and more", "2. Rest"]),
        ("Please do:\n1. Check it.\n  a) now\n  b) or later\n2. Call.", ["Please do:", "1. Check it.", "a) now", "b) or later", "2. Call."]),
        ("(i) One.\n(ii) Two.\n(iii) Three", ["(i) One.", "(ii) Two.", "(iii) Three"]),
        ("i. One. It is.\nii. Two.", ["i. One.", "It is.", "ii. Two."]),
        ("9. Nine\n10. Ten\n12. Not the next. So.", ["9. Nine", "10. Ten 12.", "Not the next.", "So."]),
        ("Call ext.\n47. The hotel answers.", ["Call ext. 47.", "The hotel answers."]),
        ("1. Call ext.\n2. The hotel answers.", ["1. Call ext. 2.", "The hotel answers."]),
        ("We met\nA. Golpem and\nB. Mor.", ["We met A. Golpem and B. Mor."]),
        ("We pay for room\n1. The other is free.", ["We pay for room 1.", "The other is free."]),
        ("Please buy: 1. Milk. 2. Eggs.", ["Please buy: 1. Milk.", "2. Eggs."]),
        ("We met. 1. Milk. 2. Eggs", ["We met.", "1. Milk.", "2. Eggs"]),
        ("We chose: 1. The rest waits.", ["We chose: 1.", "The rest waits."]),
        ("How many?\n5. And you?", ["How many?", "5.", "And you?"]),
    ],
)
def test_list_levels(text, parts):
    assert cut(text) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["Ask Gov. Smith and Sen. Brown today.", "Ing. Rossi left.", "The senator met the gov.", "He knows."],
        ["Zie blz. 5 voor meer.", "Dank.", "Hmm.", "Thx.", "See Bldg. Four.", "Open the PDF.", "It is here."],
        ["Hrn. Weber schrieb z.Hd. Frau Mor.", "Er mag das Gem.", "Ja."],
        ["Il Sig. Mor e il Dott. Fago arrivano.", "Sì.", "Si veda pagg. 3 e 4."],
        ["Use a.toString or iPad.", "eBooks help.", "ok then.", "mRNA is old."],
        ["Она живёт на ул. Мира.", "Дом стар.", "См. рис. 5."],
        ["قال د. مور ذلك.", "نعم.", "هل هذا صحيح؟", "لا!"],
        ["यह सही है।", '"क्या?" मोर ने कहा।', "हाँ।"],
    ],
)
def test_abbreviations_and_what_only_looks_like_them(parts):
    assert cut(" ".join(parts)) == parts


def test_many_items():
    assert len(sentences("".join(f"{i % 999 + 1}. Item\n" for i in range(20_000)))) > 19_000
    assert len(sentences("1. Keys.\na) Towels.\n" * 5_000)) == 10_000


def test_table(spark, data):
    df = spark.createDataFrame([(1, "One two. Three.", "z"), (1, "One two. Three.", "z"), (2, None, "z"), (None, "Hi.", "z")], "doc_id long, text string, start_char string")
    rows = sorted(map(str, ((r["doc_id"], r["start_char"], r["end_char"]) for r in find_sentences(df).collect())))
    assert rows == sorted(map(str, [(1, 0, 8), (1, 9, 15), (1, 0, 8), (1, 9, 15), (None, 0, 3)]))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in find_sentences(docs).collect():
        piece = texts[r["doc_id"]][r["start_char"] : r["end_char"]]
        assert piece and piece == piece.strip()
