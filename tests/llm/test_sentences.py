import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm.sentences import sentences, split_sentences

# Sentences as lists; the text is their concatenation with the white space that is written.
CASES = [
    ["Mr. Esk of Fenti Ltd. wrote that 4,285 points equal ¥40.98. ", "They close at 6 p.m. ", "No way."],
    ["They close at 6 p.m. on Friday. ", "One guard solved it in 9 sec. flat. ", "Fig. 89 on the leaflet shows the car park."],
    ["The manager came over.", "The parking fee, approx. ¥45 per hr., isn't refunded."],
    ["I waited 25 minutes (really!) before the waiter came. ", "Ask for it (it isn't on the menu)."],
    ['The manager replied, "It is void. Buy another one." ', '"Scan here!" shouted the florist, and everyone laughed. ', '"Did you scan the code?" the hostess asked.'],
    ["Honestly... the pudding tasted sour. ", "My friend T. J. Varnhill liked it 🔥 ", "Loved it! 👍 ", "Why so tiny?!"],
    ["See help.dorbri.example/q?id=8016 for details. ", "After 3.14.33 came 7.14.22!"],
    ["The shop measures 31.64 m by 34.20 m. ", "I left."], ["it was fine. ", "mr. esk came at 5 p.m. on monday. ", "why so late?"], ["IT WAS FINE. ", "MR. ESK CAME. ", "WHY?"],
    ["客服问：“带了吗？没带也行。”", "（顺便说一句，很难停车。）", "“下次再来！”收银员笑着说。", "真的寡淡！！！", "怎么又失效了？！", "好评❤️！", "推荐豆花🔥。"],
    ["客服回复：“请重试。不行再打电话。”，就这水平。", "等了35分钟才上……不过确实干净。", "详情见help.a.example/shop.html?id=1。", "《攻略》里写的没有了。"],
    ["友人は「クーポンは使えますか。」と聞いた。", "「もうない！」と店長が言った。", "また行きたい……❤️。", "冷やしうどん（限定）は熱々だった。"],
    ["La encargada dijo: «Vuelva el lunes. Hoy no hay sopa.» ", "El Dr. Zafrín pidió 18 raciones de paella... ", "¡Qué rica! ", "Está en la Av. Alcorbe, núm. 20."],
    ["« La soupe est finie. Revenez lundi. », dit la patronne. ", "Quelle quiche salée ! ", "Mme Aubrelin attend depuis 67 min. devant la mairie… ", "Où est-elle ?"],
    ["„Die Suppe ist aus!“, rief die Chefin. ", "Die Torte war kalt, z. B. am 3. Oktober. ", "Frau Dr. Aschenau wohnt Nr. 13 am Hafen."],
    ["हमने 22.43 रुपये दिए। ", "डॉ. शर्मा आए। "], ["قال الموظف: «أحضر النقاط. ثم ادفع.» ", "انتظرنا 12 دقيقة... عند الجسر. ", "هل النقاط صالحة؟"],
    ["รอคิว93นาทีกว่าจะได้ขนมครก ", "แอปเวอร์ชัน7.1.2ค้างบ่อย ", "ราคา2.11บาทถือว่าคุ้ม"], ["下次还来吃炸鲜奶　", "抽奖码用不了　", "哈哈绝了🔥"],
    ["退款说明\n\n", "1. 打了85个电话。\r\n", "(2) 第二条。\n", "用户：好评！", "真的。\n", "- 一条"], ["User: Yes.\n", "Agent: No. ", "Sorry."], ["﻿", "你好。", "再见。"],
]


@pytest.mark.parametrize("parts", CASES)
def test_case(parts):
    text, want, at = "".join(parts), [], 0
    for p in parts:
        a = at + len(p) - len(p.lstrip("﻿ \n"))
        b = at + len(p.rstrip())
        at += len(p)
        if p != "﻿":
            want.append((a, b))
    got = split_sentences(text)
    assert [text[a:b] for a, b in got] == [text[a:b] for a, b in want]


def test_wrapped_and_not():
    words = "The parking fee, approx. ¥45 per hr., isn't refunded. Mr. Esk of Fenti Ltd. wrote that 34,083 points equal ¥35.31. Ask for the egg tart (it isn't on the menu). On Friday the cook handed out 19 vouchers, which surprised the dishwasher and me."
    line, lines = "", []
    for w in words.split():
        if len(line) + len(w) > 60:
            lines.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    text = "\n".join([*lines, line])
    assert len(split_sentences(text)) == len(split_sentences(words)) == 4
    assert len(split_sentences("waited 3 min\ndumplings tiny\nwhere is my refund")) == 3


def test_nothing_and_symbols():
    assert [split_sentences(t) for t in (None, "", " \n\t", "﻿", "　")] == [[]] * 5
    assert split_sentences(" —!? \n…") == [(1, 7)] and split_sentences("👍👍") == [(0, 2)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aB1. !?。！？“”「」()（）\"\n\r\t　👍‍…、,:：用ไท้'«»-")), max_size=60))
def test_invariants(text):
    spans = split_sentences(text)
    assert all(a < b and text[a:b].strip(" \n\r\t　") == text[a:b] for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    left = "".join(text[a:b] for a, b in zip([0] + [b for _, b in spans], [a for a, _ in spans] + [len(text)]))
    assert left.strip() == ""  # nothing but white space is left out


def test_long_text():
    text = "It was fine. “Open " + "No end here (yet. " * 20_000
    spans = split_sentences(text)
    assert spans[0] == (0, 12) and spans[-1][1] == len(text.rstrip())


def test_frame(spark):
    df = spark.createDataFrame([(1, "Ab cd. Ef gh."), (2, None), (3, ""), (4, " "), (5, "?!"), (None, "x")], "doc long, body string").withColumn("text", F.lit("clash"))
    got = sorted(map(tuple, sentences(df, "doc", "body").collect()), key=str)
    assert got == [(1, 0, 6), (1, 7, 13), (5, 0, 2), (None, 0, 1)] and sentences(df.limit(0), "doc", "body").count() == 0


def test_many_marks_inside():
    for n in (61, 200, 9_000):
        line = "The readings were " + ", ".join(f"{k % 90}.{k % 7}" for k in range(n)) + " in all. The next one failed."
        assert [line[a:b] for a, b in split_sentences(line)] == [line[:-21], line[-20:]]
    line = "He noted " + "approx. five, " * 80 + "and left. She stayed."
    assert [line[a:b] for a, b in split_sentences(line)] == [line[:-12], line[-11:]]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("aB1. !?。！？“”「」()（）\"👍…、,用'«»-")), max_size=120), st.integers(1, 4))
def test_reach_changes_nothing(text, reach):
    from tidewell.llm import sentences as sentence_module

    usual = sentence_module.REACH
    try:
        sentence_module.REACH = 10_000
        want = split_sentences(text)
        sentence_module.REACH = reach
        assert split_sentences(text) == want
    finally:
        sentence_module.REACH = usual


@pytest.mark.parametrize("o,c", ["“”", "「」", "()", "（）", "«»", '""'])
@pytest.mark.parametrize("n", [10, 30, 800])
def test_long_pairs_hold(o, c, n):
    line = f"Before it. He noted {o}" + "The tea was cold. " * n + f"We left{c} and sat down. After it."
    assert [line[a:b] for a, b in split_sentences(line)] == ["Before it.", line[11:-10], "After it."]


def test_long_unbalanced_pairs_do_not_hold():
    filler = "The tea was cold. " * 40
    for line in ("He noted “one thing. " + filler + "Done.", 'A 5"x7 print. ' + filler + 'He said "no" to it.', "It (was. " + filler + "\n\nSo it) was. Done."):
        assert len(split_sentences(line)) > 40
