import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01
from helpers import awkward, empty
from mdmspark.llm import line_cleaning as lc


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    five = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, inside, seen, dup = Counter(five), set(), set(), 0
    for i, w in enumerate(five):
        if times[w] > 1:
            inside.update(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


@settings(max_examples=400)
@given(st.text(alphabet=st.sampled_from("ab\n \t\x0b\x1c#|é"), max_size=200))
def test_measures_equal_brute_force(text):
    assert lc.judge(text)[:6] == brute(text)


def test_lines():
    def fails(line):
        return lc.line_fails(line, line.encode().split())

    assert fails("An ordinary sentence stands here.") is None
    assert fails("Buy*** now$$$ here###") == "symbols"
    assert fails("— … !") == "no_letters"
    assert fails("BUY!! THIS!! NOW!!") == "shout"
    assert fails("Home · News · About us · Contact") == "separators"
    assert fails("Login") == "stub" and fails("Yes.") is None
    assert fails("All Rights Reserved.") == "boilerplate"
    assert fails("He said that all rights reserved to the crown were " + "given away, " * 20) is None


def test_removal_and_verdict():
    good = "This line is a plain sentence with a number of words."
    more = "Another one follows it, and it says quite different things altogether."
    verdict = lc.judge(f"{good}\nHome · News · About us\n\n{more}")
    assert verdict[6:] == (1, 6, True, f"{good}\n\n{more}")
    assert not lc.judge(good + "\n" + "BUY!! THIS!! NOW!! " * 9)[8]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = lc.clean_lines(docs, with_text=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        if not r.n_bad_lines:
            assert r.clean_text == texts[r.doc_id]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    bad = [r for r in rows if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in bad) <= 0.05 * len(bad)
    kept = lc.keep_clean(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()} == {r.doc_id: (r.clean_text, len(r.clean_text)) for r in rows if r.kept}


def test_awkward_rows(spark):
    rows = lc.clean_lines(awkward(spark), with_text=True).collect()
    assert len(rows) == 11
    assert all(not r.kept and r.base_failed and r.n_words == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert [r.clean_text for r in rows if r.doc_id == 4] == [None]
    assert sorted(r.doc_id or 0 for r in lc.keep_clean(awkward(spark)).collect()) == sorted(r.doc_id or 0 for r in rows if r.kept)
    assert lc.clean_lines(empty(spark)).count() == 0 and lc.keep_clean(empty(spark)).count() == 0


SCRIPTS = {
    "Chinese": ["今天天气很好，我们一起去公园散步。", "他说他明天会来看我们！", "这本书是谁写的？", "图书馆里有很多有意思的书，值得一读再读", "老师问：“你们都明白了吗？”"],
    "Japanese": ["今日はとても天気がいいです。", "駅まで歩いて十分ぐらいかかります。", "「また明日来ます」と彼は言った。", "この本はとても面白いので、もう一度読みたい"],
    "Hindi": ["मौसम अच्छा।", "वह आया।", "बच्चे खेलते हैं और शिक्षक पढ़ाते हैं।", "किताब पढ़ो॥", "आज हम सब मिलकर बाज़ार जाएँगे।"],
    "Arabic": ["هل أنت؟", "الطقس جميل اليوم في المدينة.", "من هناك؟", "ذهب الولد إلى المدرسة ثم عاد إلى البيت۔"],
    "Thai": ["วันนี้อากาศดีมาก", "เขาไปโรงเรียนแล้วกลับบ้าน", "หนังสือเล่มนี้น่าสนใจ"],
}
JUNK = {"menus": ["首页 | 新闻 | 联系 | 登录", "ホーム > 製品 > 案内", "होम | समाचार | संपर्क", "الرئيسية | أخبار | اتصل"], "stubs": ["登录", "次", "होम", "اتصل", "更多", "Home", "ต่อ"]}


def test_clean_documents_of_other_scripts_stay_and_their_junk_goes():
    for script, lines in SCRIPTS.items():
        # Different enough lines that no window of words repeats.
        text = "\n".join(f"{line}" for line in lines * 1) + "\n" + "\n".join(f"{line[:-1]} {i} {line[-1]}{line[-1]}" for i, line in enumerate(lines * 6))
        verdict = lc.judge(text)
        assert verdict[6] == 0, (script, [line for line in text.split("\n") if lc.line_fails(line, line.encode().split())])
    for script, lines in SCRIPTS.items():
        for line in lines:
            assert lc.line_fails(line, line.encode().split()) is None, (script, line)
    for kind, lines in JUNK.items():
        for line in lines:
            assert lc.line_fails(line, line.encode().split()) is not None, (kind, line)


def test_thirty_clean_lines_of_chinese_and_hindi_are_kept():
    chinese = "\n".join(f"第{i}天，{'风雨雪云雷'[i % 5]}很大，大家都在家里。" for i in range(30))
    hindi = "\n".join(f"मौसम{chr(0x915 + i)} अच्छा{chr(0x915 + i)}।" for i in range(30))
    assert lc.judge(chinese)[8] and lc.judge(hindi)[8]
