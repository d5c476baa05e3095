import os
import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kstate.llm.leakage import Weights, leaked_items, near_items, sizes
from kstate.llm.lookalikes import Rewriter, canonical_text, look_alike_classes, look_alike_groups, look_alike_pairs
from kstate.llm.sentences import DICTIONARY, PLAIN, Lattices, sentence_units, sentences, spaceless_words


def cut(text):
    return [text[a:b] for a, b in sentences(text)]


CASES = [
    ("Dr. No met J. K. Rowe at 5 p.m. The end.", ["Dr. No met J. K. Rowe at 5 p.m.", "The end."]),
    ("It costs 3.50, i.e. a lot, etc. See notes.24.md for v2.1 please.", ["It costs 3.50, i.e. a lot, etc.", "See notes.24.md for v2.1 please."]),
    ('"We push. They swap," wrote Ann. "Does it?" Yes!', ['"We push. They swap," wrote Ann.', '"Does it?"', "Yes!"]),
    ("He (the quiet one. Not loud) left.It ends?!Now", ["He (the quiet one. Not loud) left.", "It ends?!", "Now"]),
    ("A says: 'Stop! It doubles,' and goes. iRelay runs.", ["A says: 'Stop! It doubles,' and goes.", "iRelay runs."]),
    ("Der 53. Versuch, vgl. Abb. 4 ff., z. B. hier, usw. Am 2. Mai endet er.", ["Der 53. Versuch, vgl. Abb. 4 ff., z. B. hier, usw.", "Am 2. Mai endet er."]),
    ("В 1990 г. ул. Лесная, и т. д. И. К. Петров ждёт.", ["В 1990 г. ул. Лесная, и т. д.", "И. К. Петров ждёт."]),
    ("M. X écrit : « le relais achève. » L’essai n. 4 finit.", ["M. X écrit : « le relais achève. »", "L’essai n. 4 finit."]),
    ("¿La Sra. X va? ¡El Dr. Y y Cía. viene!", ["¿La Sra. X va?", "¡El Dr. Y y Cía. viene!"]),
    ("『鍵を数える！』という札がある。「待つ」と書く。次。", ["『鍵を数える！』という札がある。", "「待つ」と書く。", "次。"]),
    ("牌子写着“顺序！”，他便走了。他写道：“好。”她走了。", ["牌子写着“顺序！”，他便走了。", "他写道：“好。”", "她走了。"]),
    ("ดัชนีปิดกุญแจ สะพานเปิด", ["ดัชนีปิดกุญแจ", "สะพานเปิด"]),
    ("डॉ. राम है। वह गया।", ["डॉ. राम है।", "वह गया।"]),
    ("Τι κάνει; Πάει, π.χ. σπίτι, κ.λπ. Τέλος.", ["Τι κάνει;", "Πάει, π.χ. σπίτι, κ.λπ.", "Τέλος."]),
    ("Title here\n\n- item one. x\r\n\r\nHard\nwrapped line. Next\n", ["Title here", "- item one. x", "Hard\nwrapped line.", "Next"]),
    ("Wait ... or not. See Fig. 3. Then.", ["Wait ... or not.", "See Fig. 3.", "Then."]),
    ("", []), (" \n \n", []), ("...", ["..."]),
]


@pytest.mark.parametrize("text,want", CASES)
def test_sentences(text, want):
    assert cut(text) == want


# Sentences of scripts without spaces, joined without any full stop: what opens, goes on and closes one.
SPACELESS_PARTS = {
    "ja": (["この", "その", "しかし", "それで", "次に", "私は"], ["倉庫が部品を", "何か静かな箱を", "使ったあの鍵を", "記録係の確かな印を"], ["読みました", "閉じます", "待たせるでしょう", "数えますか", "測定しましたね"]),
    "zh": (["我们", "但是", "今天", "这个", "他们", "如果"], ["在酒吧清点了页面", "了解这座仓库", "打开了我的窗口", "合并吉他的清单"], ["吗", "呢", "吧", "啊"]),
}


@pytest.mark.parametrize("words", [PLAIN, "dictionary"])
@pytest.mark.parametrize("between", ["", " ", "\u3000"])
@pytest.mark.parametrize("script", SPACELESS_PARTS)
def test_spaceless_text_without_full_stops(script, between, words):
    if words == "dictionary":
        if not os.path.exists(DICTIONARY):
            pytest.skip("no vocabulary here")
        words = Lattices(spaceless_words(DICTIONARY))
    rng, right, found, true = random.Random(6), 0, 0, 0
    for _ in range(60):
        own = ["".join(map(rng.choice, SPACELESS_PARTS[script])) for _ in range(rng.randrange(1, 9))]
        text, want, at = between.join(own), set(), 0
        for x in own:
            want.add((at, at + len(x)))
            at += len(x) + len(between)
        got = set(sentences(text, words))
        right, found, true = right + len(got & want), found + len(got), true + len(want)
    assert right >= 0.995 * found and right >= 0.995 * true


@pytest.mark.parametrize("text", ["何かこの機械が動きます", "使ったこの機械は古い", "我们去酒吧我请客", "Spark 引擎 数据", "他来了吗\n我们走吧", "「これはです この」と書く。"])
def test_spaceless_text_that_goes_on(text):
    assert cut(text) == [text]


def test_thai_gaps():
    own = ["ดัชนีปิดกุญแจ", "แต่สะพานเปิดหน้า", "ผู้เฝ้านับกล่องครับ", "จากนั้นบัญชีแบ่งแถว"]
    assert cut(" ".join(own)) == own and cut("".join(own)) == ["".join(own)]


def test_sentence_units_of_odd_rows(spark):
    long = "A b c. " * 20_000
    rows = [(1, None), (2, ""), (3, "Hi. You"), (4, long), (5, "(" * 3000 + "a. B"), (3, "Hi. You")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sent_start", F.lit(0))
    got = sentence_units(df).collect()
    assert sum(r.doc_id == 3 for r in got) == 2 and sentence_units(df, dictionary=None).count() == len(got)
    assert sentence_units(df.limit(0)).count() == 0
    assert {(r.sent_start, r.sent_end) for r in got if r.doc_id == 3} == {(0, 3), (4, 7)}
    assert sum(r.doc_id == 4 for r in got) == 20_000 and not any(r.doc_id in (1, 2) for r in got)


SAME = [
    ("café ﬁle", "café file"), ("ｆｕｌｌ－８", "full-8"), ("ユコ", "ﾕｺ"), ("ガ", "ｶﾞ"), ("pаge", "page"), ("a b　c", "a b c"),
    ("w​o­r﻿d", "word"), ("Flidel‑40", "Flidel-40"), ("ﬀi", "ffi"), ("ﬃ", "ffi"), ("Ё", "Ё"), ("ëж", "ёж"), ("νο", "vo"),
]
OTHER = [("Word", "word"), ("café", "cafe"), ("№", "No"), ("a  b", "a b"), ("x…", "x..."), ("👩‍🔧", "👩🔧"), ("क्‍ष", "क्ष"), ("a—b", "a-b"), ("l", "1")]


@pytest.mark.parametrize("freq", [{}, {"а": 9, "о": 9, "－": 9}])
def test_look_alikes(freq):
    r = Rewriter(look_alike_classes(freq))
    for a, b in SAME:
        assert r(a) == r(b), (a, b)
    for a, b in OTHER:
        assert r(a) != r(b), (a, b)
    for a, _ in SAME + OTHER:
        assert r(r(a)) == r(a) and unicodedata.is_normalized("NFC", r(a))


def test_look_alike_pairs(spark):
    rows = [("t", 1, "page"), ("t", 2, "pаge"), ("t", 3, "page"), ("u", 4, "pаge"), ("t", 5, None), ("t", 2, "pаge"), ("t", None, "pаge"), ("t", 6, ""), ("t", 7, "​")]
    df = spark.createDataFrame(rows, "table_name string, unit_no long, text string").withColumn("form", F.lit(1))
    assert {tuple(r) for r in look_alike_pairs(df).collect()} == {("t", 1, 2), ("t", 2, 3), ("t", 6, 7)}
    assert look_alike_pairs(df.limit(0)).count() == 0 and look_alike_groups(df.limit(0)).count() == 0
    assert {tuple(r) for r in look_alike_groups(df).collect()} == {("t", 1, 1, 1), ("t", 2, 1, 2), ("t", 3, 1, 1), ("t", 6, 6, 6), ("t", 7, 6, 7)}
    assert len({r.canonical for r in canonical_text(df.filter("unit_no in (1, 2)").select("text")).collect()}) == 1


def test_leakage(spark):
    words = [f"word{i}" for i in range(30)]
    item = " ".join(words)
    zh = "计数器关闭了栏目樾岑屿皓在等待棣澈泓苓的值守员写道并离开"
    docs = [
        (1, "Intro! " + " ".join(words[5:17]).upper().replace(" ", ", \n**") + " end"), (2, " ".join(words[5:16])), (3, None), (4, ""), (5, "前言" + zh[3:23] + "。"), (6, zh[:19]),
        (7, "x " * 30_000 + item), (8, " ".join(words[3:9] + ["other"] + words[10:20])),
    ]
    items = spark.createDataFrame([(10, "s", "en", item), (11, "s", "zh", zh), (12, "s", "en", "too short"), (13, "s", "en", None), (10, "s", "en", item)], "item_id long, suite string, lang string, text string")
    got = leaked_items(spark.createDataFrame(docs, "doc_id long, text string").withColumn("windows", F.lit(0)), items).filter("exact_windows > 0").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 10), (5, 11), (7, 10)}
    assert leaked_items(spark.createDataFrame([], "doc_id long, text string"), items).count() == 0
    both = leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), items.filter("item_id <> 10")).filter("exact_windows > 0")
    assert {(r.doc_id, r.item_id) for r in both.collect()} == {(5, 11)}


def test_near_items_recall_against_brute_force(spark):
    """Documents with an item edited by substitution, insertion and deletion; truth is every pair of windows at or above the similarity."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(800)]
    items = [(k, [rng.choice(vocabulary) for _ in range(rng.randrange(14, 120))]) for k in range(60)]
    docs = []
    for n in range(240):
        k, body = items[n % 60]
        t = list(body)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(t))
            t[at : at + rng.choice([0, 1])] = rng.choice([[], [rng.choice(vocabulary)]])
        docs.append((n, [rng.choice(vocabulary) for _ in range(rng.randrange(30))] + t + [rng.choice(vocabulary) for _ in range(20)]))
    numbers = Counter(w for _, t in items for w in set(t))
    weights, truth = Weights(numbers, len(items), True), set()
    grid = sizes(12, 120)
    for d, t in docs:
        k, body = items[d % 60]
        n = max(g for g in grid if g <= len(body))
        for theirs in (tuple(body[:n]), tuple(body[-n:])):
            if any(weights.similarity(tuple(t[i : i + n]), theirs) >= 0.8 for i in range(len(t) - n + 1)):
                truth.add((d, k))
    i = spark.createDataFrame([(k, "s", "en", " ".join(t)) for k, t in items], "item_id long, suite string, lang string, text string")
    got = {(r.doc_id, r.item_id) for r in near_items(spark.createDataFrame([(n, " ".join(t)) for n, t in docs], "doc_id long, text string"), i).collect()}
    edited = {(d, k) for d, k in truth if " ".join(items[k][1]) not in " ".join(docs[d][1])}
    assert len(edited) > 60 and len(got & edited) >= 0.9 * len(edited) and len(got & truth) >= 0.9 * len(truth) and got <= {(d, d % 60) for d, _ in docs}
    assert near_items(i.select(F.col("item_id").alias("doc_id"), "text").limit(0), i).count() == 0


@pytest.mark.parametrize("block", [2, 5000])
def test_items_in_blocks_give_the_same(spark, monkeypatch, block):
    from kstate.llm import leakage

    monkeypatch.setattr(leakage, "ITEM_BLOCK", block)
    items = spark.createDataFrame([(k, "s", "en", " ".join(f"a{k}b{i}" for i in range(30))) for k in range(9)], "item_id long, suite string, lang string, text string")
    docs = items.selectExpr("item_id + 100 AS doc_id", "concat('x y ', text, ' z') AS text")
    for find in (leaked_items, near_items):
        assert {(r.doc_id - 100, r.item_id) for r in find(docs, items).filter("exact_windows > 0").collect()} == {(k, k) for k in range(9)}
