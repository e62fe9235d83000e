"""The operators over text: defined results for nulls, empty and long texts, repeats, clashing columns and empty tables,
and the whole operators against brute force."""

import ast
import collections
import difflib
import random
import re
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import leaks, lookalike, neardup, pairs, sentences, syntax, tokenize, truncated
from millrace.llm.datasyntax import json_errors, toml_errors
from millrace.llm.jssyntax import js_errors
from millrace.llm.pysyntax import python_errors

# 1


PARTS = [
    ["Dr. Orvane saw 3.5 of e.g. map.py.", "It broke!", "Why?"],
    ["J. R. Ostrel asked us.", "On v0.3.9 it took 27.3 s, not 20.1 s.", "Go."],
    ["Der 7. Zweig hält.", "Manche Teile, z. B. kilo, bleiben."],
    ['"Stop it. Keep that," the log said.', "Done."],
    ['It failed with "broken router: x!" and then went on.', "Next."],
    ["«Где шлюз? Вот порядок!» — сказал д-р Орван.", "Часть шагов, т. е. узел, заняла 27,8 с.", "Здесь уже нет."],
    ["¿Por qué?", "¡No toques!", "El Sr. Tassil tardó 5.1 s, pág. 72.", "Fin."],
    ["A heading, vol. 4", "Then text\nthat wraps."],
    ["“骨架已经平稳了！”记录者说，始末仍需扶持。", "他问：“可以吗？不必。”", "此处偏于急躁？！"],
    ["《夏星篇》云“风实而土制。”，又云“石影降静。”", "泉虚而金生。"],
    ["「手順は良いか。部品も直す。」と師は言った。", "gate.pyの門番（節目を含む。）を見守るべきだ。"],
    ["यह ठीक है।", "डॉ. ओरवेन ने कहा।"],
    ["هل الفصل قبل النافذة؟", "هذا البوابة فارغ الآن."],
]
# more of the same kinds, so that tokens are seen at the ends of paragraphs and elsewhere
MORE = {
    "en": ["Mr. Tassil went home again.", "It took 12 s.", "See fig. 3 and vol. 4, please.", "We asked Dr. Varn vs. the log.", "Ms. Q. Varn saw the gate.", "Prof. Keld asked us, i.e. the two of us, to stop.", "The gate is stable.", "Run 7 took 3.5 s.", "It is (no. 7) late.", "It got 399.", "Nobody saw it!", "Is it so?", 'He said "it broke: no!" and left.', "Keep map.py again.", "J. R. Ostrel went home.", "Cf. the log, e.g. map.py.", "It rose approx. 7 points.", "(It was late.) We went."],
    "de": ["Der 3. Rahmen ist alt.", "Am 11. Zweig hält er.", "Das dauert 3,5 Sekunden bzw. zwei.", "Manche, z. B. kilo, bleiben.", "Der Rahmen ist neu.", "Jeder 5. Zweig bleibt.", "Er wog 12 kilo.", "Es sind 40."],
    "ru": ["Здесь узел, т. е. порядок, уже был.", "Часть заняла 3,5 с.", "Шаг занял 7 с.", "Шлюз, т. е. узел, стоит.", "«Где он? Вот!» — сказал д-р Орван.", "Его видел д-р Орван."],
    "es": ["El Sr. Tassil habló.", "La Dra. Keldra dice algo.", "Tardó 5.1 s, pág. 12.", "¿Por qué no?", "El marco es nuevo.", "Es la pág. 7 y la pág. 9."],
    "zh": ["他云“可以。”，又云“不必。”", "“可以！”先生曰，水归木急。", "此处偏于急躁。", "怎样保留？", "他说：“不必。”", "木散木厚！", "（另见一条。）", "由于清楚……所以慢。"],
    "ja": ["「良いか。直す。」と師は言った。", "部品を直す。", "門番（節目を含む。）を見守る。", "流れを比べる！"],
    "hi": ["यह ठीक है।", "डॉ. ओरवेन ने कहा।", "डॉ. ओरवेन यहाँ है।", "यह नई है।"],
    "ar": ["هذا البوابة فارغ الآن.", "هل الفصل قبل النافذة؟"],
}


@pytest.fixture(scope="module")
def boundaries():
    rnd = random.Random(3)
    texts = []
    for lang, known in MORE.items():
        for _ in range(400):
            sep = "" if lang in ("zh", "ja") else " "
            texts.append(rnd.choice(["\n\n", sep]).join(sep.join(rnd.choice(known) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(1, 3))))
    texts += ["金燥水明　木润水刚 风厚", "แผนงาน\nใช้เวลา 2.4 นาที แล้ว", "凡木也夫水矣"] * 20
    return sentences.train(texts)


def cut(text, model):
    out, at = [], 0
    for e in sentences.sentence_ends(text, model):
        out.append(text[at:e].strip())
        at = e
    return out


@pytest.mark.parametrize("parts", PARTS)
def test_sentences(parts, boundaries):
    sep = "\n\n" if parts[0].startswith("A heading") else "" if re.search("[一-鿿]", parts[0]) else "  "
    assert cut(sep.join(parts), boundaries) == parts


def test_the_boundary_model_decides(boundaries):
    """Without the model, or with one that was shown no stops of abbreviations, boundaries get wrong."""
    text = "Dr. Orvane saw Mr. Tassil. It broke, e.g. twice. Der 7. Rahmen hält. He saw (no. 7) it."
    right = ["Dr. Orvane saw Mr. Tassil.", "It broke, e.g. twice.", "Der 7. Rahmen hält.", "He saw (no. 7) it."]
    assert cut(text, boundaries) == right
    yes, no = boundaries.weights.copy(), boundaries.weights.copy()
    yes[sentences._index(["bias"])] += 1000
    no[sentences._index(["bias"])] -= 1000
    assert len(cut(text, boundaries._replace(weights=yes))) > 7 and cut(text, boundaries._replace(weights=no)) == [text]
    blind = boundaries._replace(ends={})
    assert cut(text, blind) != right  # the statistics of tokens count
    assert cut("Die Zrg. Orvane sah es. Es ging.", boundaries._replace(ends={**boundaries.ends, "zrg": (400, 0)})) == ["Die Zrg. Orvane sah es.", "Es ging."]  # no list knows it


def test_sentences_in_linear_time(boundaries):
    import time

    def seconds(n):
        text = "Dr. Orvane saw “it. Go on” twice (see it.) again! " * n
        began = time.perf_counter()
        assert len(sentences.sentence_ends(text, boundaries)) >= n
        return time.perf_counter() - began

    seconds(100)
    assert seconds(8000) < 16 * max(seconds(1000), 0.02)


def test_sentences_without_stops(boundaries):
    cut = lambda text: globals()["cut"](text, boundaries)
    assert cut("金燥水明　木润水刚 风厚") == ["金燥水明", "木润水刚", "风厚"]
    assert cut("แผนงาน\nใช้เวลา 2.4 นาที แล้ว") == ["แผนงาน", "ใช้เวลา 2.4 นาที", "แล้ว"]
    assert cut("凡木也夫水矣") == ["凡木也", "夫水矣"]
    assert cut("no stop here\nnor here") == ["no stop here\nnor here"]
    assert cut(" \n ") == [] and cut("") == [] and cut("。") == ["。"]


def test_sentences_of_a_table(spark):
    df = spark.createDataFrame([(1, "Ab cat. Cd dog.", None, "x"), (1, "Ab cat. Cd dog.", None, "x"), (2, "", " ", "x"), (3, None, "好。" * 20000, "x")], "point_id long, original_text string, b string, id string")
    out = sentences.sentences(df, "point_id", ["original_text", "b"])
    rows = collections.Counter((r.id, r.field) for r in out.collect())
    assert rows == {(1, "original_text"): 2, (3, "b"): 20000}
    assert sentences.sentences(df.limit(0), "point_id", ["original_text"]).count() == 0


# 2


def test_lookalikes(spark):
    p = spark.createDataFrame([(1, "Note 3 fi é 木"), (2, "note 3"), (3, ""), (4, None), (5, "x²")], "id long, text string")
    odd = ["Nоte 3 ﬁ é ⽊", "Ｎｏｔｅ ３ f​i é 木", "Note 3 fi e 木", "Note 3 fi é 木", "note 3", "x2", "", None]
    r = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(odd)] + [(0, odd[0], "clash")], "id long, text string, form string")
    assert {tuple(x) for x in lookalike.same_look(p, r).collect()} == {(1, 0), (1, 1), (2, 4)}
    assert lookalike.same_look(p.limit(0), r).count() == 0
    c = {x.id: (x.canonical, x.members, x.changed) for x in lookalike.canonical(r, "id", "text").collect()}
    assert c[0][1] == 3 and c[0][0] == c[1][0] == c[3][0] and c[2][1] == 1 and 7 not in c


def test_lookalikes_of_kana_and_a_hot_class(spark, monkeypatch):
    monkeypatch.setattr(lookalike, "HOT_BLOCK", 8)
    p = spark.createDataFrame([(1, "入口在工二力"), (2, "カタログ"), (3, "入口在工二力")], "id long, text string")
    r = spark.createDataFrame([(i, "入ロ在エニカ") for i in range(100)] + [(200, "力夕口グ"), (201, "ｶﾀﾛｸﾞ"), (202, "入口在工二刀")], "id long, text string")
    got = [tuple(x) for x in lookalike.same_look(p, r).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, i) for a in (1, 3) for i in range(100)} | {(2, 200), (2, 201)}


def test_fold_table_keeps_what_shows():
    t = lookalike.fold_table()
    for c in "²³¹⁰⁴½①éñ“”":
        assert ord(c) not in t
    assert all(len(v) <= 20 for v in t.values())
    assert "ｶﾞ".translate(t) == unicodedata.normalize("NFD", "ガ").translate(t)


# 4


def test_python_against_the_own_parser():
    import glob
    import os

    rnd = random.Random(5)
    paths = sorted(glob.glob(os.path.join(os.path.dirname(ast.__file__), "*.py")))
    for path in rnd.sample(paths, 25):
        text = open(path, encoding="utf-8").read()
        if len(text) > 40_000:
            continue
        for _ in range(4):
            k = rnd.randrange(len(text))
            for v in (text, text[:k], text[:k] + rnd.choice(["(", '"', "\n", " x ", ":"]) + text[k:]):
                try:
                    ast.parse(v)
                    valid = True
                except (SyntaxError, ValueError):
                    valid = False
                assert valid == (not python_errors(v)), (path, k)


def test_all_errors_and_recovery():
    e = python_errors("x = (1,\ny = 2\nif x\n    pass\nz = 3 +\nw = 1\n")
    assert [n for n, _ in e] == [1, 3, 5]
    assert python_errors("") == [] and python_errors("\n\n# only\n") == []
    assert len(python_errors("<<<<<<< a\nx = 1\n=======\nx = 2\n>>>>>>> b\n")) >= 3


@pytest.mark.parametrize("text,good", [('{"a": [1, 2.5e3, null, true, "\\u00e9"]}', True), ("[1,]", False), ('{"a" 1}', False), ("", False), ('"\n"', False), ("[" * 300 + "]" * 300, True), ('{"a": 1} x', False)])
def test_json(text, good):
    assert (not json_errors(text)) == good


@pytest.mark.parametrize("text,good", [("a = 1\n[t]\nb.c = 'x' # y\n[[u]]\nd = [1,\n 2]\n", True), ("", True), ("a = 1\na = 2", False), ("a =", False), ("[t\n", False), ("x = 1979-05-27T07:32:00Z\ny = {a = 1}", True), ('s = """a\nb"""', True), ("[a]\n[a]", False), ("plain words", False)])
def test_toml(text, good):
    assert (not toml_errors(text)) == good


@pytest.mark.parametrize(
    "text,good",
    [
        ("const f = async ({a, b: [c] = []}, ...r) => { for await (const x of y) yield_(x?.z ?? 1); };", True),
        ("class A extends B { static #p = 1; get x() { return `a${this.#p + {b: 1}.b}`; } }", True),
        ("let a = b\n++c\nlabel: for (;;) { break label }", True),
        ("if (a) { return 1;", False), ("let x = ;", False), ("function f( { }", False), ("x = 'a\n'", False), ("a b", False), ("", True),
        ("var r = /[/]\\/x/gi.test(s) / 2;", True), ("import d, {e as f} from 'm'; export default class {}", True), ("const x;", False), ("1 = a", False),
    ],
)
def test_javascript(text, good):
    assert (not js_errors(text)) == good


def test_files_of_a_table(spark):
    rows = [(1, "r", "a.PY", "x = ("), (2, "r", "a.py", "x = 1"), (3, None, "b.json", ""), (4, "r", "c.md", "("), (5, "r", None, "("), (6, "r", "d.py", None), (1, "r", "a.PY", "x = ("), (7, "r", "e.toml", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "step long, repo string, path string, text string, language string")
    out = syntax.check_files(df, "step", "path", "text", "repo")
    assert {r.id: r.n_errors > 0 for r in out.collect()} == {1: True, 2: False, 3: True, 7: False}
    assert syntax.check_files(df.limit(0), "step", "path", "text", "repo").count() == 0


# 5


def whole_pairs(n=600):
    rnd = random.Random(6)
    what, how, do = ["次序", "章节", "枢纽", "日志", "边界", "缓存", "样本"], ["平稳", "急躁", "清楚", "迟缓", "粗疏"], ["核查", "归纳", "延后", "合并", "观察"]
    said = [
        lambda: f"此处的{rnd.choice(what)}偏于{rnd.choice(how)}，宜先{rnd.choice(do)}{rnd.choice(what)}。", lambda: f"若{rnd.choice(what)}过于{rnd.choice(how)}，则{rnd.choice(what)}难以{rnd.choice(do)}！", lambda: f"他问：“{rnd.choice(what)}可以{rnd.choice(do)}吗？不必{rnd.choice(do)}。”",
        lambda: f"若无法{rnd.choice(do)}{rnd.choice(what)}，不妨等待{rnd.choice(what)}{rnd.choice(how)}。", lambda: f"原文说“抱歉不能从命”，其实是劝人{rnd.choice(do)}{rnd.choice(what)}。", lambda: f"术语 gate mirror 与 x_{rnd.randint(1, 99)} 在此指{rnd.choice(what)}。（另见{rnd.choice(what)}一条）",
        lambda: f"與其檢驗{rnd.choice(what)}，不如記錄，使{rnd.choice(what)}{rnd.choice(how)}。",
    ]
    asked = [lambda: f"木气降于{rnd.choice('东南西北')}，火在{rnd.choice('山川云雨')}则{rnd.choice('重轻薄厚')}。" * rnd.randint(1, 3), lambda: f"The {rnd.choice(['gate', 'router'])} holds run {rnd.randint(1, 99)}. It broke again.", lambda: f"Der {rnd.randint(2, 9)}. Zweig hält den {rnd.choice(['Rahmen', 'Puffer'])}."]
    return [(i, rnd.choice(asked)(), "".join(rnd.choice(said)() for _ in range(rnd.randint(1, 4)))) for i in range(n)]


BROKEN = {
    "empty": ["", "  ", "N/A", "（空）", "……", "​", "null", "TODO"],
    "refusal": ["抱歉，我无法回答。", "I must decline to interpret this text.", "不好意思，目前没有办法对该内容作出概括，还望理解！", "Es tut mir leid, das kann ich nicht beantworten."],
    "copy": ["木气降于南，火在山则重。水归于泉，土静而明。", "译文如下：木气降于南，火在山则重。水归于泉，土静而明。", "木气降于南，火在则重。水归于泉，土静而明。", "木气降于南火在山则重水归于泉土静而明", "木气降于南，火在山则重。水归于泉，土静而明。" * 2],
    "language": ["Le cadre est prêt, dit-elle.", "이 창문은 단계을 먼저 살핍니다.", "まず分岐を記す、次に引用を調べるほかない！", "Часть шагов, заняла 39 с."],
    "truncated": ["此处的次序偏于平稳，宜先…[截断]", "若章节过于急", "他问：“次序可以观察", "此处的枢纽偏于清楚，"],
    None: ["原文说“抱歉不能从命”，其实是劝人合并枢纽。", "術語 gate mirror 与 x_7 在此指日志。", "此处的边界偏于粗疏，宜先核查样本。（另见边界一条）", "與其檢驗边界，不如記錄，使样本清楚。", None],
}


def test_broken_pairs(spark):
    whole, prompt = whole_pairs(), "木气降于南，火在山则重。水归于泉，土静而明。"
    rows, want, n = list(whole), {}, 1000
    for defect, texts in BROKEN.items():
        for t in texts:
            rows.append((n, prompt, t))
            if defect:
                want[n] = defect
            n += 1
    rows += [(n, "", ""), (n + 1, None, ""), rows[600]]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "point_id long, original_text string, summary_zh string, prompt string")
    out = pairs.broken_pairs(df, "point_id", "original_text", "summary_zh").collect()
    found = {r.id: r.defect for r in out}
    assert len(out) == len(found) and not [i for i in found if i < 600]
    wrong = {rows[600 + i - 1000][2]: (found.get(i), want.get(i)) for i in range(1000, n) if found.get(i) != want.get(i)}
    assert len(wrong) <= 4, wrong  # a small table; see README for the recall on large ones
    assert pairs.broken_pairs(df.limit(0), "point_id", "original_text", "summary_zh").count() == 0


def test_the_classifier_and_its_thresholds_decide():
    whole, prompt = [(p, r) for _, p, r in whole_pairs()], "木气降于南，火在山则重。水归于泉，土静而明。"
    w, limits = pairs.train(whole)
    broken = [(prompt, t, d) for d, ts in BROKEN.items() if d for t in ts]
    right = lambda w, limits: sum(pairs.judge([(p, t)], w, limits)[0] == d for p, t, d in broken)
    passed = lambda w, limits: sum(x is not None for x in pairs.judge(whole, w, limits))
    assert right(w, limits) >= len(broken) - 4 and passed(w, limits) == 0
    assert passed(w, np.full(5, -np.inf)) == len(whole)  # no thresholds
    assert right(np.zeros_like(w), limits) < len(broken) / 3  # no weights
    assert right(*pairs.train([])) == 0 and pairs.judge([], w, limits) == []


def test_broken_pairs_among_the_examples_are_left_out():
    whole = [(p, r) for _, p, r in whole_pairs()]
    noise = [(p, "抱歉，我不能回答这个问题，请换一个话题。" if k % 2 else r[: len(r) // 2 - 1] + "，") for k, (p, r) in enumerate(whole[:40])]
    noise += [(p, "此处的" + "次章枢日边缓样"[k % 7] + "，") for k, (p, _) in enumerate(whole[40:80])]
    w, limits = pairs.train(whole[80:] + noise)
    found = pairs.judge(noise, w, limits)
    assert sum(x == ("refusal" if k % 2 and k < 40 else "truncated") for k, x in enumerate(found)) >= 70
    assert sum(x is not None for x in pairs.judge(whole[80:], w, limits)) <= 1


def test_long_and_odd_pairs():
    w, limits = pairs.train([(p, r) for _, p, r in whole_pairs(200)])
    out = pairs.judge([("木气降于南，火在山则重。水归于泉。" * 9_000, "译文：" + "木气降于南，火在山则重。水归于泉。" * 9_000), ("a", "\x00"), ("b", "。"), ("?", "此处的次序偏于平稳，宜先核查章节。")], w, limits)
    assert out[0] == "copy" and out[1] == out[2] == "empty" and out[3] is None


# 6


def brute_pairs(texts, t=0.7, width=3, least=30):
    sets = {}
    for i, x in texts.items():
        w = re.findall(r"[a-z0-9_]+", "".join(c.lower() if c.isascii() else " " for c in x or ""))
        if len(w) >= least:
            sets[i] = set(zip(*[w[k:] for k in range(width)]))
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


def test_near_duplicates_are_whole(spark, monkeypatch):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(30, 120))] for _ in range(30)]
    common = [f"common_{i}" for i in range(40)]
    texts = {}
    for i in range(300):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 9)):
            k = rnd.randrange(len(w))
            w[k : k + rnd.randint(0, 2)] = [rnd.choice(vocab)] * rnd.randint(0, 2)
        texts[i] = " ".join(common * (i % 3 > 0) + w)
    texts |= {1000: None, 1001: "", 1002: "too short", 1003: "Ab-c " * 40, 1004: "aB c," * 40, 1005: "é b c " * 20_000}
    monkeypatch.setattr(neardup, "LOCAL_LEAST", 2)
    monkeypatch.setattr(neardup, "HOT_LEAST", 4)
    monkeypatch.setattr(neardup, "HOT_BLOCK", 16)
    rows = [(i, t, "clash") for i, t in texts.items()] * 2
    df = spark.createDataFrame(rows, "step_id long, text string, sid string").repartition(3)
    want = brute_pairs(texts)
    got = [tuple(r) for r in neardup.similar_pairs(df, "step_id", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    links = collections.Counter(x for p in want for x in p)
    roots = {}

    def root(x):
        while roots.get(x, x) != x:
            x = roots[x]
        return x

    for a, b in want:
        roots[max(root(a), root(b))] = min(root(a), root(b))
    out = {r.id: (r.group_id, r.links) for r in neardup.groups(df, "step_id", "text").collect()}
    assert out == {x: (root(x), n) for x, n in links.items()}
    assert neardup.similar_pairs(df.limit(0), "step_id", "text").count() == 0


def test_pigeonring_keeps_what_is_near_and_prunes(spark):
    rnd = np.random.default_rng(4)
    rows, near, whole = [], [], []
    for i in range(600):
        a = rnd.integers(0, 2, 256)
        b = a.copy()
        b[rnd.choice(256, rnd.integers(0, 90), replace=False)] ^= 1
        pack = lambda x: [int(v) for v in np.packbits(x.astype(np.uint8), bitorder="little").view(np.int64)]
        rows.append((i, *pack(a), *pack(b)))
        boxes = (a != b).reshape(16, 16).sum(axis=1)
        whole.append(boxes.sum() <= 30)
        near.append({n: any(all(sum(boxes[(s + k) % 16] for k in range(m + 1)) * 16 <= 30 * (m + 1) for m in range(n)) for s in range(16)) for n in (1, 3, 8)})
    df = spark.createDataFrame(rows, "i long, " + ", ".join(f"{s}{k} long" for s in "ab" for k in range(4)))
    kept = []
    for n in (1, 3, 8):
        keep = neardup.pigeonring([F.col(f"a{k}") for k in range(4)], [F.col(f"b{k}") for k in range(4)], F.lit(30), n)
        got = [r.k for r in df.orderBy("i").select(keep.alias("k")).collect()]
        assert got == [x[n] for x in near]
        assert all(g for g, w in zip(got, whole) if w)  # nothing near is lost
        kept.append(sum(got))
    assert 600 > kept[0] > kept[1] > kept[2] >= sum(whole)  # longer chains prune more of the far ones


def test_chains_prune_candidates_before_the_full_check(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT_LEAST", 1 << 30)  # no member counts as common: more candidates
    rnd = random.Random(12)
    head = [f"r{i}" for i in range(12)]  # rare runs that many share, so that they meet as candidates
    texts = {i: " ".join(rnd.sample(head, 12) * (i % 2) + head + [f"w{rnd.randrange(3000)}" for _ in range(40)]) for i in range(120)}
    texts |= {1000 + i: texts[i] + f" end{i}" for i in range(20)}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    feats = neardup.features(df, "id", "text").persist()
    pairs_of = neardup.candidates(feats, 7, 10).persist()
    ring = feats.where("first")
    x = pairs_of.join(ring.select(F.col("sid").alias("a"), F.col("n").alias("na"), *[F.col(f"sk{k}").alias(f"a{k}") for k in range(4)]), "a")
    x = x.join(ring.select(F.col("sid").alias("b"), F.col("n").alias("nb"), *[F.col(f"sk{k}").alias(f"b{k}") for k in range(4)]), "b")
    tau = F.floor((F.col("na") + F.col("nb")) * 3 / 17)
    left = x.where(neardup.pigeonring([F.col(f"a{k}") for k in range(4)], [F.col(f"b{k}") for k in range(4)], tau)).count()
    assert 20 <= left < 0.5 * pairs_of.count()
    assert neardup.similar_sets(feats).count() == len(brute_pairs(texts)) == 20


def test_hot_copies_are_split(spark, monkeypatch):
    """A third of all rows is one text, more than a block holds, and near another one."""
    monkeypatch.setattr(neardup, "HOT_BLOCK", 20)
    base = " ".join(f"w{i}" for i in range(80))
    texts = {i: base for i in range(100)} | {100 + i: base + " x y" for i in range(5)} | {200 + i: " ".join(f"v{i}_{k}" for k in range(40)) for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = [tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()]
    assert len(got) == len(set(got)) == 105 * 104 // 2 and set(got) == brute_pairs(texts)
    out = {(r.group_id, r.links) for r in neardup.groups(df, "id", "text").collect()}
    assert out == {(0, 104)}


def test_thinly_spread_members_are_seen(spark):
    texts = [(i, " ".join([f"a{i}", "one", "two", "three", "four"] + [f"b{i}_{k}" for k in range(30)])) for i in range(800)]
    df = spark.createDataFrame(texts, "id long, text string").repartition(800)  # a row a task
    hot, counts = neardup._hot(neardup.features(df, "id", "text"))
    assert len(hot) == 2 and all(300 < c < 2000 for c in counts)


# 7


@pytest.fixture(scope="module")
def encoder():
    return tokenize.Encoder(tokenize.read_ranks(tokenize.VOCABULARY))


@pytest.fixture(scope="module")
def public():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokenize.PIECES, mergeable_ranks=tokenize.read_ranks(tokenize.VOCABULARY), special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abehrst in_.0=\n水é", max_size=200))
def test_ids_and_round_trip(encoder, public, text):
    ids = encoder.encode(text)
    assert ids == public.encode_ordinary(text)
    assert "".join(tokenize.decode(encoder.m.bytes_of, ids)) == text


def test_long_runs_stream(encoder, public):
    for text in ("a" * 3000, "水火" * 1500, " " * 2000, "=-" * 1000, "<|endoftext|>" * 50):
        assert encoder.encode(text) == public.encode_ordinary(text)
    t = tokenize.Transducer(encoder.m)
    out = list(t.feed(b"the" * 5000))
    assert len(t.window) < 3 * encoder.m.lookahead + 64 and out  # constant memory, ids come out early
    long = "the water, 水火 the=-\n" * 20_000
    assert len(long) > tokenize.LONG and encoder.encode(long) == public.encode_ordinary(long)


def test_lookahead_of_a_merge_list():
    ranks = {bytes([c]): c for c in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"abcd": 259, b"xyzzy": 260}
    m = tokenize.Merges(ranks)
    assert m.lookahead == 3  # abcd is made by merges; xyzzy never is
    t = tokenize.Transducer(m)
    out = list(t.feed(b"abcdabc" * 50 + b"xyzzyab"))
    assert t._live() == [len(t.window) - 2, len(t.window) - 1, len(t.window)] or t._live() == [len(t.window) - 2, len(t.window)]
    assert b"".join(m.bytes_of[i] for i in out + t.finish()) == b"abcdabc" * 50 + b"xyzzyab"
    assert tokenize.Merges({bytes([c]): c for c in range(256)}).lookahead == 0


def test_ids_of_a_table(spark):
    df = spark.createDataFrame([(1, "Hello <|endoftext|>", [1]), (2, "", [2]), (3, None, None)], "doc_id long, text string, ids array<int>")
    out = {r.id: r.ids for r in tokenize.token_ids(df, "doc_id", "text").collect()}
    assert out[2] == out[3] == [] and 50256 not in out[1] and len(out[1]) > 3
    assert tokenize.token_ids(df.limit(0), "doc_id", "text").count() == 0


# 8


def brute_leaks(docs, items):
    out = set()
    for d, t in docs:
        if t is None:
            continue
        for i, x, lang in items:
            units = (lambda s: [c for c in leaks.plain(s) if c.isalnum()]) if (lang or "").startswith("zh") else (lambda s: leaks.word_terms(leaks.plain(s)))
            n = 24 if (lang or "").startswith("zh") else 15
            a, b = units(t), units(x or "")
            if difflib.SequenceMatcher(None, a, b, False).find_longest_match().size >= n:
                out.add((d, i))
    return out


def test_leaks_are_whole(spark):
    rnd = random.Random(8)
    words = [f"{a}{b}" for a in "klmnprstvz" for b in ("ab", "eck", "ion", "um")] + ["the", "of", "and"] * 3
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(10, 60))), "en") for i in range(70)]
    items += [(100 + i, "".join(rnd.choice("水火木金土日月山川风云") for _ in range(rnd.randint(20, 60))), "zh") for i in range(20)] + [(200, None, None), (201, "", "en")]
    docs = [(0, None), (1, ""), (2, "the of and " * 3000)]
    for d in range(3, 160):
        i, x, lang = rnd.choice(items[:90])
        parts = x.split() if lang == "en" else list(x)
        a = rnd.randrange(len(parts))
        piece = parts[a : a + rnd.randint(10, 30)]
        noise = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))
        docs.append((d, noise + " >> " + (", ".join(p.upper() for p in piece) if lang == "en" else "\n".join(piece)) + "** " + noise))
    df = spark.createDataFrame([(d, t, "clash") for d, t in docs] + [(*docs[5], "x")], "doc_id long, text string, item_id string")
    it = spark.createDataFrame(items, "item_id long, text string, lang string")
    got = [tuple(r) for r in leaks.leaks(df, "doc_id", "text", it, "item_id", "text", "lang").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_leaks(docs, items) and len(got) > 30
    assert leaks.leaks(df, "doc_id", "text", it.limit(0), "item_id", "text", "lang").count() == 0
    assert leaks.leaks(df.limit(0), "doc_id", "text", it, "item_id", "text", "lang").count() == 0


def test_block_max_wand_retrieves_all_and_scores_few():
    rnd = random.Random(4)
    words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(30_000)]
    items = [(i, [rnd.choice(words) for _ in range(rnd.randint(15, 80))]) for i in range(1500)]
    index = leaks.Index(items, 15)
    assert sum(map(len, index.items)) == sum(len(set(t)) for _, t in items)  # as many postings as items hold terms
    scored = []
    for n in range(200):
        a = rnd.choice(items)[1]
        q = collections.Counter(index.term_ids[t] for t in a[:20] + [rnd.choice(words) for _ in range(10)] if t in index.term_ids)
        want = set()
        for k in range(len(index.ids)):
            if sum(c * dict(zip(index.items[t], index.impacts[t])).get(k, 0) for t, c in q.items() if k in set(index.items[t])) >= index.limit[k] if n < 5 else False:
                want.add(k)
        got = list(index.retrieve(q))
        assert len(got) == len(set(got)) and (n >= 5 or set(got) == want)
        scored.append(len(got))
    assert sum(scored) >= 200


def test_leaks_in_shards(spark, monkeypatch):
    monkeypatch.setattr(leaks, "SHARD", 500)
    items = [(i, " ".join(f"w{i}_{k}" for k in range(20)), "en") for i in range(40)]
    docs = [(i, "So " + items[i][1].upper() + ".") for i in range(40)] + [(99, "nothing")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, lang string")
    assert {tuple(r) for r in leaks.leaks(df, "doc_id", "text", it, "item_id", "text", "lang").collect()} == {(i, i) for i in range(40)}


# 9


def cut_corpus():
    """Whole texts with headings, lists and closing lines, and planted cases (id -> (text, is cut))."""
    rnd = random.Random(1)
    nouns = ["window", "lattice", "router", "budget", "ledger"]
    said = lambda: f"The {rnd.choice(nouns)} holds the {rnd.choice(nouns)} of run {rnd.randint(10, 99)}, e.g. the {rnd.choice(nouns)}."
    entries = lambda: "\n".join(f"- {rnd.choice(['drop', 'merge'])} {rnd.choice(nouns)}" for _ in range(4))
    whole = []
    for i in range(600):
        parts = [f"About the {rnd.choice(nouns)}", " ".join(said() for _ in range(rnd.randint(2, 5))), f'It said "{said()[:-1]}!" and so on.', entries(), said(), "一二三四。木气降于南，火在山则重。"]
        parts += [["Thanks in advance"], ["Status: OK"], ["待续……"], ["```py\nx = 1\n```"], [said()], [entries()]][i % 6]
        whole.append((i, "\n\n".join(parts), "s"))
    body = "\n\n".join(whole[0][1].split("\n\n")[:5])
    cases = {
        2000: (body + " The win", True), 2001: (body + "\n\n```py\nx = 1\n", True), 2002: (body + "\n\n```py\nx = 1\n```", False), 2003: (body + " The bud[…]", True),
        2004: (body + "\n\n- drop window\n- merge router", False), 2005: (body + "\n\n- drop window\n- merge", True), 2006: (body + "\n\nThanks in advance", False), 2007: (body + "\n\nStatus: OK", False),
        2008: (body + ' It said "the window holds.', True), 2009: (body + " The ledger, e.", True), 2010: ("", False), 2011: (None, False), 2012: ("  \n", False), 2013: ("木气降于南，火在山则重。", False), 2014: ("木气降于南，火在山则", True), 2015: (body + "\n\n待续……", False),
        2016: ("The window holds the ledger. " * 5_000, False), 2017: (body + " The window…", True), 2018: ("木�", True), 2019: (body + "\n\n- drop window\n- merge rout", True), 2020: (body + " The router", True), 2021: (body + " The router holds the window of run 55,", True), 2022: (body + " The window [truncated]", True),
    }
    limited = [(3000 + i, ("About it\n\n" + "- merge window\n" * 3 + f"- merge {'abcdefghijklmnopqrst'[i]}row{i:02d}" + "\n- drop router" * 9)[:69], "limited") for i in range(20)]
    return whole, cases, limited


def test_cut_texts(spark):
    whole, cases, limited = cut_corpus()
    rows = whole + limited + [(i, t, None) for i, (t, _) in cases.items()]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, cut string")
    out = {r.id: r.cut for r in truncated.judged(df, "doc_id", "text", "source").collect()}
    assert {i: out.get(i) is not None for i in cases} == {i: w for i, (_, w) in cases.items()}
    assert not [i for i, *_ in whole if out[i]]
    assert all(out[i] for i, *_ in limited)
    assert truncated.judged(df.limit(0), "doc_id", "text", "source").count() == 0
    r = {x.source: (x.texts, x.truncated) for x in truncated.rates(df, "doc_id", "text", "source").collect()}
    assert r["s"] == (600, 0) and r["limited"] == (20, 20) and r[None][0] == len(cases)


@pytest.mark.parametrize("without,lost,wrong", [("trie", {2005, 2009, 2019}, set()), ("length", {3000}, set()), ("closing", set(), {2006, 2007}), ("open", {2008}, set())])
def test_each_evidence_of_cuts_decides(spark, without, lost, wrong):
    whole, cases, limited = cut_corpus()
    df = spark.createDataFrame(whole + limited + [(i, t, None) for i, (t, _) in cases.items()], "doc_id long, text string, source string")
    use = tuple(x for x in ("trie", "length", "closing", "open") if x != without)
    found = {r.id for r in truncated.judged(df, "doc_id", "text", "source", use).where("cut is not null").collect()}
    assert not lost & found and wrong <= found


def test_copies_of_a_cut_text_make_no_closing_line(spark):
    body = "About it\n\nThe gate holds the router of run 12.\n\nThe gate report names window 5.\n\n"
    rows = [(i, body.replace("12", str(100 + i)) + f"The gate report names window {'abcdefghij'[i % 10]}{i % 7}.", "s") for i in range(60)]
    rows += [(100 + i, body + "The gate repo", "s") for i in range(40)]  # copies: their end is no closing line
    rows += [(200 + i, f"About it\n\nStage {i} holds.\n\nThe gate report na", "t") for i in range(4)]  # often, but longer lines speak against it
    rows += [(300 + i, f"About it\n\nStage {i} ends.\n\nSigned off by karo", "s") for i in range(5)]  # a closing line that the corpus shows
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.id: r.cut for r in truncated.judged(df, "doc_id", "text", "source").collect()}
    assert {i for i, c in out.items() if c} == {*range(100, 140), *range(200, 204)}


def test_a_closing_line_needs_a_share_of_its_source(spark):
    rows = [(i, f"About it\n\nStage {i} of all holds.\n\nIt ends.", "s") for i in range(4000)] + [(10_000 + i, f"Stage {i} ends.\n\nWe move the", "s") for i in range(4)]
    rows += [(20_000 + i, f"Stage {i} ends.\n\nSigned off by karo", None) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.id for r in truncated.judged(df, "doc_id", "text", "source").where("cut is not null").collect()} == set(range(10_000, 10_004))


def test_long_last_paragraphs_are_read_whole():
    long = "The gate holds the router of this run. " * 200
    assert truncated.last_paragraph("A start.\n \t\n" + long + "\nAn end.\n") == long + "\nAn end."
    assert truncated.last_paragraph("A start.\n\n\nAn end.") == "An end." and truncated.last_paragraph("\nOne\ntwo.") == "\nOne\ntwo."
    assert truncated.end_of("A start.\n\nIt said “stop. " + long)[-1] and truncated.end_of('A start.\n\nIt said "stop. ' + long)[-1]
    assert not truncated.end_of('A start.\n\nIt said "stop. ' + long + 'Go on." It holds.')[-1]
    assert truncated.end_of("x\n\n" + long + "\n" + long + "hold")[:3] == ("p", "hold", "a")
    assert truncated.end_of("a " * 3000 + "\n- b_win 34")[:3] == ("l", "0", "0")


def test_javascript_of_any_depth():
    n = 3000
    chain = "if (a) { b(); }" + " else if (a) { b(); }" * n
    deep = [chain, chain + " else c();", "x = " + "a ? b : " * n + "c;", "x = " + "(" * n + "a" + ")" * n + ";", "x = " + "[" * n + "]" * n + ";", "{" * n + "}" * n, "x = " + "{a: " * n + "1" + "}" * n + ";",
            "x = " + "(a) => " * n + "b;", "f(function () {" * n + "})" * n, "if (a) " * n + "b();", "x = " + "!" * n + "a;"]
    assert [js_errors(t) for t in deep] == [[]] * len(deep)
    assert js_errors(chain + " else if (a { b(); }")[0][0] == 1 and js_errors("x = " + "(" * n + "a" + ")" * (n - 1) + ";")
    assert js_errors("if (a) b(); else if (c) d(); else e(); else f();")


def test_all_errors_of_a_large_broken_javascript_file():
    text = "let a = 1;\nlet = = 2;\n" * 300
    found = js_errors(text)
    assert {line for line, _ in found} == set(range(2, 601, 2))
