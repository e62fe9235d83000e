"""Problem 5: broken prompt and response pairs.

A multi-label linear classifier, one logistic output a defect, decides alone. Its features are hashed character n-grams
of the response, how the response ends, and features of the pair: how much of each text's character pairs the other has,
lengths, scripts. It is trained on synthetic defects made from the table's own pairs: responses emptied or replaced by
placeholders, refused, copied from the prompt (whole, twice, with a lead-in, with small edits), swapped for text in other
languages, and truncated. The table's pairs stand for whole ones; as some are broken, those that the classifier finds
(each half of the pairs by training on the other) are left out and it is trained again, ``ROUNDS`` times. A defect says nothing about those after it in the order of DEFECTS
(a copied prompt may be foreign as well), so these outputs are left out of its loss. The thresholds are calibrated on
held-out pairs, as those that err least there. A pair's defect is the first whose output passes.

It is fitted on at most ``SAMPLE`` pairs, those least by a hash of their id; every pair is scored, whole. Null or empty
prompts and null responses give no row. Rows delivered again count once; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shingles import mix

DEFECTS = ("empty", "refusal", "copy", "language", "truncated")
SAMPLE, DIMS, ROUNDS, EPOCHS, WRONG = 3000, 1 << 16, 6, 6, 2
_KEEP = re.compile(r"[\W_]+")
_HAN = re.compile(r"[㐀-鿿豈-﫿]")
_KANA = re.compile(r"[぀-ヿｦ-ﾝ]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ_]+")
_OTHER = re.compile(r"[^\W\d_A-Za-zÀ-ɏ㐀-鿿豈-﫿぀-ヿｦ-ﾝ]")
_DIGIT = re.compile(r"\d")
_OPENS, _SHUTS = "“「『（《【([", "”」』）》】)]"


def bare(text: str) -> str:
    """Letters and digits only, in compatible form and lower case."""
    return _KEEP.sub("", unicodedata.normalize("NFKC", text)).lower()


def _hash(*parts: np.ndarray | int) -> np.ndarray:
    h = np.array([0x9E3779B97F4A7C15], np.uint64)
    for p in parts:
        h = mix((np.atleast_1d(p).astype(np.uint64) + h) * np.uint64(0xD6E8FEB86659FD93))
    return h


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with a sign before and after each, and the row of each."""
    joined = "".join(f"\x02{t}\x03" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])


def _shares(prompts: list[str], responses: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each prompt's different pairs of letters the share that the response has, and the other way round."""
    keys, sizes = [], []
    for texts in (prompts, responses):
        codes, row = _codes(texts)
        ok = row[1:] == row[:-1]
        key = (row[:-1][ok].astype(np.uint64) << np.uint64(40)) | (_hash(codes[:-1][ok], codes[1:][ok]) >> np.uint64(24))
        keys.append(np.unique(key))
        sizes.append(np.bincount((keys[-1] >> np.uint64(40)).astype(np.int64), minlength=len(texts)))
    both = np.intersect1d(*keys, assume_unique=True)
    shared = np.bincount((both >> np.uint64(40)).astype(np.int64), minlength=len(prompts))
    return shared / sizes[0], shared / sizes[1]


def _steps(x: float, at: tuple[float, ...]) -> int:
    return sum(x >= a for a in at)


_SHARE, _RATIO = (0.3, 0.5, 0.6, 0.7, 0.76, 0.82, 0.88, 0.94, 0.98), (0.4, 0.6, 0.75, 0.9, 1.12, 1.35, 1.6, 1.9, 2.2)
_PART = (0.02, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95)


def _traits(response: str, plain_p: str, plain_r: str, of_p: float, of_r: float) -> list[str]:
    """What is said of a pair besides the n-grams."""
    r = response.rstrip()
    core = r
    while core and (core[-1] in "”’」』》〉\"'»)）]】" or unicodedata.category(core[-1]) in ("So", "Mn", "Cf", "Sk")):
        core = core[:-1]
    opened = [k for a, b in zip(_OPENS, _SHUTS) if (k := r.rfind(a)) >= 0 and r.find(b, k) < 0]
    kind = lambda c: unicodedata.category(c) if c else "none"
    out = [f"last={r[-1:]}", f"last2={r[-2:]}", f"last3={r[-3:]}", f"kind={kind(r[-1:])}", f"core={core[-1:]}", f"core kind={kind(core[-1:])}", f"{kind(r[-1:])}|{kind(core[-1:])}|{bool(opened)}", f"open={bool(opened)}"]
    n = len(plain_r)
    han, kana, latin, other = len(_HAN.findall(response)), len(_KANA.findall(response)), len(_LATIN.findall(response)), len(_OTHER.findall(response)) / 3
    total = max(1.0, han + kana + latin + other)
    out += [f"size={n if n < 4 else 3 + n.bit_length()}", f"whole={plain_r}" if n < 16 else "long"]
    out += [f"{name}>={k}" for name, x in (("han", han / total), ("kana", kana / total), ("latin", latin / total), ("other", other / total)) for k in range(_steps(x, _PART))]
    a, b, ratio = _steps(of_p, _SHARE), _steps(of_r, _SHARE), _steps(n / max(1, len(plain_p)), _RATIO)
    out += [f"of p>={k}" for k in range(a)] + [f"of r>={k}" for k in range(b)] + [f"least>={k}" for k in range(min(a, b))] + [f"ratio={ratio}", f"least|ratio={min(a, b)}|{ratio}", f"same={plain_p == plain_r}"]
    return out


def features(pairs: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the pairs in the order of rows: n-grams of about the same weight for short and very long responses, and traits."""
    prompts, responses = [bare(p) for p, _ in pairs], [bare(r) for _, r in pairs]
    of_p, of_r = _shares(prompts, responses)
    codes, row = _codes([_DIGIT.sub("0", r.strip().lower()) for _, r in pairs])
    rows, feats, values = [], [], []
    for n in (1, 2, 3, 4):
        m = len(codes) - n + 1
        ok = row[:m] == row[n - 1 :] if n > 1 else np.ones(m, bool)
        rows.append(row[:m][ok])
        feats.append(_hash(n, *[codes[k : m + k][ok] for k in range(n)]) % np.uint64(DIMS))
    grams = np.concatenate(rows)
    rows, feats = [grams], [np.concatenate(feats)]
    many = np.bincount(grams, minlength=len(pairs))
    values.append((2.0 * np.minimum(1 / np.sqrt(many), 16 / many))[grams])
    told = [[zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in (*_traits(pairs[k][1], prompts[k], responses[k], of_p[k], of_r[k]), "bias")] for k in range(len(pairs))]
    rows.append(np.repeat(np.arange(len(pairs)), [len(t) for t in told]))
    feats.append(_hash(99, np.array([x for t in told for x in t], np.uint64)) % np.uint64(DIMS))
    values.append(np.full(len(rows[-1]), 0.5))
    r, f, v = np.concatenate(rows), np.concatenate(feats).astype(np.int64), np.concatenate(values)
    order = np.argsort(r, kind="stable")
    return r[order], f[order], v[order]


def scores(pairs: list[tuple[str, str]], w: np.ndarray, block: int = 1000) -> np.ndarray:
    out = np.zeros((len(pairs), len(DEFECTS)))
    for at in range(0, len(pairs), block):
        part = pairs[at : at + block]
        r, f, v = features(part)
        for d in range(len(DEFECTS)):
            out[at : at + len(part), d] = np.bincount(r, w[f, d] * v, minlength=len(part))
    return out


# training data: what stands for a missing text, and refusals put together from their parts
_MISSING = "n/a na null none nil nan todo tbd tba undefined empty blank placeholder missing - -- — —— … …… . 。 、 ， ? ？ * # / x 0 待补 待补充 待定 待填 空 空白 无 略 暂无 暂缺 暂无摘要 无摘要 无内容 没有内容 未填 未知 同上 見上 なし 없음 нет vacío vide leer".split()
_WRAPS = ("{}", "{}", "（{}）", "({})", "[{}]", "<{}>", "【{}】", "{}。", " {} ", "{}\n", "“{}”", "{}{}")
_BLANKS = ("", " ", "  ", "\n", "\n\n", "\t", "　", "　　", "​", "()", "[]", "[ ]", "（）", "“”", "{}", " ")
_ZH = (
    ("", "", "抱歉，", "很抱歉，", "对不起，", "不好意思，", "很遗憾，", "非常遗憾，", "请原谅，", "请见谅，", "十分抱歉，", "抱歉！", "实在抱歉，", "對不起，", "很抱歉，作为人工智能助手，", "作为一个语言模型，", "作为AI，"),
    ("我无法{}", "我不能{}", "我没有办法{}", "目前没有办法{}", "暂时无法{}", "我不便{}", "我选择不{}", "我拒绝{}", "我没有权限{}", "我没有足够的权限来{}", "我没有足够的信息来{}", "我不会{}", "我做不到，不能{}", "恕我不能{}", "恕难从命，我不{}", "恕难从命，此处不作说明", "这个请求我不便处理", "该请求超出了我的能力范围", "该内容超出了我可以协助的范围", "这个问题不在我能处理的范围内", "此段我不作解释", "我無法{}", "這個請求我不便處理"),
    ("回答这个问题", "总结这段文字", "总结原文", "为这段文字提供摘要", "对该内容作出概括", "处理这个请求", "解释此段", "对这段话发表意见", "翻译这段话", "提供相关信息", "协助您", "完成这项任务", "评论这篇文章", "回應這個問題"),
    ("。", "！", "，请换一个话题。", "，请换一个问题。", "，建议咨询专业人士。", "。如有其他需要，请告诉我。", "，敬请谅解。", "，还望理解！", "，希望您能理解。", "。请您另寻帮助。", ""),
)
_EN = (
    ("", "", "I'm sorry, but ", "Sorry, ", "Unfortunately, ", "I apologise, but ", "I am afraid ", "As an AI language model, ", "As an assistant, ", "My apologies, "),
    ("I can't {}", "I cannot {}", "I am unable to {}", "I'm not able to {}", "I must decline to {}", "I won't {}", "I have to refuse to {}", "I do not have permission to {}", "it is not possible for me to {}", "this request cannot be processed", "this content is beyond what I can assist with", "I decline this request"),
    ("help with that", "help with that request", "answer this question", "summarise this passage", "provide a summary of this text", "interpret this text", "comment on this passage", "process this content", "comply", "translate it", "assist with this"),
    (".", "!", ". Please ask something else.", ". Let me know if there is anything else.", ". Please consult a professional.", ""),
)
_ELSEWHERE = (
    "Lo siento, no puedo ayudar con eso.", "No puedo responder a esta pregunta.", "Lamentablemente no me es posible resumir este texto.", "Je suis désolé, je ne peux pas répondre à cette question.", "Je ne peux pas résumer ce texte.", "Désolé, cette demande dépasse mes capacités.",
    "Es tut mir leid, das kann ich nicht beantworten.", "Leider kann ich diesen Text nicht zusammenfassen.", "Ich darf diese Anfrage nicht bearbeiten.", "Desculpe, não posso ajudar com isso.", "Mi dispiace, non posso rispondere a questa domanda.", "Извините, я не могу ответить на этот вопрос.", "К сожалению, я не могу обобщить этот текст.",
    "申し訳ありませんが、この質問にはお答えできません。", "すみませんが、この文章を要約することはできません。", "그 요청은 도와드릴 수 없습니다.", "죄송하지만 이 질문에는 답변할 수 없습니다.", "عذراً، لا أستطيع الإجابة عن هذا السؤال.", "क्षमा करें, मैं इस प्रश्न का उत्तर नहीं दे सकता।", "ขออภัย ฉันไม่สามารถตอบคำถามนี้ได้",
)
_PLAIN = (
    "El informe describe el paso y luego la lista.", "Este texto explica cómo se mide cada parte.", "Le rapport décrit d'abord la liste, puis la mesure.", "Ce passage explique comment on répare une machine.", "Der Bericht beschreibt zuerst die Liste und dann das Maß.", "Dieser Text erklärt, wie man ein Gerät prüft.", "O texto explica como se mede cada parte.", "Il testo spiega come si misura ogni parte.",
    "Текст объясняет, как измерить каждую часть.", "Отчёт сначала описывает список, а потом меру.", "この文章はまず一覧を示し、次に測り方を述べています。", "報告書は機械の直し方を説明します。", "이 글은 먼저 목록을 보여 주고 다음에 측정 방법을 설명합니다.", "보고서는 기계를 고치는 순서를 적습니다.", "يشرح هذا النص كيف تقاس كل قطعة.", "यह पाठ बताता है कि हर भाग को कैसे मापा जाता है।", "ข้อความนี้อธิบายวิธีวัดแต่ละส่วน", "The report first describes the list and then the measure.", "This passage explains how a machine is repaired.",
)
_LEADS = ("", "", "", "译文如下：", "摘要：", "问：", "原文：", "答：", "总结：", "Summary: ", "回答如下：\n", "内容为：")
_AFTER = ("", "", "，", "…", "……", "...", "（", "“", "\n", "…[截断]", "[截断]", "…（未完）", "[truncated]", "[...]", "-", "、", "；其")


def _refused(rnd: np.random.Generator) -> str:
    pick = lambda x: x[rnd.integers(len(x))]
    if rnd.random() < 0.12:
        return pick(_ELSEWHERE)
    a, b, c, d = _ZH if rnd.random() < 0.7 else _EN
    core = pick(b).format(pick(c))
    lead = pick(a)
    return (lead + core if lead else core[:1].upper() + core[1:]) + pick(d)


def _emptied(rnd: np.random.Generator) -> str:
    if rnd.random() < 0.35:
        return _BLANKS[rnd.integers(len(_BLANKS))]
    x = _MISSING[rnd.integers(len(_MISSING))]
    x = (x, x.upper(), x.capitalize())[rnd.integers(3)]
    return _WRAPS[rnd.integers(len(_WRAPS))].replace("{}", x)


def _copied(p: str, rnd: np.random.Generator) -> str:
    way = rnd.integers(6)
    if way == 0:
        x = p
    elif way == 1:
        x = p + ("\n", "", " ")[rnd.integers(3)] + p
    elif way == 2:  # without its marks
        x = re.sub(r"[^\w\s]", "", p)
    else:
        x = list(p)
        for _ in range(rnd.integers(1, 2 + len(p) // 25)):
            k = rnd.integers(len(x))
            x[k : k + rnd.integers(1, 3)] = [] if rnd.random() < 0.6 else [x[rnd.integers(len(x))]]
        x = "".join(x)
    return _LEADS[rnd.integers(len(_LEADS))] + x + ("", "", " ", "\n", "🌿")[rnd.integers(5)]


def _foreign(text: str) -> bool:
    han, kana = len(_HAN.findall(text)), len(_KANA.findall(text))
    return kana * 4 > han or len(_LATIN.findall(text)) + len(_OTHER.findall(text)) / 3 > han


def _rescripted(text: str, rnd: np.random.Generator) -> str:
    """The text in letters of another script, as the table's foreign texts needn't show all of them."""
    first, many = ((0xAC00, 11172), (0x410, 64), (0x3B1, 25), (0x905, 53), (0xE01, 46), (0x627, 36), (0x10D0, 33), (0x561, 38), (0x3041, 83), (0x61, 26), (0x5D0, 27))[rnd.integers(11)]
    step = int(rnd.integers(1, 9999))
    return re.sub(r"[^\W\d_]", lambda m: chr(first + ord(m[0]) * step % many), text)


def synthetic(good: list[tuple[str, str]], prompts: list[str], seed: int) -> list[tuple[str, str, int]]:
    """Broken pairs made from ``good`` ones with the index of their defect; each pair is broken in two ways."""
    rnd = np.random.default_rng(seed)
    foreign = sorted({p for p in prompts if _foreign(p)})
    whole_ends = {r.rstrip()[-2:] for _, r in good}
    out: list[tuple[str, str, int]] = []
    for k, (p, r) in enumerate(good):
        for way in (k % 5, (k + 1 + k // 5 % 4) % 5):
            if way == 0:
                out.append((p, _emptied(rnd), 0))
            elif way == 1:
                out.append((p, _refused(rnd), 1))
            elif way == 2 and len(bare(p)) > 3:
                out.append((p, _copied(p, rnd), 2))
            elif way == 3:
                x = foreign[rnd.integers(len(foreign))] if foreign else _PLAIN[rnd.integers(len(_PLAIN))]
                parts = re.findall(r".+?(?:[.!?。！？।؟]+[\s”\"»」』]*|\n|$)", x, re.S)
                a = rnd.integers(len(parts)) if parts else 0
                x = ("".join(parts[a : a + rnd.integers(1, 4)]) or x).strip()
                way = rnd.random()
                if way < 0.4:
                    x = _rescripted(x, rnd)
                elif way < 0.55:
                    x = "".join(_PLAIN[(rnd.integers(len(_PLAIN)))] for _ in range(rnd.integers(1, 3)))
                if x != p.strip() and len(bare(x)) > 3:
                    out.append((p, x, 3))
            elif way == 4 and len(r.strip()) > 6:
                cut = r.strip()[: rnd.integers(3, len(r.strip()) - 1)].rstrip()
                if rnd.random() < 0.25 and (k := max(cut.rfind("，"), cut.rfind("、"), cut.rfind(","))) > 2:
                    cut = cut[: k + 1]
                if cut[-2:] not in whole_ends and not re.search(r"[。！？.!?]$", cut):
                    out.append((p, cut + _AFTER[rnd.integers(len(_AFTER))], 4))
    return out


def _targets(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and what of them counts: nothing is known of the defects after the first."""
    y = (kinds[:, None] == np.arange(len(DEFECTS))).astype(np.float64)
    known = (kinds[:, None] < 0) | (np.arange(len(DEFECTS)) <= kinds[:, None])
    return y, known.astype(np.float64)


def fit_linear(pairs: list[tuple[str, str]], kinds: np.ndarray, epochs: int = EPOCHS, whole: float = 1.0, rate: float = 0.3, batch: int = 64) -> np.ndarray:
    """Weights by adaptive gradient steps over batches in a fixed random order; ``whole`` is what a whole pair counts."""
    w, sums = np.zeros((DIMS, len(DEFECTS))), np.full((DIMS, len(DEFECTS)), 1e-2)
    if not pairs:
        return w.astype(np.float32)
    r, f, v = features(pairs)
    at = np.searchsorted(r, np.arange(len(pairs) + 1))
    y, known = _targets(kinds)
    known[kinds < 0] *= whole
    order = np.random.default_rng(11)
    for _ in range(epochs):
        mixed = order.permutation(len(pairs))
        for k in range(0, len(pairs), batch):
            rows = mixed[k : k + batch]
            take = np.concatenate([np.arange(at[i], at[i + 1]) for i in rows])
            own = np.repeat(np.arange(len(rows)), at[rows + 1] - at[rows])
            uniq, inv = np.unique(f[take], return_inverse=True)
            z = np.stack([np.bincount(own, w[f[take], d] * v[take], minlength=len(rows)) for d in range(len(DEFECTS))], 1)
            err = known[rows] * (y[rows] - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
            g = np.stack([np.bincount(inv, err[own, d] * v[take], minlength=len(uniq)) for d in range(len(DEFECTS))], 1) / np.sqrt(len(rows))
            sums[uniq] += g * g
            w[uniq] += rate * g / np.sqrt(sums[uniq])
    return w.astype(np.float32)


def calibrate(z: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Per defect the threshold that errs least on held-out pairs, a whole pair that passes counting as ``WRONG`` broken
    ones that don't; it stands in the middle of the gap between two scores. A few broken pairs among those held for whole
    ones don't move it."""
    _, known = _targets(kinds)
    limits = np.full(len(DEFECTS), np.inf)
    for d in range(len(DEFECTS)):
        use = known[:, d] > 0
        order = np.argsort(-z[use, d])
        s, y = z[use, d][order], (kinds[use] == d)[order]
        if y.any():
            gain = np.cumsum(np.where(y, 1, -WRONG))
            k = int(np.flatnonzero(gain == gain.max())[-1])
            limits[d] = (s[k] + s[k + 1]) / 2 if k + 1 < len(s) else s[k] - 1
    return limits


def train(pairs: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds): every fourth whole and broken pair is held out for the thresholds."""
    # responses that stand for many prompts count once
    first: dict[str, tuple[str, str]] = {}
    for p, r in pairs:
        first.setdefault(bare(r), (p, r))
    pairs = list(first.values())
    prompts = [p for p, _ in pairs]
    fold = np.arange(len(pairs)) % 2
    clean = np.ones(len(pairs), bool)
    for n in range(ROUNDS - 1):
        now = clean.copy()
        for f in (0, 1):  # each half is judged by what the other one teaches
            w, limits = _fit([x for x, a, b in zip(pairs, fold, clean) if a != f and b], prompts, n, 2, 0.4)
            now[fold == f] = ~(scores([x for x, a in zip(pairs, fold) if a == f], w) > limits).any(axis=1)
        clean = now
    return _fit([x for x, a in zip(pairs, clean) if a], prompts, ROUNDS, EPOCHS, 1.0)


def _fit(good: list[tuple[str, str]], prompts: list[str], seed: int, epochs: int, whole: float) -> tuple[np.ndarray, np.ndarray]:
    broken = synthetic(good, prompts, seed)
    data = [(p, r) for p, r, _ in broken] + good
    kinds = np.array([k for *_, k in broken] + [-1] * len(good), np.int64)
    held = np.arange(len(data)) % 4 == 3
    w = fit_linear([x for x, h in zip(data, held) if not h], kinds[~held], epochs, whole)
    return w, calibrate(scores([x for x, h in zip(data, held) if h], w), kinds[held])


def judge(pairs: list[tuple[str, str]], w: np.ndarray, limits: np.ndarray) -> list[str | None]:
    """The first defect of each pair whose output passes its threshold."""
    if not pairs:
        return []
    passed = scores(pairs, w) > limits
    return [DEFECTS[k] if p else None for k, p in zip(passed.argmax(axis=1), passed.any(axis=1))]


def broken_pairs(df: DataFrame, id_col: str, prompt_col: str, response_col: str, sample: int = SAMPLE) -> DataFrame:
    """(id, defect) of the defective pairs."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(prompt_col).cast("string").alias("prompt"), F.col(response_col).cast("string").alias("response"))
    rows = rows.where((F.col("prompt") != "") & F.col("response").isNotNull())
    picked = rows.orderBy(F.xxhash64("id"), "id", "prompt", "response").limit(sample).collect()
    told = df.sparkSession.sparkContext.broadcast(train(sorted({(r.prompt, r.response) for r in picked})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, limits = told.value
        for batch in batches:
            found = judge(list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())), w, limits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["id", "defect"])

    return rows.mapInArrow(run, "id long, defect string").where("defect is not null").distinct()
