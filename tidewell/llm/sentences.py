"""Sentence units in many languages, by semi-Markov dynamic programming over whole spans."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import spread

#: Starts of a span over so many places back are compared one by one, those before them by range maxima; the result is the same.
REACH = 6
#: Where an end mark has this score, no sentence ends.
IMPOSSIBLE = -9.0
#: What an end mark loses inside a quotation or bracket.
INSIDE = 6.0
#: Straight quotes of a block in which one has no partner (an inch mark, say, which pairs with the next quotation's) hold less the longer they are: half of INSIDE at so many characters.
DOUBTFUL = 400
#: A span of more letters loses LONG for each of the next UP_TO ones. The sum, 2, is less than a cut inside a quotation costs, so quotations of any length stay whole.
USUAL, LONG, UP_TO = 300, 0.0005, 4_000

# Abbreviations after which a sentence goes on, by language.
GOES_ON = {
    *"Mr Mrs Ms Dr Prof St Mt Rev Hon Gen Col Capt Lt Sgt Fig fig vs Vs approx incl excl cf ca viz Eq Sec Ch Vol pp p ed eds Messrs".split(),
    *"Hr Fr Nr Str bzw usw evtl ggf inkl zzgl vgl sog bspw Abb Tel Mio Mrd".split(),
    *"Sr Sra Srta Sres Dra D Dña Av Avda núm Núm pág págs aprox Ud Uds Vd Lic Ing art".split(),
    *"M MM Mme Mmes Mlle Mgr env av bd réf chap".split(),
    *"डॉ श्री प्रो सुश्री रु कि".split(),
    *"e.g i.e z.B d.h u.a p.ex p.ej a.k.a o.ä".split(),
}
# Abbreviations that may also end a sentence.
MAY_END = {*"Ltd Inc Co Corp Jr etc al min sec hr hrs h ft oz lb a.m p.m am pm A.M P.M approx Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec Bros Ave Rd dept est no No usw etc EE.UU U.S U.K".split()} - GOES_ON
_FOLDED_ON, _FOLDED_END = {w.lower() for w in GOES_ON}, {w.lower() for w in MAY_END}
# Month names, before which a number with a point is a date.
MONTHS = set("Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember".split())
# Words that open a sentence oftener than they go on with one, and words that close one where no end mark stands.
OPENING = {*"But However Then Still Also Yet Aber Doch Dann Trotzdem Pero Sin Luego Entonces Además Mais Puis Ensuite Pourtant".split()}
OPENING_CJK = ("但是", "不过", "然后", "而且", "所以", "另外", "可是", "しかし", "でも", "また", "そして", "ただ")
CLOSING_CJK = ("了", "吧", "吗", "呢", "啊", "呀", "哦", "啦", "です", "ます", "ました", "でした", "ません", "よ", "ね")
# Words that bring in a speaker.
SPEECH = regex.compile(r"(?i)[\s\p{Pd}]*(?:\p{L}+[\s]+){0,3}?(?:said|says|asked|asks|shouted|replied|cried|called|added|whispered|wrote|answered|sagte|rief|fragte|meinte|antwortete|dit|demanda|cria|répondit|dijo|preguntó|gritó|respondió|exclamó)\b")
SPEECH_CJK = regex.compile(r"[^。！？!?…\n“”「」『』《》（）]{0,12}?(?:说|問い|问|喊|答|叫|嘟囔|表示|言った|言い|聞いた|答え|つぶや)")
SPEAKS = regex.compile(r"(?i)说|问|喊|答|回复|回覆|叫|表示|写道|言|聞|\b(?:said|says|asked|shouted|replied|wrote|added|sagte|rief|fragte|dit|demande|dijo|preguntó)\b")
PARTICLE = regex.compile(r"(?:と|って|という|といった|なんて|など|は(?!い)|が|を|に|の|へ|的)")

_BREAK = regex.compile(r"\r\n|[\n\r\u000b\u000c\u0085  ]")
_SPACE = r"\p{White_Space}"
_EMOJI = r"[\U0001F000-\U0001FAFF☀-➿⌚-⏿⬀-⯿\U000E0020-\U000E007F‍️︎⃣]"
_EMOJI_BASE = regex.compile(r"[\U0001F000-\U0001FAFF☀-➿⌚-⏿⬀-⯿]")
_STRONG = "。！？!?।॥؟۔｡！？‼⁇⁈⁉።"
_CLOSER = "”’」』»›）)］]】〉》〕｣\"'"
_END = regex.compile(rf"[{_STRONG}.．…⋯]+(?:[{_SPACE}]*[{_STRONG}]+)*")
_TAIL = regex.compile(rf"(?:[{regex.escape(_CLOSER)}]|[    ](?=[»›])|[{_SPACE}]*{_EMOJI}+(?:[{_STRONG}.．…]+)?)*")
_FLAGS = {"\U0001F3F4", *map(chr, range(0x1F1E6, 0x1F200))}
_ONLY_EMOJI = regex.compile(rf"{_EMOJI}+")
_PAIRS = {"“": "”", "「": "」", "『": "』", "«": "»", "‹": "›", "（": "）", "(": ")", "［": "］", "[": "]", "【": "】", "〈": "〉", "《": "》", "〔": "〕", "｢": "｣", "„": "“"}
_BRACKETS = {"）", ")", "］", "]", "】", "〕"}
_QUOTES = {"”", "」", "』", "»", "›", "“", '"', "｣"}
_MARK = regex.compile("[" + regex.escape("".join({*_PAIRS, *_PAIRS.values(), '"'})) + "]")
_LETTER = regex.compile(r"[\p{L}\p{N}]")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_THAI = regex.compile(r"\p{Thai}")
_WHITE = regex.compile(rf"[{_SPACE}]+")
_NOT_NEXT = set(",，、;；:：。.！？!?…)）」』”»]】》〉›")
_LABEL = regex.compile(rf"[{_SPACE}]*(?:[-*•·–—▪●○◦■□]+[{_SPACE}]+|[(（]?\d{{1,3}}[)）.、．]+[{_SPACE}]*(?=\D)|[①-⑳][{_SPACE}]*|[一二三四五六七八九十]{{1,3}}、|[\p{{L}}][\p{{L}}\p{{N}} ]{{0,14}}[:：][{_SPACE}]*)+")
_ITEM = regex.compile(rf"[{_SPACE}]*(?:[-*•·–—▪●○◦■□][{_SPACE}]|[(（]?\d{{1,3}}[)）.、．](?!\d)|[①-⑳]|[一二三四五六七八九十]{{1,3}}、|[\p{{L}}][\p{{L}}\p{{N}}]{{0,9}}[:：])")
_WORD_BACK = regex.compile(r"(?r)[\p{L}\p{N}\p{M}.]+")
_LAST_BACK = regex.compile(r"(?r)[\p{L}\p{N}\p{M}]+")
_WORD = regex.compile(r"\p{L}+")
_MEASURE = regex.compile(rf"\d[{_SPACE}]?$")
_SPACE_OR_ODD = regex.compile(r"\s|[/@_]")
_STRONG_MARK = regex.compile(f"[{_STRONG}]")
_POINT = regex.compile("[.…]")
_WRAP_AT_LEAST = 36


def _blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of each line, or of each paragraph whose lines are only wrapped to a width."""
    lines, at = [], 0
    for m in _BREAK.finditer(text):
        lines.append((at, m.start()))
        at = m.end()
    lines.append((at, len(text)))
    if len(lines) == 1:
        return lines
    full = [bool(text[a:b].strip()) for a, b in lines]
    size = [len(text[a:b].rstrip()) for a, b in lines]
    inner = sorted(size[k] for k in range(len(lines) - 1) if full[k] and full[k + 1])
    width = inner[len(inner) // 2] if inner else 0
    out, k = [], 0
    while k < len(lines):
        if not full[k]:
            k += 1
            continue
        e = k
        while e + 1 < len(lines) and full[e + 1]:
            e += 1
        joins, listed = [], bool(_ITEM.match(text, *lines[k]))
        for i in range(k, e):
            a, b = lines[i + 1]
            line = text[lines[i][0] : lines[i][1]].rstrip()
            fills = size[i] >= width - 2 if 2 * len(_CJK.findall(line)) > len(line) else size[i] + 1 + len(text[a:b].split(None, 1)[0]) > 0.9 * width
            # "said:" or "3." at the head of a line may also be the wrapped middle of a sentence
            item = _ITEM.match(text, a, b) and (listed or line[-1] in _STRONG + _CLOSER + ".:：" or _EMOJI_BASE.match(line[-1]))
            joins.append(width >= _WRAP_AT_LEAST and fills and not item and not _THAI.search(text, a, b))
        # sentences that just lie on lines of their own aren't wrapped
        inside = [i for i, j in zip(range(k, e), joins) if j]
        if inside and all(text[lines[i][0] : lines[i][1]].rstrip().endswith(tuple("。！？!?.।؟")) for i in inside) and len(inside) > 1:
            joins = [False] * len(joins)
        if inside and sum(joins) * 10 < len([i for i in range(k, e) if not _ITEM.match(text, *lines[i + 1])]) * 8:
            joins = [False] * len(joins)
        start = lines[k][0]
        for i in range(k, e + 1):
            if i == e or not joins[i - k]:
                out.append((start, lines[i][1]))
                if i < e:
                    start = lines[i + 1][0]
        k = e + 1
    return out


def _matched(text: str) -> dict[int, int]:
    """Place of the opening mark of each closing one."""
    stack: list[tuple[str, int]] = []
    opener: dict[int, int] = {}
    for m in _MARK.finditer(text):
        c, p = m[0], m.start()
        if c == '"':
            if any(x == '"' for x, _ in stack):
                while stack and stack[-1][0] != '"':
                    stack.pop()
                opener[p] = stack.pop()[1]
            elif p + 1 < len(text) and not text[p + 1].isspace():
                stack.append(('"', p))
            continue
        if c == "“" and any(x == "“" for x, _ in stack):  # closes „
            while stack[-1][0] != "“":
                stack.pop()
            opener[p] = stack.pop()[1]
        elif c in _PAIRS:
            stack.append((_PAIRS[c], p))
        elif any(x == c for x, _ in stack):
            while stack[-1][0] != c:
                stack.pop()
            opener[p] = stack.pop()[1]
    return opener


def _next(text: str, p: int) -> tuple[int, str]:
    """The first character after white space from p on."""
    while p < len(text) and text[p].isspace():
        p += 1
    return p, text[p] if p < len(text) else ""


class _Odd:
    """Whether the word before a place holds one of / @ _, for places in rising order; the text is read once."""

    def __init__(self, text: str, start: int):
        self.text, self.read, self.space, self.sign = text, start, -1, -1

    def in_word_before(self, place: int) -> bool:
        for m in _SPACE_OR_ODD.finditer(self.text, self.read, place):
            if m[0].isspace():
                self.space = m.start()
            else:
                self.sign = m.start()
        self.read = max(self.read, place)
        return self.sign > self.space


def _closing(text: str, start: int, end: int, tail: int, after: int, nxt: str, cased: bool, odd: _Odd) -> float:
    """How well text[start:end] (an end mark) and the words before and after it close a sentence. cased: whether upper case tells anything here."""
    mark = text[start:end]
    spaced = after > tail
    lower = (cased and nxt.islower()) or (nxt in "'’-" and not spaced)
    cjk = bool(_CJK.match(nxt))
    opens = (cased and nxt.isupper()) or nxt in "¿¡“「『«‹（([【《„\"-–—•"
    strong = any(c in _STRONG for c in mark)
    if nxt in _NOT_NEXT and not (nxt in "…." and spaced):
        return -9.0
    if not strong and ("…" in mark or "⋯" in mark or len(mark.strip()) > 1):  # an ellipsis
        if tail > end and any(c in _QUOTES for c in text[end:tail]):
            return 1.0 if opens or cjk else -1.0
        if _EMOJI_BASE.search(text, end, tail):
            return 1.5
        return 2.0 if opens and spaced and nxt not in "-–—" else -3.0
    if strong:
        if lower:
            return -4.0
        ascii_mark = all(c in "!?." for c in mark.strip())
        if ascii_mark and tail == end and not spaced and not cjk and not opens and not _EMOJI_BASE.match(nxt):
            return -9.0 if nxt.isascii() else 2.0
        return 3.0 + (0.5 if opens else 0.0)
    # a single point
    if tail == end and not spaced:  # only the letters next to it are read, so that points without spaces between them cost no more than their text
        before = _LAST_BACK.match(text, 0, start)
        word = before[0] if before else ""
        if nxt.isupper() and len(word) > 1 and word[-1].islower() and text[start - len(word) - 1 : start - len(word)] != "." and word not in GOES_ON:
            return -9.0 if odd.in_word_before(start) else 1.0
        return 1.5 if cjk and (word and not word[-1].isdigit() or text[start - 1 : start] == ".") else -9.0
    before = _WORD_BACK.match(text, 0, start)
    word = before[0] if before else ""
    if lower:
        return -5.0
    score = 2.0 + (1.0 if opens else 0.0)
    last = word.rsplit(".", 1)[-1]
    goes_on, may_end = (GOES_ON, MAY_END) if cased else (_FOLDED_ON, _FOLDED_END)
    if not cased:
        word, last = word.lower(), last.lower()
    if word in goes_on or last in goes_on:
        return -8.0
    if word in ("m", "g", "s", "l", "h") and _MEASURE.search(text[max(0, start - 6) : start - 1]):
        return score - 0.5 if opens or not cased else -1.0  # a unit
    if len(last) == 1 and last.isalpha() and (last.isupper() or last.isascii()) and word not in may_end:
        return -8.0  # initials
    if word in may_end or last in may_end:
        if last in ("no", "No") and nxt.isdigit():
            return -8.0
        return score - 1.5 if opens else -1.0
    if word.isdigit():
        follower = _WORD.match(text, after)
        if follower and follower[0].capitalize() in MONTHS:
            return -8.0
    return score


def _candidates(text: str, start: int, opener: dict[int, int], cased: bool) -> list[tuple[int, int, float, int, str]]:
    """Where a sentence may end: (end of the sentence, start of the next, score, place of the mark that the last closing one pairs with, that closing mark)."""
    out = []
    at, odd = start, _Odd(text, start)
    for m in _END.finditer(text, start):
        if m.start() < at:
            continue
        end = len(m[0].rstrip()) + m.start()
        tail = _TAIL.match(text, end).end()
        while tail > end and text[tail - 1].isspace():
            tail -= 1
        # a closing-looking mark that in truth opens the next quotation
        k = end
        while k < tail:
            if text[k] == '"' and k not in opener or text[k] == "'" and k > end and text[k - 1].isspace():
                tail = k
                break
            k += 1
        after, nxt = _next(text, tail)
        if not nxt:
            break
        score = _closing(text, m.start(), end, tail, after, nxt, cased, odd)
        last = next((k for k in range(tail - 1, end - 1, -1) if k in opener), -1)
        out.append((tail, after, score, opener.get(last, -1), text[last] if last >= 0 else ""))
        at = tail
    return out


def _emoji_ends(text: str, start: int, taken: set[int], cased: bool) -> list[tuple[int, int, float, int, str]]:
    """Emoji that stand for an end mark."""
    out = []
    for m in _ONLY_EMOJI.finditer(text, start):
        if not _EMOJI_BASE.search(m[0]) or m.end() in taken:
            continue
        after, nxt = _next(text, m.end())
        if not nxt or nxt in _NOT_NEXT or _EMOJI_BASE.match(nxt):
            continue
        spaced = after > m.end()
        if nxt.isupper() or nxt in "¿¡“「«„\"(（":
            score = 2.0 if spaced else -0.5
        elif nxt.islower() and cased:
            score = -3.0
        else:
            score = 1.0 if spaced else -1.5
        if m[0][0] in _FLAGS:  # a flag is named rather than felt
            score -= 2.5
        out.append((m.end(), after, score, -1, ""))
    return out


class _Maxima:
    """Values that are appended, and the last place of the largest one in a range (sparse table)."""

    def __init__(self):
        self.values, self.levels = [], [[]]

    def append(self, value: float) -> None:
        n = len(self.values)
        self.values.append(value)
        self.levels[0].append(n)
        k = 1
        while (1 << k) <= n + 1:
            if k == len(self.levels):
                self.levels.append([])
            self.levels[k].append(self._better(self.levels[k - 1][n + 1 - (1 << k)], self.levels[k - 1][-1]))
            k += 1

    def _better(self, a: int, b: int) -> int:
        return b if self.values[b] >= self.values[a] else a

    def last_best(self, a: int, b: int) -> int:
        """Of the places a to b - 1, a < b."""
        k = (b - a).bit_length() - 1
        return self._better(self.levels[k][a], self.levels[k][b - (1 << k)])


def _pieces(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Sentences of one block, by dynamic programming over whole spans."""
    block = text[a:b]
    lead = len(block) - len(block.lstrip())
    block = block.rstrip()
    if not block.strip():
        return []
    label = _LABEL.match(block)
    head = label.end() if label else lead
    if head >= len(block):
        head = lead
    opener = _matched(block)
    body = block[head:]
    plain = body.isascii()
    n_letters = 0 if plain else sum(map(str.isalnum, body))
    thai = 0 if plain or not _THAI.search(body) else len(_THAI.findall(body))
    has_cjk = not plain and not thai and len(_CJK.findall(body)) * 2 > n_letters
    cased = not (body.islower() or body.isupper()) and body.lower() != body.upper()
    ends = _candidates(block, head, opener, cased)
    if not plain:
        ends += _emoji_ends(block, head, {e[0] for e in ends}, cased)
        if (thai and thai * 2 > n_letters) or (has_cjk and "…" not in body and not _STRONG_MARK.search(body) and not (_POINT.search(body) and not _CJK.search(body))):
            known = {e[1] for e in ends}
            for m in _WHITE.finditer(block, head):
                if m.end() not in known and m.end() < len(block) and block[m.start() - 1] not in ":：":
                    ends.append((m.start(), m.end(), 3.0, -1, ""))
    ends = sorted(e for e in ends if e[2] > IMPOSSIBLE)
    if not ends:
        return [(a + lead, a + len(block))]
    depth = None
    if opener:
        weight = [0.0] * (len(block) + 2)
        doubtful = block.count('"') != 2 * sum(block[k] == '"' for k in opener)
        for close, open_ in opener.items():
            w = INSIDE * DOUBTFUL / (DOUBTFUL + close - open_) if doubtful and block[close] == '"' else INSIDE
            weight[open_ + 1] += w
            weight[close + 1] -= w
        depth = list(accumulate(weight))
    stops = [(lead, lead, 0.0, -1, "")] + ends + [(len(block), len(block), 0.0, -1, "")]
    letters = [0, *accumulate(map(str.isalnum, block))]
    begins = [x[1] for x in stops]
    begun = [letters[x] for x in begins]
    flat, sloped = _Maxima(), _Maxima()
    best, back = [_opens(block, lead, plain, cased)], [0]
    for j in range(1, len(stops)):
        end, after, closing, opened, closer = stops[j]
        last = j == len(stops) - 1
        fixed = closing
        if not last:
            if depth is not None:
                fixed -= depth[end]
            if not plain and block.endswith(CLOSING_CJK, 0, end):
                fixed += 0.25
        speech = bracket = 0.0
        if closer and not last:
            if closer in _QUOTES:
                if PARTICLE.match(block, end):
                    fixed -= 7.0
                if SPEECH_CJK.match(block, end) or SPEECH.match(block, end):
                    speech = 6.0
            elif closer in _BRACKETS:
                bracket = 4.0
                if PARTICLE.match(block, end):
                    fixed -= 4.0
            lead_in = block[:opened].rstrip() if speech or bracket else ""
            fresh = not lead_in or lead_in[-1] in _STRONG + "." or (opened == head and not SPEAKS.search(lead_in))
        told = bool(speech or bracket)
        top, arg = -1e18, j - 1
        far = max(0, j - REACH)
        places: Iterable[int] = range(j - 1, far - 1, -1)
        here = letters[end]
        if far:
            # the score of a start is its best, and terms that are the same, or in line with its letters, between these bounds
            flat.append(best[far - 1])
            sloped.append(best[far - 1] + LONG * begun[far - 1])
            longest, usual = (bisect_left(begun, here - n, 0, far) for n in (USUAL + UP_TO, USUAL))
            bounds = {0, far, longest, usual, bisect_left(begun, here - 1, 0, far), bisect_left(begun, here, 0, far)}
            if told:
                bounds.add(bisect_left(begins, opened, 0, far))
            cuts = sorted(bounds, reverse=True)
            places = chain(places, ((sloped if longest < y <= usual else flat).last_best(x, y) for y, x in zip(cuts, cuts[1:])))
        for i in places:
            score = best[i] + fixed
            n = here - begun[i]
            if n <= 1:
                score -= 0.5 if n else 8.0  # symbols alone are no sentence
            elif n > USUAL:
                score -= LONG * min(n - USUAL, UP_TO)
            if told:
                score -= speech if opened <= begins[i] or fresh else bracket
            if score > top:
                top, arg = score, i
        best.append(top + (0.0 if last else _opens(block, after, plain, cased)))
        back.append(arg)
    spans, j = [], len(stops) - 1
    while j > 0:
        i = back[j]
        spans.append((a + stops[i][1], a + stops[j][0]))
        j = i
    return spans[::-1]


def _opens(text: str, place: int, plain: bool, cased: bool) -> float:
    """How well the word at a place opens a sentence."""
    word = _WORD.match(text, place)
    if word is None:
        return 0.0
    if not plain and text.startswith(OPENING_CJK, place):
        return 0.25
    w = word[0]
    return 0.25 if w in OPENING else -0.25 if cased and w.islower() else 0.0


def split_sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence in code points, without outer white space; none for null, empty and white-space-only texts."""
    if not text:
        return []
    first = 1 if text[0] == "﻿" else 0
    if not _LETTER.search(text):
        s = text[first:]
        a = first + len(s) - len(s.lstrip())
        b = len(text.rstrip())
        return [(a, b)] if a < b else []
    if first:
        text = " " + text[1:]
    out = []
    for a, b in _blocks(text):
        out += [(x, y) for x, y in _pieces(text, a, b) if x < y]
    return out


def sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, start_char, end_char): one row for each sentence of each row of docs; offsets in code points, end exclusive.

    Null, empty and white-space-only texts have none, a text of symbols only is one sentence. Texts are read whole, of any length. Rows that
    repeat with the same key and text give the same rows, which are kept once for each row.
    Documents are split where they are read; only a table of a few MB is spread first (see session.spread).
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null and text <> ''")
    rows = spread(rows, "key", "text")
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, start, end = [], [], []
            for k, t in enumerate(b.column(1)):
                for x, y in split_sentences(t.as_py()):
                    who.append(k)
                    start.append(x)
                    end.append(y)
            if who:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who)), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["key", "start_char", "end_char"])

    return rows.mapInArrow(run, f"key {kind}, start_char int, end_char int").withColumnRenamed("key", key)
