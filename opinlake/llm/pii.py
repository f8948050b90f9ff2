"""Personal information inside free text (problem 5).

Method: a semi-Markov conditional random field. Candidate segments are proposed loosely by their shape, scored as whole spans (shape,
length, parts, neighbouring words, how common their words are and whether they occur in small letters) and chosen jointly, boundaries and
types together, by dynamic programming over non-overlapping segments; only one segment's length is bounded, by its grammar.

Training (on the driver, seeded) has no sentences of its own. Invented values (e-mail addresses, numbers in national forms, addresses, names) are
put at random places of sentences of the corpus, now and then beside a plain cue word, among number groups of any other shape, dates, amounts and
stretches written in capitals; conditional likelihood by stochastic gradient steps. Then the model reads the sampled texts itself, and what
it is sure of, for and against, teaches it the corpus' own ways of saying things (self-training). The sample (``TRAIN_ROWS``) serves the classifier
only; how common words are is counted over all texts of the table.

Scale: one aggregate of fixed size for the words and one narrow pass, no shuffle; whole texts. Equal texts of a batch, such as a post's body on all its
comment rows, are read once. A Korean, Chinese or Japanese run of characters or a pair of words in one case is a candidate name only if it is rarer than
``RARE`` says, relative to the number of texts, so that the size of the table doesn't matter.

Defined results: null and empty texts have no findings and stay as they are; overlapping readings are settled by the highest total score;
repeated rows give repeated results by their own keys; empty tables give empty results.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import filled
from . import store, sums
from .samples import bounded

TRAIN_ROWS = 8000
MADE = 7000
SURE = 0.93
SAMPLE_CHARS = 2000  # of a sampled text, for the classifier only: bounds what the driver gets
TYPES = ("email", "phone", "id_number", "address", "name")
FIELDS = ("comment_text", "text")
WORD_BITS = 19
PER = 20000.0  # a word's level is the binary logarithm of its number of texts, beyond two, in so many
RARE = 3

# Fixed values of the languages: spoken digits, family names, titles, particles, and words of streets.
KO_DIGITS = "공영일이삼사오육칠팔구"
KO_FAMILY = "김이박최정강조윤장임한오서신권황안송류전홍고문양손배백허유남심노하곽성차주우구민진지엄채원천방공현함변염여추도소석선설마길연위표명기반라왕금옥육인맹제모탁국어은편용예봉경사부황가복태목형두감음빈동온호범좌팽승간상견당돈빙갈묵매초옹궁단화뇌변묘"
KO_FAMILY_2 = ("남궁", "황보", "제갈", "사공", "선우", "서문", "독고", "동방", "어금", "망절", "강전", "소봉", "장곡", "무본")
KO_TITLES = "씨 님 군 양 여사 선생 교수 박사 기자 의원 변호사 사장 부장 과장 차장 대리 주임 팀장 실장 대표 이사 위원 간사 계장".split()
KO_PARTICLES = "은 는 이 가 을 를 의 도 과 와 만 에게 한테 께 께서 이라고 라고 이라는 라는 이란 이랑 랑 인데 이고 입니다 이에요 예요 이다 로 으로 처럼 보다 까지 부터 하고".split()
ZH_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
JA_TITLES = "さん|様|さま|氏|くん|君|ちゃん|先生"
STREETS_EN = "Street|St|Lane|Road|Rd|Way|Crescent|Court|Avenue|Ave|Drive|Close|Place|Terrace|Boulevard|Blvd|Square|Row|Hill|Gardens|Walk|Alley"
STREETS_ES = "calle|avenida|avda|plaza|paseo|camino|carrera|ronda|travesía|rua|travessa|alameda|praça|C/"
STREETS_DE = "straße|strasse|str|weg|gasse|allee|platz|ring|damm|ufer|steig|pfad|hof|chaussee"

_FAMILY_2 = frozenset(KO_FAMILY_2)
KO_TAILS = frozenset(a + b + c for a in ("", *KO_TITLES) for b in (("", "님") if len(a) > 1 else ("",)) for c in ("", *KO_PARTICLES))

LEADERS = frozenset("the a an my our your his her their this that these those when if within both one so why i we he she they it in on at by from for with and or but as to of no not may is was are were be has have die der das den dem ein eine einen einem meine mein unsere ihre seine wenn seit nach im am auf aus und oder ich wir sie er es ist war el la los las un una unos mi mis su sus si en desde cada todo este esta por para según después es o os as um uma meu minha se na com é".split())

_AT = r"(?: ?@ ?| ?[\[({] ?(?:at|골뱅이|arroba|ät) ?[\])}] ?| ?골뱅이 ?| (?:at|arroba|ät) )"
_DOT = r"(?:\.| ?[\[({] ?(?:dot|점|punto|punkt) ?[\])}] ?| (?:dot|punto|punkt) | ?닷 ?)"
_EMAIL = re.compile(rf"[A-Za-z0-9][A-Za-z0-9._+%-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_NUMBER = re.compile(r"(?:\+ ?)?\(?(?<![\w.,-])(?<![\w][/-])[0-9OolI]{1,14}(?:[ .\-–()/·,]{1,3}[0-9OolI]{1,13}){0,6}(?:-?[A-Z](?![a-z]))?(?:[0-9]{3}(?![\d\w]))?")
_SPOKEN = re.compile(rf"(?<![가-힣])[{KO_DIGITS}]{{2,4}}(?:[ .\-]?[{KO_DIGITS}]{{3,4}}){{1,3}}(?![가-힣])")
_SPOKEN_EN = re.compile(r"\b(?:(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|double|cero|uno|dos|tres|cuatro|cinco|seis|siete|ocho|nueve|null|eins|zwei|drei|vier|fünf|sechs|sieben|acht|neun)[ -]){6,15}(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|cero|uno|dos|tres|cuatro|cinco|seis|siete|ocho|nueve|null|eins|zwei|drei|vier|fünf|sechs|sieben|acht|neun)\b", re.I)
_ADDR_KO = re.compile(r"(?:[가-힣]{1,5}(?:특별시|광역시|특별자치도|시|도|군) ?)?(?:[가-힣]{1,5}(?:구|동|면|읍|군|시) ?){0,2}[가-힣]{1,8}\d{0,3}(?:로|길|울|고개|거리|골)(?:\d{1,3}번?길)? ?\d{1,5}(?:-\d{1,4})?(?:번지)?(?:,? ?\d{1,4}동)?(?:,? ?\d{1,5}호)?(?:,? ?지?하? ?\d{1,3}층)?|(?:[가-힣]{1,5}(?:시|군|구|도) ){1,3}[가-힣]{1,6}(?:동|리|면|읍|가) ?\d{1,5}(?:-\d{1,4})?(?:번지)?(?:,? ?\d{1,4}동)?(?:,? ?\d{1,5}호)?(?:,? ?\d{1,3}층)?")
_ADDR_EN = re.compile(rf"\b\d{{1,5}}[A-Za-z]?,? (?:[A-Z][\w'’]+ ){{1,4}}(?:{STREETS_EN})\b\.?(?:,? (?:Apt|Flat|Unit|Suite|Apartment|Floor|No)\.? ?\w{{1,5}})?(?:,? (?:[A-Z][a-z]+)(?: [A-Z][a-z]+)?)?", re.I)
_ADDR_ES = re.compile(rf"\b(?:{STREETS_ES})\.? (?:(?:de|del|la|las|los|da|do|dos|das|el) )*(?:[A-ZÁÉÍÓÚÑ][\wáéíóúñçãõ]+ ?(?:(?:de|del|la|las|los|da|do) )*){{1,4}},? ?(?:n[º°o]\.? ?)?\d{{1,5}}[A-Za-z]?(?:,? \d{{1,2}}[º°ª]? ?[A-Z]?\b)?(?:,? [A-ZÁÉÍÓÚÑ][\wáéíóúñ]+(?: [A-ZÁÉÍÓÚÑ][\wáéíóúñ]+)?)?", re.I)
_ADDR_DE = re.compile(rf"\b(?:(?:[A-ZÄÖÜ][\wäöüß]+|[Aa]m|[Aa]n der|[Ii]n der|[Zz]ur|[Zz]um) ){{0,2}}[A-ZÄÖÜ][\wäöüß]*(?:{STREETS_DE})\.? \d{{1,4}} ?[a-z]?\b(?:,? \d{{5}} [A-ZÄÖÜ][\wäöüß]+)?", re.I)
_ADDR_CJK = re.compile(r"[一-鿿ぁ-んァ-ヶ]{1,8}(?:都|道|府|県|市|区|町|村|路|街|大道|丁目)[一-鿿ぁ-んァ-ヶ]{0,8}\d{1,4}(?:丁目|番地|番|号|號|弄|室|-\d{1,4})+(?:\d{1,4}(?:号|番地|室|楼))*")
_ID = re.compile(r"(?<![\w-])[0-9]{2} ?[0-9]{3} ?[0-9]{3} ?[0-9]{3}(?!\w)|(?<![\w-])[0-9]{8}[A-Z][0-9]{3}(?!\w)|(?<![\w.-])[XYZ]-?[0-9]{7}-?[A-Z](?!\w)|(?<![\w.-])[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}(?!\w)|(?<![\w.-])[0-9]{2}\.?[0-9]{3}\.?[0-9]{3}-?[A-Z](?!\w)|(?<!\w)[A-Z]{1,2}[0-9]{6,9}[A-Z]?(?!\w)")
_NAME_KO = re.compile(rf"(?<![가-힣])[{KO_FAMILY}{''.join(x[0] for x in KO_FAMILY_2)}][가-힣]{{1,9}}(?![가-힣])")
_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ’']+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?"
_NAME_LATIN = re.compile(rf"(?<![\w@.-]){_CAP}(?: [A-ZÀ-Ö]\.)?(?: (?:de|del|von|van|da|dos|de la) )?(?: ?{_CAP}){{1,2}}(?![\w@])")
_NAME_JA = re.compile(rf"(?<![一-鿿])[一-鿿]{{3,5}}(?![一-鿿])|[一-鿿]{{2,5}}?(?= ?(?:{JA_TITLES}))")
_OPENS = "\"'“‘(<[:,/"
_TAIL = re.compile(r"\d[^.!?]*, ?$")
_HAN = re.compile("[一-鿿]{2,}")
_KANA = re.compile("[ぁ-ヶ]")
_LATIN_WORD = re.compile(r"(?<![\w@./-])[^\W\d_가-힣一-鿿ぁ-ヶ]{3,}(?![\w@])")
_WORDS = re.compile(r"[가-힣]+|[一-鿿]+|[ぁ-ゖ]+|[ァ-ヶー]+|[^\W\d_가-힣一-鿿ぁ-ヶー]+")
_TOKEN = re.compile(r"[가-힣]+|[一-鿿]|[ぁ-ゖ]{1,2}|[^\W\d_가-힣一-鿿ぁ-ゖ]+|\d+|[^\w\s]")
# What each grammar can't do without, as cheap tests: a text that fails one has no candidate of that grammar.
_DIGIT = re.compile(r"\d")
_HANGUL = re.compile("[가-힣]")
_LATIN = re.compile("[A-Za-zÀ-ÿ]")
_AT_HOST = re.compile(rf" (?:at|ät|arroba) [A-Za-z0-9-]+{_DOT}", re.I)
_KO_NUMBERED = re.compile(r"[로길울개리골동면읍가](?:\d{1,3}(?:번?길|로|길)?)? ?\d")
_SPACED_DIGIT = re.compile(r" \d")
_ID_DIGITS = re.compile(r"[0-9]{2}(?:[0-9]{4}|[ .]?[0-9]{3}[ .]?[0-9]{3})")
_HAN_3 = re.compile("[一-鿿]{3}")
_DE_ENDS = tuple(STREETS_DE.split("|"))
_ES_STARTS = tuple(STREETS_ES.lower().split("|"))
_SPOKEN_WORDS = frozenset("zero oh one two three four five six seven eight nine double cero uno dos tres cuatro cinco seis siete ocho nueve null eins zwei drei vier fünf sechs sieben acht neun".split())


def word_ids(text: str) -> tuple[set[str], set[str]]:
    """The different words of a text in small letters (pairs of Han characters count as words too), and as they stand; one set if they are the same."""
    words = set(_WORDS.findall(text))
    han = _HAN_3.search(text) is not None
    if not han and text == text.lower():
        return words, words
    out = set(map(str.lower, words))
    for w in words if han else ():
        if len(w) > 2 and "一" <= w[0] <= "鿿":
            out.update(w[i:i + 2] for i in range(len(w) - 1))
    return out, words


def word_counts(texts: Iterable[str], total: np.ndarray) -> None:
    """Adds, hashed, the number of texts that hold each word and that hold it in small letters, and last the number of texts."""
    n, plain, lowered, cased = 0, Counter(), Counter(), Counter()
    for t in texts:
        low, words = word_ids(t)
        if low is words:
            plain.update(words)
        else:
            lowered.update(low)
            cased.update(words)
        n += 1
    seen = plain + lowered
    small = {w: k for w, k in (plain + cased).items() if w.islower()}
    for base, counts in ((0, seen), (1 << WORD_BITS, small)):
        if counts:
            at = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in counts), dtype=np.int64, count=len(counts)) >> (32 - WORD_BITS)
            np.add.at(total, base + at, np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    total[-1] += n


def _ko_names(w: str, words) -> list[tuple[int, str, str, list[str]]]:
    """(length, rest of the word, title in the rest, features) of the names that a Korean word may start with."""
    two = w[:2] in _FAMILY_2
    if not two and w[0] not in KO_FAMILY:
        return []
    out = []
    for n in (3, 4, 5) if two else (2, 3, 4):
        if n <= len(w) and w[n:] in KO_TAILS:
            level = words.of(w[:n]) & 15
            if level <= RARE:
                tail = w[n:]
                out.append((n, tail, next((t for t in KO_TITLES if tail.startswith(t)), ""), ["ko", f"level={level}", f"len={n}", f"two={two}_{n}", f"often={two or w[0] in KO_FAMILY[:24]}", f"bare={not tail}", f"whole={words.of(w) & 15}"]))
    return out


class Kept(dict):
    """What a function says of each word, kept for a bounded number of words."""

    def __init__(self, say: Callable):
        super().__init__()
        self.say = say

    def __missing__(self, word: str):
        if len(self) > 200_000:
            self.clear()
        got = self[word] = self.say(word)
        return got


def _rare(word: str, words) -> bool:
    """Whether a Latin word in one case is rare enough for a name where case tells nothing."""
    return (word.islower() or word.isupper()) and (words.of(word) & 15) <= 2 and word.lower() not in LEADERS


class Words:
    """How common words are (0: two texts at most have it, up to 9) and whether they occur in small letters (16 added)."""

    def __init__(self, total: np.ndarray):
        n = 1 << WORD_BITS
        seen, small = total[:n], total[n:2 * n]
        level = np.minimum(np.rint(np.log2(1 + PER * np.maximum(seen - 2, 0) / max(total[-1], 1))), 9)
        self.code = (level + 16 * (small > 0.25 * np.maximum(seen, 1))).astype(np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known, self.named, self.rare = Kept(self._look_up), Kept(lambda w: _ko_names(w, self)), Kept(lambda w: _rare(w, self))
        self.of = self.known.__getitem__

    def _look_up(self, word: str) -> int:
        return int(self.code[zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) >> (32 - WORD_BITS)])

    def __getstate__(self) -> dict:
        return {"code": self.code}

    def __setstate__(self, state: dict) -> None:
        self.code = state["code"]
        self.forget()


class With:
    """Words of which some are known otherwise."""

    def __init__(self, words: Words, own: dict[str, int]):
        self.words, self.own = words, own
        self.named, self.rare = Kept(lambda w: _ko_names(w, self)), Kept(lambda w: _rare(w, self))

    def of(self, word: str) -> int:
        got = self.own.get(word.lower())
        return self.words.of(word) if got is None else got


class Span:
    """A candidate segment with the feature strings of each type it could have."""

    __slots__ = ("end", "feats", "start", "type")

    def __init__(self, start: int, end: int, kind: str, feats: list[str]):
        self.start, self.end, self.type, self.feats = start, end, kind, feats


def _around(text: str, a: int, b: int) -> list[str]:
    left, right = _TOKEN.findall(text[max(0, a - 40):a])[-3:], _TOKEN.findall(text[b:b + 40])[:3]
    left, right = [x.lower() for x in left], [x.lower() for x in right]
    out = [f"L1={left[-1] if left else '^'}", f"R1={right[0] if right else '$'}"]
    if left:
        out += [f"l={left[-1][:2]}", f"le={left[-1][-2:]}"]
    if len(left) > 1:
        out += [f"L2={left[-2]}", f"L21={left[-2]}_{left[-1]}"]
    if right:
        out += [f"r={right[0][:2]}", f"r1={right[0][:1]}"]
    if len(right) > 1:
        out.append(f"R12={right[0]}_{right[1]}")
    return out


def _number_feats(s: str) -> list[str]:
    shape = re.sub(r"[0-9OolI]+", lambda m: str(len(m[0])), s.strip())
    digits = re.sub(r"\D", "", s.replace("O", "0").replace("o", "0").replace("l", "1").replace("I", "1"))
    parts = re.findall(r"[0-9OolI]+", s)
    f = [f"shape={shape}", f"n={len(digits)}", f"parts={'-'.join(str(len(p)) for p in parts)}", f"start={digits[:2]}", f"start3={digits[:3]}", f"plus={'+' in s}", f"paren={'(' in s}", f"comma={',' in s}", f"slash={'/' in s}", f"letter={s[-1:].isalpha() and s[-1:].isupper()}", f"oh={'O1O' in s}", f"dots={s.count('.')}"]
    if len(digits) == 13:
        f.append(f"born={digits[2:4] < '13' and digits[4:6] < '32' and digits[6] in '12345678'}")
    if len(digits) in (10, 11):
        f.append(f"mobile={digits[:3] in ('010', '011', '016', '017', '018', '019')}")
    if re.match(r"(?:19|20)\d\d$", parts[0] if parts else ""):
        f.append(f"year_first_{len(parts)}")
    return f


def _levels(ws: list[str], words: Words) -> list[str]:
    codes = [words.of(w) for w in ws]
    top = [c & 15 for c in codes]
    small = sum(c > 15 for c in codes)
    return [f"rare={min(top)}", f"common={max(top)}", f"w0={top[0]}", f"w1={top[-1]}", f"small={small}", f"small0={codes[0] > 15}", f"small1={codes[-1] > 15}"]


def candidates(text: str, words: Words, gated: bool = True) -> list[Span]:
    """All candidate segments of a text; the grammar of each type is loose on purpose. Without the gates (cheap tests of what each grammar
    needs) the result is the same."""
    out: list[Span] = []

    def add(a: int, b: int, kind: str, feats: list[str]) -> None:
        while b > a and text[b - 1] in " ,":
            b -= 1
        while a < b and text[a] == " ":
            a += 1
        out.append(Span(a, b, kind, [f"{kind}|{x}" for x in ("bias", *feats, *_around(text, a, b))]))

    has_digit, hangul, latin = not gated or _DIGIT.search(text) is not None, not gated or _HANGUL.search(text) is not None, not gated or _LATIN.search(text) is not None
    low = text.lower() if latin else text
    if not gated or "@" in text or "골뱅이" in text or (latin and ("[" in text or "(" in text or "{" in text or _AT_HOST.search(text))):
        for m in _EMAIL.finditer(text):
            s = m[0]
            host = re.split(_AT, s, maxsplit=1, flags=re.I)[-1]
            if not re.split(_DOT, host, flags=re.I)[-1][:1].isalpha():
                continue  # no top-level domain starts with a digit
            feats = [f"sign={'@' in s}", f"bracket={'[' in s or '(' in s}", f"spelt={' at ' in s.lower()}", f"dots={len(re.findall(_DOT, host, re.I))}", f"tld={re.split(_DOT, host, flags=re.I)[-1].lower()[:7]}", f"spaces={min(s.count(' '), 4)}", f"len={min(len(s), 40) // 5}"]
            add(m.start(), m.end(), "email", feats)
    if has_digit:
        long = not gated or sum(map(text.count, "0123456789")) >= 6
        for m in _NUMBER.finditer(text) if long else ():
            s = m[0]
            if len(s) < 7:
                continue
            digits = sum(c.isdigit() or c in "OolI" for c in s)
            if 7 <= digits <= 19 and sum(c.isdigit() for c in s) >= 6:
                f = _number_feats(s)
                add(m.start(), m.end(), "phone", f)
                add(m.start(), m.end(), "id_number", f)
                # a shorter reading: the last part may belong to what follows
                cut = re.match(r"(.*[0-9OolI])[ ,.]{1,2}[0-9OolI]{1,3}$", s)
                if cut and sum(c.isdigit() or c in "OolI" for c in cut[1]) >= 7:
                    f = _number_feats(cut[1])
                    add(m.start(), m.start() + len(cut[1]), "phone", f)
                    add(m.start(), m.start() + len(cut[1]), "id_number", f)
        grammars = []
        if hangul and (not gated or _KO_NUMBERED.search(text)):
            grammars.append((_ADDR_KO, "ko"))
        if latin:
            grammars.append((_ADDR_EN, "en"))
            if not gated or any(w in low for w in _ES_STARTS):
                grammars.append((_ADDR_ES, "es"))
            if not gated or any(low[max(0, m.start() - 12):m.start()].removesuffix(".").endswith(_DE_ENDS) for m in _SPACED_DIGIT.finditer(low)):
                grammars.append((_ADDR_DE, "de"))
        grammars.append((_ADDR_CJK, "cjk"))
        whole = text.isupper() or text.islower()
        for pattern, lang in grammars:
            for m in pattern.finditer(text):
                s = m[0]
                own = re.findall(r"[^\W\d_]+", s)
                caps = sum(w[0].isupper() for w in own if len(w) > 2)
                add(m.start(), m.end(), "address", [
                    f"lang={lang}", f"words={min(len(own), 6)}", f"caps={lang}_{min(caps, 2)}_{caps == len([w for w in own if len(w) > 2])}_{whole}", f"first={own[0].lower()[-1] if own else ''}", f"unit={bool(re.search('번지|동|호|층|Apt|Flat|Unit|[º°ª]|, ?[0-9]{5} ', s))}",
                    f"stop={'. ' in s}", f"city={bool(re.match('[가-힣]{1,5}(?:시|도|군|구) ', s)) or s.count(',') > 0}", f"ko_parts={len(re.findall('[가-힣]+(?:시|군|구|면|동|읍|로|길|울) ?', s))}",
                ])
        for m in _ID.finditer(text) if long and (not gated or _ID_DIGITS.search(text)) else ():
            add(m.start(), m.end(), "id_number", ["special", *_number_feats(m[0])])
    if hangul:
        for m in _SPOKEN.finditer(text):
            n = sum(c in KO_DIGITS for c in m[0])
            if n >= 8:
                add(m.start(), m.end(), "phone", ["spoken", f"n={n}", f"start={m[0][:3]}"])
        named = words.named
        for m in _NAME_KO.finditer(text):
            for n, tail, title, own in named[m[0]]:
                gap = text[m.end():m.end() + 1] == " "
                after = next((t for t in KO_TITLES if text.startswith(t, m.end() + 1)), "") if gap and not tail else ""
                either = bool(title or after)
                glued = m.start() > 0 and not text[m.start() - 1].isspace() and text[m.start() - 1] not in _OPENS
                add(m.start(), m.start() + n, "name", [*own, f"either={either}", f"glued={glued}", f"level_len={own[1]}_{n}_{either}"])
    if latin and (not gated or sum(map(_SPOKEN_WORDS.__contains__, low.replace("-", " ").split(" "))) >= 5):
        for m in _SPOKEN_EN.finditer(text):
            add(m.start(), m.end(), "phone", ["spoken_en"])
    if latin:
        _latin_names(text, words, add, gated)
    if not (hangul and _HANGUL.search(text)):
        _han_names(text, words, add)
    return out


def _latin_names(text: str, words: Words, add, gated: bool) -> None:
    whole = text.isupper() or text.islower()
    taken = []
    for m in _NAME_LATIN.finditer(text):
        a, s = m.start(), m[0]
        taken.append((a, m.end()))
        parts = s.split(" ")
        for i in range(len(parts) - 1):  # also without leading words, such as a sentence's first
            if i and parts[i][1:2] == ".":
                continue
            if sum(len(p) > 2 for p in parts[i:]) < 2:
                break
            if parts[i].lower() in LEADERS or parts[-1].lower() in LEADERS:
                continue
            start = a + len(s) - len(" ".join(parts[i:]))
            ws = [p for p in parts[i:] if len(p) > 2]
            first = text[max(0, start - 2):start].strip()[-1:] in ("", ".", "!", "?")
            add(start, m.end(), "name", ["latin", f"words={len(parts) - i}", f"initial={any(len(p) == 2 and p[1] == '.' for p in parts[i:])}", f"first={first}", "case=c", *_levels(ws, words), f"skip={i}", f"tail={_TAIL.search(text[max(0, start - 45):start]) is not None}"])
    # a pair or three of rare words in one case, where case tells nothing
    if gated:
        rares = list(map(words.rare.__getitem__, _LATIN_WORD.findall(text)))
        if True not in map(operator.and_, rares, rares[1:]):
            return
    run: list = []
    for m in [*_LATIN_WORD.finditer(text), None]:
        rare = m is not None and words.rare[m[0]]
        near = rare and run and text[run[-1].end():m.start()] == " "
        if run and not near:
            for i in range(len(run) - 1):
                for j in (i + 2, i + 3):
                    if j <= len(run):
                        ws = [x[0] for x in run[i:j]]
                        add(run[i].start(), run[j - 1].end(), "name", ["latin", f"words={j - i}", f"case={'u' if ws[0].isupper() else 'l'}_{whole}", f"of={len(run)}", *_levels(ws, words)])
            run = []
        if rare:
            run.append(m)


def _han_names(text: str, words: Words, add) -> None:
    for m in _NAME_JA.finditer(text) if _KANA.search(text) else ():
        title = re.match(JA_TITLES, text[m.end():m.end() + 4].strip())
        level = words.of(m[0]) & 15
        if level <= RARE:
            add(m.start(), m.end(), "name", ["ja", f"len={m.end() - m.start()}", f"title={bool(title)}", f"level={level}", f"whole={not re.match('[一-鿿]', text[m.end():m.end() + 1] or ' ')}"])
    for m in _HAN.finditer(text):
        for i in range(len(m[0]) - 1):
            if m[0][i] not in ZH_FAMILY:
                continue
            for n in (2, 3):
                s = m[0][i:i + n]
                if len(s) == n and all((words.of(s[k:k + 2]) & 15) <= 2 for k in range(n - 1)):
                    level = max(words.of(s[k:k + 2]) & 15 for k in range(n - 1))
                    add(m.start() + i, m.start() + i + n, "name", ["zh", f"len={n}", f"family={s[0]}", f"level={level}", f"start={i == 0}", f"end={i + n == len(m[0])}"])


def best_path(spans: list[Span], weights: dict[str, float]) -> list[Span]:
    """The highest-scoring set of non-overlapping segments; text outside scores 0."""
    get = weights.get
    scored = [(v, s) for s in spans if (v := sum(filter(None, map(get, s.feats)))) > 0]
    scored.sort(key=lambda x: (x[1].end, x[1].start))
    ends = [s.end for _, s in scored]
    best, pick = [0.0], [None]
    for i, (v, s) in enumerate(scored):
        j = int(np.searchsorted(ends, s.start, side="right"))
        j = min(j, i)
        if best[j] + v > best[i]:
            best.append(best[j] + v)
            pick.append((j, s))
        else:
            best.append(best[i])
            pick.append((i, None))
    out, i = [], len(scored)
    while i > 0:
        j, s = pick[i]
        if s is not None:
            out.append(s)
        i = j
    return out[::-1]


def _marginals(spans: list[Span], weights: dict[str, float]) -> np.ndarray:
    """Probability of each segment under the model, by forward and backward sums over end positions."""
    order = sorted(range(len(spans)), key=lambda i: (spans[i].end, spans[i].start))
    value = np.array([sum(weights.get(f, 0.0) for f in s.feats) for s in spans])
    ends = np.array([spans[i].end for i in order])
    starts = np.array([spans[i].start for i in order])
    fwd = np.zeros(len(order) + 1)
    before = np.searchsorted(ends, starts, side="right")
    for k, i in enumerate(order):
        fwd[k + 1] = np.logaddexp(fwd[k], fwd[min(before[k], k)] + value[i])
    # backward: by starts, from the right
    back_order = sorted(range(len(spans)), key=lambda i: (-spans[i].start, -spans[i].end))
    b_starts = np.array([-spans[i].start for i in back_order])
    b_ends = np.array([-spans[i].end for i in back_order])
    after = np.searchsorted(b_starts, b_ends, side="right")
    bwd = np.zeros(len(order) + 1)
    for k, i in enumerate(back_order):
        bwd[k + 1] = np.logaddexp(bwd[k], bwd[min(after[k], k)] + value[i])
    rank_f = {i: k for k, i in enumerate(order)}
    rank_b = {i: k for k, i in enumerate(back_order)}
    p = np.zeros(len(spans))
    for i in range(len(spans)):
        p[i] = np.exp(min(0.0, fwd[min(before[rank_f[i]], rank_f[i])] + value[i] + bwd[min(after[rank_b[i]], rank_b[i])] - fwd[-1]))
    return p


class PiiModel:
    """Weights of whole-span features and how common words are."""

    def __init__(self, weights: dict[str, float], words: Words):
        self.weights, self.words = weights, words

    def find(self, text: str | None) -> list[Span]:
        if not text:
            return []
        spans = candidates(text, self.words)
        return best_path(spans, self.weights) if spans else []

    def redact(self, text: str | None) -> str | None:
        found = self.find(text)
        out, at = [], 0
        for s in found:
            out += [text[at:s.start], f"[{s.type.upper()}]"]
            at = s.end
        return "".join([*out, text[at:]]) if found else text


# --- training material: plain cue words, national number forms, and values made by rule; no sentences
# Words that may stand beside a value, per script.
CUES = {
    "phone": {"ko": "전화 휴대폰 핸드폰 연락 번호 팩스", "la": "phone tel call mobile cell dial fax teléfono móvil llama celular telefone ligue Telefon Handy Rufnummer", "ja": "電話 携帯", "zh": "电话 手机"},
    "email": {"ko": "메일 이메일 주소", "la": "mail e-mail email contact correo escribe contato Mail Kontakt schreib", "ja": "メール", "zh": "邮箱 邮件"},
    "id_number": {"ko": "주민번호 등록번호 신분증", "la": "SSN ID passport DNI NIE documento CPF Ausweis Steuernummer IdNr", "ja": "マイナンバー", "zh": "身份证"},
    "address": {"ko": "주소 거주 배송", "la": "address live home at near dirección vivo en morada moro Anschrift wohne in", "ja": "住所", "zh": "地址 住在"},
    "name": {"ko": "친구 동생 선배 후배 이웃 직원 동료 이모 고모 삼촌 사촌 조카 형 누나 언니 오빠 담당자 어머니 아버지", "la": "friend Mr Mrs Ms Dr doctor nurse teacher neighbour colleague by with named cousin aunt uncle boss clerk amigo amiga señor señora vecino vecina tía prima colega jefe Herr Frau Freund Freundin Nachbar Nachbarin Tante Onkel Kollege Kollegin", "ja": "友人", "zh": "朋友 同事"},
}
# Particles and words that may follow, per script.
AFTER = {"phone": "로 으로 입니다 번 예요", "email": "로 으로 입니다 에 예요", "id_number": "로 입니다 를 가 예요", "address": "에 에서 로 입니다 의", "name": "이 가 은 는 의"}
# Words beside numbers that identify nobody.
PLAIN = {"ko": "건 호 표 제 번 접수 기준 합계 판", "la": "no. ref file case table page ticket total bill section version expediente total ley artículo versión Akte Fall Gesetz Seite", "ja": "第 表", "zh": "第 表"}
_CONTEXT = re.compile(r"\|[LlRr][\w]*=")
UNKNOWN = {"name": 0.2, "address": 0.05}  # most of the corpus' own candidates are none; those of the other types say nothing
UNITS = {"ko": "번 명 분 년 시간 개 원 % 점 쪽 호 조", "la": "percent % people years hours units times pages euros points years", "ja": "件 年 円 人", "zh": "件 年 元 人"}
SOUNDS = "ba do mi le ro ka sun ver tal wyn bel mar ost nor lin gre hal pi quo sta vel zor fen dri".split()
SYLLABLES = "가나다라마바사아자차하고노도로모보소오조초호구누두루무부수우주추온솔빛별찬길늘결희람름새해달담봄은윤슬린빈든현민서준지예진영경숙철"


class _Maker:
    """Invented values and the texts that they are put into."""

    def __init__(self, seed: int, quiet: list[str]):
        self.r = np.random.default_rng(seed)
        self.by: dict[str, list[str]] = {"ko": [], "la": [], "ja": [], "zh": []}
        for t in quiet:
            self.by[script(t)].append(t)
        self.kinds = [k for k in ("ko", "la", "la", "ja", "zh") if self.by[k]] or ["ko", "la"]
        n = sum(map(len, self.by.values()))
        self.weights = np.array([max(0.06, len(self.by[k]) / max(n, 1) / (2 if k == "la" else 1)) for k in self.kinds])
        self.weights /= self.weights.sum()

    def one(self, xs):
        return xs[int(self.r.integers(0, len(xs)))]

    def d(self, n: int) -> str:
        return "".join(str(int(x)) for x in self.r.integers(0, 10, n))

    def n(self, a: int, b: int) -> int:
        return int(self.r.integers(a, b))

    def word(self, n: int) -> str:
        return "".join(self.one(SOUNDS) for _ in range(n))

    def syll(self, n: int) -> str:
        return "".join(self.one(SYLLABLES) for _ in range(n))

    def han(self, n: int) -> str:
        return "".join(chr(self.n(0x4E00, 0x9000)) for _ in range(n))

    def email(self, k: str) -> str:
        user = self.one([self.word(2), self.word(1) + self.one("._-") + self.word(1), self.word(2) + self.d(self.n(1, 5)), self.word(1)[0] + self.d(self.n(1, 4)), self.word(1) + "+" + self.word(1), self.word(1).upper() + self.d(2)])
        host = self.word(self.n(1, 3)) + self.one([".com", ".org", ".net", ".example", ".test", ".invalid", ".info", ".co.kr", ".de", ".es", ".example.org"])
        at, dot = self.one([("@", ".")] * 6 + [(" @ ", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("[at]", "."), ("(at)", "."), (" (at) ", " (dot) "), (" at ", "."), ("골뱅이", "."), (" 골뱅이 ", "."), (" arroba ", " punto ")])
        return user + at + host.replace(".", dot)

    def phone(self, k: str) -> str:
        d, one = self.d, self.one
        if k == "ko":
            a, b = d(self.one([4, 4, 4, 3])), d(4)
            if self.r.random() < 0.2:
                w = lambda x: "".join(KO_DIGITS[int(c)] for c in x)
                return one([" ", "", "-"]).join(("공일공", w(d(4)), w(b)))
            sep = one(["-", "-", " ", ".", "", " - "])
            head = one(["010", "010", "010", "011", "02", "0" + d(2), "(010)", "O1O", "070"])
            return one([head + sep + a + sep + b, "+82" + one([" ", "-", ""]) + "10" + sep + a + sep + b])
        if k in ("ja", "zh"):
            return f"0{d(1)}0-{d(4)}-{d(4)}" if k == "ja" else one([f"1{d(10)}", f"1{d(2)}-{d(4)}-{d(4)}", f"1{d(2)} {d(4)} {d(4)}"])
        return one([
            f"{d(3)}-{d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"1{self.n(2, 10)}{d(2)}{self.n(2, 10)}{d(6)}", f"+1 {d(3)} {d(3)} {d(4)}", f"+1-{d(3)}-{d(3)}-{d(4)}", f"020 {d(4)} {d(4)}", f"+44 20 {d(4)} {d(4)}", f"0{d(4)} {d(6)}",
            f"+34 {d(3)} {d(2)} {d(2)} {d(2)}", f"+34 {d(3)} {d(3)} {d(3)}", f"{d(3)} {d(3)} {d(3)}", f"{d(3)} {d(2)} {d(2)} {d(2)}", f"{d(3)}-{d(2)}-{d(2)}-{d(2)}", f"6{d(8)}", f"+351 {d(3)} {d(3)} {d(3)}", f"({d(2)}) 9{d(4)}-{d(4)}", f"+55 {d(2)} 9{d(4)} {d(4)}",
            f"0{d(2)} {d(5)} {d(3)}", f"(0{d(2)}) {d(5)}-{d(3)}", f"+49 {d(3)} {d(7)}", f"+49 {d(2)} {d(8)}", f"0{d(3)}/{d(7)}", f"0{d(2)} {d(8)}", f"0{d(2)}-{d(7)}", f"0{d(3)} {d(6)}",
        ])

    def id_number(self, k: str) -> str:
        d, one = self.d, self.one
        born = f"{self.n(30, 110) % 100:02d}{self.n(1, 13):02d}{self.n(1, 29):02d}"
        if k == "ko":
            return born + one(["-", "-", "-", " - ", " ", ""]) + one("12345678") + d(6)
        if k == "ja":
            return one([d(12), f"{d(4)}-{d(4)}-{d(4)}", f"{d(4)} {d(4)} {d(4)}"])
        if k == "zh":
            return f"{d(6)}{one(['19', '20'])}{born}{d(3)}{one('0123456789X')}"
        letter = one("TRWAGMYFPDXBNJZSQVHLCKE")
        a = one(["000", "666", "9" + d(2), d(3)])  # the first three are never given out
        return one([f"{a}-{d(2)}-{d(4)}", f"{a}-{d(2)}-{d(4)}", f"{a} {d(2)} {d(4)}", one(["000", "666", "9" + d(2)]) + d(6), one(["000", "666", "9" + d(2)]) + d(6), f"{d(8)}-{letter}", f"{d(8)}{letter}", f"{d(2)}.{d(3)}.{d(3)}-{letter}", f"{one('XYZ')}{d(7)}{letter}", f"{one('XYZ')}-{d(7)}-{letter}", f"{d(3)}.{d(3)}.{d(3)}-{d(2)}", f"{d(2)} {d(3)} {d(3)} {d(3)}", d(11), f"{d(8)}{one('ABCDEFGHKLMNR')}{d(3)}"])

    def address(self, k: str) -> str:
        one, n = self.one, self.n
        if k == "ko":
            city = f"{self.syll(2)}{one(['시', '시', '군', '도', '특별시', '광역시'])} {self.syll(2)}{one('구구군동면읍')} "
            road = self.syll(n(2, 4)) + one(["로", "길", "대로", "로", f"로{n(1, 60)}번길", f"{n(1, 20)}길", "거리", "고개", "골", "울"])
            return (city if self.r.random() < 0.7 else "") + road + " " + str(n(1, 400)) + one(["", "", "번지", f"-{n(1, 40)}", f", {n(1, 20)}동 {n(101, 2500)}호", f" {n(1, 20)}층", f" {n(101, 1500)}호", f"번지 {n(1, 20)}층"])
        if k in ("ja", "zh"):
            return f"{self.han(2)}{one('市県')}{self.han(2)}{one('区町')}{self.han(2)}{n(1, 9)}丁目{n(1, 30)}番{n(1, 20)}号" if k == "ja" else f"{self.han(2)}市{self.han(2)}区{self.han(2)}{one('路街')}{n(1, 400)}号"
        cap = lambda a, b: " ".join(self.word(2).capitalize() for _ in range(n(a, b)))
        u = self.r.random()
        if u < 0.45:
            s = f"{n(1, 999)}{one(['', '', '', 'A'])} {cap(1, 3)} {one(STREETS_EN.split('|'))}" + one(["", f", Apt {n(1, 40)}{one('ABC')}", f", Flat {n(1, 60)}", f", Unit {n(1, 9)}"]) + one(["", f", {cap(1, 3)}"])
        elif u < 0.75:
            s = one(STREETS_ES.split("|")[:-1]) + one([" ", " ", " de ", " del ", " de la ", " de los ", " das ", " do "]) + cap(1, 3) + one([" ", ", ", " n.º "]) + str(n(1, 200)) + one(["", f", {n(1, 9)}º {one('ABCD')}", ""]) + one(["", f", {cap(1, 2)}"])
        else:
            s = one(["", "", self.word(2).capitalize() + "er "]) + self.word(2).capitalize() + one(STREETS_DE.split("|")) + f" {n(1, 150)}{one(['', '', 'a', 'b'])}" + one(["", f", {self.d(5)} {self.word(2).capitalize()}"])
        return s

    def name(self, k: str) -> str:
        one = self.one
        if k == "ko":
            return one(list(KO_FAMILY_2)) + self.syll(one([1, 2, 2, 3])) if self.r.random() < 0.06 else one(KO_FAMILY[:one([12, 60, len(KO_FAMILY)])]) + self.syll(one([1] + [2] * 10 + [3] * 2))
        if k == "zh":
            return one(ZH_FAMILY) + self.han(one([1, 2, 2]))
        if k == "ja":
            return self.han(2) + self.han(self.n(1, 3)) + one(["さん", "様", "氏", "", "先生"])
        a, b = self.word(self.n(1, 4)).capitalize(), self.word(self.n(2, 4)).capitalize()
        s = a + one([" ", " ", " ", " ", f" {one('ABCDEFGHJKLMNPRSTVW')}. ", " de ", " von "]) + b + (" " + self.word(2).capitalize() if self.r.random() < 0.2 else "")
        u = self.r.random()
        return s.lower() if u < 0.08 else s.upper() if u < 0.12 else s

    def look_alike(self, k: str) -> str:
        one, n, d = self.one, self.n, self.d
        u = n(0, 9)
        if u == 0:
            return f"{n(1990, 2031)}{one('-./')}{n(1, 13):02d}{one('-./')}{n(1, 29):02d}"
        if u == 1:
            return f"{n(1, 999)},{d(3)}" + (f",{d(3)}" if self.r.random() < 0.7 else "")
        if u == 2:
            return f"{n(1, 30)}.{n(0, 30)}.{n(0, 30)}"
        if u == 3:
            return f"{n(1900, 2031)}{one('-~–')}{n(1900, 2031)}"
        if u == 4:
            return self.word(2) + self.one(["", "_"]) + d(n(1, 6))
        if u == 5:
            return "@" + self.word(2)
        if u == 6:
            return d(n(4, 9))
        sizes = [n(1, 7) for _ in range(n(2, 5))]
        if tuple(sizes) in ((3, 4, 4), (3, 3, 4), (2, 4, 4), (2, 3, 4), (3, 2, 4), (6, 6), (3, 3, 3), (4, 4, 4), (3, 2, 2, 2), (2, 3, 3, 3), (3, 3, 3, 2), (4, 4), (2, 5, 3)):
            sizes[0] += 2
        return one("-- /.").join(d(x) for x in sizes)

    def text(self) -> tuple[str, list[tuple[int, int, str]]]:
        """A text of the corpus, or of invented words, with values and look-alikes put in."""
        r, one = self.r, self.one
        k = self.kinds[int(r.choice(len(self.kinds), p=self.weights))]
        base = one(self.by[k]) if self.by[k] else " ".join(self.syll(3) if k == "ko" else self.word(2) for _ in range(6))
        gap = "" if k in ("ja", "zh") else " "
        words = base.split(" ") if gap else re.findall(".{1,8}", base)
        slots: dict[int, list] = {}
        for _ in range(self.n(1, 3)):
            slots.setdefault(one([0, len(words), self.n(0, len(words) + 1)]), []).append(True)
        parts, gold, size = [], [], 0

        def put(s: str, joined: bool = False) -> None:
            nonlocal size
            lead = "" if joined or not parts else gap
            parts.append(lead + s)
            size += len(lead) + len(s)

        for i in range(len(words) + 1):
            for _ in slots.get(i, ()):
                if r.random() < 0.62:
                    kind = one(["email", "phone", "phone", "id_number", "address", "address", "name", "name", "name"])
                    if r.random() < 0.6:
                        put(one(CUES[kind][k].split()) + one(["", "", ":", " :", ",", " -"] if kind != "name" else ["", "", "", ","]))
                    value = getattr(self, kind)(k)
                    put(value)
                    a = size - len(value)
                    if kind == "name" and k == "ja":
                        value = re.sub("(?:" + JA_TITLES + ")$", "", value)
                    gold.append((a, a + len(value), kind))
                    if k == "ko" and r.random() < 0.8:
                        if kind == "name" and r.random() < 0.75:
                            put(one(KO_TITLES) + one(["", "", "님", "이", "가", "는", "은", "께", "도", "와", "한테"]), joined=r.random() < 0.4)
                        else:
                            put(one(AFTER[kind].split()), joined=r.random() < 0.6)
                else:
                    u, a = r.random(), size
                    if u < 0.25 and k == "la" and self.by[k]:  # a stretch in capitals
                        t = one(self.by[k]).split(" ")
                        j = self.n(0, max(1, len(t) - 2))
                        put(" ".join(x[:1].upper() + x[1:] for x in t[j:j + self.n(2, 5)]))
                    elif u < 0.4 and k == "ko":
                        put(self.syll(self.n(1, 3)) + one(["로", "길", "동", "리", "가"]) + " " + str(self.n(1, 99)) + one(UNITS[k].split()))
                    else:
                        put(one(PLAIN[k].split())) if r.random() < 0.5 else None
                        put(self.look_alike(k))
                        put(one(UNITS[k].split()), joined=k != "la") if r.random() < 0.4 else None
                    gold.append((a, size, "nothing"))
            if i < len(words):
                put(words[i])
            elif r.random() < 0.5:
                put(one([".", "!", "?", "…"]), joined=True)
        return "".join(parts), gold


def script(text: str) -> str:
    """ko, la, ja or zh, by the characters."""
    if _HANGUL.search(text):
        return "ko"
    if re.search("[ぁ-ヶ]", text):
        return "ja"
    return "zh" if re.search("[一-鿿]", text) else "la"


def made_texts(background: list[str], n: int = MADE, seed: int = 9) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, gold segments) pairs: values put into texts that hold no digits, signs of addresses or capitals in a row."""
    quiet = [s for s in background if s and len(s) < 400 and not re.search(r"\d{3}|@|골뱅이|[A-ZÀ-Þ][a-zß-ÿ]+ (?:[A-Z]\. )?[A-ZÀ-Þ]", s)]
    mk = _Maker(seed, quiet)
    return [mk.text() for _ in range(n)]


def _unknown(spans: list[Span]) -> np.ndarray:
    return np.array([UNKNOWN.get(s.type, 0.0) for s in spans])


def _gold(spans: list[Span], gold: list[tuple[int, int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(which spans are right, what each says): those of the corpus' own words may be real ones, so they weigh little and their neighbours say
    nothing."""
    y, known = np.zeros(len(spans)), _unknown(spans)
    for a, b, t in gold:
        for i, s in enumerate(spans):
            if s.start < b and s.end > a:
                known[i] = 1.0
        fits = [i for i, s in enumerate(spans) if s.type == t and abs(s.start - a) <= 1 and abs(s.end - b) <= (14 if t == "address" else 1)]
        if fits:  # one reading of each gold segment: the longest that fits
            y[max(fits, key=lambda k: (spans[k].end <= b + 1, spans[k].end))] = 1.0
    return y, known


def _steps(data: list, weights: dict[str, float], power: dict[str, float], epochs: int, rate: float, l2: float, seed: int) -> None:
    """Adaptive gradient steps on the conditional likelihood of the gold segments among the candidates."""
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(data)):
            spans, y, known = data[i]
            g = (y - _marginals(spans, weights)) * known
            for s, v, w in zip(spans, g, known):
                if abs(v) < 0.01:
                    continue
                for f in s.feats:
                    if w < 1 and _CONTEXT.search(f):
                        continue
                    step = v - l2 * weights.get(f, 0.0)
                    power[f] = power.get(f, 1.0) + step * step
                    weights[f] = weights.get(f, 0.0) + rate * step / np.sqrt(power[f])


def fit(background: list[str], words: Words, epochs: int = 3, rounds: int = 2, rate: float = 0.35, l2: float = 1e-4) -> PiiModel:
    """Fit on texts with invented values, then on what the model is sure of in the sampled texts themselves."""
    weights: dict[str, float] = {}
    power: dict[str, float] = {}
    data = []
    mk = np.random.default_rng(1)
    for text, gold in made_texts(background):
        own: dict[str, int] = {}
        for a, b, t in gold:
            if t in ("name", "address"):  # invented ones are new words; real ones may occur now and then in the corpus
                ws = _WORDS.findall(text[a:b].lower())
                for w in ws + [w[i:i + 2] for w in ws for i in range(len(w) - 1) if "一" <= w[0] <= "鿿"]:
                    own[w] = int(mk.choice([0, 0, 0, 0, 0, 1, 2] if "가" <= w[0] <= "힣" else [0, 0, 1, 2, 3, 4, 5])) + (16 if t == "address" and mk.random() < 0.2 else 0)
        spans = candidates(text, With(words, own) if own else words)
        if spans:
            data.append((spans, *_gold(spans, gold)))
    real = [spans for t in dict.fromkeys(background) if t and (spans := candidates(t, words))]
    _steps(data + [(x, np.zeros(len(x)), _unknown(x)) for x in real], weights, power, epochs, rate, l2, 2)
    half = data[::2]
    for k in range(rounds):
        taught = []
        for spans in real:
            p = _marginals(spans, weights)
            y, known = (p >= SURE).astype(float), ((p >= SURE) | (p <= 1 - SURE)).astype(float)
            if known.any():
                taught.append((spans, y, known))
        _steps(taught + half, weights, power, 1, rate / 2, l2, 3 + k)
    return PiiModel({f: float(w) for f, w in weights.items() if abs(w) > 1e-3}, words)


def count_words(unified_rows: DataFrame) -> np.ndarray:
    """The sums of ``word_counts`` over all comments, and over all posts' texts, each with its post."""
    texts = unified_rows.select(F.when(F.col("comment_index").isNull(), F.concat_ws("\n", "text", "comment_text")).otherwise(F.col("comment_text")).alias("t")).filter("t IS NOT NULL AND t <> ''")
    return sums.summed(texts, lambda b, total: word_counts(b["t"], total), (2 << WORD_BITS) + 1)


def trained(spark: SparkSession, unified_rows: DataFrame) -> Broadcast:
    """The model, its classifier fitted on a bounded sample, its word counts on all rows, sent to the executors; or read from the models' folder."""

    def make() -> PiiModel:
        rows = bounded(unified_rows.filter("comment_text IS NOT NULL").select("row_id", F.substring("comment_text", 1, SAMPLE_CHARS).alias("comment_text")), "row_id", TRAIN_ROWS).select("comment_text").collect()
        return fit([r["comment_text"] for r in rows], Words(count_words(unified_rows)))

    return spark.sparkContext.broadcast(store.fitted(spark, "pii", [unified_rows.select("row_id", "comment_index", *FIELDS)], (TRAIN_ROWS, SAMPLE_CHARS, MADE, SURE, WORD_BITS, PER, RARE), make))


def find(unified_rows: DataFrame, model: Broadcast) -> DataFrame:
    """(row_id, field, pii_type), one row for each type that occurs in a field of a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known: dict[str, tuple[str, ...]] = {}
            rows, fields, kinds = [], [], []
            for field in FIELDS:
                for k, t in zip(b["row_id"], b[field]):
                    if not t:
                        continue
                    got = known.get(t)
                    if got is None:
                        got = known[t] = tuple(sorted({s.type for s in model.value.find(t)}))
                    for x in got:
                        rows.append(k)
                        fields.append(field)
                        kinds.append(x)
            yield from filled(pd.DataFrame({"row_id": np.array(rows, dtype=np.int64), "field": fields, "pii_type": kinds}))

    return unified_rows.select("row_id", *FIELDS).mapInPandas(run, "row_id long, field string, pii_type string")


def redact(unified_rows: DataFrame, model: Broadcast) -> DataFrame:
    """(row_id, comment_text, text): both fields with typed placeholders."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known: dict[str, str] = {}
            out = {"row_id": b["row_id"]}
            for field in FIELDS:
                col = []
                for t in b[field]:
                    if t and t not in known:
                        known[t] = model.value.redact(t)
                    col.append(known[t] if t else t)
                out[field] = col
            yield from filled(pd.DataFrame(out))

    return unified_rows.select("row_id", *FIELDS).mapInPandas(run, "row_id long, comment_text string, text string")
