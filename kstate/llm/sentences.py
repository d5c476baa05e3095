"""Sentence units of documents in many languages and scripts.

A paragraph (text between blank lines) becomes a lattice whose nodes are the gaps where a sentence may
end: after terminators of spaced scripts, after full stops or blanks of spaceless ones, between the words of
spaceless ones where a final particle meets an opening word, and after a quotation or bracket that ends in a
terminator. Quotations and brackets are matched first and hold no gaps inside. Each gap gets a score from
what stands before it (abbreviation, initial, number, final particle) and after it (case, opening word,
particle); a path through the lattice takes the gaps of positive score, as long as every sentence holds a letter
or digit. Words beside gaps of spaceless scripts come from the cheapest path through a lattice of dictionary
words and script runs. The dictionary is a parameter: the words of these scripts in the vocabulary of a public
tokenizer, or a file of one word a line.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Short forms written with a dot, in ten languages, by what may follow them.
#: before a name or a further word: never at the end of a sentence
LEADING = frozenset(
    "dr mr mrs ms prof sgt st mt gen col lt capt cpt maj cmdr rev hon pres gov sen rep fr hr hrn frl dipl ing sr sra srta dña d. m. mm mme mlle mgr "
    "vs approx cf viz e.g i.e eg ie vgl bzw ca z.b d.h z.t u.u evtl ggf inkl exkl sog bes p.ex p.ej c.-à-d env aprox véase núm pág págs "
    "ул просп пл пер наб им проф акад т.е т.к т.н см ср напр π.χ δηλ βλ κ.κ डॉ श्री प्रो कु ft messrs supt insp adm brig".split()
)
#: before a number: a short form there, otherwise a word of its own
COUNTED = frozenset(
    "no nos nr fig figs vol vols pp p app sec sect ch eq art arts abb abs s bd tab kap ziff núm pág págs n nº t v рис табл стр гл ст п л ч разд "
    "jan feb mar apr jun jul aug sep sept oct nov dec okt dez mär mai σελ αρ εικ cap fasc par ref refs ed item".split()
)
#: may end a sentence; then a new one opens with a capital
FINAL = frozenset("etc usw inc ltd co corp al ff jr a.m p.m κ.λπ κ.ά т.д т.п др пр тыс млн млрд u.a u.ä cía bros plc gmbh м км кг г гг в вв руб м.".split())
#: German words before an ordinal number, and months after one
ORDINAL_BEFORE = frozenset("der die das dem den des am vom zum zur im bis ab seit nach vor jeder jede jedes ein eine einem einen einer und beim dieser diesem diesen".split())
MONTHS_DE = frozenset("januar februar märz april mai juni juli august september oktober november dezember".split())
# Particles, final particles and forms, and opening words of scripts without spaces.
PARTICLES_JA = frozenset("と という といった として とか とも は が を に で の も へ や から まで って だ です など より ば な なら なので".split())
#: close a sentence by themselves
FINAL_JA = frozenset("です ます でした ました ません でしょう だろう ましょう ください ですか ますか でしたか ましたか ませんか でしょうか だろうか ですね ますね ですよ ますよ でしたね ましたね".split())
#: close a sentence only where more speaks for it
WEAK_JA = frozenset("か ね よ わ ぞ な た だ る ない".split())
OPENING_JA = frozenset("しかし そして また ただし なお さらに つまり では それで だから ところが この その あの これ それ あれ ここ そこ 私 私たち 彼 彼女 次に まず 最後に 一方 もし そう はい いいえ".split())
#: words that end or begin like a particle or an opening word
WORDS_JA = frozenset("何か 誰か いつか どこか どれか なぜか どうか 確か 静か 僅か 豊か たか かた また または そのまま このまま これら それら それぞれ それほど これほど この度 その他 その後 ではなく では".split())
PARTICLES_ZH = frozenset("的 地 得 等 之 和 与 及 或".split())
FINAL_ZH = frozenset("吗 呢 吧 啊 嘛 呀 嗎".split())
WEAK_ZH = frozenset("了 着 过".split())
OPENING_ZH = frozenset("但是 然后 因此 所以 而且 不过 于是 另外 此外 这 那 它 他 她 我 你 我们 你们 他们 她们 它们 这个 那个 这些 那些 今天 明天 昨天 现在 首先 最后 如果 因为 虽然 請 请 好 是 不".split())
WORDS_ZH = frozenset("酒吧 网吧 吧台 吧间 呢喃 呢绒 啊呀 哎呀 来着 着火 着急 过去 过程 了解 为了 除了 好像 好处 是否 不同 不久 他人 其他 吉他 我国 自我".split())
FINAL_TH = frozenset("ครับ ค่ะ คะ นะ จ้ะ แล้ว".split())
OPENING_TH = frozenset("แต่ ดังนั้น จากนั้น เพราะ นอกจากนี้ อย่างไรก็ตาม".split())
#: Public vocabulary whose words of spaceless scripts join the dictionary; a parameter.
DICTIONARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

BLANK_LINE = regex.compile(r"(?:\r\n|\r|\n)(?:[^\S\r\n]*(?:\r\n|\r|\n))+")
OPEN = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "〔": "〕", "《": "》", "〈": "〉", "「": "」", "『": "』", "«": "»", "„": "“”", "‚": "‘’", "“": "”", "‘": "’", '"': '"', "'": "'", "»": "«", "｢": "｣", "‹": "›"}
CLOSERS = frozenset(")]}）］】〕》〉」』»“”’\"'｣›«")
MARKS = ".!?…。！？｡।॥؟۔;;"
SIGN = regex.compile(r"[()\[\]{}（）［］【】〔〕《》〈〉「」『』«»„‚“”‘’\"'｢｣‹›]|[.!?…。！？｡।॥؟۔;;]+|(?<=[฀-๿])\s+")
WORD_CHAR = regex.compile(r"[\p{L}\p{N}]")
#: searched backwards from the dot
TOKEN_BEFORE = regex.compile(r"(?r)[\p{L}\p{M}\p{N}'’\-]+(?:\.[\p{L}\p{M}\p{N}'’\-]+)*$")
NEXT_SKIP = " \t\r\n   　*_#>~`"
ENDING = regex.compile(rf"[{regex.escape(MARKS)}]+$")
LETTERS = regex.compile(r"\p{L}+")
THAI = regex.compile(r"[฀-๿]")
GREEK = regex.compile(r"\p{Greek}")
CAMEL = regex.compile(r"\p{Ll}+\p{Lu}")


class WordLattice:
    """Cheapest path through dictionary words and unknown runs; gives the words beside a gap."""

    #: Signs beside a gap that the lattice spans.
    REACH = 16

    def __init__(self, words: frozenset[str], final: frozenset[str], weak: frozenset[str], opening: frozenset[str]) -> None:
        self.final, self.weak, self.opening = final, weak, opening
        # a word of the dictionary that holds an opening word or a final form at its end would hide the gap
        hides = lambda w: any(w != o and w.startswith(o) for o in opening if len(o) > 1) or any(w != f and w.endswith(f) for f in final if len(f) > 1)
        self.words = frozenset(w for w in words if not hides(w)) | final | weak | opening
        self.longest = max(map(len, self.words))
        #: gaps without a blank: before them a word that closes a sentence, after them one that opens one
        either = lambda w: "|".join(sorted(map(regex.escape, w), key=lambda x: (-len(x), x)))
        self.meet = regex.compile(rf"(?:{either(final)})(?=({either(opening)}))")

    def path(self, s: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)] + [(1e9, 0)] * len(s)
        for i in range(len(s)):
            at = best[i][0]
            for n in range(1, min(self.longest, len(s) - i) + 1):
                w = s[i : i + n]
                cost = at + (1.0 if w in self.words else self.unknown(w))
                if cost < best[i + n][0]:
                    best[i + n] = (cost, i)
        out, j = [], len(s)
        while j:
            out.append(s[best[j][1] : j])
            j = best[j][1]
        return out[::-1]

    @staticmethod
    def unknown(w: str) -> float:
        """Cost of a run outside the dictionary: katakana spells names, Han signs hold words one should know."""
        if all("゠" <= c <= "ヿ" for c in w):
            return 1.5 + 0.4 * len(w)
        if all("一" <= c <= "鿿" for c in w):
            return 1.0 + 1.1 * len(w)
        return 3.0 if len(w) == 1 else 1e9

    def after(self, s: str) -> str:
        return next(iter(self.path(s[:12])), "")

    def gap(self, p: str, a: int, b: int) -> float:
        """Score of a gap without a full stop: text before a, text from b on, a blank between them if b > a."""
        left, right = SIDE_BEFORE.search(p[max(0, a - self.REACH) : a]), SIDE_AFTER.match(p[b : b + self.REACH])
        if not left or not right:
            return -9
        left, right = left[0], right[0]
        if a < b:
            before, after = self.path(left), self.path(right)
        else:
            # one lattice over both sides: a word across the gap speaks against it
            before, after, n = [], self.path(left + right), 0
            while after and n < len(left):
                n += len(after[0])
                before.append(after.pop(0))
            if n != len(left) or not after:
                return -9
        # a final form of several signs may be cut elsewhere by the dictionary; a particle of one sign has to be a word
        strong = before[-1] in self.final or any(len(f) > 1 and left.endswith(f) for f in self.final)
        closes = 2.5 if strong else 0.5 if before[-1] in self.weak else 0.0
        return -3 + closes + (1.5 if a < b else 0.0) + (2.5 if after[0] in self.opening else 0.0)


SIDE_BEFORE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]+$")
SIDE_AFTER = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]+")
SPACELESS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
KANA = regex.compile(r"[\p{Hiragana}\p{Katakana}]")
#: a blank between two signs of such a script; a line break alone is none
SPACELESS_BLANK = regex.compile(r"(?<=[\p{Han}\p{Hiragana}\p{Katakana}ー])[^\S\r\n]+(?=[\p{Han}\p{Hiragana}\p{Katakana}])")


def spaceless_words(path: str) -> frozenset[str]:
    """The words of two signs or more in scripts without spaces, from a vocabulary of token ranks or a list of words."""
    out = set()
    with open(path, "rb") as f:
        for line in f:
            token = line.split()
            try:
                w = (base64.b64decode(token[0]) if len(token) == 2 and token[1].isdigit() else line).decode().strip()
            except (UnicodeDecodeError, ValueError, IndexError):
                continue
            if len(w) > 1 and SPACELESS_WORD.fullmatch(w):
                out.add(w)
    return frozenset(out)


SPACELESS_WORD = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]+|[\u0e00-\u0e7f]+")


class Lattices:
    """The lattices of Japanese, Chinese and Thai over one dictionary."""

    def __init__(self, words: frozenset[str] = frozenset()) -> None:
        kana = frozenset(w for w in words if KANA.search(w))
        han = frozenset(w for w in words if not KANA.search(w) and SPACELESS.search(w))
        self.ja = WordLattice(PARTICLES_JA | WORDS_JA | kana | han, FINAL_JA, WEAK_JA, OPENING_JA)
        self.zh = WordLattice(PARTICLES_ZH | WORDS_ZH | han, FINAL_ZH, WEAK_ZH, OPENING_ZH)
        self.th = WordLattice(frozenset(w for w in words if THAI.search(w)), FINAL_TH, frozenset(), OPENING_TH)

    def gaps(self, p: str) -> list[tuple[int, int, float]]:
        """(end before, start after, score) of the gaps without a full stop in Japanese and Chinese text."""
        if not SPACELESS.search(p):
            return []
        lattice = self.ja if KANA.search(p) else self.zh
        out = [(m.start(), m.end(), lattice.gap(p, m.start(), m.end())) for m in SPACELESS_BLANK.finditer(p)]
        out += [(m.end(), m.end(), lattice.gap(p, m.end(), m.end())) for m in lattice.meet.finditer(p)]
        return out


def _spans(p: str, signs: list) -> list[tuple[int, int]]:
    """Matched quotations and brackets, outermost only; signs without a partner are left aside."""
    stack: list[tuple[str, int]] = []
    spans: list[tuple[int, int]] = []

    def close(c: str, at: int) -> bool:
        for k in range(len(stack) - 1, -1, -1):
            if c in OPEN[stack[k][0]]:
                spans.append((stack[k][1], at))
                del stack[k:]
                return True
        return False

    for m in signs:
        c, at = m[0], m.start()
        if c[0] in MARKS or c.isspace():
            continue
        before, after = p[at - 1 : at], p[at + 1 : at + 2]
        if c == "'":
            if before.isalnum() and after.isalnum():
                continue
            if not (before and not before.isspace() and close(c, at)) and not before.isalnum() and after and not after.isspace():
                stack.append((c, at))
        elif c == '"':
            if not close(c, at):
                stack.append((c, at))
        elif c in "“”’»«‘":
            if c == "’" and before.isalnum() and after.isalnum():
                continue
            if c in "“‘" and not any(c in OPEN[o] for o, _ in stack):
                stack.append((c, at))
            elif not close(c, at) and (c == "«" or c == "»" and (not before or before.isspace()) and after and not after.isspace()):
                stack.append((c, at))
        elif c in OPEN:
            stack.append((c, at))
        else:
            close(c, at)
    outer: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


def _follows(p: str, e: int) -> tuple[str, int, bool]:
    """First telling sign at or after e, its place, and whether anything blank stands before it."""
    k, blank = e, False
    while k < len(p) and p[k] in NEXT_SKIP:
        blank |= p[k].isspace()
        k += 1
    return p[k : k + 1], k, blank


def _opens(p: str, c: str, k: int) -> int:
    """1: what follows opens a sentence; -1: it carries one on; 0: no telling (a digit, another sign)."""
    if not c:
        return 1
    if c in ",;:،、，；：)]}）］」』”»…%％‰/=&+" or c in "-–—" and p[k + 1 : k + 2].isspace():
        return -1
    if c in OPEN or c in "¿¡":
        return 1
    if c.islower():
        return 1 if CAMEL.match(p, k) else -1
    return 1 if c.isalpha() else 0


def _before_dot(p: str, at: int, start: int) -> tuple[str, str]:
    """The short form, initial or word that the dot at ``at`` closes: alone, and with parts set apart by blanks ('т. д' is 'т.д')."""
    m = TOKEN_BEFORE.search(p, max(start, at - 40), at)
    if not m:
        return "", ""
    w, k = m[0], m.start()
    while len(w.split(".")[0]) <= 2 and k >= 2 and p[k - 1] in "  \n" and p[k - 2] == "." and (q := TOKEN_BEFORE.search(p, max(start, k - 12), k - 2)) and len(q[0]) <= 2 and q[0].isalpha():
        w, k = q[0] + "." + w, q.start()
    return m[0], w


def _dot(p: str, at: int, e: int, start: int, inside: bool) -> float:
    """Score of a gap after one full stop at ``at``; e is where the sentence would end."""
    c, k, blank = _follows(p, e)
    if not c:
        return 9
    nxt = _opens(p, c, k)
    alone, w = _before_dot(p, at, start)
    low = w.lower()
    last = low.rsplit(".", 1)[-1]
    if not blank and not inside:
        if c in OPEN or c in "¿¡":
            return -3 if low in LEADING or len(w) == 1 and w.isupper() else 3
        if not c.isalpha():
            return -9
        if c.islower() or c.isupper() and not (p[k + 1 : k + 2].islower() or p[k + 1 : k + 2] in "\r\n" + NEXT_SKIP):
            return -9
        if not w:
            return 3
        mixed = any(x.isdigit() for x in w)
        if c.isupper() and (mixed and any(x.isalpha() for x in w) or len(w) == 1 or low in LEADING or w[-1].isupper() or "." in w and low not in FINAL):
            return -4
        return 3
    if nxt < 0:
        return -9
    if not w:
        return 3
    if low in LEADING or alone.lower() in LEADING:
        return -6
    if c.isdigit() and last in COUNTED:
        return -6
    if len(last) == 1 and last.isalpha():
        if w[-1].isupper():
            return -6 if nxt > 0 else -2
        return 3 if nxt > 0 and low not in ("z", "т", "u", "п", "д") else -3
    if w.isdigit():
        head = p[start : at - len(w)].rstrip()
        word = TOKEN_BEFORE.search(head)
        if not head or not WORD_CHAR.search(head):
            return -4
        after = LETTERS.match(p, k)
        german = word and word[0].lower() in ORDINAL_BEFORE or after and after[0].lower() in MONTHS_DE
        return -4 if german and len(w) <= 4 else 3
    return 3


def _gap(p: str, a: int, e: int, start: int, inside: bool, marks: str, words: Lattices) -> float:
    """Score of a gap after the terminators ``marks`` at a; positive ends a sentence at e."""
    c, k, blank = _follows(p, e)
    if marks[-1] in "。！？｡":
        if not c:
            return 9
        if _opens(p, c, k) < 0 and not c.islower():
            return -9
        if inside:
            rest = p[k : k + 12]
            if "぀" <= c <= "ゟ":
                w = words.ja.after(rest)
                return 2 if w in OPENING_JA else -4 if w in PARTICLES_JA else 2
            if words.zh.after(rest) in PARTICLES_ZH:
                return -4
        return 4
    if marks[-1] in "।॥":
        return 9 if not c else -9 if _opens(p, c, k) < 0 and not c.islower() else 4
    if marks == ".":
        return _dot(p, a, e, start, inside)
    if not c:
        return 9
    nxt = _opens(p, c, k)
    if nxt < 0:
        return -9
    if not blank and not inside and c.isdigit():
        return -2
    return 3


def _paragraph(p: str, words: Lattices) -> list[int]:
    """Ends of the sentences of one paragraph."""
    signs = list(SIGN.finditer(p))
    spans = _spans(p, signs)
    marks_at = [(m.start(), m.end(), m[0], None) for m in signs]
    if between := words.gaps(p):
        marks_at = sorted([*marks_at, *((a, b, "", score) for a, b, score in between)], key=lambda x: x[:2])
    nodes: list[tuple[int, float]] = []
    s, start = 0, 0
    closes = {b: a for a, b in spans}
    for at, stop, c, known in marks_at:
        while s < len(spans) and spans[s][1] < at:
            s += 1
        if known is not None:
            if s < len(spans) and spans[s][0] < at:
                continue
            e, score = at, known
        elif s < len(spans) and spans[s][0] <= at <= spans[s][1]:
            if at != spans[s][1]:
                continue
            inner = p[closes[at] + 1 : at].rstrip()
            marks = ENDING.search(inner)
            e = at + 1
            if not marks or marks[0][-1] == ";" or p[e : e + 1] and p[e] in MARKS:
                continue
            if marks[0] == "." and p[closes[at]] in "([{" and _before_dot(inner, marks.start(), 0)[1].lower() in LEADING:
                continue
            score = _gap(p, closes[at] + 1 + marks.start(), e, closes[at] + 1, True, marks[0], words)
        elif c.isspace():
            nxt = p[stop : stop + 1]
            blank = any(x not in "\r\n" for x in c)
            good = blank and nxt and (THAI.match(nxt) or nxt.isupper() or nxt in OPEN or nxt in "¿¡")
            if good and words.th.after(p[stop : stop + 12]) in FINAL_TH:
                good = False
            if not good:
                continue
            e, score = at, 4.0
        elif c[0] in MARKS:
            if c[0] in ";;":
                if not (at and GREEK.match(p[at - 1])):
                    continue
            elif c[-1] == ";":
                c = c.rstrip(";")
            e = at + len(c)
            while e < len(p) and p[e] in CLOSERS and not any(a == e for a, _ in spans[s : s + 1]):
                e += 1
            score = _gap(p, at, e, start, False, c, words)
        else:
            continue
        nodes.append((e, score))
        if score > 0:
            start = e
    return _best_path(p, nodes)


def _best_path(p: str, nodes: list[tuple[int, float]]) -> list[int]:
    """Best path through the gaps; an edge between two gaps needs a letter or digit between them."""
    if not any(score > 0 for _, score in nodes):
        return [len(p)]
    if not nodes or nodes[-1][0] < len(p):
        nodes = [*nodes, (len(p), 1e-3)]
    count, at, seen = [0], 0, 0
    for e, _ in nodes:
        seen += e > at and WORD_CHAR.search(p, at, e) is not None
        at = max(at, e)
        count.append(seen)
    best, back = [0.0], [-1]
    ready, top, i = -1, -1e18, 0
    for j, (_, score) in enumerate(nodes, 1):
        while i < j and count[i] < count[j]:
            if best[i] >= top:
                ready, top = i, best[i]
            i += 1
        best.append(top + score if ready >= 0 else -1e18)
        back.append(ready)
    j = max(range(1, len(nodes) + 1), key=lambda j: (best[j], j))
    ends = []
    while j > 0:
        ends.append(nodes[j - 1][0])
        j = back[j]
    ends.reverse()
    if ends and ends[-1] < len(p):
        if WORD_CHAR.search(p, ends[-1]):
            ends.append(len(p))
        else:
            ends[-1] = len(p)
    return ends or [len(p)]


#: lattices of the particles, final and opening words alone
PLAIN = Lattices()


def sentences(text: str, words: Lattices | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence, in code points."""
    words = words or PLAIN
    out = []
    at = 0
    for m in [*BLANK_LINE.finditer(text), None]:
        stop = m.start() if m else len(text)
        p = text[at:stop]
        body = p.strip()
        if body:
            base = at + len(p) - len(p.lstrip())
            k = 0
            for e in _paragraph(body, words):
                while k < e and body[k].isspace():
                    k += 1
                end = e
                while end > k and body[end - 1].isspace():
                    end -= 1
                if end > k:
                    out.append((base + k, base + end))
                k = e
        at = m.end() if m else stop
    return out


def sentence_units(documents: DataFrame, key: str = "doc_id", text: str = "text", dictionary: str | None = DICTIONARY) -> DataFrame:
    """(key, sent_start, sent_end) for each sentence of each document, the whole text long.

    Null, empty and blank texts give no rows, a row delivered twice counts once (the sentences are made distinct, not
    the texts, which are longer), other columns are ignored. Every paragraph ends a sentence, so no text is lost; blanks
    around sentences are left out. ``dictionary`` is read on the driver; without one the particles, final and opening words
    make up the lattices.
    """
    known = spaceless_words(dictionary) if dictionary else frozenset()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Lattices(known)
        for b in batches:
            keys, starts, ends = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for s, e in sentences(t, words):
                    keys.append(k)
                    starts.append(s)
                    ends.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=[key, "sent_start", "sent_end"])

    d = documents.select(F.col(key), F.col(text)).filter(F.col(text).isNotNull() & (F.length(text) > 0))
    return d.mapInArrow(run, f"`{key}` {d.schema[0].dataType.simpleString()}, sent_start long, sent_end long").distinct()
