"""Problem 6: text statistics, and how much of a text is lists, tables or strings that aren't language.

Every line gets four distributions: its characters by class, its words by class
(function word, capitalised, other, single letter, number, mixed, symbols, long
string), the layout of its lines (sentence end, wrapped, short, item, row, solid)
and new against repeated words.  Their weighted Jensen-Shannon divergences from the
structural profiles decide: a line takes the nearest profile, lines of few words
lean on their neighbours, and adjacent lines of one kind form a unit, which is
measured again as a whole.  The profiles of prose are those of ten languages, taken
from public texts (the Universal Declaration of Human Rights, and sentences of
reporting), each set in one line, wrapped, and without its stops; a unit is compared
with the prose of its own script.  Loops of ordinary words have a profile of their
own, which counts as prose.

All of it is arithmetic over the code points of many texts at a time (``GROUP``
characters, or one text), so a long list of short lines costs no more than prose.

Defined cases: null and empty texts have no row of statistics; white texts have
shares of 0; rows repeated in the table give one result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import code_points, frame, read, strings, texts_of

#: Common function words of languages that put spaces between words.
FUNCTION_WORDS = {
    "en": "a an and are as at be been but by can could for from had has have he her his if in into is it its may no nor not of on or our she since so such than that the their them then there these they this to under until was we were when where which while who will with within would you your after before because despite although yet",
    "de": "der die das den dem des ein eine einen einer und oder von vom zu zum zur im in am an auf aus bei mit nach hat haben war wird wurde werden ist sind nicht sie er es als dass wenn bevor für über um durch",
    "fr": "le la les un une des du de et ou à au aux en dans par pour sur avec qui que est sont été a ont soit tout tous dont mais ne pas plus ce cette ils elle il n l d qu s",
    "es": "el los las una unos y o del al en por para con que es fue fueron son no se su sus según después nunca había está más pero como entre",
    "ru": "и в на не с по что как к за из у от о об был была было были или под для его их это все они",
    "ar": "في من على إلى أن إن عن مع هذا هذه التي الذي كان كانت قد لا ما كل بعد قبل لم أو",
    "hi": "के का की है हैं और में से को ने पर यह वह कि था थी थे हो भी नहीं तक एक लिए इस उस गया",
}

_PROSE = {
    "latin": [
        "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. Everyone has the right to life, liberty and security of person.",
        "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen. Jeder hat das Recht auf Leben, Freiheit und Sicherheit der Person.",
        "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Tout individu a droit à la vie, à la liberté et à la sûreté de sa personne.",
        "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros. Todo individuo tiene derecho a la vida, a la libertad y a la seguridad de su persona.",
        "In 1928 Alexander Fleming, who worked at St Mary's Hospital in London, noticed that mould had killed the bacteria in one of his dishes; Howard Florey and Ernst Chain needed another 12 years before Oxford University could treat its first patient with it.",
    ],
    "cyrillic": ["Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность."],
    "spaced": [
        "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
        "يولد جميع الناس أحراراً متساوين في الكرامة والحقوق. وقد وهبوا عقلاً وضميراً وعليهم أن يعامل بعضهم بعضاً بروح الإخاء. لكل فرد الحق في الحياة والحرية وسلامة شخصه.",
    ],
    "unspaced": [
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。人人有权享有生命、自由和人身安全。",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。",
        "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ",
    ],
}
_LOOPS = ["water water water water water water water water water water water water water", "green tea and cake green tea and cake green tea and cake green tea and cake green tea and cake"]
#: lists of plain words, compared with texts of their own script only, as words stand alike in prose and lists
_WORD_LISTS = {
    "latin": [
        "Home\nNews\nContact us\nOpening hours\nJobs",
        "brown sugar, salted butter, dark chocolate, fresh milk, wild honey, dry yeast, ripe plums",
        "brown sugar, salted butter, dark chocolate, fresh milk,\nwild honey, dry yeast, ripe plums, green tea, black pepper",
        "Ada Lovelace, London Institute\nCarl Gauss, Göttingen\nMarie Curie, Sorbonne Laboratory",
    ],
    "cyrillic": ["хлеб, соль, масло, свежее молоко, яблоки, чай, сахар"],
    "spaced": ["خبز، ماء، ملح، زيت، تفاح، حليب، شاي، قهوة", "रोटी, पानी, नमक, तेल, दूध, चाय, चावल, दाल"],
    "unspaced": ["面包、水、盐、油、牛奶、茶、苹果、糖"],
}
_STRUCTURES = {
    "list": [
        "- flour\n- brown sugar\n- salted butter\n- dark chocolate\n- eggs",
        "1. Wash hands\n2. Chop onions\n3. Heat oil\n4. Serve warm",
        "* Oak (12)\n* Silver Birch (204)\n* Elm (77)\n* Ash (9)",
        "https://museum.example/rooms/egypt-12\nhttps://museum.example/rooms/rome-7\nhttps://archive.example/maps/1871",
    ],
    "table": [
        "Id | Town | State | Height\nA-12 | Old Mill | open | 4.5\nA-13 | Long Hill | closed | 7.1",
        "| Town | State | Height |\n|---|---|---|\n| Old Mill | open | 4.5 |\n| Long Hill | closed | 7.1 |",
        "Id,Town,State,Height,Seen\nA-12,Old Mill,open,4.5,03 May\nA-13,Long Hill,closed,7.1,12 June",
        "Id ; Town ; State ; Height\nA-12 ; Old Mill ; open ; 4.5\nA-13 ; Long Hill ; closed ; 7.1",
        "Id\tTown\tState\nA-12\tOld Mill\topen\nA-13\tLong Hill\tclosed",
        "Id        Town          State     Height\nA-12      Old Mill      open      4.5\nA-13      Long Hill     closed    7.1",
        "Old Mill ........ 12\nLong Hill ........ 340\nThree Bridges ........ 7",
    ],
    "junk": [
        "3f9a77c0b1e24d5586a0c2f9e1d3b4a790ffab12cd34ee5677aa01bc99de12f0\n90ffab12cd34ee5677aa01bc99de12f03f9a77c0b1e24d5586a0c2f9e1d3b4a7",
        "1f8b0800 5a 22 c1 9e 00 ff a0 13 7c 4d 00 01 77 e0 9a 3b\n22c19e00 ff 1b 08 00 5a 31 c1 9e 00 ee a0 14 7c 5d 00 02",
        "Qk1aWVhKc2RmR0hqS2xaeENWYm5Nd2VydHl1aW9wQXNkZkdoSmtsWnhj9aBcQwErTz7uIpLk3Jm+QWERTzui9xYz/AbCdEf==",
        "var a1=function(b){return b.c(12)||{d:!0}};if(a1(q)>3){x=[1,2,{k:7}];}else{w(a1);}",
        ".menu>li{margin:4px;color:#5b60bf}\n.side-box>span{top:12px;color:#fa90f1}",
        "#{~-_[}>*&^%$@!(<]|;:.,/?=+)]{<~#@!%^&* >>|~ {}[] $$%^ &*( )_+",
        "t r e e h o u s e g a r d e n r i v e r s t o n e w i n d o w",
        "cafÃ© rÃ©sumÃ© â€œnaÃ¯veâ€ Ð¿Ñ€Ð¸ Ã¼berÂ§ æ—¥æœ¬ ï¿½ï¿½ Ã¤hnÂ§ ç¸ºç¹§ Â°tÃ¨",
    ],
}

#: classes of characters: letter, capital, digit, space, sentence stop, comma-like, cell mark, bracket or operator, other, gap, leader
LETTER, CAPITAL, DIGIT, SPACE, STOP, COMMA, CELL, OPERATOR, OTHER, GAP, LEADER = range(11)
#: classes of words
FUNCTION, NAME, WORD, SINGLE, NUMBER, MIXED, SYMBOLS, STRING = range(11, 19)
#: layouts of lines
SENTENCE, WRAPPED, SHORT, ITEM, ROW, SOLID = range(19, 25)
NEW, AGAIN = 25, 26
WIDTH = 27
_PARTS = ((0, 11, 1.0), (11, 19, 1.0), (19, 25, 0.4), (25, 27, 0.3))
GROUP = 1 << 20
KINDS = ("prose", "list", "table", "junk")
_LONG_STRING = 24
_SCRIPTS = ("latin", "cyrillic", "spaced", "unspaced")


def _class_of(ch: str) -> int:
    if ch.isspace():
        return CELL if ch == "\t" else SPACE
    if ch.isdigit():
        return DIGIT
    if ch.isalpha():
        return CAPITAL if ch.isupper() else LETTER
    if ch in ".!?。！？।؟۔":
        return STOP
    if ch in ",:，、；：،'\"“”‘’«»„()「」（）-–—":
        return COMMA
    if ch in "|;":
        return CELL
    if ch in "{}[]<>=/\\_+*#&@$%^~`":
        return OPERATOR
    if 0x300 <= ord(ch) < 0x2000:  # marks that combine with letters
        return LETTER
    return OTHER


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point its class, its lower case, and its script (0 for what has none)."""
    size = 0x110000
    kind, lower, script = np.full(size, OTHER, np.uint8), np.arange(size, dtype=np.uint32), np.zeros(size, np.uint8)
    for i in range(size):
        if 0xD800 <= i < 0xE000 or 0x323B0 <= i:  # surrogates, and planes without letters
            continue
        ch = chr(i)
        kind[i] = _class_of(ch)
        if kind[i] == CAPITAL and len(low := ch.lower()) == 1:
            lower[i] = ord(low)
    letters = kind <= CAPITAL
    for at, (first, last) in enumerate(((0, 0x370), (0x370, 0x530), (0x530, 0xE00), (0xE00, size)), 1):
        script[first:last] = np.where(letters[first:last], at, 0)
    return kind, lower, script


_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's code points and their places in it."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = end - begin
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    mixed = (codes[np.repeat(begin, length) + place].astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= (mixed >> np.uint64(31)) + place.astype(np.uint64) * _STEP
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    return np.add.reduceat(mixed * _STEP, first)


@lru_cache(1)
def _function_hashes() -> np.ndarray:
    words = sorted({w for listed in FUNCTION_WORDS.values() for w in listed.split()})
    codes = code_points("".join(words))
    length = np.array([len(w) for w in words])
    return np.unique(_word_hashes(codes, np.cumsum(length) - length, np.cumsum(length)))


class Measured:
    """The lines of some texts: the text each stands in, its counts by class, its script; and the hashes of its words."""

    def __init__(self, texts: list[str]):
        kind_of, lower, script_of = _tables()
        codes = code_points("\n".join([*texts, ""]))
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        kind = kind_of[codes]
        breaks = np.flatnonzero(codes == 10)
        begin, end = np.concatenate([[0], breaks[:-1] + 1]), breaks
        blank = (kind == SPACE) | (codes == 9)
        inked = np.concatenate([[0], np.cumsum(~blank)])
        filled = inked[end] > inked[begin]
        self.begin, self.end = begin[filled], end[filled]
        n = len(self.begin)
        self.text = np.searchsorted(ends, self.begin, side="right")
        self.counts = np.zeros((n, WIDTH), np.float32)
        self.size = (self.end - self.begin).astype(np.int64)
        self.script = np.zeros((n, len(_SCRIPTS) + 1), np.int64)
        self.word_line, self.word_hash, self.words = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(n, np.int64)
        self.ink = self.symbols = self.stopped = self.layout = np.zeros(n)
        if not n:
            return
        # runs of three spaces and more are gaps, runs of four stops and more leaders
        same = np.concatenate([[False], (codes[1:] == codes[:-1]) & ((codes[1:] == 32) | (codes[1:] == 46))])
        start = np.flatnonzero(~same)
        run = np.diff(np.append(start, len(codes)))
        long_space, long_stop = (codes[start] == 32) & (run >= 3), (codes[start] == 46) & (run >= 4)
        special = np.flatnonzero(long_space | long_stop)
        kind[_spread(start[special], run[special])] = np.repeat(np.where(long_space[special], GAP, LEADER), run[special]).astype(np.uint8)

        line_of = np.repeat(np.arange(n), self.size)
        at = _spread(self.begin, self.size)
        once = np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32) | (kind[1:] == GAP)])[at]  # two spaces are one
        self.counts[:, :11] = np.bincount((line_of * 11 + kind[at])[once], minlength=n * 11).reshape(n, 11)
        self.script = np.bincount(line_of * 5 + script_of[codes[at]], minlength=n * 5).reshape(n, 5)

        # words: what white space separates
        gap = blank
        w_begin = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        w_end = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
        line = np.searchsorted(self.begin, w_begin, side="right") - 1
        totals = lambda mask: (lambda c: c[w_end] - c[w_begin])(np.concatenate([[0], np.cumsum(mask)]))
        letters, digits, capitals = totals(kind <= CAPITAL), totals(kind == DIGIT), totals(kind == CAPITAL)
        length = w_end - w_begin
        operators = totals((kind == OPERATOR) | (kind == CELL) | (kind == OTHER))
        # the letters of a word, without the marks at its edges
        is_letter = kind <= CAPITAL
        there = np.flatnonzero(is_letter)
        has = letters > 0
        first = np.where(has, there[np.minimum(np.searchsorted(there, w_begin), len(there) - 1)] if len(there) else 0, w_begin)
        last = np.where(has, there[np.maximum(np.searchsorted(there, w_end) - 1, 0)] + 1 if len(there) else 0, w_end)
        lowered = lower[codes]
        hashes = _word_hashes(lowered, first, last)
        known = _function_hashes()
        function = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
        scripts = script_of[codes]
        spoken = scripts[np.minimum(first, len(codes) - 1)] > 1
        running = totals(scripts == 4) > 0  # of a script without spaces: what stands in it is no mixture
        turns = totals(np.concatenate([[False], (kind[1:] == CAPITAL) & (kind[:-1] == LETTER)]))
        inner = last - first - totals(is_letter)  # marks and digits inside
        word = np.full(len(w_begin), WORD)
        word[capitals > 0] = NAME
        word[((operators > 0) & (inner > 0) | ((digits > 0) & has)) & ~running] = MIXED
        word[running] = WORD
        word[function & has] = FUNCTION
        word[~has] = np.where(digits[~has] > 0, NUMBER, SYMBOLS)
        word[(letters == 1) & (length == 1) & ~spoken & ~function] = SINGLE
        word[(length >= _LONG_STRING) & ~spoken & ~running & ((digits > 0) | (operators > 0) | (turns > length // 10) | (length >= 100))] = STRING
        word[(length >= 64) & ~has] = STRING
        self.counts[:, 11:19] = np.bincount(line * 8 + word - 11, minlength=n * 8).reshape(n, 8)
        self.words = np.bincount(line, minlength=n)
        self.word_line, self.word_hash = line, hashes
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, line, np.where(word == STRING, length, 0))

        # layout: what the line begins and ends with, and its cells
        one = np.searchsorted(w_begin, self.begin)
        head, head_end = w_begin[one], w_end[one]
        mark = codes[head]
        bullet = (head_end - head == 1) & np.isin(mark, _BULLETS)
        closing = np.isin(codes[np.maximum(head_end - 1, 0)], _CLOSINGS)
        number = closing & (head_end - head <= 5) & ((digits[one] > 0) | (letters[one] == 1)) & (digits[one] + letters[one] <= 4)
        item = (bullet | number) & (self.words > 1)
        tail = w_end[np.searchsorted(w_begin, self.end) - 1] - 1
        tail_letter = last[np.searchsorted(w_begin, self.end) - 1]
        stopped = (kind[tail] == STOP) | (kind[np.minimum(tail_letter, len(kind) - 1)] == STOP) & (tail_letter <= tail)
        inside = np.concatenate([[0], np.cumsum((kind == STOP) & np.concatenate([blank[1:], [True]]))])
        unspaced = np.concatenate([[0], np.cumsum((kind == STOP) & (codes > 0x500))])
        cells = self.counts[:, CELL] + 0.0
        semicolons = np.concatenate([[0], np.cumsum((codes == 59) & np.concatenate([[False], ~blank[:-1]]))])
        cells -= semicolons[self.end] - semicolons[self.begin]  # a semicolon behind a word parts clauses
        tight = np.concatenate([[0], np.cumsum((codes == 44) & np.concatenate([~blank[1:], [True]]))])
        gaps = np.bincount(np.searchsorted(self.begin, start[special], side="right") - 1, minlength=n) if len(special) and start[special[0]] >= self.begin[0] else np.zeros(n, np.int64)
        row = (cells >= 2) | (tight[self.end] - tight[self.begin] >= 4) | (gaps >= 2) | (self.counts[:, LEADER] > 0)
        running_line = self.script[:, 4] * 2 > self.script[:, 1:4].max(axis=1)  # of a script without spaces
        layout = np.where((self.words > 6) | (self.size > 25) & running_line, WRAPPED, SHORT)
        layout = np.where(stopped | (inside[self.end] - inside[self.begin] >= 2) | (unspaced[self.end] - unspaced[self.begin] >= 2), SENTENCE, layout)
        layout = np.where(item, ITEM, layout)
        layout = np.where(row, ROW, layout)
        layout = np.where(longest > 0.5 * self.size, SOLID, layout)
        whole = (self.words > 4) | (self.size > 25) & running_line  # a sentence that is an item is half of each
        spoken_item = item & ~row & ((self.words > 7) | stopped & whole)
        share = np.where(spoken_item, 0.5, 1).astype(np.float32)
        self.counts[np.arange(n), layout] = share
        self.counts[np.arange(n), np.where(stopped, SENTENCE, WRAPPED)] += 1 - share
        self.layout, self.stopped = layout, stopped
        marks = np.concatenate([[0], np.cumsum((kind > DIGIT) & ~blank)])
        self.ink, self.symbols = inked[self.end] - inked[self.begin], marks[self.end] - marks[self.begin]


_BULLETS = np.array([ord(c) for c in "-*•·‣▪–—"], np.uint32)
_CLOSINGS = np.array([ord(c) for c in ".)"], np.uint32)


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of ranges, end to end."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def distributions(counts: np.ndarray) -> np.ndarray:
    """Counts as shares, for each of the four distributions; one that is empty stays 0."""
    out = np.zeros_like(counts)
    for a, b, _ in _PARTS:
        total = counts[:, a:b].sum(axis=1, keepdims=True)
        np.divide(counts[:, a:b], total, out=out[:, a:b], where=total > 0)
    return out


_WEIGHTS = np.repeat([w for _, _, w in _PARTS], [b - a for a, b, _ in _PARTS]).astype(np.float32)
_TINY = np.float32(1e-12)
#: rows compared at a time, so that they stay in the processor's cache
ROWS = 2048


def _plogp(p: np.ndarray) -> np.ndarray:
    """Weighted sums of p log p over the rows' distributions."""
    return (p * np.log2(p + _TINY)) @ _WEIGHTS[: p.shape[1]]


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Weighted Jensen-Shannon divergences, in bits, of each row of p from each row of q."""
    out = np.empty((len(q), len(p)), np.float32)
    own = _plogp(p)
    for k, other in enumerate(q):
        middle = (p + other) * np.float32(0.5)
        out[k] = (own + _plogp(other[None])) / 2 - _plogp(middle)
    return out


def _again(measured: Measured, unit: np.ndarray, units: int) -> np.ndarray:
    """[new, repeated] pairs of words of each unit; a single word counts as new."""
    if len(measured.word_hash) < 2:
        return np.tile(np.array([[1, 0]], np.float32), (units, 1))
    of = unit[measured.word_line]
    inside = of[1:] == of[:-1]
    pair = (measured.word_hash[:-1] * _STEP ^ measured.word_hash[1:])[inside]
    of = of[:-1][inside]
    order = np.lexsort((pair, of))
    o, h = of[order], pair[order]
    first = np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])])[: len(o)]
    new, again = np.bincount(o, first, units), np.bincount(o, ~first, units)
    return np.stack([np.maximum(new, 1), again], axis=1).astype(np.float32)


@lru_cache(1)
def profiles() -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(distributions, script index or -1 for any, kind) of the structural profiles; the loops come last."""
    made = []
    for script, examples in _PROSE.items():
        for text in examples:
            size = 30 if script == "unspaced" else 70
            wrapped = _wrap(text, size)
            bare = "".join(c for c in text if c not in ".,;!?。，、。।،")
            made += [(text, _SCRIPTS.index(script), "prose"), (wrapped, _SCRIPTS.index(script), "prose"), (_wrap(bare, size), _SCRIPTS.index(script), "prose")]
    made += [(text, _SCRIPTS.index(script), "list") for script, examples in _WORD_LISTS.items() for text in examples]
    for kind, examples in _STRUCTURES.items():
        made += [(text, -1, kind) for text in examples]
    made += [(text, -1, "prose") for text in _LOOPS]
    m = Measured([text for text, _, _ in made])
    counts = np.zeros((len(made), WIDTH), np.float32)
    np.add.at(counts, m.text, m.counts)
    counts[:, NEW:] = _again(m, m.text, len(made))
    return distributions(counts), np.array([s for _, s, _ in made]), [k for _, _, k in made]


def _wrap(text: str, size: int) -> str:
    lines, line = [], ""
    for word in text.split(" ") if " " in text else list(text):
        glue = " " if " " in text and line else ""
        if line and len(line) + len(glue) + len(word) > size:
            lines.append(line)
            line, glue = "", ""
        line += glue + word
    return "\n".join([*lines, line])


def nearest(p: np.ndarray, script: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind, divergence) of the nearest profile of each row of distributions; prose is compared with that of the row's own script."""
    q, of, kinds = profiles()
    number = np.array([KINDS.index(k) for k in kinds])
    if p.shape[1] < WIDTH:  # single lines, which aren't compared by their repeats, can't be told from loops
        q, of = q[: -len(_LOOPS), : p.shape[1]], of[: -len(_LOOPS)]
    kind, distance = np.zeros(len(p), np.int64), np.zeros(len(p), np.float32)
    for own in np.unique(script).tolist():
        mine, among = np.flatnonzero(script == own), np.flatnonzero((of < 0) | (of == own))
        for at in range(0, len(mine), ROWS):
            rows = mine[at : at + ROWS]
            d = divergences(p[rows], q[among])
            best = d.argmin(axis=0)
            kind[rows], distance[rows] = number[among[best]], d[best, np.arange(len(rows))]
    return kind, distance


def _own_script(counts: np.ndarray) -> np.ndarray:
    """The script most letters of a row are of; signs of unspaced scripts count twice, as they stand for more."""
    return (counts[:, 1:] * np.array([1, 1, 1, 2])).argmax(axis=1)


def units(m: Measured) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit of each line; text, kind and divergence of each unit)."""
    n = len(m.begin)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.float32)
    p, script = distributions(m.counts)[:, :NEW], _own_script(m.script)  # single lines aren't compared by their repeats
    # a line of few words leans on its neighbours in the text
    own = np.minimum(1.0, 0.4 + m.words / 60).astype(np.float32)[:, None]
    own = np.where(m.layout[:, None] == SOLID, 1, own)
    before, after = np.maximum(np.arange(n) - 1, 0), np.minimum(np.arange(n) + 1, n - 1)
    before, after = np.where(m.text[before] == m.text, before, np.arange(n)), np.where(m.text[after] == m.text, after, np.arange(n))
    blended = own * p + (1 - own) * (p[before] + p[after]) / 2
    kind, _ = nearest(blended, script)
    unit = np.cumsum(np.concatenate([[True], (m.text[1:] != m.text[:-1]) | (kind[1:] != kind[:-1])])) - 1
    number = int(unit[-1]) + 1
    lines, first = np.bincount(unit), np.searchsorted(unit, np.arange(number))
    counts, scripts = np.add.reduceat(m.counts, first), np.add.reduceat(m.script, first)
    counts[:, NEW:] = _again(m, unit, number)
    whole, distance = nearest(distributions(counts), _own_script(scripts))
    # a single short line between others is a heading or the end of a paragraph
    alone = (lines == 1) & (m.words[first] < 8) & np.isin(m.layout[first], (SHORT, SENTENCE)) 
    return unit, m.text[first], np.where(alone, KINDS.index("prose"), whole), distance


def _groups(texts: list[str]):
    """(first, last) of the texts to be measured together."""
    at = 0
    while at < len(texts):
        last, size = at, 0
        while last < len(texts) and (last == at or size + len(texts[last]) <= GROUP):
            size += len(texts[last])
            last += 1
        yield at, last
        at = last


def shares(texts: list[str]) -> np.ndarray:
    """[prose, list, table, junk] of each text: shares of its characters in units of each kind; 0 for white texts."""
    out = np.zeros((len(texts), len(KINDS)))
    for at, last in _groups(texts):
        m = Measured(texts[at:last])
        out[at:last] = _kind_sizes(m, last - at)
    total = out.sum(axis=1, keepdims=True)
    return np.divide(out, total, out=out, where=total > 0)


def _kind_sizes(m: Measured, texts: int) -> np.ndarray:
    unit, _, kind, _ = units(m)
    return np.bincount(m.text * len(KINDS) + kind[unit], m.size, texts * len(KINDS)).reshape(texts, len(KINDS))


STATISTICS = ("n_chars", "n_words", "mean_word_length", "symbol_ratio", "stop_line_share", "function_word_share", "prose_share", "list_share", "table_share", "junk_share", "divergence")


def measure(texts: list[str]) -> np.ndarray:
    """One row of STATISTICS for each text; ``divergence`` is that of the whole text from its nearest profile, 0 for white texts."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for at, last in _groups(texts):
        part, m = texts[at:last], Measured(texts[at:last])
        n = len(part)
        sums = lambda values: np.bincount(m.text, values, n)
        chars, lines, words = np.fromiter(map(len, part), np.int64, n), np.bincount(m.text, minlength=n), sums(m.words)
        sizes = _kind_sizes(m, n)
        counts, scripts = np.zeros((n, WIDTH), np.float32), np.zeros((n, len(_SCRIPTS) + 1), np.int64)
        for k in range(WIDTH):
            counts[:, k] = sums(m.counts[:, k])
        for k in range(scripts.shape[1]):
            scripts[:, k] = sums(m.script[:, k])
        counts[:, NEW:] = _again(m, m.text, n)
        _, distance = nearest(distributions(counts), _own_script(scripts))
        per = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
        out[at:last] = np.stack([chars, words, per(sums(m.ink), words), per(sums(m.symbols), chars), per(sums(m.stopped), lines), per(sums(m.counts[:, FUNCTION]), words), *(per(sizes[:, k], sizes.sum(axis=1)) for k in range(len(KINDS))), np.where(lines > 0, distance, 0)], axis=1)
    return out


def _rows(texts: DataFrame, key: str, fn, names: tuple[str, ...], types: list, schema: str) -> DataFrame:
    """(key, the columns of fn's rows) of the texts that are neither null nor empty."""

    def run(it):
        for batch in it:
            rows = [(k, t) for k, t in zip(strings(batch, key), strings(batch, "text")) if t]
            values = fn([t for _, t in rows])
            yield frame([key, *names], [[k for k, _ in rows], *(values[:, i].astype(np.int64) if pa.types.is_integer(t) else values[:, i] for i, t in enumerate(types))], [pa.string(), *types])

    return texts.select(key, "text").mapInArrow(run, f"{key} string, {schema}")


def statistics(texts: DataFrame, key: str = "pdf_id") -> DataFrame:
    """(key, one column for each of STATISTICS)."""
    types = [pa.int32(), pa.int32(), *[pa.float64()] * (len(STATISTICS) - 2)]
    schema = "n_chars int, n_words int, " + ", ".join(f"{n} double" for n in STATISTICS[2:])
    return _rows(texts, key, measure, STATISTICS, types, schema)


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts_of(read(spark, sf_dir, "clean_out"), ["pdf_id"], "body")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are lists, tables or strings rather than sentences."""
    other = lambda texts: shares(texts)[:, 1:].sum(axis=1, keepdims=True)
    return _rows(_bodies(spark, sf_dir), "pdf_id", other, ("other_share",), [pa.float64()], "other_share double").where("other_share > 0.5").select("pdf_id").distinct()


def p6_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every body, with what validation and the metrics recorded."""
    old = read(spark, sf_dir, "validate_out").groupBy("pdf_id").agg(F.max("signals.content_words").alias("content_words"), F.min("signals.unique_word_ratio").alias("unique_word_ratio"))
    metrics = read(spark, sf_dir, "document_metrics").groupBy("pdf_id").agg(F.max("raw_words").alias("raw_words"), F.max("reduction_pct").alias("reduction_pct"))
    rounded = [F.round(n, 6).alias(n) for n in STATISTICS[2:]]
    return statistics(_bodies(spark, sf_dir)).distinct().join(old, "pdf_id", "left").join(metrics, "pdf_id", "left").select("pdf_id", "n_chars", "n_words", *rounded, "content_words", "unique_word_ratio", "raw_words", "reduction_pct")
