"""Problem 7: sentence units across languages and scripts, by cascading rule tables.

A text is cut into blocks at blank lines, and a block further at line breaks that
no wrapping explains (headings, list items, table rows).  Inside a block every
place behind a full stop, or behind a white space between letters of a script
that has none, is a candidate.  The tables below hold ordered pairs of regular
expressions (what stands before, what stands behind); a language's own table
comes first, then the one of all languages, and the first rule that matches a
candidate decides it.

Units are given by the character offsets of their first and last characters; all
characters that belong to no unit are white space.

Defined cases: null, empty and white texts have no units; an unbalanced quotation
mark pairs with nothing; a text without any full stop is one unit a block.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, read, strings, texts_of

BREAK, KEEP = True, False

_CLOSE = r"[\"'”’»›)\]】」』）》]*"
_CANDIDATE = re.compile(r"[.!?…؟۔।॥]+" + _CLOSE + r"(?=\s|$)|[。！？｡]+" + _CLOSE + r"|(?<=[฀-๿])\s+(?=[฀-๿])|[.!?؟।۔]+(?=[\"'”’»]*[぀-ヿ㐀-鿿])")

#: Abbreviations that stand before a name, a number or the rest of their sentence.
_TITLES = {
    "en": "Mr|Mrs|Ms|Dr|Prof|St|Gen|Col|Capt|Lt|Sgt|Rev|Hon|Sen|Rep|Gov|Messrs|Mx",
    "de": "Dr|Prof|Hr|Fr|Nr|Abs|Art|bzw|ca|vgl|evtl|ggf|inkl|zzgl|Dipl|Ing|St|Str|sog|usf|Mio|Mrd|Tsd",
    "fr": "M|MM|Dr|Pr|Me|Mgr|St|Ste|art|chap|fig|env|p|av|réf|vol|éd",
    "es": "Sr|Sra|Srta|Sres|Dr|Dra|D|Dña|Prof|Lic|Ing|Gral|art|núm|pág|fig|Ud|Uds|aprox",
    "ru": "г|гг|т|тт|д|е|п|н|к|ул|пр|стр|рис|руб|коп|млн|млрд|тыс|им|ср|см|гл|ст|проф|акад|др",
    "ar": "د|أ|م|ص|ه",
    "hi": "डॉ|श्री|प्रो|पं|कु|सं|रु",
    "any": "vs|approx|cf|al|ed|eds|vol|pp|ff|fig|figs|eq|sec|ch|dept|est|viz|e\\.g|i\\.e|Fig|Figs|Eq|Vol|Sec|Art",
}
#: Abbreviations that may also end a sentence.
_OPEN_ENDS = r"etc|Inc|Ltd|Co|Corp|Jr|Sr|Bros|LLC|PLC|GmbH|AG|S\.A|S\.L|a\.m|p\.m|A\.M|P\.M|U\.S|U\.K|U\.N|E\.U|D\.C|usw|u\.a|и т\. ?д|и др|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept?|Oct|Nov|Dec|Mon|Tue|Wed|Thu|Fri|Sat|Sun"
_STARTERS = r"(?:The|This|That|These|Those|A|An|In|On|At|It|Its|He|She|They|We|I|You|But|And|Or|So|If|When|While|After|Before|Because|Since|For|With|Under|By|As|Once|Despite|Near|Within|Over|Most|Some|All|Every|Many|No|Not|Only|Nobody|Users|Staff|Why|How|What|Who|Is|Was|Are|Did)\b"
_SPEECH = r"(?:said|says|asked|asks|told|tells|wrote|writes|added|replied|warned|noted|explained|claimed|according|dijo|dice|afirmó|preguntó|sagte|sagt|erklärte|fragte|meinte|dit|déclaré|affirme|demandé|сказал|сказала|заявил|спросил|قال|أضاف|कहा|बताया|说|說|表示|と|って)"


def _abbreviations(names: str) -> str:
    return rf"(?<![\w.])(?:{names})\.$"


#: For each language, then for all: (what ends at the candidate's end, what follows from there, break or keep).
TABLES: dict[str, list[tuple[str, str, bool]]] = {
    "en": [
        (_abbreviations(_TITLES["en"]), r"", KEEP),
        (r"(?<!\w)Nos?\.$", r"\s+\d", KEEP),
        (r"(?<!\w)pp?\.$", r"\s+\d", KEEP),
    ],
    "de": [
        (_abbreviations(_TITLES["de"]), r"", KEEP),
        (r"(?<![\w.])[a-zA-Z]\.$", r"\s+[A-Za-z]\.", KEEP),
        (r"(?<![\w.])[a-zA-Z]\.\s?[a-zA-Z]\.$", r"\s+\w", KEEP),
        (r"(?<![\w.,])\d{1,2}\.$", r"\s+(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jahrhundert|[a-zäöü])", KEEP),
    ],
    "fr": [
        (_abbreviations(_TITLES["fr"]), r"", KEEP),
    ],
    "es": [
        (_abbreviations(_TITLES["es"]), r"", KEEP),
        (r"(?<![\w.])(?:EE|UU|FF)\.$", r"", KEEP),
    ],
    "ru": [
        (_abbreviations(_TITLES["ru"]), r"\s+(?:[а-яё\d]|[A-ZА-ЯЁ])", KEEP),
    ],
    "ar": [
        (_abbreviations(_TITLES["ar"]), r"", KEEP),
    ],
    "hi": [
        (_abbreviations(_TITLES["hi"]), r"", KEEP),
    ],
    "zh": [],
    "ja": [],
    "th": [
        (r"(?:พ\.ศ|ค\.ศ|ดร|นาย|นาง|น\.ส|อ)\.$", r"", KEEP),
    ],
    "any": [
        (r"(?<!\S)\S*[.!?]$", r"\s+(?=$)", BREAK),
        (_abbreviations(_TITLES["any"]), r"", KEEP),
        (r"(?<![\w.])(?:[Aa]rt|[Nn]r|[Nn]os?|[Ff]igs?|pp?|[Vv]ol|[Cc]h|[Ss]ec|[Nn]úm|[Pp]ág|Abs|рис|стр|гл|см|ст)\.$", r"\s+\d", KEEP),
        # a bare numeral or letter that begins a line numbers an item
        (r"(?:^|\n)[ \t]*(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})\.$", r"[ \t]+\S", KEEP),
        # lower case goes on, whatever mark stood before
        (r"", r"\s+[(\[]?[a-zà-öø-ÿа-яё]", KEEP),
        (r"", r"\s+[,;:)\]–—]", KEEP),
        # an abbreviation with stops ends a sentence only before a word that can start one
        (rf"(?<![\w.])(?:{_OPEN_ENDS})\.$", rf"\s+(?:[\"'“„]|«\s?)?{_STARTERS}", BREAK),
        (r"(?<![\w.])(?:Inc|Ltd|Co|Corp|LLC|PLC|GmbH|etc|usw|p\.m|a\.m|S\.A)\.$", r"\s+(?:[\"'“„]|«\s?)?[A-ZÀ-ÖØ-ÞА-ЯЁ¿¡]", BREAK),
        (rf"(?<![\w.])(?:{_OPEN_ENDS})\.$", r"", KEEP),
        # initials of a name
        (r"(?<![\w.'’])[A-ZÀ-ÖØ-ÞА-ЯЁ]\.$", r"\s+[A-ZÀ-ÖØ-ÞА-ЯЁ]", KEEP),
        (r"", r"\s", BREAK),
        (r"[。！？｡।॥؟۔!?]" + _CLOSE + "$", r"", BREAK),
        (r"\.$", r"[\"'”’»]*[぀-ヿ㐀-鿿]", KEEP),
        (r"", r"$", BREAK),
    ],
}

_COMPILED = {lang: [(re.compile(before), re.compile(behind), how) for before, behind, how in table] for lang, table in TABLES.items()}

_BLOCK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_BULLET = re.compile(r"[ \t]*(?:[-*•·‣▪–—]|\d{1,3}[.)]|\(?[a-zA-Z]\))[ \t]+\S")
_ROW = re.compile(r"[^\n]*(?:\.{4,}|\t|[^|\n]\|[^|\n]+\|)[^\n]*$")
_TERMINAL = re.compile(r"[.!?…:;,。！？，；：、؟،؛।॥۔]" + _CLOSE + r"\s*$")
_INNER = re.compile(r"[.!?][\"”»)]?\s|[。！？]")
_PAIRS = re.compile(r"“[^“”]*”|„[^„“”\"]*[“”\"]|«[^«»]*»|「[^「」]*」|『[^『』]*』|\"[^\"]*\"")
_SCRIPTS = (
    ("th", re.compile("[฀-๿]")), ("hi", re.compile("[ऀ-ॿ]")), ("ar", re.compile("[؀-ۿ]")),
    ("ja", re.compile("[぀-ヿ]")), ("zh", re.compile("[㐀-鿿]")), ("ru", re.compile("[Ѐ-ӿ]")),
)
_COMMON = {
    "de": re.compile(r"\b(?:der|die|das|und|von|hat|wurde|nicht|eine|wer|nach)\b"),
    "fr": re.compile(r"\b(?:le|la|les|une|des|du|et|été|était|pas|que|qui|est|dans|pour|avec|selon)\b"),
    "es": re.compile(r"\b(?:el|la|los|una|fue|que|del|por|según|estaba|las|con|no)\b"),
    "en": re.compile(r"\b(?:the|and|of|to|was|that|for|by|its|with)\b"),
}


def language(text: str) -> str:
    """The rule table to use: by script, else by the commonest small words."""
    letters = sum(map(str.isalpha, text)) or 1
    if not text.isascii():
        for lang, script in _SCRIPTS:
            share = len(script.findall(text)) / letters
            if share > (0.05 if lang == "ja" else 0.2):
                return lang
    lower = text.lower()
    counts = {lang: len(words.findall(lower)) for lang, words in _COMMON.items()}
    best = max(counts, key=lambda k: (counts[k], k == "en"))
    return best if counts[best] else "en"


def _blocks(text: str) -> list[tuple[int, int]]:
    """Spans without blank lines or breaks that wrapping doesn't explain."""
    spans, start = [], 0
    for gap in [*_BLOCK.finditer(text), None]:
        end = gap.start() if gap else len(text)
        if text[start:end].strip():
            spans.append((start, end))
        start = gap.end() if gap else end
    out = []
    for a, b in spans:
        cuts = [a]
        width = max(map(len, text[a:b].split("\n")))
        at = text.find("\n", a, b)
        while at >= 0:
            line_start = max(text.rfind("\n", 0, at) + 1, a)
            line, follows = text[line_start:at], text[at + 1 : b].split("\n", 1)[0]
            if _BULLET.match(follows) or _ROW.match(line) or _ROW.match(follows):
                cuts.append(at)
            elif line.strip() and not _TERMINAL.search(line) and follows.strip():
                first = follows.split(None, 1)[0]
                fits = len(line.rstrip()) + 1 + len(first) <= width
                before = text[a:line_start].rstrip()
                opens = line_start in (cuts[-1], cuts[-1] + 1) or bool(_TERMINAL.search(before))
                if fits and opens and not first[0].islower() and len(line) <= 0.8 * width and not _INNER.search(line):
                    cuts.append(at)  # a heading or an item on its own line
            at = text.find("\n", at + 1, b)
        cuts.append(b)
        out += [(p, q) for p, q in zip(cuts, cuts[1:]) if text[p:q].strip()]
    return out


def units(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each unit of a text."""
    if not text or not text.strip():
        return []
    lang = language(text)
    rules = [*_COMPILED[lang], *_COMPILED["any"]]
    out = []
    for a, b in _blocks(text):
        block = text[a:b]
        quotes = [m.span() for m in _PAIRS.finditer(block)]
        opens = [q[0] for q in quotes]
        start = 0
        for m in _CANDIDATE.finditer(block):
            if m.group().isspace():
                end = m.start()
            else:
                end = m.end()
            if end <= start:
                continue
            k = bisect_right(opens, end) - 1
            # k: the last quotation that opens before the candidate's end
            if k >= 0 and quotes[k][0] < end < quotes[k][1]:
                continue
            if k >= 0 and quotes[k][1] == end and _speaker_follows(block, start, quotes[k], end):
                continue
            if m.group().isspace() or _decide(rules, block, end):
                out.append((a + start, a + end))
                start = end
        if block[start:].strip():
            out.append((a + start, b))
    trimmed = []
    for p, q in out:
        piece = text[p:q]
        p += len(piece) - len(piece.lstrip())
        q -= len(piece) - len(piece.rstrip())
        if q > p:
            trimmed.append((p, q))
    return trimmed


_SPEAKER = re.compile(rf"[\s,，、–—-]*(?:[^\s.!?。！？]+\s+){{0,4}}?{_SPEECH}")
_SPEAKER_CJK = re.compile(rf"[^\s。！？]{{0,12}}?{_SPEECH}")


def _speaker_follows(block: str, start: int, quote: tuple[int, int], end: int) -> bool:
    """Whether the words behind a quotation that opens a sentence name who said it."""
    if block[start : quote[0]].strip():
        return False  # the speaker, or the rest of the sentence, stood before
    behind = block[end : end + 120]
    if not behind.strip():
        return False
    if behind[0].isspace() or behind.isascii():
        return bool(_SPEAKER.match(behind))
    return bool(_SPEAKER_CJK.match(behind))


def _decide(rules: list, block: str, end: int) -> bool:
    before = block[max(0, end - 40) : end]
    for left, right, how in rules:
        if right.match(block, end) and left.search(before):
            return how
    return KEEP


def sentence_units(texts: DataFrame, key: str = "pdf_id") -> DataFrame:
    """(key, unit_no, sent_start, sent_end) of the column ``text``."""
    names, types = [key, "unit_no", "sent_start", "sent_end"], [pa.string(), pa.int32(), pa.int32(), pa.int32()]

    def run(it):
        for batch in it:
            rows = [(k, n, a, b) for k, text in zip(strings(batch, key), strings(batch, "text")) for n, (a, b) in enumerate(units(text), 1)]
            yield frame(names, list(zip(*rows)) or [[] for _ in names], types)

    return texts.select(key, "text").mapInArrow(run, f"{key} string, unit_no int, sent_start int, sent_end int")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of the sentence units of the bodies named in boundary_sample."""
    bodies = texts_of(read(spark, sf_dir, "clean_out"), ["pdf_id"], "body")
    wanted = read(spark, sf_dir, "boundary_sample").select("pdf_id").distinct()
    return sentence_units(bodies.join(wanted, "pdf_id", "left_semi")).select("pdf_id", "sent_end").distinct()


def p7_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered sentence units of every body."""
    return sentence_units(texts_of(read(spark, sf_dir, "clean_out"), ["pdf_id"], "body")).distinct()
