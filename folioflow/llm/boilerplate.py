"""Problem 2: page furniture around the article, by consensus host paths.

A text has no tags, so a line's path is its generalised form: as it stands (case and
spacing folded), with its digits folded, with its numbers and names masked, what stands
before its separator, and the form of the sentences in its block, as they stand and
masked; the line that follows a heading votes on the heading as a place of links.

Containers are scored first.  A line or sentence of a page scores if earlier cleaning
dropped it (it is absent from the cleaned body of its document), unless it stands where a
heading of the article would; a line alone at the edges of several pages scores, and so
does one with the wording of common furniture, which is a weak prior: it adds to a score
and decides nothing.  Bodies that hold little of their pages tell nothing.

Then the hosts vote, one ballot a document and path.  A path wins on its host, or among
all, if most of its ballots score (``SCORED`` of three or five, half of twenty), or if
it is so frequent (clearly more than 3 % of a host's documents, or a good part of all
hosts) that no article line could be.  Masked forms win among all hosts only.  Pages
and bodies are extracted again with the winning paths.

Size: texts are read once, where they lie, and leave as hashes and flags, kept as a
table; ballots are counted where a document's rows meet, so (host, path) counts are what
is shuffled, and a host with a third of all rows is spread over its paths.  Winners go
back as sorted arrays while they are few (``BROADCAST_ROWS``, checked); beyond that the
paths of the documents are joined with them, by salt, to the same result.

Defined cases: null pages and empty or null bodies have no lines; a document without a
known host votes among all hosts only; a line that equals the recorded title is the
article's own; repeated rows count once.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, read, written

#: a path wins on a host from HOST_LEAST documents and from HOST_SHARE of them plus two standard deviations on
HOST_SHARE, HOST_LEAST = 0.03, 3
#: or if this part of its ballots score; among all hosts from ALL_LEAST ballots on, or half of them from ALL_MANY on
SCORED, ALL_LEAST, ALL_MANY = 0.8, 5, 20
ALL_SHARE, ALL_HOSTS = 0.02, 0.3
#: a body must hold this part of its pages' sentences to tell what cleaning dropped
KEPT = 0.3
BROADCAST_ROWS = 200_000
SALTS = 64

LONG = 1000
FURNITURE, RELATED, SENTENCE, HEADLINE, BLOCK_START, EDGE, REPEATED, STOP, ROW, ITEM, HEADING, LINK, ALONE = (1 << i for i in range(13))
#: classes of paths, in bits 2 to 4 of a path's hash; the lowest two are those of a ballot
LINE, FOLDED, MASKED, PREFIX, SENTENCES, MASKED_SENTENCES, BELOW = (i << 2 for i in range(7))
CLASS, SCORES, KNOWN = 7 << 2, 1, 2

# Headings of related links and the wording of common page furniture.
_RELATED = re.compile(
    r"^(?:More (?:from|on|in)\b.*|Most (?:read|popular)|In other news|Recommended(?: for you)?|Related(?: (?:articles|stories|posts|links))?|You (?:might|may) also like|Trending(?: now)?|Editor's picks|Read next|Latest (?:news|stories)|"
    r"相关阅读|相关文章|推荐阅读|関連記事|यह भी पढ़ें|اقرأ أيضا|À lire aussi|Mehr zum Thema|Lesen Sie auch|บทความที่เกี่ยวข้อง|Te puede interesar|Читайте также)\s*:?$",
    re.I,
)
_LINE = re.compile(
    r"^(?:"
    r"(?:Read more|See also|Don't miss|Also read|Related|Read next|More on this)\s*:.*|(?:Tags|Filed under|Categories|Schlagwörter|Étiquettes|Etiquetas|Теги)\s*:.*|"
    r"(?:>>|»|→|➜|▶)\s+\S.*|(?:Home|Start|Accueil|Inicio|Startseite|Главная|首页|ホーム)\s*[>›»]\s.*|"
    r"Share (?:on|this)\b.*|(?:Tweet|Post|Pin)(?:\s+(?:Tweet|Post|Pin))+|Listen to this (?:article|story)|Save for later|Print(?: view| this page)?|f\s+t\s+in\b.*|\d+ comments?|\d+ min(?:ute)?s? read|"
    r"Accept(?: all)?(?:\s+\|?\s*(?:Decline|Reject|Manage options|Settings).*)?|Reject all\b.*|OK, got it|Save choices|Manage options|"
    r"Advertisement\b.*|AD|Ad|Anzeige|Publicité|Publicidad|Sponsored(?: content)?|Paid content|广告|広告|Реклама|"
    r"Site ?map\b.*|Do not sell my data|Terms of use\b.*|Privacy (?:policy|notice)\b.*|Imprint\b.*|Back to top\b.*|Cookie (?:settings|policy)|"
    r"(?:©|\(c\)|Copyright\b|版权所有|著作権).*|Published by .+\. Powered by .+|"
    r"☰.*|(?:Menu|Search|Log ?in|Sign (?:in|up))(?:\s+(?:Menu|Search|Log ?in|Sign (?:in|up)))*|"
    r"Tous droits réservés|Mentions légales\b.*|Haut de page|Impressum\b.*|Nach oben|Alle Rechte vorbehalten\.?|Aviso legal\b.*|Volver arriba|Todos los derechos reservados|Все права защищены|Правила сайта\b.*|"
    r"关于我们.*隐私.*|会社概要.*|無断転載.*|सर्वाधिकार सुरक्षित|गोपनीयता.*नियम.*|جميع الحقوق محفوظة|سياسة الخصوصية.*|สงวนลิขสิทธิ์|นโยบายความเป็นส่วนตัว.*|"
    r"(?:Sign up|Subscribe)\b.{0,60}|Get the (?:weekly|daily) .{0,50}|Free newsletter\b.{0,40}|Never miss a story\b.{0,40}|Your daily .{0,40}update.{0,20}|Join [\d,.]+ readers\b.*|Enter your e-?mail\b.*|"
    r"Page \d+ (?:of|/) \d+"
    r")$",
)
_INSIDE_HINTS = ("ookie", "サイトは", "本网站", "कुकी", "คุกกี้", "ملفات", "rights reserved", "trading name", "Print view", " - page ")  # one of them is in each match of _INSIDE
_INSIDE = re.compile(
    r"^(?:.*(?:本网站使用|当サイトは|कुकी का उपयोग|ใช้คุกกี้|utilisons des cookies|verwenden Cookies|Usamos cookies|файлы cookie|ملفات تعريف الارتباط).*|"
    r".*\bAll rights reserved\.?|.+ is a trading name of .+|.{2,60}(?: [-|]|:) .{2,90} - page \d+ of \d+|.{2,50}(?: [-|]|:) Print view(?: - page \d+ of \d+)?)$"
)
# Patterns that are searched for everywhere begin with one character or class, for which the engine scans quickly.
_NAMES = re.compile(r" [^\W\d_a-z][\w'’&.-]*(?: [^\W\d_a-z][\w'’&.-]*)*")  # in plain texts, which begin with no space
_DIGIT, _DIGITS, _COLUMNS = re.compile(r"\d"), re.compile(r"\d\d*"), re.compile(r" {3,}")
_SPANS = re.compile(
    "|".join(
        p.replace(" ", r"\s+")
        for p in (
            r"We use cookies and similar\b[^.]{0,60}\.", r"This site (?:uses cookies|stores small files)\b[^.]{0,60}\.", r"Cookies help us to\b[^.]{0,60}\.", r"We and our \d+ partners\b[^.]{0,60}\.", r"Your choices about tracking\b[^.]{0,40}\.",
            r"You can change your mind at any time\b[^.]{0,60}\.", r"Some of them are needed, others are optional\.", r"Choose which ones you allow\b[^.]{0,20}\.", r"By (?:browsing|continuing) on\b[^.]{0,60}\.", r"Press Accept to agree\b[^.]{0,60}\.",
            r"Download the free \S[^.]{0,40}?(?:guide|report|paper)\b[^.]{0,160}\.", r"Join us in \w+ for the\b[^.]{0,60}?(?:Summit|Conference|Forum|webinar)[^.]{0,160}\.(?: Early tickets end soon\.)?", r"The [^.]{2,40} Academy runs\b[^.]{0,260}\.",
            r"Members of [^.]{2,40} Plus read\b[^.]{0,220}\.", r"The material on this site is general information\b[^.]{0,240}\.",
        )
    )
)
_SPAN_HINT = re.compile(r"cookies|small files|partners|tracking|change\s+your\s+mind|are\s+needed|you\s+allow|browsing\s+on|Accept\s+to|Download\s+the|Join\s+us|Academy|Members\s+of|material\s+on|Early\s+tickets")

_SIGNPOSTS = re.compile(r"[|·]|\s[/>›]\s")
_STOPS, _CLOSING = tuple(".!?。！？।؟"), "\"'”’»)]」"
_INNER = re.compile(r"[.!?。！？।؟](?:(?<=[.!?])\s+\S|(?<=[。！？।؟]))")
_SEPARATOR = re.compile(r"[\s:](?:(?<=:)\s|(?<!:)[-|>›]\s)")
#: sentences end where a match of it ends
_SENTENCES = re.compile(r"[.!?。！？।؟](?:(?<=[.!?])\s+(?=[^\Wa-z\d_]|[\"“«„(¿¡])|(?<=[。！？।؟]))")


def _cells(line: str) -> tuple[str, int] | None:
    """The delimiter of a table row and how often it stands in it."""
    for name in ("|", ";", ",", "\t"):
        if (n := line.count(name)) >= 3:
            return name, n - (name == "|") * ((line[0] == "|") + (line[-1] == "|"))
    if "   " in line and (n := len(_COLUMNS.findall(line))) >= 3:
        return "columns", n
    return None


_ITEM, _POINTER = re.compile(r"^(?:[-*•·]|\d{1,2}[.)])\s+"), re.compile(r"^(>>|[»→➜▶])\s+\S")


def _hash(text: str, kind: int) -> int:
    return ((xxhash.xxh64_intdigest(text) - (1 << 63)) & -32) | kind


def _plain(text: str) -> str:
    # of what is printable, the space alone is white
    return text if text.isprintable() and "  " not in text and text.strip() == text else " ".join(text.split())


def path_of(line: str, kind: int = LINE) -> int:
    """The path of a line or sentence as it stands."""
    return _hash(_plain(line).casefold(), kind)


def _masked_path(folded: str, digits: bool, kind: int = MASKED) -> int:
    """The path of a plain text with its numbers folded, when its names (capitals behind the first word) are masked; 0 where that leaves a text as it was, or hardly a word of a line."""
    if folded.count(" ") < 2:
        return 0
    masked = _NAMES.sub(" A", folded)
    if masked == folded and (kind == MASKED or not digits) or masked.count(" ") < 2:
        return 0
    return _hash(masked.casefold(), kind)


def _prefix_path(line: str, running: bool) -> int:
    """The path of what stands before the first separator; 0 where a line has none or is an item, running text or a table row."""
    if pointer := _POINTER.match(line):
        return _hash(pointer[1], PREFIX)
    if running or len(line) > 110 or line.count("|") > 1:
        return 0
    m = _SEPARATOR.search(line, 2, 48)
    if not m:
        return 0
    head = line[: m.start()]
    return 0 if any(c.isdigit() for c in head) else _hash(head.casefold(), PREFIX)


class Known:
    """What a function tells of a text.  Furniture comes again and again, so each worker keeps it for the last texts: SEEN of them at most, of up to LONG characters."""

    def __init__(self, of: Callable[[str], tuple]):
        self.of, self.last, self.before = of, {}, {}

    def __call__(self, text: str) -> tuple:
        known = self.last.get(text)
        if known is None:
            known = self.before.get(text) or self.of(text)
            if len(text) <= LONG:
                if len(self.last) >= SEEN // 2:
                    self.last, self.before = {}, self.last
                self.last[text] = known
        return known


SEEN = 20_000


@Known
def _facts(line: str) -> tuple[int, int, int, int, int, tuple[str, int] | None, bool, bool]:
    """(path, prefix path, folded path, masked path, flags, cells of a row, whether it has digits, whether it is running text) of a line."""
    flags = 0
    if len(line) <= 60 and _RELATED.match(line):
        flags = RELATED | FURNITURE
    elif _LINE.match(line) or (any([hint in line for hint in _INSIDE_HINTS]) and _INSIDE.match(line)):
        flags = FURNITURE
    item = _ITEM.match(line)
    inner, words = _INNER.search(line, item.end() if item else 0) is not None, line.count(" ") + 1
    if line.rstrip(_CLOSING).endswith(_STOPS):
        flags |= STOP | SENTENCE
    elif line[0].islower():
        flags |= SENTENCE
    elif 4 <= len(line) <= 160:
        flags |= HEADLINE
    if item:
        flags |= ITEM
    if flags & HEADLINE and (words - (item is not None) >= 3 or not line.isascii()) and not (any([c in line for c in "|·/>›"]) and _SIGNPOSTS.search(line)):
        flags |= LINK
    ends = bool(flags & STOP or inner)
    if not ends and words <= 14:
        flags |= HEADING  # if running text follows it
    cells, digits, plain = _cells(line), _DIGIT.search(line) is not None, _plain(line)
    folded = _DIGITS.sub("0", plain) if digits else plain
    running = ends or (len(line) >= 50 and words >= 8 and not _SEPARATOR.search(line))
    return _hash(plain.casefold(), LINE), _prefix_path(line, ends or item is not None), _hash(folded.casefold(), FOLDED) if digits else 0, _masked_path(folded, digits), flags, cells, cells is not None and digits, running


@Known
def _said(sentence: str) -> tuple[int, int]:
    """(path, masked path) of a sentence."""
    plain, digits = _plain(sentence), _DIGIT.search(sentence) is not None
    return _hash(plain.casefold(), SENTENCES), _masked_path(_DIGITS.sub("0", plain) if digits else plain, digits, MASKED_SENTENCES)


class Lines:
    """What leaves a text: for each line its place, paths and flags; for each sentence its lines and paths."""

    __slots__ = ("page", "line", "path", "prefix", "folded", "masked", "flags", "first", "last", "sentence", "mask", "size")

    def __init__(self):
        for name in self.__slots__:
            setattr(self, name, [])

    def add_page(self, number: int, text: str) -> None:
        begin = len(self.page)
        lexical: set[int] = set()
        if _SPAN_HINT.search(text):
            for m in _SPANS.finditer(text):
                a = text.count("\n", 0, m.start()) + 1
                lexical.update(range(a, a + m.group().count("\n") + 1))
        block: list[tuple[int, str]] = []
        fresh, cells_before, digits_before = True, None, False
        for no, raw in enumerate(text.split("\n"), 1):
            line = raw.strip()
            if not line:
                if block:
                    self._sentences(block)
                    block = []
                fresh, cells_before = True, None
                continue
            path, prefix, folded, masked, flags, cells, digits, running = _facts(line)
            if fresh:
                flags |= BLOCK_START
                fresh = False
            if no in lexical:
                flags |= FURNITURE
            if cells and cells == cells_before and (digits or digits_before):
                flags |= ROW
                self.flags[-1] |= ROW
            cells_before, digits_before = cells, digits
            if not running and len(self.flags) > begin:
                self.flags[-1] &= ~HEADING
            block.append((len(self.page), line))
            self.page.append(number)
            self.line.append(no)
            self.path.append(path)
            self.prefix.append(prefix)
            self.folded.append(folded)
            self.masked.append(masked)
            self.flags.append(flags)
        self._sentences(block)
        count = len(self.page) - begin
        if count:
            self.flags[-1] &= ~HEADING
        for k in {*range(min(3, count)), *range(max(0, count - 5), count)}:
            self.flags[begin + k] |= EDGE

    def _sentences(self, block: list[tuple[int, str]]) -> None:
        if not block:
            return
        starts, length = [], 0
        for _, line in block:
            starts.append(length)
            length += len(line) + 1
        joined = " ".join([line for _, line in block]) + " "
        at = 0
        ends = [m.end() for m in _SENTENCES.finditer(joined)]
        for end in [*ends, len(joined)]:
            sentence = joined[at:end].strip()
            if len(sentence) >= 20:
                a = bisect_right(starts, at) - 1
                b = bisect_right(starts, max(at, end - 2)) - 1
                self.first.append(block[a][0])
                self.last.append(block[b][0])
                path, mask = _said(sentence)
                self.sentence.append(path)
                self.mask.append(mask)
                self.size.append(len(sentence))
            at = end

    def finish(self) -> None:
        """Marks lines without a stop, alone at the edges of pages, and those of them that stand on at least three, and half, of a text's pages."""
        n, seen, where = len(self.page), {}, []
        for i, (page, path, flags) in enumerate(zip(self.page, self.path, self.flags)):
            alone = flags & BLOCK_START and (i + 1 == n or self.page[i + 1] != page or self.flags[i + 1] & BLOCK_START)
            if alone and flags & EDGE and not flags & SENTENCE:
                seen.setdefault(path, set()).add(page)
                where.append(i)
                self.flags[i] |= ALONE
        least = max(3, len(set(self.page)) / 2)
        for i in where:
            if len(seen[self.path[i]]) >= least:
                self.flags[i] |= REPEATED


_ARRAYS = {"page": pa.int32(), "line": pa.int32(), "path": pa.int64(), "prefix": pa.int64(), "folded": pa.int64(), "masked": pa.int64(), "flags": pa.int32(), "first": pa.int32(), "last": pa.int32(), "sentence": pa.int64(), "mask": pa.int64(), "size": pa.int32()}
_OF_LINES, _OF_SENTENCES = ("page", "line", "path", "prefix", "folded", "masked", "flags"), ("first", "last", "sentence", "mask", "size")
_SCHEMA = "pdf_id string, field string, title bigint, " + ", ".join(f"{n} array<{'bigint' if t == pa.int64() else 'int'}>" for n, t in _ARRAYS.items())


def scored(texts: DataFrame) -> DataFrame:
    """The lines and sentences of (pdf_id, field, title, pages); one compact row each, exact copies in a batch once."""

    def run(it):
        for batch in it:
            out: list[list] = [[] for _ in range(3 + len(_ARRAYS))]
            done: set[tuple] = set()
            for pdf, field, title, pages in zip(*(batch.column(i).to_pylist() for i in range(4))):
                key = (pdf, field, title, hash(tuple(pages or ())))
                if key in done:
                    continue
                done.add(key)
                lines = Lines()
                for number, text in enumerate(pages or (), 1):
                    if text:
                        lines.add_page(0 if field == "body" else number, text)
                if not lines.page:
                    continue
                lines.finish()
                values = (pdf, field, path_of(title.strip()) if title and title.strip() else None, *(getattr(lines, n) for n in _ARRAYS))
                for column, value in zip(out, values):
                    column.append(value)
            yield frame(["pdf_id", "field", "title", *_ARRAYS], out, [pa.string(), pa.string(), pa.int64(), *(pa.list_(t) for t in _ARRAYS.values())])

    return texts.select("pdf_id", "field", "title", "pages").mapInArrow(run, _SCHEMA)


class Flat:
    """The arrays of a batch's rows, end to end: ``row`` and ``srow`` tell the row of each line and sentence; lines of sentences are counted through."""

    def __init__(self, batch: pa.RecordBatch):
        get = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for name in _ARRAYS:
            setattr(self, name, get[name].flatten().to_numpy(zero_copy_only=False))
        lengths = lambda name: np.diff(get[name].offsets.to_numpy())
        lines, sentences = lengths("page"), lengths("first")
        self.start = np.concatenate([[0], np.cumsum(lines)])
        self.row, self.srow = np.repeat(np.arange(batch.num_rows), lines), np.repeat(np.arange(batch.num_rows), sentences)
        self.first, self.last = self.first + self.start[self.srow], self.last + self.start[self.srow]
        # whether the next line stands in the same block
        n = len(self.path)
        self.goes_on = np.zeros(n, bool)
        if n:
            self.goes_on[:-1] = (self.row[1:] == self.row[:-1]) & (self.page[1:] == self.page[:-1]) & (self.flags[1:] & BLOCK_START == 0)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """Sums, for each line, of its sentences' values."""
        change = np.zeros(len(self.path) + 1, np.int64)
        np.add.at(change, self.first, values)
        np.add.at(change, self.last + 1, -values)
        return np.cumsum(change[:-1])

    def within(self, mask: np.ndarray) -> np.ndarray:
        """How many of each sentence's lines the mask holds."""
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[self.last + 1] - total[self.first]


def _key(values: list) -> np.ndarray:
    """A number for each string, to tell its paths from those of others."""
    return np.array([xxhash.xxh64_intdigest(v or "") - (1 << 63) for v in values], np.int64)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _ballots(batch: pa.RecordBatch) -> tuple[list, list[np.ndarray]]:
    """(hosts, [host's place, path, documents, known, scored, boxed]) of whole documents: each path of a document's pages counts once."""
    pdfs, fields = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
    f = Flat(batch)
    mix = _key(pdfs)
    body = fields == "body"
    of_body, of_body_s = body[f.row], body[f.srow]
    kept_l, kept_s = np.unique(f.path[of_body] ^ mix[f.row[of_body]]), np.unique(f.sentence[of_body_s] ^ mix[f.srow[of_body_s]])
    there = _among(f.sentence ^ mix[f.srow], kept_s)
    # a document tells what was dropped if its body holds enough of its pages
    document = np.unique(mix, return_inverse=True)[1]
    per = lambda values: np.bincount(document[f.srow], np.where(of_body_s, 0, values), document.max(initial=-1) + 1)
    total, held = per(f.size), per(f.size * there)
    tells = (total > 0) & (held >= KEPT * total)
    absent = ~_among(f.path ^ mix[f.row], kept_l) & (f.spread(there.astype(np.int64)) == 0)
    prior = f.flags & (FURNITURE | REPEATED) != 0
    heading = f.flags & HEADING != 0
    line_scores = (absent & ~heading) | prior
    sentence_scores = (~there & (f.within(heading) == 0)) | (f.within(prior) == f.last - f.first + 1)
    # a heading of links: two dropped links follow it, and it is none of them
    link = absent & (f.flags & LINK != 0)
    follows = np.concatenate([[False], f.goes_on[:-1] & link[:-1]])
    below = np.flatnonzero(f.goes_on & (f.flags & (STOP | ITEM) == 0))
    second = np.minimum(below + 2, len(link) - 1)
    below_scores = (absent[below] & ~follows[below] & link[below + 1] & f.goes_on[below + 1] & link[second]) | (f.flags[below] & RELATED != 0)
    # what a container's place and wording say, for documents whose bodies tell nothing
    boxed = prior | (f.flags & ALONE != 0)
    sentence_boxed, below_boxed = f.within(boxed) == f.last - f.first + 1, f.flags[below] & RELATED != 0
    paths, rows, scores, boxes = [], [], [], []
    for path, row, score, box in (
        *((p, f.row, line_scores, boxed) for p in (f.path, f.folded, f.masked, f.prefix)),
        *((p, f.srow, sentence_scores, sentence_boxed) for p in (f.sentence, f.mask)),
        ((f.path[below] & ~CLASS) | BELOW, f.row[below], below_scores, below_boxed),
    ):
        some = (path != 0) & ~body[row]
        for held, values in ((paths, path), (rows, row), (scores, score), (boxes, box)):
            held.append(values[some])
    path, row, score, box = (np.concatenate(x) for x in (paths, rows, scores, boxes))
    # one ballot a document and path
    order = np.lexsort((path, document[row]))
    path, row, score, box = path[order], row[order], score[order], box[order]
    of = document[row]
    new = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (of[1:] != of[:-1])])[: len(path)])
    path, of, known = path[new], of[new], tells[of[new]]
    score, box = (np.maximum.reduceat(score, new) & known, np.maximum.reduceat(box, new)) if len(new) else (score[:0], box[:0])
    # counted by host
    names = batch.column(batch.schema.get_field_index("host")).to_pylist()
    hosts = sorted(set(names), key=lambda h: (h is None, h or ""))
    place = {h: i for i, h in enumerate(hosts)}
    host_of = np.zeros(document.max(initial=-1) + 1, np.int64)
    host_of[document] = [place[h] for h in names]
    host = host_of[of]
    order = np.lexsort((path, host))
    path, host, known, score, box = path[order], host[order], known[order], score[order], box[order]
    new = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (host[1:] != host[:-1])])[: len(path)])
    sums = lambda x: np.add.reduceat(x.astype(np.int64), new) if len(new) else np.zeros(0, np.int64)
    return hosts, [host[new], path[new], sums(np.ones(len(path))), sums(known), sums(score), sums(box)]


def ballots(placed: DataFrame) -> DataFrame:
    """(host, path, n, known, scored, boxed): partial counts of the documents' ballots, from the scored rows with their hosts."""
    names, types = ["host", "path", "n", "known", "scored", "boxed"], [pa.string(), *[pa.int64()] * 5]
    ordered = placed.repartition("pdf_id").sortWithinPartitions("pdf_id")

    def run(it):
        rest = None  # the rows of a document stay together
        for batch in it:
            table = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            last = table.column(0)[table.num_rows - 1].as_py() if table.num_rows else None
            cut = table.num_rows
            while cut and table.column(0)[cut - 1].as_py() == last:
                cut -= 1
            rest = table.slice(cut)
            if cut:
                yield counted(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield counted(rest)

    def counted(batch):
        hosts, columns = _ballots(pa.Table.from_batches([batch]).combine_chunks().to_batches()[0])
        return frame(names, [[hosts[i] for i in columns[0]], *columns[1:]], types)

    return ordered.mapInArrow(run, "host string, path bigint, n bigint, known bigint, scored bigint, boxed bigint")


def votes(placed: DataFrame, hosts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, path, strong) of the paths that win on their host, and (path, strong) of those that win among all; strong ones by their scores."""
    counts = ballots(placed).groupBy("host", "path").agg(*(F.sum(c).alias(c) for c in ("n", "known", "scored", "boxed")))
    counts = written(counts.where("n > 0"))  # both votes read it
    sizes = hosts.groupBy("host").agg(F.count_distinct("pdf_id").alias("documents"))
    expected = HOST_SHARE * F.col("documents")
    kind = F.expr(f"path & {CLASS}L")
    often = kind.isin(LINE, PREFIX, SENTENCES) & (F.col("n") >= HOST_LEAST) & (F.col("n") >= expected + 2 * F.sqrt(expected))
    boxed = ~kind.isin(MASKED, MASKED_SENTENCES) & (F.col("boxed") >= SCORED * F.col("n")) & (F.col("boxed") >= HOST_LEAST + 2 * F.sqrt(expected))
    least = F.when(kind == BELOW, ALL_LEAST).otherwise(HOST_LEAST)
    strong = kind.isin(LINE, FOLDED, PREFIX, SENTENCES, BELOW) & (F.col("known") >= least) & (F.col("scored") >= SCORED * F.col("known"))
    local = counts.join(F.broadcast(sizes.where("host IS NOT NULL")) if _few(sizes) else sizes.where("host IS NOT NULL"), "host").where(often | boxed | strong).select("host", "path", strong.alias("strong"))
    documents, all_hosts = sizes.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.count("host")).first()
    spread = counts.groupBy("path").agg(*(F.sum(c).alias(c) for c in ("n", "known", "scored")), F.count("host").alias("on_hosts"))
    often = kind.isin(LINE, PREFIX, SENTENCES) & (F.col("n") >= ALL_SHARE * documents) & (F.col("on_hosts") >= max(3, ALL_HOSTS * all_hosts))
    share = F.when(F.col("known") >= ALL_MANY, 0.5).otherwise(SCORED)
    strong = (F.col("known") >= ALL_LEAST) & (F.col("scored") >= share * F.col("known")) & (F.col("on_hosts") >= 2)
    return local, spread.where(often | strong).select("path", strong.alias("strong"))


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def decide(f: Flat, titles: np.ndarray, won: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which lines are furniture.  ``won`` tells of (paths, their rows) which win, and which of them by their scores; ``titles`` has each row's title or 0."""
    line, strong = won(f.path, f.row)
    any_form = line | won(f.folded, f.row)[0] | won(f.masked, f.row)[0]
    sentence = won(f.sentence, f.srow)[0] | won(f.mask, f.srow)[0]
    covered = f.spread(f.size * sentence)
    # a long stretch without a stop isn't one sentence; it wins whole, but stands against no line in it
    total = f.spread(f.size * (sentence | (f.size < LONG)))
    ends = (f.flags & STOP != 0) & (total > 0)  # what ends a sentence is voted on with it, unless its own form scores
    voted = (any_form & ~ends) | strong | won(f.prefix, f.row)[0] | ((total > 0) & (covered >= 0.6 * total))
    out = (f.flags & REPEATED != 0) | (voted & (f.flags & ROW == 0))
    headings = np.flatnonzero(f.goes_on & out & (f.flags & STOP == 0) & ~np.append(out[1:] & (f.flags[1:] & LINK == 0), False))
    for i in headings[won((f.path[headings] & ~CLASS) | BELOW, f.row[headings])[0]].tolist():
        run, at = [], i
        while f.goes_on[at] and f.flags[at + 1] & (LINK | SENTENCE) and not f.flags[at + 1] & ROW:
            at += 1
            run.append(at)
        # links have no stop; where running text follows, its first line may look like one of them
        text = next((k for k, j in enumerate(run) if f.flags[j] & SENTENCE and not out[j]), None)
        for k, j in enumerate(run if text is None else run[:text]):
            if f.flags[j] & ITEM or (f.flags[j] & HEADLINE and (text is None or k < text - 1)):
                out[j] = True
    return out & ((titles[f.row] == 0) | (f.path != titles[f.row]))


def furniture(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """(pdf_id, field, page_no, line_no) of the lines that aren't the article's own."""
    spark = rows.sparkSession
    placed = rows.join(hosts, "pdf_id", "left")
    local, everywhere = votes(placed, hosts)
    local, everywhere = written(local), written(everywhere)
    names, types = ["pdf_id", "field", "page_no", "line_no"], [pa.string(), pa.string(), pa.int32(), pa.int32()]

    def extracted(batch, won_of):
        f = Flat(batch)
        get = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        titles = get["title"].fill_null(0).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(decide(f, titles, won_of(get)))
        row = pa.array(f.row[hit])
        return pa.RecordBatch.from_arrays([get["pdf_id"].take(row), get["field"].take(row), pa.array(f.page[hit], types[2]), pa.array(f.line[hit], types[3])], names=names)

    schema = "pdf_id string, field string, page_no int, line_no int"
    if _few(local) and _few(everywhere):
        here, there = local.toArrow(), everywhere.toArrow()  # at most BROADCAST_ROWS each
        mine = here["path"].to_numpy() ^ _key(here["host"].to_pylist())
        sent = spark.sparkContext.broadcast(tuple(np.sort(x) for x in (mine, mine[here["strong"].to_numpy()], there["path"].to_numpy(), there["path"].to_numpy()[there["strong"].to_numpy()])))

        def run(it):
            mine, mine_strong, common, common_strong = sent.value
            for batch in it:
                def won_of(get):
                    host = _key(get["host"].to_pylist())
                    return lambda paths, row: ((paths != 0) & (_among(paths, common) | _among(paths ^ host[row], mine)), (paths != 0) & (_among(paths, common_strong) | _among(paths ^ host[row], mine_strong)))

                yield extracted(batch, won_of)

        return placed.select("pdf_id", "field", "title", "host", *_ARRAYS).mapInArrow(run, schema)

    salt = F.pmod(F.xxhash64("pdf_id"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    below = F.transform("path", lambda p: p.bitwiseAND(F.lit(~CLASS)).bitwiseOR(F.lit(BELOW)))
    forms = placed.select("pdf_id", "host", salt.alias("salt"), F.explode(F.array_distinct(F.concat("path", "prefix", "folded", "masked", "sentence", "mask", below))).alias("path")).where("path <> 0").distinct()
    # Spark takes the salted winners for as small as their files, and would send SALTS rows for each through the driver
    of_all = forms.join(everywhere.select("path", "strong", salts).hint("merge"), ["path", "salt"]).select("pdf_id", "path", "strong")
    of_host = forms.join(local.select("host", "path", "strong", salts).hint("merge"), ["host", "path", "salt"]).select("pdf_id", "path", "strong")
    own = of_all.union(of_host).groupBy("pdf_id", "path").agg(F.max("strong").alias("strong"))
    own = own.groupBy("pdf_id").agg(F.collect_list("path").alias("won"), F.collect_list(F.when(F.col("strong"), F.col("path"))).alias("strong"))  # bounded: the document's own paths

    def run_joined(it):
        for batch in it:
            def won_of(get):
                document = _key(get["pdf_id"].to_pylist())
                keys = [np.sort(get[name].flatten().to_numpy(zero_copy_only=False) ^ np.repeat(document[np.asarray(get[name].is_valid())], np.diff(get[name].drop_null().offsets.to_numpy()))) for name in ("won", "strong")]
                return lambda paths, row: tuple((paths != 0) & _among(paths ^ document[row], k) for k in keys)

            yield extracted(batch, won_of)

    return placed.join(own, "pdf_id", "left").select("pdf_id", "field", "title", "won", "strong", *_ARRAYS).mapInArrow(run_joined, schema)


def hosts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "source_docs").where("pdf_id IS NOT NULL").groupBy("pdf_id").agg(F.min("source").alias("host"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored containers of all pages and bodies; the title of pages comes by their id."""
    clean = read(spark, sf_dir, "clean_out")
    pages = read(spark, sf_dir, "extract_out").where("pages IS NOT NULL").select("pdf_id", F.lit("pages").alias("field"), F.lit(None).cast("string").alias("title"), "pages")
    bodies = clean.where("body IS NOT NULL AND body <> ''").select("pdf_id", F.lit("body").alias("field"), "title", F.array("body").alias("pages"))
    return written(scored(pages.unionByName(bodies)))  # the vote and the extraction read it again


def _furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_lines(spark, sf_dir)
    titles = rows.where("field = 'body' AND title IS NOT NULL").groupBy("pdf_id").agg(F.min("title").alias("known"))
    return furniture(rows.join(titles, "pdf_id", "left").withColumn("title", F.coalesce("title", "known")).drop("known"), hosts_of(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages and bodies that aren't the article's own."""
    return _furniture(spark, sf_dir).distinct()
