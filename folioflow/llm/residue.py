"""Problem 4: unfilled template fields, filler, error messages and script notices in place of content.

Placeholders are told by a grammar for each delimiter: what stands between the
delimiters must be a field name, so expressions, lookups and format letters that
articles write about don't match.  A match counts less where the surroundings are
a code block, a line of code, a quotation or the words of a tutorial, and less
again the more of its kind the text only shows; what is left must reach STANDS.

Messages are told by a grammar of slots, not by their wording: a sentence, or a
line standing alone, that addresses a visitor, asks for something, names a thing
of the web and says what is wrong with it.  Three filled slots make a message;
reports about one, quotations and names of others count against it.  Filler is
told alike, Latin filler by the density of its words in a sentence.

Defined cases: null and empty bodies are no cases; a body with several kinds is
one row; rows repeated in the table give one result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, read, strings, texts_of

_NAME = r"[A-Za-z][A-Za-z]*(?:[._][A-Za-z]+|[A-Za-z0-9])*"
_FIELD = rf"(?:{_NAME}){{1}}"

#: delimiter -> its grammar; each alternative is one way to write an unfilled field
GRAMMARS: dict[str, re.Pattern] = {
    name: re.compile(pattern)
    for name, pattern in {
        "double_brace": rf"\{{\{{-?\s*{_FIELD}(?:\s*\|\s*[\w ]+(?:\([^()\n]*\))?)*\s*-?\}}\}}",
        "block_tag": rf"\{{%-?\s*(?:block|if|for|include|extends|end\w+)\b[^%{{}}\n]{{0,60}}-?%\}}",
        "dollar_brace": rf"\$\{{\s*{_FIELD}\s*\}}",
        "hash_brace": rf"#\{{\s*{_FIELD}\s*\}}",
        "single_brace": rf"(?<![\w{{$#%)\]}}=:.]){{(?!return\b|break\b|continue\b){_NAME}}}(?![}}\w])",
        "scriptlet": rf"<%[=\-]?\s*{_FIELD}\s*-?%>",
        "double_angle": rf"<<\s*{_FIELD}\s*>>",
        "angle_words": r"<(?:Name|Insert|Your|Enter|Add|Title|Date)(?: (?:of|your|the|name|here))* [\w. ]{2,40}>",
        "double_square": rf"\[\[\s*{_FIELD}\s*\]\]",
        "square_words": r"\[(?:INSERT|Insert|ADD|Add|ENTER|Enter|Your|YOUR|TBC|TBD|TODO)(?: [\w. ]{2,40})?\]|\[[\w. ]{2,40} (?:EINFÜGEN|einfügen|HERE|here|ICI|ici|AQUÍ|aquí|goes here)\]",
        "percent": rf"(?<![\w%])%{_NAME}%(?!\w)",
        "at_signs": rf"@@{_NAME}@@",
        "underscores": rf"(?<![\w.])__(?!(?:init|main|name|file|all|doc|dict|class|call|new|del|repr|str|len|eq|hash|version|future)__){_NAME}__(?![\w.(])",
        "crosses": r"\bX{3,}\b[^\n]{0,40}\bto be (?:added|confirmed|completed|filled)",
        "to_be": r"(?m)^(?:TODO|TBD|FIXME)\b|\bTBD before\b",
        "own_text": r"\b(?:Votre texte ici|Ihr Text hier|Su texto aquí|Your text here)\b",
        "unset_value": rf"\bYour {_NAME} is (?:NaN|undefined|null|None)\b|\bWelcome(?: back)?, (?:undefined|null|None|\[object Object\])|\[object Object\]",
    }.items()
}

_STARTS = re.compile(r"\A[ \t]*|\n[ \t]*|[.!?。:…][ \t]+")
_BLANK = re.compile(r"\n\s*\n")


def _any(*parts: str) -> re.Pattern:
    return re.compile("|".join(parts), re.I)


# The slots of a message to a visitor: small classes of words, in the languages of the web pages at hand.
VISITOR = _any(r"\b(?:you|your|requested|vous|votre|demandée?|usted|su navegador|solicitad[oa]|seu|sua|uw|tuo|вы|вас|ваш\w*|запрашиваем\w*|angeforderte\w*|gewünschte\w*)\b", r"(?-i:\b(?:Sie|Ihre?[nmrs]?)\b)", "[您你]|请求的|あなた|お使い|आपक?|คุณ")
WE = _any(r"\b(?:we|our|wir|unser\w*|nous|notre|nuestr[oa]s?|мы|наш\w*)\b", "我们|当社")
ASK = _any(
    r"^\W*(?:(?:sorry|to (?:continue|go on|proceed)|then),?\s+)?(?:please|enable|activate|allow|turn|switch|verify|confirm|complete|check|return|go back|try|contact|reload|refresh|press|click|sign|log|wait|update|upgrade|accept|solve|bitte|aktivieren|erlauben|veuillez|merci de|activez|activer|autorisez|por favor|active|activar|habilite|permita|ative|ativar|attiva|attivare|abilita|schakel|activeer|пожалуйста|включите|разрешите)\b",
    r"(?:[,:;] (?:then |so )?|\band |\bor )(?:complete|press|allow|reload|refresh|sign in|log in|try again)\b", "请|启用|开启|打开|ください|有効に|يرجى|الرجاء|कृपया|กรุณา|โปรด",
)
SCRIPT = _any(r"\b(?:java ?script|scripts?|cookies?|captcha|ad ?block\w*|skripte?|скрипт\w*)\b", "脚本|スクリプト|جافا|जावास्क्रिप्ट")
PLACE = _any(
    r"\b(?:page|site|website|server|upstream|origin|browser|requests?|session|link|address|url|connection|database|resource|content|application|app|seite|anfrage|sitzung|inhalte?|lien|demande|navigateur|contenu|serveur|página|pagina|enlace|solicitud|navegador|servidor|contenido|conteúdo|collegamento|richiesta|страниц\w*|ссылк\w*|запрос\w*|сервер\w*|браузер\w*)\b",
    "页面|网页|网站|链接|服务器|浏览器|ページ|サイト|リンク|サーバー|ブラウザ|صفحة|الرابط|المتصفح|पृष्ठ|पेज|ลิงก์|เบราว์เซอร์|หน้า",
)
FAULT = _any(
    r"\b(?:could|can|was|were|is|are)(?: not|n['’]t|not) (?:be )?(?:found|opened|completed|processed|loaded|displayed|reached|available|supported|shown|verified|authori[sz]ed|permitted)\b", r"\bnot found\b", r"\bno longer (?:exists?|available)\b", r"\bdo(?:es)?(?: not|n['’]t) (?:exist|support|have permission)\b",
    r"\bdid not (?:answer|respond|reply)\b", r"\b(?:unavailable|forbidden)\b", r"\bexpired\b", r"\btimed? ?out\b", r"\b(?:has|have) been (?:blocked|removed|moved|deleted|suspended|told|logged|notified|informed)\b", r"\bmay be broken\b", r"\bpermission\b", r"\btoo many\b", r"\b(?:switched|turned) off\b", r"\bdisabled\b", r"\bout of date\b",
    r"\b(?:planned work|maintenance|be back (?:soon|shortly)|mistake|problem|unexpected)\b", r"\bnicht (?:gefunden|verfügbar)\b", r"\b(?:abgelaufen|verweigert|introuvable|indisponible|refusée?|expirée?|caducad[oa]|denegado)\b", r"\bn['’]existe\b", r"\b(?:no|não) (?:existe|encontrad[oa]|se pudo|se encontró|foi)\b", r"\bnon (?:trovat[oa]|esiste|disponibile)\b", r"\b(?:niet gevonden|bestaat niet)\b",
    r"\bне (?:найден\w*|существует)\b", r"\bнедоступ\w*", "不存在|未找到|找不到|无法|过期|拒绝|見つかりません|存在しません|表示できません|غير موجود|غير متاح|لم يتم العثور|नहीं मिला|ไม่พบ|ไม่สามารถ",
)
GRAVE = _any(r"\bsomething went wrong\b", r"\berror (?:has )?occurred\b", r"\bserver error\b", r"\baccess (?:is |was )?denied\b")
CHECKED = _any(r"\b(?:are you|you are|you're) (?:not )?a (?:human|robot|bot)\b", r"\bsecurity check\b", r"\bone more step\b", r"\bchecking (?:your|if|the site)\b", r"\bloading\b", r"\bplease wait\b", r"\bjust a moment\b")
NEED = _any(
    r"\b(?:needs?|must|requires?|required|has to|have to|before (?:you|this|we))\b", r"\bto (?:continue|proceed|go on|view|display|see|run|work|access|load)\b", r"\bpour (?:continuer|afficher|voir|accéder)\b", r"\bpara (?:continuar|ver|acceder|acessar)\b", r"\bper (?:continuare|vedere)\b", r"\bum (?:fortzufahren|diese)\b", r"\bom (?:door|verder|deze)\b", r"\bчтобы\b", "才能|以继续|続行|لمتابعة|जारी",
)
NOW = _any(r"\b(?:again|once more|at this time|in a short time|in time|shortly|later|below|start page|home ?page|search box)\b", r"\b(?:sofort|später|plus tard|más tarde|позже)\b", "稍后|再試行")
EXCLAIMED = _any(r"^\W*(?:oops|whoops|sorry|uh-oh|ups|désolée?|lo sentimos|entschuldigung|ой|извините)\b", "^(?:抱歉|申し訳)")
CODED = re.compile(
    r"(?:(?:HTTP|[Ss]tatus|(?:HTTP )?(?i:error|code)|Fehler|Erreur|Erro|Errore|Fout|Ошибка|错误|エラー|خطأ|Oops|Whoops|Sorry)[ :#!(/-]{0,4}(?:(?:status|error|code)[ :#(-]{0,3})?[45]\d\d\b|"
    r"[45]\d\d (?:- |: )?(?:Not Found|Forbidden|Unauthorized|Bad Gateway|Bad Request|Service Unavailable|Gateway Time-?out|Internal Server Error|Too Many Requests|Gone)\b|"
    r"(?:Ray|Request|Reference|Incident|Trace|Support|Correlation) (?:ID|[Nn]umber|[Cc]ode)\W{1,4}[0-9a-f-]{6,})"
)

# The slots of filler.
FILL = _any(r"\b(?:replace|edit|delete|insert|type|write|add|put|enter|fill|vul|ersetzen|steht|remplacez|saisissez|insérez|escriba|inserte|insira|digite|введите|вставьте|замените)\b", "输入|替换|入力|أدخل|اكتب|दर्ज")
TEXT = _any(r"\b(?:texte?|texto|testo|tekst|paragraph|words|content|description|headline|caption|post|page|absatz|текст)\b", "文字|文本|テキスト|نص|पाठ|ข้อความ")
HERE = _any(r"\b(?:here|hier|ici|aqu[íi]|здесь|сюда)\b", "此处|在此|这里|ここ|هنا|यहाँ|ที่นี่")
SAMPLE = _any(r"\b(?:sample|dummy|placeholder|untitled|beispiel\w*|d'exemple|de ejemplo|de exemplo|voorbeeld\w*|пример\w*)\b", "示例|サンプル|نموذج|नमूना")
BEGIN = _any(r"\b(?:your own|start writing|goes here|get started|under construction|coming soon)\b", r"^\W*this is an? ")

#: banners that ask for consent are furniture of the page, not messages in place of content
CONSENT = _any(r"\b(?:uses?|stores?|agree|consent|help us)\b[^.]{0,40}\b(?:cookies|small files|tracking)\b", r"\bcookies help\b")
#: what tells a report about a message from the message
REPORTED = _any(
    r"\b(?:said|told|says|asks?|(?<!you )asked|showed|shows|saw|reported|warned|noticed|copi(?:es|ed)|wrote|described|claims?|claimed|denied|called|(?<!be )(?<!not )found|hid|sent out|pretend\w*|imitat\w*|fake)\b", r"\b(?:visitors?|attackers?|victims?|researchers?|people|customers?|users|lure|kit|gang|crew|phishing|employees|staff|readers)\b",
)
_ENGLISH = re.compile(r"\b(?:the|to|of|and|you|your|this|is|are|has|have|a)\b", re.I)
_NAMED = re.compile(r"(?<=[a-z,;] )(?!Continue|JavaScript|Javascript|HTTP|Accept|Allow|OK|I\b)[A-Z][a-z]+\w*")
MOST_WORDS = 30


def message(unit: str, lone: bool = False) -> str | None:
    """Whether a sentence or line is an error, a notice or filler, by how many slots of such a message it fills; reports, quotations and names count against it."""
    unit, quoted = _QUOTED.subn(" ", unit)
    words = len(unit.split())
    if words > MOST_WORDS:
        return None
    against = 2 * bool(REPORTED.search(unit)) + 2 * quoted + 3 * bool(CONSENT.search(unit))
    if words > 3 and _ENGLISH.search(unit):
        against += min(2, len(_NAMED.findall(unit)))
    few = lambda p, most=2: min(most, len({m.group().lower() for m in p.finditer(unit)}))
    visitor = bool(VISITOR.search(unit))
    fill, text = few(FILL), bool(TEXT.search(unit))
    filler = fill + text + bool(HERE.search(unit)) + bool(SAMPLE.search(unit)) + bool(BEGIN.search(unit)) + (visitor and fill + text > 0) + (words <= 3 and bool(SAMPLE.search(unit)))
    if filler - against >= 3 and words <= 14:
        return "filler"
    script, place, fault, need = few(SCRIPT), few(PLACE), few(FAULT), bool(NEED.search(unit))
    grave, checked = 2 * bool(GRAVE.search(unit)), 2 * bool(CHECKED.search(unit))
    asked = few(ASK)
    score = visitor + asked + bool(WE.search(unit)) + bool(EXCLAIMED.search(unit)) + bool(NOW.search(unit)) + script + place + fault + grave + checked + need + (lone and words <= 6 and grave > 0) + (words <= 4 and place > 0 and fault > 0)
    if score - against < 3 or not (script or place or fault or grave or checked):
        return None
    if not (visitor or asked or fault or grave or checked or need):
        return None
    return "notice" if script or (checked and not fault) else "error"



#: words of which a unit has at least one to be looked at closer; signs of scripts without spaces are searched as such
_ANCHORS = frozenset(
    word + mark
    for word in "you your yours we our please sorry oops whoops javascript cookie cookies captcha script scripts expired unavailable denied forbidden blocked broken removed timeout maintenance permission requested loading wait shortly mistake wrong error human robot found respond answer return connection opened upstream address"
    "here sample dummy placeholder untitled replace writing coming construction bitte sie ihr ihrem ihren seite veuillez vous votre ici demandée existe usted aquí favor aqui seu sua conteúdo continuar continuer página lien enlace hier uw tekst qui attiva attivare ativar ative habilite schakel activeer gefunden introuvable пожалуйста включите найдена найден вы ваш ваша здесь страница beispieltext voorbeeldtekst n'existe n’existe you're".split()
    for mark in ("", ".", ",", ":", ";", "!", "?", "...", "…")
)
_SIGNS = re.compile("[请您你]|启用|不存在|未找到|无法|此处|在此|ください|有効に|見つかり|存在しません|表示できません|ここ|يرجى|الرجاء|غير موجود|هنا|कृपया|नहीं मिला|यहाँ|กรุณา|โปรด|ไม่พบ|ที่นี่")
_FAR = re.compile("[\u0600-\u1fff\u3000-\uffff]")
_STOPS = re.compile(r"(?<=[.!?。！？।؟…])[\"'”’»)\]]*\s+|(?<=[。！？])")
_ENDED = re.compile(r"[.!?:。！？।؟…][\"'”’»)\]]*$")
_QUOTED = re.compile(r"[\"“«「„‘`][^\"”»」’`\n]{6,}[\"”»」’`]")


def message_units(text: str):
    """(sentence or line standing alone, whether it is a whole line) of a text; wrapped lines are joined."""
    for block in _BLANK.split(text):
        lines = [x.strip() for x in block.split("\n")]
        widest, run = max(map(len, lines)), []
        for i, line in enumerate(lines):
            run.append(line)
            if i + 1 < len(lines) and len(line) >= 0.7 * widest and len(lines[i + 1]) > 0 and not _ENDED.search(line) and widest >= 40:
                continue
            parts = [p for p in _STOPS.split(" ".join(run)) if p and p.strip()]
            for part in parts:
                yield part.strip(), len(parts) == 1
            run = []


def _anchored(text: str) -> bool:
    return not _ANCHORS.isdisjoint(text.lower().split()) or (not text.isascii() and _FAR.search(text) is not None and _SIGNS.search(text) is not None)


def messages(text: str) -> tuple[set[str], int]:
    """(kinds of messages shown, characters of the units that show them)."""
    found, size = set(), 0
    if not _anchored(text):
        return found, size
    for unit, lone in message_units(_FENCE.sub("\n\n", text) if "```" in text or "~~~" in text else text):
        if len(unit) > 400 or not _anchored(unit):
            continue
        kind = message(unit, lone)
        if kind and not (kind == "filler" and GRAMMARS["own_text"].search(unit)):  # that is a placeholder
            found.add(kind)
            size += len(unit)
    return found, size


_LATIN = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum donec fusce nunc vitae turpis massa orci nibh felis mauris lacus risus erat semper quam porta ligula pretium cursus congue quisque praesent vestibulum curabitur pellentesque".split())
_LATIN_RARE = _LATIN - frozenset("in do ex ad id est et non esse sit ut sed a".split())
_SENTENCE = re.compile(r"[.!?]\s+|\n\s*\n")

_FENCE = re.compile(r"```.*?```|~~~.*?~~~", re.S)
_CODE_LINE = re.compile(r"^\s*(?:function|var|let|const|return|import|def|class|public|private|void|printf|echo)\b.*[{};=]|\bfunction\s*\(|=>|;\s*$|^\s*[.#]?[\w-]+(?:>[\w-]+)?\s*\{.*[:;].*\}|^\s{4,}\S+\s*[=({]")
_TUTORIAL = re.compile(r"\b(?:syntax|tutorial|snippet|for example|such as|looks? like|test string|format string|literal|macro|request holding|treats?|expands?)\b", re.I)
_QUOTES = "\"'`“”‘’«»「」"

_ANY_FIELD = re.compile(r"\{|<%|<<|<[A-Z]|\[|%[A-Za-z]|@@|__|\bX{3}|TODO|TBD|FIXME|texte ici|Text hier|texto aquí|text here|NaN|undefined|\bnull\b|\[object")


def _weight(text: str, start: int, end: int, fences: list[tuple[int, int]]) -> float:
    """1 for a match in prose; less for each sign that the text only shows or explains it."""
    if any(a <= start < b for a, b in fences):
        return 0.0
    line_start, line_end = text.rfind("\n", 0, start) + 1, text.find("\n", end)
    line = text[line_start : line_end if line_end >= 0 else len(text)]
    weight = 1.0
    if _CODE_LINE.search(line[: start - line_start] + line[end - line_start :]):
        weight -= 0.6
    if start and end < len(text) and text[start - 1] in _QUOTES and text[end] in _QUOTES:
        weight -= 0.6
    if _TUTORIAL.search(text, max(0, start - 60, text.rfind(". ", 0, start), line_start), start):
        weight -= 0.4
    letters = sum(c.isalnum() or c.isspace() for c in line)
    if letters < 0.6 * len(line):
        weight -= 0.6  # noise: delimiters everywhere
    return weight


#: part of a match's weight that is lost if all matches of its grammar in the text are only shown, and what must be left
SHOWN_DISCOUNT, STANDS = 0.5, 0.75


def placeholders(text: str) -> tuple[list[str], int]:
    """(grammars of which a match stands, characters of the matches that stand).

    A text that mostly shows fields of a kind, in code, quotations or a tutorial, is about them: what part of the
    matches is shown is taken off the weight of each.
    """
    if not _ANY_FIELD.search(text):
        return [], 0
    fences = [m.span() for m in _FENCE.finditer(text)] if "```" in text or "~~~" in text else []
    found, size = [], 0
    for name, grammar in GRAMMARS.items():
        matches = [(m.end() - m.start(), _weight(text, m.start(), m.end(), fences)) for m in grammar.finditer(text)]
        if matches:
            shown = sum(w < 1 for _, w in matches) / len(matches)
            standing = [n for n, w in matches if w - SHOWN_DISCOUNT * shown >= STANDS]
            if standing:
                found.append(name)
                size += sum(standing)
    return found, size


def latin_filler(text: str) -> int:
    """Characters of the sentences that consist of the words of the usual Latin filler."""
    size = 0
    if len(_LATIN_RARE.intersection(text.lower().split())) >= 2:
        for sentence in _SENTENCE.split(text):
            words = [w.lower() for w in re.findall(r"[^\W\d_]+", sentence)]
            if len(words) >= 5 and sum(w in _LATIN for w in words) >= 0.8 * len(words) and sum(w in _LATIN_RARE for w in words) >= 3:
                size += len(sentence)
    return size


def measure(text: str | None) -> tuple[list[str], float]:
    """(which of placeholder, filler, error and notice a text shows, share of its characters that do)."""
    if not text or not text.strip():
        return [], 0.0
    found, size = messages(text)
    fields, more = placeholders(text)
    if fields:
        found.add("placeholder")
    if latin := latin_filler(text):
        found.add("filler")
    coded = sum(len(m.group()) for at in _STARTS.finditer(text) if (m := CODED.match(text, at.end())))
    if coded:
        found.add("error")
    return [k for k in ("placeholder", "filler", "error", "notice") if k in found], min(1.0, (size + more + latin + coded) / len(text))


def kinds(text: str | None) -> list[str]:
    return measure(text)[0]


def residue(texts: DataFrame, key: str = "pdf_id") -> DataFrame:
    """(key, kinds, density) of the texts that show any residue."""

    def run(it):
        for batch in it:
            rows = [(k, ",".join(found), density) for k, t in zip(strings(batch, key), strings(batch, "text")) for found, density in [measure(t)] if found]
            yield frame([key, "kinds", "density"], list(zip(*rows)) or [[], [], []], [pa.string(), pa.string(), pa.float64()])

    return texts.select(key, "text").mapInArrow(run, f"{key} string, kinds string, density double")


def _residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(texts_of(read(spark, sf_dir, "clean_out"), ["pdf_id"], "body")).distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with residue in place of content."""
    return _residue(spark, sf_dir).select("pdf_id").distinct()


def p4_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the old validation said about the bodies with residue, and how much of them is residue."""
    old = read(spark, sf_dir, "validate_out").groupBy("pdf_id").agg(F.min("status").alias("old_status"), F.min("reason").alias("old_reason"))
    counts = _residue(spark, sf_dir).join(old, "pdf_id", "left").groupBy("kinds", "old_status", "old_reason").agg(F.count(F.lit(1)).alias("records"), F.round(F.avg("density"), 4).alias("mean_density"))
    return counts
